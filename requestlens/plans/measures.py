"""Dashboard measures over the fact: grouped aggregates for any list of slicer columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.functions.numeric import fraction, percent
from requestlens.operators.quantiles import aggregate_with_quantile
from requestlens.plans.marts import last_days


def _closed() -> Column:
    return F.col("status") == "Closed"


def _open() -> Column:
    return F.col("status") == "Open"


def _met() -> Column:
    return F.count_if(F.col("sla_compliant"))


def _missed() -> Column:
    return F.count_if(~F.col("sla_compliant"))


def positive_resolution() -> Column:
    return F.when(F.col("resolution_days") > 0, F.col("resolution_days"))


MEASURES: dict[str, Callable[[], Column]] = {
    "total_requests": lambda: F.count("*"),
    "closed_requests": lambda: F.count_if(_closed()),
    "open_requests": lambda: F.count_if(_open()),
    "avg_resolution_days": lambda: F.avg(positive_resolution()),
    "sla_compliant_count": _met,
    "sla_breached_count": _missed,
    "sla_compliance": lambda: fraction(_met(), _met() + _missed()),
    "sla_breach_rate": lambda: fraction(_missed(), _met() + _missed()),
    "sla_compliance_pct": lambda: percent(_met(), F.count("sla_compliant")),
    "avg_open_request_age": lambda: F.avg(F.when(_open(), F.col("open_request_age_days"))),
    "open_over_30_days": lambda: F.count_if(_open() & (F.col("open_request_age_days") > 30)),
    "requests_with_coords": lambda: F.count_if("has_coordinates"),
    "coordinate_coverage": lambda: fraction(F.count_if("has_coordinates"), F.count("*")),
    "emergency_rate_pct": lambda: percent(F.count_if("is_emergency"), F.count("*")),
}


def measure(fact: DataFrame, names: Sequence[str], by: Sequence[str | Column] = ()) -> DataFrame:
    """Any of the measures together, in one aggregate."""
    return fact.groupBy(*by).agg(*[MEASURES[name]().alias(name) for name in names])


def resolution_measures(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average and exact median over rows with a positive resolution time. ``fact`` should be a stored table."""
    rows = fact.withColumn("_positive", positive_resolution())
    columns = [MEASURES["avg_resolution_days"]().alias("avg_resolution_days")]
    return aggregate_with_quantile(rows, by, columns, "_positive", "median_resolution_days")


def compliance_all_except(fact: DataFrame, keep: str, by: Sequence[str]) -> DataFrame:
    """Compliance of each fine group beside that of its ``keep`` value over all other slicers."""
    fine = measure(fact, ["sla_compliant_count", "sla_breached_count", "sla_compliance"], [keep, *by])
    whole = Window.partitionBy(keep)
    met, missed = F.sum("sla_compliant_count").over(whole), F.sum("sla_breached_count").over(whole)
    return fine.withColumn(f"sla_compliance_by_{keep}", fraction(met, met + missed))


def _bucket_condition(low: float | None, high: float | None) -> Column:
    age = F.col("open_request_age_days")
    condition = _open()
    if low is not None:
        condition = condition & (age > low)
    return condition & (age <= high) if high is not None else condition


def aging_buckets(fact: DataFrame, by: Sequence[str] = ("agency_key",), edges: Sequence[int] = tuple(V.AGE_BUCKET_EDGES)) -> DataFrame:
    """Open requests per age bucket, one column each."""
    bounds = list(zip([None, *edges], [*edges, None]))
    columns = []
    for low, high in bounds:
        name = f"open_{0 if low is None else low + 1}_{high}" if high is not None else f"open_over_{low}"
        columns.append(F.count_if(_bucket_condition(low, high)).alias(name))
    return fact.groupBy(*by).agg(*columns, F.count_if(_open()).alias("open_requests"))


def adjusted_compliance(fact: DataFrame, targets: Sequence[int] = (30,), by: Sequence[str] = ()) -> DataFrame:
    """Share of closed requests resolved within each what-if target; all targets share one aggregate."""
    counted = fact.groupBy(*by).agg(
        F.count_if(_closed()).alias("closed_requests"),
        *[F.count_if(_closed() & (F.col("resolution_days") <= target)).alias(f"_t{target}") for target in targets],
    )
    entries = [
        F.struct(F.lit(target).alias("target_days"), F.col(f"_t{target}").alias("adjusted_compliant")) for target in targets
    ]
    listed = counted.select(*by, "closed_requests", F.inline(F.array(*entries)))
    return listed.withColumn("adjusted_compliance", fraction(F.col("adjusted_compliant"), F.col("closed_requests")))


def kpi_rollup(fact: DataFrame, path: Sequence[str], target: float = V.SLA_TARGET_FRACTION) -> DataFrame:
    """Compliance against the target at every level of a drill path.

    Rows are counted at the finest level first; the rollup then expands those few groups instead of the fact.
    """
    fine = measure(fact, ["total_requests", "sla_compliant_count", "sla_breached_count"], path)
    rolled = fine.rollup(*path).agg(
        F.grouping_id().cast("int").alias("level_mask"),
        F.sum("total_requests").alias("total_requests"),
        F.sum("sla_compliant_count").alias("sla_compliant_count"),
        F.sum("sla_breached_count").alias("sla_breached_count"),
    )
    met = F.col("sla_compliant_count")
    rolled = rolled.withColumn("sla_compliance", fraction(met, met + F.col("sla_breached_count")))
    return rolled.withColumn("on_target", F.col("sla_compliance") >= target)


GRAINS = {"day": "DAY", "week": "WEEK", "month": "MONTH"}


def period(grain: str, day: str = "created_date_key") -> Column:
    return F.col(day) if grain == "day" else F.trunc(day, GRAINS[grain])


def volume_trend(fact: DataFrame, grain: str, legend: str) -> DataFrame:
    """Requests per period and legend value with the same period of the year before and the growth."""
    counts = measure(fact, ["total_requests"], [period(grain).alias("period"), legend])
    earlier = counts.select(
        F.col("period").alias("_period"), F.col(legend).alias("_legend"), F.col("total_requests").alias("requests_py")
    )
    # Weeks have no calendar twin: compare with the Monday 52 weeks before.
    twin = F.date_sub("period", 364) if grain == "week" else F.add_months("period", -12)
    joined = counts.join(earlier, (F.col("_period") == twin) & F.col("_legend").eqNullSafe(F.col(legend)), "left")
    current, before = F.col("total_requests"), F.col("requests_py")
    return joined.drop("_period", "_legend").withColumn("yoy_growth", fraction(current - before, before))


def agency_table(fact: DataFrame) -> DataFrame:
    names = ["total_requests", "avg_resolution_days", "sla_compliance", "open_over_30_days", "emergency_rate_pct"]
    return measure(fact, names, ["agency_key"])


def geo_by(fact: DataFrame, area: str) -> DataFrame:
    """Located requests per area value."""
    return measure(fact.where("has_coordinates"), ["total_requests", "sla_compliance"], [area])


def geo_cells(fact: DataFrame, cells_per_degree: int = 100) -> DataFrame:
    """Located requests per square cell; cells are numbered by the integer part of degrees times ``cells_per_degree``."""
    def cell(column: str) -> Column:
        return F.floor(F.round(F.col(column) * cells_per_degree, 6)).cast("int").alias(f"{column}_cell")

    located = fact.where("has_coordinates")
    return measure(located, ["total_requests", "sla_compliance"], [cell("latitude"), cell("longitude")])


def compliance_trend(fact: DataFrame, slicer: str, grain: str = "month") -> DataFrame:
    return measure(fact, ["total_requests", "sla_compliance_pct"], [period(grain).alias("period"), slicer])


def top_complaints(fact: DataFrame, limit: int = 10, days: int | None = None) -> DataFrame:
    """The most frequent complaint types, optionally of the last days only."""
    rows = fact if days is None else last_days(fact, days)
    names = ["total_requests", "sla_compliance_pct", "sla_breach_rate", "avg_resolution_days"]
    ranked = measure(rows, names, ["complaint_type"]).orderBy(F.desc("total_requests"), F.asc("complaint_type"))
    return ranked.limit(limit)
