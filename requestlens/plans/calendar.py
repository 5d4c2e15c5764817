"""Time intelligence on daily counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from requestlens.functions.numeric import fraction
from requestlens.plans.fact import MONTH
from requestlens.plans.marts import newest_month

TO_DATE_SPANS = {"mtd": ["year", "month"], "qtd": ["year", "quarter"], "ytd": ["year"]}


def daily_volume(fact: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests per created day; every window below runs on these rows, never on the fact."""
    return fact.groupBy(F.col("created_date_key").alias("date_key"), *by).agg(F.count("*").alias("total_requests"))


def on_calendar(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """Daily counts on every calendar day, zero where there are none."""
    joined = dates.select("date_key", "year", "quarter", "month").join(daily, "date_key", "left")
    return joined.withColumn("total_requests", F.coalesce("total_requests", F.lit(0)))


def to_date_total(days: DataFrame, span: str, by: Sequence[str] = ()) -> DataFrame:
    """Running total since the start of the month, quarter or year."""
    window = Window.partitionBy(*TO_DATE_SPANS[span], *by).orderBy("date_key")
    running = F.sum("total_requests").over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.withColumn(f"requests_{span}", running)


def prior_year(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The count of the same day one year before (29 February falls back to the 28th) and the growth."""
    earlier = daily.select(
        F.col("date_key").alias("_day"), *[F.col(c).alias(f"_{c}") for c in by], F.col("total_requests").alias("requests_py")
    )
    match = F.col("_day") == F.add_months("date_key", -12)
    for column in by:
        match = match & F.col(column).eqNullSafe(F.col(f"_{column}"))
    joined = daily.join(earlier, match, "left").drop("_day", *[f"_{c}" for c in by])
    growth = fraction(F.col("total_requests") - F.col("requests_py"), F.col("requests_py"))
    return joined.withColumn("yoy_growth", growth)


def monthly_prior_year(daily: DataFrame) -> DataFrame:
    """Month totals, those of the same month one year before, and the growth."""
    months = daily.groupBy(F.year("date_key").alias("year"), F.month("date_key").alias("month")).agg(
        F.sum("total_requests").alias("total_requests")
    )
    earlier = months.select((F.col("year") + 1).alias("year"), "month", F.col("total_requests").alias("requests_py"))
    joined = months.join(earlier, ["year", "month"], "left")
    return joined.withColumn("yoy_growth", fraction(F.col("total_requests") - F.col("requests_py"), F.col("requests_py")))


def rolling_average(daily: DataFrame, days: int = 7, by: Sequence[str] = (), zero_fill: bool = False) -> DataFrame:
    """Mean of the daily counts in the ``days`` days that end today.

    Days without requests are ignored; ``zero_fill`` counts them as zero by dividing by the full span.
    """
    number = F.date_diff("date_key", F.lit("1970-01-01").cast("date"))
    window = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy(number).rangeBetween(1 - days, 0)
    mean = F.sum("total_requests").over(window) / F.lit(days) if zero_fill else F.avg("total_requests").over(window)
    return daily.withColumn(f"rolling_{days}d_avg", mean)


def last_n_days(fact: DataFrame, days: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Requests created at most ``days`` days before the newest created day; on a table stored by month, only its last months are read."""
    if MONTH not in fact.columns:
        recent = fact.where(F.col("created_date_key") >= fact.agg(F.date_sub(F.max("created_date_key"), days)).scalar())
    else:
        newest = newest_month(fact, MONTH)
        first_month = newest.agg(F.trunc(F.date_sub(F.max("created_date_key"), days), "MONTH")).scalar()
        first_day = newest.agg(F.date_sub(F.max("created_date_key"), days)).scalar()
        recent = fact.where((F.col(MONTH) >= first_month) & (F.col("created_date_key") >= first_day))
    return recent.groupBy(*by).agg(F.count("*").alias("total_requests"))


def closed_volume(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Created and closed requests per calendar month: the date dimension in both of its roles."""
    def per_month(role: str, name: str) -> DataFrame:
        days = fact.groupBy(F.col(role).alias("date_key")).agg(F.count("*").alias("_n"))
        return days.join(dates.select("date_key", "year", "month"), "date_key").groupBy("year", "month").agg(
            F.sum("_n").alias(name)
        )

    created, closed = per_month("created_date_key", "created_requests"), per_month("closed_date_key", "closed_requests")
    return created.join(closed, ["year", "month"], "full").fillna(0, ["created_requests", "closed_requests"])
