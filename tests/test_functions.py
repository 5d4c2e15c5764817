"""Scalar rules against literal examples."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from requestlens.functions import rules as R
from requestlens.functions import standardize as S
from requestlens.functions import temporal as D
from requestlens.functions.numeric import fraction, percent, rounded, surrogate_key


def values(spark, rule, inputs):
    """Results of ``rule`` over text inputs, in order."""
    rows = [(number, text) for number, text in enumerate(inputs)]
    df = spark.createDataFrame(rows, "n int, x string").select("n", rule(F.col("x")).alias("y"))
    return [row.y for row in sorted(df.collect(), key=lambda row: row.n)]


def test_parse_datetime(spark):
    good = ["2024-01-15T10:30:00.123456", "2024-01-15T10:30:00", "2024-01-15 10:30:00", "2024-01-15", "2024-1-5T1:2:3"]
    assert values(spark, D.parse_datetime, good) == [
        dt.datetime(2024, 1, 15, 10, 30, 0, 123456), dt.datetime(2024, 1, 15, 10, 30), dt.datetime(2024, 1, 15, 10, 30),
        dt.datetime(2024, 1, 15), dt.datetime(2024, 1, 5, 1, 2, 3),
    ]
    bad = [None, "invalid", "", "2024", "2024-01", "2024-02-30", "2024-01-15T10:30:00Z", "2024-01-15 10:30:00.5",
           "2024-01-15T25:00:00", " 2024-01-15", "2024-01-15\n", "0000-01-01"]
    assert values(spark, D.parse_datetime, bad) == [None] * len(bad)


def test_epoch_millis(spark):
    got = values(spark, lambda x: D.from_epoch_millis(x.cast("bigint")), ["0", "1705314600123", "-1"])
    assert got == [
        dt.datetime(1970, 1, 1), dt.datetime(2024, 1, 15, 10, 30, 0, 123000), dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    ]


@pytest.mark.parametrize("name, spellings", [
    ("MANHATTAN", ["MANHATTAN", "Manhattan", "NEW YORK", "MN", " mn "]),
    ("BRONX", ["BRONX", "BX"]),
    ("BROOKLYN", ["BROOKLYN", "BK", "KINGS"]),
    ("QUEENS", ["QUEENS", "QN"]),
    ("STATEN ISLAND", ["STATEN ISLAND", "SI", "RICHMOND"]),
    ("UNSPECIFIED", ["UNKNOWN", "", None]),
])
def test_borough(spark, name, spellings):
    assert values(spark, S.borough, spellings) == [name] * len(spellings)


def test_agency(spark):
    inputs = ["New York Police Department", "POLICE DEPARTMENT", "Department of Buildings", "DEPARTMENT OF SANITATION",
              "UNKNOWN AGENCY", None, "", " nypd\t"]
    assert values(spark, S.agency, inputs) == ["NYPD", "NYPD", "DOB", "DSNY", "UNKNOWN AGENCY", None, None, "NYPD"]


def test_zip(spark):
    inputs = ["10001", "10001-1234", "  10001  ", "123", "abcde", "99999", None, "", "11697", "11698", "10000"]
    assert values(spark, S.zip_code, inputs) == ["10001"] * 3 + [None] * 5 + ["11697", None, None]
    assert values(spark, S.zip_digits, ["10001-1234", "abcde", None]) == ["100011234", "", None]


def pair(spark, rule, created, closed):
    df = spark.createDataFrame([(created, closed)], "a string, b string")
    times = df.select(D.parse_datetime(F.col("a")).alias("a"), D.parse_datetime(F.col("b")).alias("b"))
    return times.select(rule(F.col("a"), F.col("b")).alias("y")).first().y


def test_resolution_days(spark):
    assert pair(spark, D.resolution_days, "2024-01-15T10:00:00", "2024-01-18T14:00:00") == pytest.approx(3.1666667)
    assert 0 < pair(spark, D.resolution_days, "2024-01-15T10:00:00", "2024-01-15T18:00:00") < 1
    assert pair(spark, D.resolution_days, "2024-01-18", "2024-01-15") == -3
    strict = lambda a, b: D.resolution_days(a, b, strict=True)
    assert pair(spark, strict, "2024-01-18", "2024-01-15") is None
    assert pair(spark, strict, "2024-01-18", None) is None
    assert pair(spark, strict, None, "2024-01-18") is None


def test_business_days(spark):
    assert pair(spark, D.business_days, "2024-01-15T10:00:00", "2024-01-19T10:00:00") == 5
    assert pair(spark, D.business_days, "2024-01-19", "2024-01-22") == 2
    assert pair(spark, D.business_days, "2024-01-20", "2024-01-21") == 0
    assert pair(spark, D.business_days, "2024-01-16", "2024-01-15") is None
    holiday = lambda a, b: D.business_days(a, b, ["2024-01-15", "2024-01-20"])
    assert pair(spark, holiday, "2024-01-15", "2024-01-16") == 1


def test_business_days_against_enumeration(spark):
    start = dt.date(1969, 11, 20)
    rows = [(start + dt.timedelta(days=a), start + dt.timedelta(days=a + b)) for a in range(0, 90, 3) for b in range(0, 30)]
    df = spark.createDataFrame([(str(a), str(b)) for a, b in rows], "a string, b string")
    got = df.select("a", "b", D.business_days(D.parse_datetime(F.col("a")), D.parse_datetime(F.col("b"))).alias("n")).collect()
    for row in got:
        a, b = dt.date.fromisoformat(row.a), dt.date.fromisoformat(row.b)
        assert row.n == sum((a + dt.timedelta(days=i)).weekday() < 5 for i in range((b - a).days + 1))


def test_sla_compliance(spark):
    def rule(days):
        return lambda a, b: D.sla_compliant(a, b, F.lit(days), strict=True)

    assert pair(spark, rule(1), "2024-01-15T10:00:00", "2024-01-16T10:00:00") is True
    assert pair(spark, rule(1), "2024-01-15", "2024-01-20") is False
    assert pair(spark, rule(1), "2024-01-15", None) is None


def test_categories(spark):
    kinds = ["Noise - Residential", "Heat/Hot Water", "Rodent", "Missed Collection", "Unknown Type", None]
    keyword = lambda x: R.keyword_category(x, F.lit(None).cast("string"))
    assert values(spark, keyword, kinds) == ["noise", "housing", "housing", "sanitation", "other", "other"]
    assert values(spark, R.complaint_category, kinds) == ["Noise", "Heat/Hot Water", "Rodent/Pest", "Other", "Other", "Other"]
    by_detail = lambda x: R.keyword_category(F.lit("Other"), x)
    assert values(spark, by_detail, ["Dead Tree", "Location wrong", "Repair"]) == ["parks", "animals", "environment"]
    assert values(spark, R.is_emergency, ["HEAT", "No hot water", "Noise", None]) == [True, True, False, False]


def test_address(spark):
    got = values(spark, S.address_parts, ["123 main st", "123 MAIN ST APT 4B", "INVALID", None, "9 OLD MILL RD # 7", "1  A B  UNIT 3"])
    assert tuple(got[0]) == ("123", "MAIN", "ST", None)
    assert tuple(got[1]) == ("123", "MAIN", "ST", "APT 4B")
    assert tuple(got[2]) == tuple(got[3]) == tuple(got[5]) == (None,) * 4
    assert tuple(got[4]) == ("9", "OLD MILL", "RD", "# 7")
    types = ["ST", "AVENUE", "BLVD", "ROAD", "DR", "LANE", "CT", "PLACE", "PKWY", "TERRACE", "CIR"]
    every = values(spark, S.address_parts, [f"5 ELM {suffix}" for suffix in types])
    assert [row.street_type for row in every] == types


def test_location(spark):
    got = values(spark, S.location, [
        '{"type": "Point", "coordinates": [-73.99, 40.75]}', '{"type": "Point", ', "[1, 2]", None, "",
        '{"coordinates": ["x", 1.5], "human_address": {"city": "A"}}',
    ])
    assert (got[0].type, got[0].coordinates) == ("Point", [-73.99, 40.75])
    for row in got[1:5]:
        assert (row.coordinates, row.human_address) == (None, None)
    assert got[5].coordinates == [None, 1.5] and "city" in got[5].human_address


def test_domains_and_counties(spark):
    assert values(spark, S.agency_domain, ["NYPD", "HPD", "XYZ", None]) == ["Public Safety", "Housing & Buildings", "Other", "Other"]
    assert values(spark, S.county, ["BROOKLYN", "UNSPECIFIED"]) == ["Kings County", "Unspecified"]
    assert values(spark, S.borough_order, ["MANHATTAN", "STATEN ISLAND", "UNSPECIFIED"]) == [1, 5, 0]


def test_numbers(spark):
    row = spark.range(1).select(
        rounded(F.lit(1.005)).alias("a"), percent(F.lit(1), F.lit(8)).alias("b"), percent(F.lit(1), F.lit(0)).alias("c"),
        fraction(F.lit(1), F.lit(4)).alias("d"), surrogate_key(F.lit("a"), F.lit(None).cast("string")).alias("e"),
    ).first()
    import hashlib

    from requestlens import fixed_values as V

    assert (row.a, row.b, row.c, row.d) == (1.01, 12.5, None, 0.25)
    assert row.e == hashlib.md5(f"a-{V.SURROGATE_NULL}".encode()).hexdigest()
