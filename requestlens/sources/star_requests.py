"""Raw service requests derived from the order star tables.

The rules use integer arithmetic only, so the same table can be written in any SQL dialect. Every line item is one
version of a request; some requests have several. Only the tables that the requested columns need are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from requestlens import fixed_values as V
from requestlens.sources.tables import table, table_bytes

AS_OF = "2027-08-03 12:00:00"
BASE_INGEST = "2027-08-03 00:00:00"
DAY_SHIFT = 9497
# Bytes on disk beyond which orders are not sent to all tasks.
LARGE_ORDERS = 16 << 20
# The columns of a line that ``unique_key`` spells out, one to one where it is not null.
LINE_KEY = ["ok", "ln"]

# 28 pairs with a policy and four without one.
REQUEST_KINDS = [(agency, kind) for agency, kind, *_ in V.SLA_POLICIES if agency != "*"] + [
    ("OATH", "Hearing Request"),
    ("DOITT", "Public Wi-Fi"),
    ("LAW", "Legal Claim"),
    ("NYPD", "Graffiti"),
]
# The last long name of each code, as a title; codes without one are called by their code.
AGENCY_TITLES = {code: f"{code} Office" for code in V.AGENCY_CODES} | {code: name.title() for name, code in V.AGENCY_ALIASES.items()}
PLACE_TYPES = ["Address", "Intersection", "Block Face", "Latitude/Longitude", "N/A", "Rooftop"]
BOROUGH_SPELLINGS = [
    "MANHATTAN", "new york ", "MN",
    "BRONX", " bx", "Bronx",
    "BROOKLYN", "Kings", "BK",
    "QUEENS", "qn ", "Queens",
    "STATEN ISLAND", "SI", " richmond",
]
STREET_SUFFIXES = ["ST", "AVE", "BLVD", "RD", "DR", "LN", "CT", "PL", "PKWY", "TER", "CIR", "SQ"]


def text_list(values: Sequence[str]) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def _pick(values: Sequence[str], index: str) -> str:
    return f"element_at(array({text_list(values)}), CAST(({index}) + 1 AS INT))"


# One version in eight says that the request was created a month earlier. A single interval is added, since every addition
# to a timestamp costs more than the arithmetic on minutes.
_CREATED = (
    f"o_orderdate + INTERVAL '1' MINUTE * ({DAY_SHIFT * 1440} - CASE WHEN pk % 8 = 0 THEN {31 * 1440} ELSE 0 END "
    "+ (ok * 37 + ln * 101 + pk) % 1440)"
)
_STATUS = (
    "CASE o_orderstatus WHEN 'F' THEN CASE WHEN pk % 4 = 0 THEN 'Open' WHEN pk % 4 = 1 THEN 'In Progress' ELSE 'Closed' END "
    "WHEN 'O' THEN CASE WHEN pk % 5 = 0 THEN 'Closed' ELSE 'Open' END "
    "ELSE CASE WHEN pk % 6 = 0 THEN 'Closed' WHEN ln % 2 = 0 THEN 'In Progress' ELSE 'Pending' END END"
)
_CLOSED = "created + INTERVAL '1' MINUTE * ((ok * 53 + pk * 7 + ln) % 86400 - 1440)"
_AGENCY = _pick([agency for agency, _ in REQUEST_KINDS], "pk % 32")
_TITLE = _pick([AGENCY_TITLES[agency] for agency, _ in REQUEST_KINDS], "pk % 32")
_LATITUDE = "concat('40.', CAST(40 + ck % 60 AS STRING))"
_LONGITUDE = "concat(CASE WHEN ck % 2 = 0 THEN '-73.' ELSE '-74.' END, lpad(CAST(ck * 7 % 100 AS STRING), 2, '0'))"
_POINT = f"concat('{{\"type\": \"Point\", \"coordinates\": [', {_LONGITUDE}, ', ', {_LATITUDE}, ']}}')"

RULES = {
    "unique_key": "CASE WHEN ok % 997 <> 0 THEN concat(CAST(ok AS STRING), '-', CAST(ln AS STRING)) END",
    "created_date": (
        "CASE WHEN ok % 503 = 0 THEN 'invalid' "
        "WHEN ln % 4 = 0 THEN concat(replace(CAST(created AS STRING), ' ', 'T'), '.000000') "
        "WHEN ln % 4 = 2 THEN CAST(created AS STRING) "
        "ELSE replace(CAST(created AS STRING), ' ', 'T') END"
    ),
    "closed_date": (
        f"CASE WHEN {_STATUS} = 'Closed' AND ok % 13 <> 0 THEN replace(CAST({_CLOSED} AS STRING), ' ', 'T') "
        "WHEN ln % 2 = 0 THEN '' END"
    ),
    "agency": (
        f"CASE CAST(ln % 4 AS INT) WHEN 1 THEN concat(' ', lower({_AGENCY}), ' ') "
        f"WHEN 2 THEN {_TITLE} ELSE {_AGENCY} END"
    ),
    "agency_name": f"CASE WHEN sk % 10 = 0 THEN concat({_TITLE}, ' Office') ELSE {_TITLE} END",
    "complaint_type": _pick([kind for _, kind in REQUEST_KINDS], "pk % 32"),
    "descriptor": "CASE WHEN p_size % 10 <> 0 THEN p_brand END",
    "location_type": _pick(PLACE_TYPES, "ln % 6"),
    "incident_zip": (
        "CASE WHEN ok % 31 = 0 THEN NULL WHEN ok % 29 = 0 THEN 'abcde' "
        "ELSE concat(CAST(10001 + ck % 1800 AS STRING), CASE WHEN ln = 5 THEN '-1234' ELSE '' END) END"
    ),
    "incident_address": (
        "CASE WHEN ok % 41 <> 0 THEN concat(CAST(ok % 900 + 1 AS STRING), ' ', upper(p_name), ' ', "
        f"{_pick(STREET_SUFFIXES, 'pk % 12')}, "
        "CASE WHEN ln % 3 = 0 THEN concat(' APT ', CAST(ln AS STRING), 'B') ELSE '' END) END"
    ),
    "borough": (
        "CASE WHEN ok % 23 = 0 THEN CASE CAST(ln % 3 AS INT) WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'UNKNOWN' END "
        f"ELSE {_pick(BOROUGH_SPELLINGS, 'n_regionkey * 3 + ln % 3')} END"
    ),
    "latitude": f"CASE WHEN ok % 11 <> 0 THEN {_LATITUDE} END",
    "longitude": f"CASE WHEN ok % 11 <> 0 THEN {_LONGITUDE} END",
    "location": f"CASE WHEN ok % 11 = 0 THEN NULL WHEN ok % 37 = 0 THEN '{{\"type\": \"Point\", ' ELSE {_POINT} END",
    "status": _STATUS,
    "resolution_description": "CASE WHEN ok % 7 <> 0 THEN l_returnflag END",
    # Versions of one request fall into different batches; a batch takes up to 50 minutes.
    "ingested_at": f"TIMESTAMP_NTZ '{BASE_INGEST}' + INTERVAL '1' HOUR * ((ok + pk) % 5) + INTERVAL '1' SECOND * ((ok * 13 + sk * 7) % 3000)",
    "batch_id": "concat('batch_', CAST((ok + pk) % 5 AS STRING))",
    # Position text that settles ties between versions of one request landed in the same batch.
    "source_row": "concat(CAST(pk AS STRING), '-', CAST(sk AS STRING), '-', l_returnflag)",
}
_PART_COLUMNS = {"descriptor", "incident_address"}
_BOROUGH_COLUMNS = {"borough"}


def request_lines(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Joined lines, not yet derived, with all that the rules of the given raw columns read."""
    wanted = list(columns)
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_partkey").alias("pk"),
        F.col("l_suppkey").alias("sk"),
        "l_returnflag",
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("ck"), "o_orderstatus", "o_orderdate"
    )
    # Dealt by order, the lines need no further shuffle to meet large orders, and the region travels with the orders, which
    # are fewer. Small orders go to all tasks; then the rebalance evens out an input that comes in few pieces.
    large = table_bytes(spark, folder, "orders") > LARGE_ORDERS
    places = None
    if _BOROUGH_COLUMNS & set(wanted):
        nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
        customers = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("ck"), F.col("c_nationkey").alias("n_nationkey")
        )
        places = customers.join(nations, "n_nationkey")
    if large and places is not None:
        orders, places = orders.join(places, "ck"), None
    base = (lines.hint("rebalance", "ok") if large else lines.hint("rebalance")).join(orders, "ok")
    if _PART_COLUMNS & set(wanted):
        parts = table(spark, folder, "part").select(F.col("p_partkey").alias("pk"), "p_name", "p_brand", "p_size")
        base = base.join(parts, "pk")
    if places is not None:
        base = base.join(places, "ck")
    return base.withColumn("created", F.expr(_CREATED))


def derived(columns: Sequence[str]) -> list[Column]:
    """Raw columns from the lines of ``request_lines``."""
    return [F.expr(RULES[name]).alias(name) for name in columns]


def raw_requests(spark: SparkSession, folder: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The raw request columns asked for (all by default), plus ``source_row`` when named."""
    wanted = list(columns) if columns is not None else list(RULES)
    return request_lines(spark, folder, wanted).select(*derived(wanted))
