"""Payloads as they were landed, against their contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from requestlens.catalog import inputs as I
from requestlens.catalog.oracle import RAW, over
from requestlens.catalog.registry import query
from requestlens.plans.contract import contract_report
from requestlens.schemas import API_FIELDS
from requestlens.session import fresh_path
from requestlens.sources.landing import FILE_ROWS
from requestlens.sources.star_requests import RULES
from requestlens.sources.tables import table

_FIELDS = [name for name in API_FIELDS if name in RULES]
_PART = "CAST(split_part(source_row, '-', 1) AS BIGINT)"
_CUT = f"{_PART} % 50 = 1"
_ZIP_NUMBER = "batch_id = 'batch_0' AND length(incident_zip) = 5 AND substr(incident_zip, 1, 1) = '1'"


def _landed_lines(spark, folder):
    """Records as JSON lines. Batches differ: one has a field more, one a field less, two send numbers; some lines are cut off."""
    rows = I.raw(spark, folder, *_FIELDS, "source_row", "batch_id")
    record = F.to_json(F.struct(*[c for c in _FIELDS if c not in ("status", "latitude", "incident_zip")],
        F.expr("CASE WHEN batch_id <> 'batch_3' THEN status END").alias("status"),
        F.expr("CASE WHEN batch_id <> 'batch_2' THEN latitude END").alias("latitude"),
        F.expr(f"CASE WHEN NOT coalesce({_ZIP_NUMBER}, false) THEN incident_zip END").alias("incident_zip"),
        F.expr(f"CASE WHEN batch_id = 'batch_1' THEN {_PART} END").alias("priority"),
    ))
    # Numbers take the place of texts of the same name.
    number = F.concat_ws(", ", F.expr("CASE WHEN batch_id = 'batch_2' AND latitude IS NOT NULL THEN concat('\"latitude\": ', latitude) END"),
                         F.expr(f"CASE WHEN {_ZIP_NUMBER} THEN concat('\"incident_zip\": ', incident_zip) END"))
    whole = F.when(number == "", record).otherwise(F.concat(F.expr("'{'"), number, F.lit(", "), F.substring(record, F.lit(2), F.length(record))))
    line = F.when(F.expr(_CUT), F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    path = fresh_path(spark, "contract-lines")
    # Compressed files are read whole, so their rows are limited.
    landed = rows.select("batch_id", line.alias("value")).write.partitionBy("batch_id").option("maxRecordsPerFile", FILE_ROWS)
    landed.text(path, compression="lz4")
    return spark.read.schema("value string, batch_id string").text(path)


def _field_sql(name: str) -> str:
    value, kind, retyped = name, "'STRING'", "0"
    if name == "status":
        value = "CASE WHEN batch_id <> 'batch_3' THEN status END"
    if name == "latitude":
        kind, retyped = "CASE WHEN batch_id = 'batch_2' THEN 'DECIMAL' ELSE 'STRING' END", "count(latitude) FILTER (WHERE batch_id = 'batch_2')"
    if name == "incident_zip":
        kind, retyped = "CASE WHEN batch_id = 'batch_0' THEN 'VARIANT' ELSE 'STRING' END", f"count(*) FILTER (WHERE {_ZIP_NUMBER})"
    return f"SELECT batch_id, '{name}' AS field, 'STRING' AS declared_type, {kind} AS kind, count({value}) AS records, {retyped} AS retyped FROM good GROUP BY batch_id"


_ABSENT = ", ".join(f"'{name}'" for name in API_FIELDS if name not in RULES)


@query("mon_contract", over(RAW, f""", good AS (SELECT * FROM raw WHERE NOT ({_CUT})),
found AS ({" UNION ALL ".join(_field_sql(name) for name in _FIELDS)}
  UNION ALL SELECT DISTINCT batch_id, unnest([{_ABSENT}]), 'STRING', NULL, 0, 0 FROM raw
  UNION ALL SELECT batch_id, 'priority', NULL, 'BIGINT', count(*), 0 FROM good WHERE batch_id = 'batch_1' GROUP BY 1)
SELECT batch_id, field, declared_type, CASE WHEN records > 0 THEN kind END AS found_type, records, retyped,
  CASE WHEN declared_type IS NULL THEN 'unknown' WHEN records = 0 THEN 'missing' WHEN retyped > 0 THEN 'retyped' ELSE 'known' END AS status FROM found
UNION ALL SELECT batch_id, NULL, NULL, NULL, count(*), 0, 'unreadable' FROM raw WHERE {_CUT} GROUP BY 1"""))
def mon_contract(spark, folder):
    return contract_report(_landed_lines(spark, folder), "value", {name: "STRING" for name in API_FIELDS}, ["batch_id"])


@query("mon_contract_events", """
SELECT event_type, 'k' AS field, 'STRING' AS declared_type, 'BIGINT' AS found_type, count(*) AS records, count(*) AS retyped, 'retyped' AS status
FROM events WHERE json_type(props, '$.k') IN ('UBIGINT', 'BIGINT') GROUP BY 1
UNION ALL SELECT DISTINCT event_type, 'page', 'BIGINT', NULL, 0, 0, 'missing' FROM events""")
def mon_contract_events(spark, folder):
    """The properties of events, by their type, against a contract that has one field as text and another that never comes."""
    return contract_report(table(spark, folder, "events"), "props", {"k": "STRING", "page": "BIGINT"}, ["event_type"])
