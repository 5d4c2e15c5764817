"""Landed request pages: JSON files of records, one array per file or one record per line."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from requestlens.functions.temporal import from_epoch_millis
from requestlens.schemas import API_FIELDS, RAW, RAW_ALL_STRING

CORRUPT = "_corrupt"
FILE_ROWS = 500_000
TASK_PAGES = 48
TIMES = ["created_date", "closed_date", "resolution_action_updated_date"]


def page_schema(extra: tuple[str, ...] = ()) -> T.StructType:
    """All fields as text, so that no single bad value can spoil a page; ``_corrupt`` keeps unreadable input."""
    fields = RAW_ALL_STRING.fields + [T.StructField(name, T.StringType()) for name in (*extra, CORRUPT)]
    return T.StructType(fields)


def read_pages(spark: SparkSession, path: str, array_pages: bool = True, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows of landed pages. Array pages are whole JSON documents; otherwise each line is one record."""
    return (
        spark.read.schema(page_schema(extra))
        .option("multiLine", array_pages)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def api_projection(df: DataFrame) -> DataFrame:
    return df.select(*API_FIELDS)


def conform(df: DataFrame) -> DataFrame:
    """Give ``df`` every raw column; what the input leaves out is null. Extra columns are kept.

    Times that come as numbers are milliseconds since 1970, in UTC; they and timestamps become text of the first accepted layout.
    """
    known = set(RAW.fieldNames())
    typed = {name: instant for name in TIMES if name in df.columns and (instant := _instant(df, name)) is not None}
    if typed:
        df = df.withColumns({name: F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for name, instant in typed.items()})
    return df.to(T.StructType(RAW.fields + [field for field in df.schema.fields if field.name not in known]))


def _instant(df: DataFrame, name: str) -> Column | None:
    """A column that holds numbers or timestamps as a zone-free timestamp; none for text."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return from_epoch_millis(F.col(name))
    return F.col(name).cast("timestamp_ntz") if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)) else None


def with_payload(df: DataFrame) -> DataFrame:
    """Fill ``raw_payload`` with the record as JSON; null fields are left out, as the source does."""
    present = [name for name in API_FIELDS if name in df.columns]
    return df.withColumn("raw_payload", F.to_json(F.struct(*present)))


def land_lines(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write records as compressed JSON lines, one folder per batch. A file is read by one task, so ``df`` comes in small parts."""
    df.select("batch_id", *columns).write.mode("errorifexists").option("compression", "gzip").partitionBy("batch_id").json(path)


def deal_pages(df: DataFrame, page_rows: int, by: list[str]) -> DataFrame:
    """Rows with the number ``page`` of a page of their batch, each page in one task and ``TASK_PAGES`` pages to a task on average.

    Rows are dealt to the pages of their batch by a hash of ``by``, so a page is never larger than a few times its share. There
    is one row per batch to tell how many pages it has: that joins without a shuffle, which would send a batch to one task.
    ``df`` is a stored table; with columns that are derived after the deal, only what they are derived from is shuffled.
    """
    batches = df.groupBy("batch_id").agg(F.greatest(F.ceil(F.count("*") / page_rows), F.lit(1)).alias("_pages"))
    tasks = math.ceil((batches.agg(F.sum("_pages")).first()[0] or 1) / TASK_PAGES)
    dealt = df.join(F.broadcast(batches), "batch_id").withColumn("page", F.pmod(F.xxhash64(*by), F.col("_pages"))).drop("_pages")
    return dealt.repartition(tasks, "batch_id", "page")


def land_arrays(df: DataFrame, path: str, columns: list[str], page_rows: int, compression: str | None = None, dealt: bool = False) -> None:
    """Write records as pages: JSON documents, each an array of about ``page_rows`` records, one file per page in a folder per batch.

    Records that ``deal_pages`` has not ``dealt`` before are dealt by all their columns. With a ``compression`` the field names of
    every record do not fill the disk; each page is read as a whole anyway.
    """
    rows = df if dealt else deal_pages(df, page_rows, columns)
    pages = rows.groupBy("batch_id", "page").agg(F.to_json(F.collect_list(F.struct(*columns))).alias("value"))
    pages.write.mode("append").partitionBy("batch_id", "page").text(path, compression=compression)


def land_in_turn(df: DataFrame, path: str, columns: list[str], turn: str, turns: int, files: int) -> None:
    """Write records as compressed JSON lines in the order of the column ``turn``, 0 to ``turns`` - 1, each in ``files`` files.

    A file stream takes files by age, so with ``files`` files per trigger every turn is a micro-batch. ``df`` is a stored table
    with at least that many rows in every turn.
    """
    for number in range(turns):
        mine = df.where(F.col(turn) == number).select(*columns).repartition(files)
        mine.write.mode("append").option("compression", "gzip").json(path)


def files_per_turn(df: DataFrame, turn: str, least: int, file_rows: int = FILE_ROWS) -> int:
    """Files for ``land_in_turn`` that hold about ``file_rows`` rows in the largest turn; the smallest turn still fills them all."""
    sizes = [row["count"] for row in df.groupBy(turn).count().collect()]
    return max(least, min(math.ceil(max(sizes) / file_rows), min(sizes) // 1000)) if sizes else least
