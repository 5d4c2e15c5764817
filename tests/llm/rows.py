"""Small tables with every awkward row: nulls, empty and long texts, repeats, and columns named like those of the operators."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, shard int, score double, rid long, bucket int, "
    "component_id long, gone long, draws string, key long, hash long"
)
LONG = " ".join(f"long{i % 9001}" for i in range(60_000))
PASSAGE = "the quick brown fox jumps over the lazy dog while seven small wizards box in the cold night air"
TEXTS = [
    (1, f"{PASSAGE}.", "en", "b"),
    (2, f"Some words first. {PASSAGE}. And others after it.", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, "a"),
    (5, " \t\n ", "en", None),
    (6, "one", "en", "c"),
    (7, "One", "en", "c"),
    (8, "ein kleiner Satz über schöne Dinge und große Häuser", "de", "é"),
    (9, LONG, "en", "b"),
    (10, f"{PASSAGE}.", "en", "b"),
    (10, f"{PASSAGE}.", "en", "b"),
    (11, f"{PASSAGE}.", None, None),
    (None, f"{PASSAGE}.", "en", "b"),
    (None, None, None, None),
    (12, "12 + 34 = 46 !!", "en", "a"),
    (13, "a b c d e", "en", "a"),
    (-5, "a b c d e", "en", "a"),
    (14, LONG, "en", "b"),
    (15, "😀 naïve 😀 token: \"abcdef123456\" café", "fr", "a"),
]


def awkward(spark: SparkSession, partitions: int = 3) -> DataFrame:
    rows = [(i, t, lang, s, None if t is None else len(t), 1, 2, 0.5, 3, 4, 5, 6, "x", 7, 8) for i, t, lang, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]], partitions: int = 3) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)


def labels(spark: SparkSession, rows: list[tuple], repeat: int = 1) -> DataFrame:
    return spark.createDataFrame(rows * repeat, "doc_id long, quality int, toxic int, text string")


def words(text: str | None) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]
