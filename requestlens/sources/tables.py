"""Reading the given parquet tables with their declared columns."""

from pyspark.sql import DataFrame, SparkSession

# Column contracts of the tables in use; declaring them saves a footer-reading job per scan.
TABLES = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def table_bytes(spark: SparkSession, folder: str, name: str) -> int:
    """The size of a table's files, from the file system alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
