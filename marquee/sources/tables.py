"""Parquet tables of a dataset directory (``<dir>/<name>.parquet``).

Reads are lazy: column pruning and filters reach the Parquet scan through
Catalyst (``ReadSchema`` / ``PushedFilters`` in the plan). Tables with a
declared schema are read with it, which skips reading file footers on the
driver to infer one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The published layout of the benchmark tables.
BENCH_SCHEMAS = {
    "region": "r_regionkey INT,r_name STRING",
    "nation": "n_nationkey INT,n_name STRING,n_regionkey INT",
    "customer": "c_custkey BIGINT,c_name STRING,c_nationkey INT,c_acctbal DOUBLE,c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT,s_name STRING,s_nationkey INT,s_acctbal DOUBLE",
    "part": "p_partkey BIGINT,p_name STRING,p_brand STRING,p_type STRING,p_size INT,p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT,o_custkey BIGINT,o_orderstatus STRING,o_totalprice DOUBLE,"
              "o_orderdate TIMESTAMP_NTZ,o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT,l_partkey BIGINT,l_suppkey BIGINT,l_linenumber INT,"
                "l_quantity DOUBLE,l_extendedprice DOUBLE,l_discount DOUBLE,l_tax DOUBLE,"
                "l_returnflag STRING,l_linestatus STRING,l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT,ts TIMESTAMP_NTZ,user_id BIGINT,event_type STRING,value DOUBLE,props STRING",
    "documents": "doc_id BIGINT,text STRING,lang STRING,source STRING,n_chars BIGINT",
    "embeddings": "vec_id BIGINT,embedding ARRAY<FLOAT>,label INT",
    "pages": "page_id BIGINT,url STRING,html STRING",
    "benchmark": "item_id BIGINT,text STRING",
    "labels": "doc_id BIGINT,quality INT,toxic INT",
    "conversations": "conv_id BIGINT,turn BIGINT,role STRING,text STRING",
}
BENCH_TABLES = tuple(BENCH_SCHEMAS)


def table_path(data_dir: str, name: str) -> str:
    return f"{data_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, data_dir: str, name: str,
               schema: str | None = None) -> DataFrame:
    """Lazy read of ``<data_dir>/<name>.parquet`` (declared schema when known)."""
    schema = schema or BENCH_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(table_path(data_dir, name))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Expose DataFrames to ``spark.sql`` under their dict keys (session temp views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
