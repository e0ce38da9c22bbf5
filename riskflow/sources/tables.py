"""Table sources and sinks: fact/label split, date-partitioned transaction store,
dimension snapshots, CSV profile files and text history files.

Transactions are stored partitioned by ``tx_date`` (the reference partitions
its table by ``DATE(TX_TS)``). ``read_transactions`` turns a time range into a
predicate on the partition column, so only the needed day folders are listed
and read (Catalyst prunes partitions only for predicates on the partition
column itself, not for ones on ``TX_TS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions import as_timestamp

TX_COLUMNS = ["TX_ID", "TX_TS", "CUSTOMER_ID", "TERMINAL_ID", "TX_AMOUNT"]
LABEL_COLUMNS = ["TX_ID", "TX_FRAUD"]
PARTITION_COLUMN = "tx_date"


def split_transactions(all_rows: DataFrame) -> DataFrame:
    """The transaction facts of a wide table (five columns)."""
    return all_rows.select(*TX_COLUMNS)


def split_labels(all_rows: DataFrame) -> DataFrame:
    """The labels of a wide table."""
    return all_rows.select(*LABEL_COLUMNS)


def write_transactions(tx: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store transactions partitioned by day. Rows are rebalanced by day before writing: small days share a task,
    and adaptive execution splits a large day over several tasks and files."""
    (tx.withColumn(PARTITION_COLUMN, F.to_date("TX_TS"))
     .hint("rebalance", PARTITION_COLUMN)
     .write.mode(mode).partitionBy(PARTITION_COLUMN).parquet(path))


def read_transactions(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Transactions with ``start <= TX_TS <= end`` (either bound optional), pruned to the day partitions."""
    df = spark.read.parquet(path)
    cond = F.lit(True)
    if start is not None:
        lo = as_timestamp(start)
        cond = cond & (F.col(PARTITION_COLUMN) >= F.to_date(lo)) & (F.col("TX_TS") >= lo)
    if end is not None:
        hi = as_timestamp(end)
        cond = cond & (F.col(PARTITION_COLUMN) <= F.to_date(hi)) & (F.col("TX_TS") <= hi)
    return df.where(cond)


def snapshot(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Copy a table (``CREATE OR REPLACE TABLE AS SELECT *``) and return the copy."""
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)


def write_profiles(df: DataFrame, path: str) -> None:
    """Profile file: CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_profiles(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read a CSV profile file with header and an explicit schema (no inference pass)."""
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(schema).csv(path)


def write_history(lines: DataFrame, path: str, column: str = "value") -> None:
    """One id per line (the hacked customer / terminal history files)."""
    lines.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """History lines as a one-column table ``value``."""
    return spark.read.text(path)


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS``; ``location`` places its tables (use a shared folder)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def save_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0,
               mode: str = "overwrite") -> str:
    """``CREATE OR REPLACE TABLE name AS SELECT ...`` in the catalog; with ``bucket_by`` the table
    is hash-bucketed on that column, so joins/aggregations on it read it co-partitioned."""
    w = df.write.mode(mode).format("parquet")
    if bucket_by and buckets:  # a task a bucket, and so a file a bucket
        w = (df.repartition(buckets, bucket_by).write.mode(mode).format("parquet")
             .bucketBy(buckets, bucket_by).sortBy(bucket_by))
    w.saveAsTable(name)
    return name


def store_co_bucketed(tx: DataFrame, labels: DataFrame, database: str, buckets: int,
                      location: str | None = None) -> tuple[str, str]:
    """Store transactions and labels as catalog tables bucketed (and sorted) by TX_ID into
    the same number of buckets. Every ``tx JOIN txlabels USING (TX_ID)`` over the two
    tables (``spark.table``) then runs bucket against bucket, with no shuffle -- the
    join every analysis starts with is the largest exchange otherwise."""
    spark = tx.sparkSession
    create_namespace(spark, database, location)
    t = save_table(tx.select(*TX_COLUMNS), f"{database}.tx", bucket_by="TX_ID", buckets=buckets)
    lb = save_table(labels.select(*LABEL_COLUMNS), f"{database}.txlabels", bucket_by="TX_ID", buckets=buckets)
    return t, lb
