"""Table sources and sinks."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from riskflow.session import cluster_settings, configure, materialize, scratch_path
from riskflow.sources import tables
from riskflow.sources.fixtures import load_fixture, load_table


def test_read_transactions_bounds(spark):
    tx, _ = load_fixture(spark, SF_SMALL)
    path = scratch_path(spark, "tx")
    tables.write_transactions(tx, path)
    lo, hi = "2024-01-10 00:00:00", "2024-01-12 12:00:00"
    ts = F.col("TX_TS")
    assert tables.read_transactions(spark, path).count() == tx.count()
    assert tables.read_transactions(spark, path, start=lo).count() == tx.where(ts >= F.lit(lo).cast("timestamp")).count()
    assert tables.read_transactions(spark, path, end=hi).count() == tx.where(ts <= F.lit(hi).cast("timestamp")).count()
    both = tables.read_transactions(spark, path, lo, hi)
    assert both.count() == tx.where(ts.between(F.lit(lo).cast("timestamp"), F.lit(hi).cast("timestamp"))).count()
    assert set(both.columns) == {*tables.TX_COLUMNS, tables.PARTITION_COLUMN}


def test_profiles_csv_round_trip_keeps_types(spark):
    sup = load_table(spark, SF_SMALL, "supplier")
    path = scratch_path(spark, "profiles")
    tables.write_profiles(sup, path)
    back = tables.read_profiles(spark, path, sup.schema)
    assert back.schema == sup.schema
    assert back.exceptAll(sup).count() == 0 and sup.exceptAll(back).count() == 0


def test_history_lines(spark):
    ids = spark.createDataFrame([("7",), ("42",)], "CUSTOMER_ID string")
    path = scratch_path(spark, "history")
    tables.write_history(ids, path, "CUSTOMER_ID")
    assert sorted(r["value"] for r in tables.read_history(spark, path).collect()) == ["42", "7"]


def test_split_and_snapshot(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    wide = tx.join(lb, "TX_ID", "left")
    assert tables.split_transactions(wide).columns == tables.TX_COLUMNS
    snap = tables.snapshot(tables.split_labels(wide), scratch_path(spark, "labels"))
    assert snap.count() == tx.count()


def test_materialize_and_settings(spark):
    df = spark.range(10)
    assert materialize(df, "m").count() == 10
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    assert int(cluster_settings(1000)["spark.sql.shuffle.partitions"]) == 3000


def test_large_day_is_written_by_several_tasks_and_buckets_have_one_file(spark):
    from pyspark.sql import functions as F

    tx = spark.range(200_000, numPartitions=8).select(
        F.col("id").cast("string").alias("TX_ID"), F.lit("2024-01-20 10:00:00").cast("timestamp").alias("TX_TS"),
        F.md5(F.col("id").cast("string")).alias("CUSTOMER_ID"), F.lit("t").alias("TERMINAL_ID"), F.rand(1).alias("TX_AMOUNT"))
    path = scratch_path(spark, "day")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.write_transactions(tx, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(spark.read.parquet(path).inputFiles()) > 1 and spark.read.parquet(path).count() == 200_000
    name = f"one_file_{scratch_path(spark, 'x')[-12:]}"
    tables.save_table(tx.limit(5000).withColumn("path", F.lit(1)), name, bucket_by="TX_ID", buckets=4)
    assert len(spark.table(name).inputFiles()) == 4
    spark.sql(f"DROP TABLE {name}")
