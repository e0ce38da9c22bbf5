import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from riskflow.session import configure

    s = (SparkSession.builder.master("local[*]").appName("riskflow-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskflow-test-ckpt-"))
    configure(s)
    yield s


@pytest.fixture()
def tx_schema():
    return "TX_ID string, TX_TS timestamp, CUSTOMER_ID string, TERMINAL_ID string, TX_AMOUNT double"


def make_tx(spark, rows):
    """rows: (TX_ID, 'YYYY-mm-dd HH:MM:SS[.f]', CUSTOMER_ID, TERMINAL_ID, amount)"""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "TX_ID string, ts string, CUSTOMER_ID string, TERMINAL_ID string, "
                                     "TX_AMOUNT double")
    return df.select("TX_ID", F.col("ts").cast("timestamp").alias("TX_TS"), "CUSTOMER_ID", "TERMINAL_ID",
                     "TX_AMOUNT")


def make_labels(spark, rows):
    return spark.createDataFrame(rows, "TX_ID string, TX_FRAUD int")
