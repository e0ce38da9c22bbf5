"""The prediction table of the catalog (S9): typed columns, and a creation time that the table itself fills in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Fixed names and types of the prediction table.
COLUMNS = {
    "TX_ID": "STRING",
    "prediction_timestamp": "TIMESTAMP",
    "fraud_probability": "DOUBLE",
    "is_fraud": "BOOLEAN",
    "model_version": "STRING",
    "created_at": "TIMESTAMP DEFAULT current_timestamp()",
}


def create_prediction_table(spark: SparkSession, name: str, location: str | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with the default of ``created_at``; ``location`` places its files."""
    columns = ", ".join(f"{c} {t}" for c, t in COLUMNS.items())
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")
    return name


def insert_predictions(rows: DataFrame, name: str) -> None:
    """Insert by name; columns that ``rows`` does not have get the table's default."""
    given = [c for c in COLUMNS if c in rows.columns]
    rows.select(*given).createOrReplaceTempView(view := f"_new_{abs(hash(name)):x}")
    try:
        rows.sparkSession.sql(f"INSERT INTO {name} ({', '.join(given)}) SELECT {', '.join(given)} FROM {view}")
    finally:
        rows.sparkSession.catalog.dropTempView(view)
