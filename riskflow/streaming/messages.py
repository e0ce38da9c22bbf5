"""Transaction messages: JSON encoding, decoding and the dead-letter route.

A message is a JSON object ``{TX_ID, TX_TS, CUSTOMER_ID, TERMINAL_ID, TX_AMOUNT}``
with the timestamp as text. ``parse_messages`` decodes with an explicit schema
(``from_json``, JVM side) and splits good rows from rows that cannot be scored.
The reference nacks such a message, which makes the broker redeliver it for
ever; here it goes to a dead-letter table with its raw text and a reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType([
    T.StructField("TX_ID", T.StringType()),
    T.StructField("TX_TS", T.StringType()),
    T.StructField("CUSTOMER_ID", T.StringType()),
    T.StructField("TERMINAL_ID", T.StringType()),
    T.StructField("TX_AMOUNT", T.DoubleType()),
])
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fixed dead-letter reasons.
REASON_MALFORMED = "malformed json"
REASON_NO_ID = "missing TX_ID"
REASON_BAD_TS = "bad TX_TS"
REASON_NO_AMOUNT = "missing TX_AMOUNT"
REASON_NO_PARTY = "missing CUSTOMER_ID or TERMINAL_ID"
FILES_PER_TRIGGER, OFFSETS_PER_TRIGGER = 100, 1_000_000


def message_text() -> Column:
    """The JSON text of a transaction, from its columns."""
    return F.to_json(F.struct(F.col("TX_ID"), F.date_format("TX_TS", TS_TEXT_FORMAT).alias("TX_TS"), F.col("CUSTOMER_ID"),
                              F.col("TERMINAL_ID"), F.col("TX_AMOUNT")))


def to_message(tx: DataFrame) -> DataFrame:
    """Encode transactions as one JSON text column ``value``."""
    return tx.select(message_text().alias("value"))


def _decoded(raw: DataFrame, value: str) -> DataFrame:
    return raw.select(F.col(value).cast("string").alias("_raw"),
                      F.from_json(F.col(value).cast("string"), MESSAGE_SCHEMA).alias("m"))


def _reason() -> Column:
    m = F.col("m")
    ts = F.try_to_timestamp(m["TX_TS"])
    # json_object_keys is NULL for text that is not a JSON object
    return (F.when(m.isNull() | F.json_object_keys(F.col("_raw")).isNull(), F.lit(REASON_MALFORMED))
            .when(m["TX_ID"].isNull(), F.lit(REASON_NO_ID))
            .when(m["CUSTOMER_ID"].isNull() | m["TERMINAL_ID"].isNull(), F.lit(REASON_NO_PARTY))
            .when(ts.isNull(), F.lit(REASON_BAD_TS))
            .when(m["TX_AMOUNT"].isNull(), F.lit(REASON_NO_AMOUNT)))


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Good messages as transactions (TX_TS a TIMESTAMP); works on batch and streaming frames."""
    d = _decoded(raw, value)
    return (d.where(_reason().isNull())
            .select(F.col("m.TX_ID").alias("TX_ID"), F.try_to_timestamp(F.col("m.TX_TS")).alias("TX_TS"),
                    F.col("m.CUSTOMER_ID").alias("CUSTOMER_ID"), F.col("m.TERMINAL_ID").alias("TERMINAL_ID"),
                    F.col("m.TX_AMOUNT").alias("TX_AMOUNT")))


def dead_letters(raw: DataFrame, value: str = "value") -> DataFrame:
    """Messages that cannot be scored: raw text and reason."""
    d = _decoded(raw, value)
    return d.select(F.col("_raw").alias("value"), _reason().alias("reason")).where(F.col("reason").isNotNull())


def message_stream(spark, source: str = "text", path: str | None = None, max_per_trigger: int | None = 0,
                   **options) -> DataFrame:
    """A stream of raw messages as one text column ``value``.

    ``source='text'``: one message per line of the files arriving under ``path``
    (``maxFilesPerTrigger`` bounds a micro-batch). ``source='kafka'``: the Kafka
    source (``options`` as for Spark's Kafka source, e.g.
    ``kafka_bootstrap_servers=...``, ``subscribe=...``; ``maxOffsetsPerTrigger``
    bounds a micro-batch); it needs the spark-sql-kafka package on the classpath.
    Without ``max_per_trigger`` a micro-batch is bounded by ``FILES_PER_TRIGGER`` files or ``OFFSETS_PER_TRIGGER``
    messages; None lifts the bound.
    """
    if max_per_trigger == 0:
        max_per_trigger = FILES_PER_TRIGGER if source == "text" else OFFSETS_PER_TRIGGER
    reader = spark.readStream
    if source == "text":
        if max_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        return reader.text(path)
    if source == "kafka":
        reader = reader.format("kafka")
        for k, v in options.items():
            reader = reader.option(k.replace("_", "."), v)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load().select(F.col("value").cast("string").alias("value"))
    raise ValueError(f"unknown message source {source!r}")
