"""Micro-batch scoring of live transactions (C4) with Structured Streaming.

The reference handles one message at a time: a parameterised SQL lookup of the
newest customer and terminal feature rows not later than the transaction, a
call to a model endpoint, one row insert, then ack. Here each micro-batch is
handled as a whole inside ``foreachBatch``:

1. ``enrich`` -- the newest feature row not later than each transaction, from
   the stored snapshot: an equi-join with the newest row per key when the batch
   is live (the usual case), the general as-of join (``riskflow.operators.asof``)
   against the history of the batch's keys when it holds older transactions;
   missing features become 0 (the reference's COALESCE), all features doubles;
2. ``PipelineModel.transform`` scores the batch (probability of class 1);
3. ``prediction_rows`` projects the six prediction columns (NULL probability
   -> 0.0, ``is_fraud = p > 0.5``);
4. the batch is written aside and then named in the sink's log (``commit_log``): a
   replayed batch (after a failure, from the checkpoint) replaces its own entry, so
   that readers see the old form or the new one, and a stream with another
   checkpoint appends.

Offsets live in the checkpoint folder below the shared ``spark.checkpoint.dir``;
``maxFilesPerTrigger`` (file source) bounds the size of a batch.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions import as_timestamp
from riskflow.operators.asof import asof_join
from riskflow.plans import features as fe
from riskflow.streaming import commit_log
from riskflow.streaming.messages import dead_letters, parse_messages

ENRICHED_FEATURES = [*fe.CUSTOMER_FEATURES, *fe.TERMINAL_FEATURES]
THRESHOLD = 0.5
KEY_PART, KEY_PARTS, COMPLETE = "key_part", 32, "_COMPLETE"
# The prediction table (typed DDL of the reference; created_at defaults to the time of the write).
PREDICTION_SCHEMA = T.StructType([
    T.StructField("TX_ID", T.StringType()),
    T.StructField("prediction_timestamp", T.TimestampType()),
    T.StructField("fraud_probability", T.DoubleType()),
    T.StructField("is_fraud", T.BooleanType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])
PREDICTION_COLUMNS = [f.name for f in PREDICTION_SCHEMA.fields]


def _stored_by_key(df: DataFrame, key: str, path: str) -> None:
    """Write a feature table in ``KEY_PARTS`` folders by the hash of its key, sorted by key."""
    (df.withColumn(KEY_PART, _key_part(F.col(key))).repartition(KEY_PART).sortWithinPartitions(KEY_PART, key)
     .write.partitionBy(KEY_PART).parquet(path))


def _key_part(key):
    return F.pmod(F.hash(key), F.lit(KEY_PARTS))


def materialize_features(spark: SparkSession, tx: DataFrame, labels: DataFrame, as_of, path: str) -> dict:
    """Write the feature snapshot of ``as_of`` below ``path``: the per-second customer and
    terminal tables and, for each, its newest row per key (``*_latest``).

    Computed once, read by every micro-batch; returns the table paths. Every
    call writes a version folder of its own, marked when it is complete, so a
    running stream never loses the files it reads; a stream given ``path`` itself
    takes the newest complete version with each batch (``newest_snapshot``).
    The tables are partitioned by a hash of their key, so that a batch reads
    only the folders of its keys. The labelled history (one scan and label join)
    is kept persisted only while its two feature tables are written.
    """
    version = f"{path.rstrip('/')}/version={_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}"
    out = {k: f"{version}/{k}" for k in ("customer", "terminal", "customer_latest", "terminal_latest")}
    as_of = fe.resolve_as_of(as_of)
    base = fe.labelled_recent(tx, labels, as_of).persist()
    try:
        _stored_by_key(fe.customer_per_second(tx, labels, base=base).drop("n_tx"), "customer_id", out["customer"])
        _stored_by_key(fe.terminal_per_second(tx, labels, base=base).drop("n_tx"), "terminal_id", out["terminal"])
    finally:
        base.unpersist()
    for kind, key in (("customer", "customer_id"), ("terminal", "terminal_id")):
        table = spark.read.parquet(out[kind]).drop(KEY_PART)
        _stored_by_key(fe.latest_per_key(table, key), key, out[f"{kind}_latest"])
    _files(spark, version)[0].createNewFile(_files(spark, f"{version}/{COMPLETE}")[1])
    return out


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def newest_snapshot(spark: SparkSession, path: str) -> dict:
    """The table paths of the newest complete version below ``path``."""
    fs, p = _files(spark, path)
    versions = sorted(str(s.getPath()) for s in fs.listStatus(p) if s.isDirectory())
    done = [v for v in versions if fs.exists(_files(spark, f"{v}/{COMPLETE}")[1])]
    if not done:
        raise FileNotFoundError(f"no complete feature snapshot below {path}")
    return {k: f"{done[-1]}/{k}" for k in ("customer", "terminal", "customer_latest", "terminal_latest")}


def read_snapshot(spark: SparkSession, paths: dict | str) -> dict:
    """The snapshot's tables, from their paths or from the folder of all versions."""
    if isinstance(paths, str):
        paths = newest_snapshot(spark, paths)
    return {k: spark.read.parquet(v) for k, v in paths.items()}


class Snapshots:
    """The tables that a stream's batches read: listed once for each version (a version never changes), not per batch."""

    def __init__(self, spark: SparkSession, paths: dict | str):
        self.spark, self.paths, self.version, self.tables = spark, paths, None, {}

    def current(self) -> dict:
        paths = newest_snapshot(self.spark, self.paths) if isinstance(self.paths, str) else self.paths
        if paths != self.version:
            self.version, self.tables = paths, read_snapshot(self.spark, paths)
        return self.tables


class BatchKeys:
    """The different customers and terminals of a batch, and the snapshot folders they are in: one small job for all
    tables of the snapshot."""

    def __init__(self, batch: DataFrame, keep=lambda df: df):
        self.keys = {k: keep(batch.select(c).distinct()) for k, c in (("customer_id", "CUSTOMER_ID"), ("terminal_id", "TERMINAL_ID"))}
        self.batch, self._parts = batch, None

    def _key_parts(self, fkey: str) -> list[int]:
        if self._parts is None:  # at most KEY_PARTS numbers each
            sets = [F.collect_set(_key_part(F.col(df.columns[0]))).alias(k) for k, df in self.keys.items()]
            self._parts = self.batch.agg(*sets).first()
        return self._parts[fkey]

    def of(self, features: DataFrame, fkey: str) -> DataFrame:
        """The feature rows of the batch's keys; of a stored snapshot, only the key folders of the batch are read."""
        keys = self.keys[fkey]
        if KEY_PART in features.columns:
            parts = self._key_parts(fkey)
            if len(parts) < KEY_PARTS:
                features = features.where(F.col(KEY_PART).isin(parts))
            features = features.drop(KEY_PART)
        return features.join(keys, features[fkey] == keys[keys.columns[0]], "left_semi")


def _keys_in(batch: DataFrame, key: str, features: DataFrame, fkey: str) -> DataFrame:
    return BatchKeys(batch).of(features, fkey)


class Persisted:
    """Persists batch-sized intermediates of one micro-batch and releases them after its write.

    A micro-batch is bounded by the trigger limit, so keeping it in executor
    memory (spilling to disk) while several branches read it is cheap and
    avoids re-reading the source for each branch.
    """

    def __init__(self):
        self.frames: list[DataFrame] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        df = df.persist()
        self.frames.append(df)
        return df

    def release(self) -> None:
        for df in self.frames:
            df.unpersist()
        self.frames.clear()


def _same(df: DataFrame) -> DataFrame:
    return df


def _general(batch: DataFrame, history: DataFrame, key: str, hkey: str, cols: list[str], keys: BatchKeys) -> DataFrame:
    """General as-of lookup against the history of the batch's keys only; a snapshot's history is bounded by its days."""
    return asof_join(batch, keys.of(history, hkey), key, "TX_TS", hkey, "feature_ts", cols, keep_right_ts=False,
                     right_unique=True, compact_left=False, by_span=False)


def _latest_cols(latest: DataFrame, hkey: str, cols: list[str], tag: str) -> DataFrame:
    return latest.select(F.col(hkey).alias(f"_{tag}k"), F.col("feature_ts").alias(f"_{tag}ts"),
                         *[F.col(c) for c in cols])


def enrich(batch: DataFrame, customer_features: DataFrame, terminal_features: DataFrame,
           fill: float | None = 0.0, customer_latest: DataFrame | None = None,
           terminal_latest: DataFrame | None = None, keep=_same) -> DataFrame:
    """Transactions plus ``tx_amount`` and the 24 features of the newest rows not later than TX_TS.

    With ``*_latest`` (newest row per key, see ``materialize_features``): live
    transactions are almost always newer than the snapshot, and then the answer
    is the key's newest row -- one equi-join per table. Rows older than their
    key's newest row (replays, late arrivals) go through the general as-of join
    against the history of just their keys. When ``keep`` (a ``Persisted``) is
    given, the joined batch is persisted and one small job tells whether any row
    is late; if none is, the history is not touched at all, else the late rows
    alone take the general path.
    Without ``*_latest`` every row takes the general as-of join.
    """
    c_cols, t_cols = list(fe.CUSTOMER_FEATURES), list(fe.TERMINAL_FEATURES)

    batch = keep(batch)
    keys = BatchKeys(batch, keep)

    def general(rows: DataFrame) -> DataFrame:
        out = _general(rows, customer_features, "CUSTOMER_ID", "customer_id", c_cols, keys)
        return _general(out, terminal_features, "TERMINAL_ID", "terminal_id", t_cols, keys)

    if customer_latest is None or terminal_latest is None:
        out = general(batch)
    else:
        # newest rows of the batch's keys only: the distinct keys of a trigger-bounded
        # batch are the small side AQE can broadcast, so the key tables are filtered
        # where they are read instead of being shuffled whole for every batch
        cl = _latest_cols(keys.of(customer_latest, "customer_id"), "customer_id", c_cols, "c")
        tl = _latest_cols(keys.of(terminal_latest, "terminal_id"), "terminal_id", t_cols, "t")
        j = (batch.join(cl, batch["CUSTOMER_ID"] == cl["_ck"], "left")
             .join(tl, batch["TERMINAL_ID"] == tl["_tk"], "left"))
        late = (F.coalesce(F.col("_cts") > F.col("TX_TS"), F.lit(False))
                | F.coalesce(F.col("_tts") > F.col("TX_TS"), F.lit(False)))
        j = keep(j.withColumn("_late", late))
        if keep is _same:  # no persisted batch: split by row, one plan
            out = (j.where(~F.col("_late")).select(*batch.columns, *c_cols, *t_cols)
                   .unionByName(general(j.where(F.col("_late")).select(*batch.columns))))
        elif j.where(F.col("_late")).limit(1).count() > 0:  # late rows alone take the general path
            late_rows = keep(j.where(F.col("_late")).select(*batch.columns))
            out = j.where(~F.col("_late")).select(*batch.columns, *c_cols, *t_cols).unionByName(general(late_rows))
        else:  # live batch: the newest rows are the answer
            out = j.select(*batch.columns, *c_cols, *t_cols)
    feats = [(F.coalesce(F.col(c).cast("double"), F.lit(float(fill))) if fill is not None
              else F.col(c).cast("double")).alias(c) for c in ENRICHED_FEATURES]
    return out.select("TX_ID", "TX_TS", "CUSTOMER_ID", "TERMINAL_ID",
                      F.col("TX_AMOUNT").cast("double").alias("tx_amount"), *feats)


def enrich_with(batch: DataFrame, snapshot: dict, fill: float | None = 0.0, keep=_same) -> DataFrame:
    return enrich(batch, snapshot["customer"], snapshot["terminal"], fill,
                  snapshot.get("customer_latest"), snapshot.get("terminal_latest"), keep)


def lookup_features(spark: SparkSession, snapshot: dict, transaction: dict, fill: float | None = 0.0) -> DataFrame:
    """Features of one transaction given as parameters (``TX_ID``, ``TX_TS`` text,
    ``CUSTOMER_ID``, ``TERMINAL_ID``, ``TX_AMOUNT``): the reference's per-message lookup.

    The parameters become a one-row frame (typed by the message schema) that goes
    through the same enrichment as a micro-batch; use ``enrich_with`` for many.
    """
    from riskflow.streaming.messages import MESSAGE_SCHEMA

    row = spark.createDataFrame([tuple(transaction.get(f.name) for f in MESSAGE_SCHEMA.fields)], MESSAGE_SCHEMA)
    row = row.withColumn("TX_TS", F.try_to_timestamp(F.col("TX_TS")))
    return enrich_with(row, snapshot, fill)


def prediction_rows(scored: DataFrame, prob: str = "fraud_probability", model_version: str = "unknown",
                    created_at=None) -> DataFrame:
    """The prediction table rows; ``created_at`` defaults to the current time."""
    p = F.coalesce(F.col(prob).cast("double"), F.lit(0.0))
    values = [F.col("TX_ID"), F.col("TX_TS"), p, p > F.lit(THRESHOLD), F.lit(model_version),
              as_timestamp(created_at)]
    return scored.select(*[v.cast(f.dataType).alias(f.name) for v, f in zip(values, PREDICTION_SCHEMA.fields)])


def latest_predictions(predictions: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` newest predictions by ``created_at`` (ties: newer transaction, then TX_ID)."""
    return predictions.orderBy(F.col("created_at").desc(), F.col("prediction_timestamp").desc(),
                               F.col("TX_ID").asc()).limit(k)


def score_batch(batch: DataFrame, snapshot: dict, model: PipelineModel | None, model_version: str,
                created_at=None, score_col: str | None = None, keep=_same) -> DataFrame:
    """Enrich, score and project one batch. ``snapshot``: tables of ``read_snapshot``.
    ``score_col`` (instead of a model) names an enriched column taken as the probability
    -- a fixed, model-free score."""
    enriched = enrich_with(batch, snapshot, keep=keep)
    if model is not None:
        from pyspark.ml.functions import vector_to_array

        scored = model.transform(enriched)
        scored = scored.withColumn("fraud_probability", vector_to_array(F.col("probability")).getItem(1))
    else:
        scored = enriched.withColumn("fraud_probability", F.col(score_col or "terminal_id_risk_1day_window"))
    return prediction_rows(scored, "fraud_probability", model_version, created_at)


def run_of(checkpoint: str) -> str:
    """A name for all runs of a stream on one checkpoint: batch numbers go on with the checkpoint, and start again
    with a new one."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def write_batch(df: DataFrame, sink: str, batch_id: int, run: str = "0") -> None:
    """Publish a batch (``commit_log``): a replay of ``batch_id`` of the same ``run`` replaces it in one step; streams with
    other checkpoints append to the table."""
    commit_log.publish(df, sink, batch_id, run)


def read_batches(spark: SparkSession, sink: str) -> DataFrame:
    """The published batches of a sink, with ``run`` and ``batch_id``."""
    return commit_log.read(spark, sink)


def run_scoring_stream(spark: SparkSession, raw_stream: DataFrame, feature_paths: dict, sink: str,
                       checkpoint: str, model: PipelineModel | None = None, model_version: str = "unknown",
                       created_at=None, score_col: str | None = None, dead_letter_sink: str | None = None,
                       available_now: bool = True):
    """Start (and with ``available_now`` run to completion) the scoring stream over ``raw_stream``
    (a streaming frame with a text column ``value``). Returns the StreamingQuery."""
    run, snapshots = run_of(checkpoint), Snapshots(spark, feature_paths)

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        keep = Persisted()
        try:
            raw = keep(batch_df)
            rows = score_batch(parse_messages(raw), snapshots.current(), model, model_version,
                               created_at, score_col, keep)
            write_batch(rows, sink, batch_id, run)
            if dead_letter_sink:
                write_batch(dead_letters(raw), dead_letter_sink, batch_id, run)
        finally:
            keep.release()

    writer = raw_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def run_enrich_stream(spark: SparkSession, raw_stream: DataFrame, feature_paths: dict, sink: str,
                      checkpoint: str):
    """Stream of enriched transactions (R1 alone), written per batch like the scores."""
    run, snapshots = run_of(checkpoint), Snapshots(spark, feature_paths)

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        keep = Persisted()
        try:
            enriched = enrich_with(parse_messages(batch_df), snapshots.current(), keep=keep)
            write_batch(enriched, sink, batch_id, run)
        finally:
            keep.release()

    q = (raw_stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def land_stream(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                partition_by: list[str] | None = None):
    """Append a stream to a file table (Spark's file sink: exactly-once through its log)."""
    w = stream.writeStream.format(fmt).option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.trigger(availableNow=True).start(sink)
    q.awaitTermination()
    return q
