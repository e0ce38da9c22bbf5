"""Registered streaming queries (S10-S13, R1-R6). Each runs a Structured Streaming
query to completion (``availableNow``) with its checkpoint below the shared
checkpoint folder, then reads the sink back as a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskflow.functions import as_timestamp
from riskflow.plans import features as fe
from riskflow.plans import sql_functions
from riskflow.plans.queries_joins import SNAPSHOT_AS_OF, SNAPSHOT_SQL
from riskflow.plans.queries_features import AS_OF_SQL, feature_ctes
from riskflow.plans import model_checks as mc
from riskflow.plans import models as mo
from riskflow.plans.queries_models import _fitted, _train
from riskflow.plans.registry import AS_OF, fixture, r, register
from riskflow.session import scratch_path, unique_name
from riskflow.sources import predictions, tables
from riskflow.sources.fixtures import DEAD_MESSAGE, labels_from_events, load_table, messages_from_events, transactions_from_events
from riskflow.streaming import commit_log
from riskflow.streaming import messages as msg
from riskflow.streaming import scoring as sc

MESSAGE_FILES = 6        # the fixture topic is written as at least this many files
FILES_PER_TRIGGER = 2    # -> several micro-batches per run
FIXED_MODEL_VERSION = "fixed-score"
FIXED_SCORE = "terminal_id_risk_1day_window"


def _events_stream(spark, sf_dir):
    schema = load_table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{sf_dir.rstrip('/')}/event[s].parquet"))  # a glob: the source wants a pattern or folder


def _topic(spark, sf_dir) -> str:
    """Write the fixture's message topic as text files; returns the folder."""
    path = scratch_path(spark, "topic")
    rows = messages_from_events(load_table(spark, sf_dir, "events"))
    # several files at any size: more with the input, so that no task writes more than a scan task reads
    rows.repartition(max(MESSAGE_FILES, rows.rdd.getNumPartitions())).write.text(path)
    return path


def _message_stream(spark, path):
    return msg.message_stream(spark, "text", path, FILES_PER_TRIGGER)


def _read_batches(spark, path):
    return sc.read_batches(spark, path).drop("run", "batch_id")


TX_SELECT = f"TX_ID, TX_TS, CUSTOMER_ID, TERMINAL_ID, {r('TX_AMOUNT')} AS TX_AMOUNT"


@register("stream_land_transactions", f"SELECT {TX_SELECT}, CAST(TX_TS AS DATE) AS tx_date FROM tx")
def q_stream_land_transactions(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "tx_stream"), scratch_path(spark, "ckpt")
    tx = transactions_from_events(_events_stream(spark, sf_dir)).withColumn("tx_date", F.to_date("TX_TS"))
    sc.land_stream(tx, sink, ckpt, partition_by=["tx_date"])
    return spark.read.parquet(sink)


@register("stream_land_labels", "SELECT TX_ID, TX_FRAUD FROM txlabels")
def q_stream_land_labels(spark, sf_dir):
    sink, ckpt = scratch_path(spark, "label_stream"), scratch_path(spark, "ckpt")
    sc.land_stream(labels_from_events(_events_stream(spark, sf_dir)), sink, ckpt)
    return spark.read.parquet(sink)


@register("stream_parse_json", f"SELECT {TX_SELECT} FROM tx JOIN txlabels USING (TX_ID)")
def q_stream_parse_json(spark, sf_dir):
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "parsed"), scratch_path(spark, "ckpt")
    sc.land_stream(msg.parse_messages(_message_stream(spark, topic)), sink, ckpt)
    return spark.read.parquet(sink)


@register("stream_dead_letter", f"""SELECT {DEAD_MESSAGE} AS value,
       ['{msg.REASON_NO_ID}', '{msg.REASON_MALFORMED}', '{msg.REASON_BAD_TS}', '{msg.REASON_NO_AMOUNT}', '{msg.REASON_NO_PARTY}'][event_id % 5 + 1] AS reason
FROM events WHERE event_type = 'signup'""", fixture_cte=False)
def q_stream_dead_letter(spark, sf_dir):
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "dead_letter"), scratch_path(spark, "ckpt")
    sc.land_stream(msg.dead_letters(_message_stream(spark, topic)), sink, ckpt)
    return spark.read.parquet(sink)


def _enriched_sql() -> str:
    feats = []
    for c in fe.CUSTOMER_FEATURES:
        feats.append(r(f"COALESCE(cf.{c}, 0)") + f" AS {c}")
    for c in fe.TERMINAL_FEATURES:
        feats.append(r(f"COALESCE(tf.{c}, 0)") + f" AS {c}")
    return f"""{feature_ctes().replace(AS_OF_SQL, SNAPSHOT_SQL)},
g AS (SELECT tx.* FROM tx JOIN txlabels USING (TX_ID)),
en AS (SELECT g.TX_ID, g.TX_TS, g.CUSTOMER_ID, g.TERMINAL_ID, {r('g.TX_AMOUNT')} AS tx_amount, {', '.join(feats)}
       FROM g ASOF LEFT JOIN cf ON g.CUSTOMER_ID = cf.customer_id AND g.TX_TS >= cf.feature_ts
              ASOF LEFT JOIN tf ON g.TERMINAL_ID = tf.terminal_id AND g.TX_TS >= tf.feature_ts)"""


def _snapshot(spark, sf_dir) -> dict:
    tx, lb = fixture(spark, sf_dir)
    return sc.materialize_features(spark, tx, lb, SNAPSHOT_AS_OF, scratch_path(spark, "features"))


@register("stream_enrich", f"WITH {_enriched_sql()}\nSELECT * FROM en")
def q_stream_enrich(spark, sf_dir):
    paths = _snapshot(spark, sf_dir)
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "enriched"), scratch_path(spark, "ckpt")
    sc.run_enrich_stream(spark, _message_stream(spark, topic), paths, sink, ckpt)
    return _read_batches(spark, sink)


_PRED_SQL = f"""WITH {_enriched_sql()},
pr AS (SELECT TX_ID, TX_TS AS prediction_timestamp, COALESCE({FIXED_SCORE}, 0.0) AS p FROM en)
SELECT TX_ID, prediction_timestamp, {r('p')} AS fraud_probability, p > 0.5 AS is_fraud,
       '{FIXED_MODEL_VERSION}' AS model_version, {AS_OF_SQL} AS created_at FROM pr"""


def _fixed_predictions(spark, sf_dir, created_at=AS_OF):
    paths = _snapshot(spark, sf_dir)
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "predictions"), scratch_path(spark, "ckpt")
    sc.run_scoring_stream(spark, _message_stream(spark, topic), paths, sink, ckpt,
                          model_version=FIXED_MODEL_VERSION, created_at=created_at, score_col=FIXED_SCORE)
    return _read_batches(spark, sink)


@register("prediction_rows", _PRED_SQL)
def q_prediction_rows(spark, sf_dir):
    return _fixed_predictions(spark, sf_dir).select(*sc.PREDICTION_COLUMNS)


_LATER = "prediction_timestamp + INTERVAL 1 SECOND * (CAST(TX_ID AS BIGINT) % 7)"


@register("latest_predictions", f"""WITH p AS ({_PRED_SQL})
SELECT * REPLACE ({_LATER} AS created_at) FROM p ORDER BY created_at DESC, prediction_timestamp DESC, TX_ID ASC LIMIT 10""")
def q_latest_predictions(spark, sf_dir):
    """Predictions with creation times of their own."""
    later = F.timestamp_seconds(F.unix_seconds("TX_TS") + F.col("TX_ID").cast("long") % 7)
    return sc.latest_predictions(_fixed_predictions(spark, sf_dir, later)).select(*sc.PREDICTION_COLUMNS)


@register("prediction_table", f"""WITH p AS ({_PRED_SQL})
SELECT * EXCLUDE (created_at), CAST(TX_ID AS BIGINT) % 2 = 0 AS given, TRUE AS created_at_agrees FROM p""")
def q_prediction_table(spark, sf_dir):
    """Scored rows inserted by name into the catalog table: even ids with a creation time, the others take the default."""
    rows = _fixed_predictions(spark, sf_dir)
    db = unique_name("riskflow_predictions")
    tables.create_namespace(spark, db, scratch_path(spark, "warehouse"))
    name = predictions.create_prediction_table(spark, f"{db}.online_fraud_prediction")
    start, even = spark.sql("SELECT current_timestamp() AS t").first()["t"], F.col("TX_ID").cast("long") % 2 == 0
    predictions.insert_predictions(rows.where(even), name)
    predictions.insert_predictions(rows.where(~even).drop("created_at"), name)
    at = F.col("created_at")
    agrees = F.when(even, at == as_timestamp(AS_OF)).otherwise(at.between(F.lit(start), F.current_timestamp()))
    return spark.table(name).select(*[c for c in sc.PREDICTION_COLUMNS if c != "created_at"], even.alias("given"), agrees.alias("created_at_agrees"))


@register("stream_replayed_batch", f"""SELECT TX_ID, TX_TS, CAST(CAST(TX_ID AS BIGINT) % 3 AS INTEGER) AS batch_id,
       CASE WHEN CAST(TX_ID AS BIGINT) % 3 = 1 THEN {r('2 * TX_AMOUNT')} ELSE {r('TX_AMOUNT')} END AS TX_AMOUNT FROM tx""")
def q_stream_replayed_batch(spark, sf_dir):
    """Three published batches, one of them replayed with other amounts, and a compacted log."""
    tx, _ = fixture(spark, sf_dir)
    sink, batch = scratch_path(spark, "replayed"), F.col("TX_ID").cast("long") % 3
    for i in range(3):
        sc.write_batch(tx.where(batch == i), sink, i)
    commit_log.compact(spark, sink)
    sc.write_batch(tx.where(batch == 1).withColumn("TX_AMOUNT", F.col("TX_AMOUNT") * 2), sink, 1)
    return sc.read_batches(spark, sink).select("TX_ID", "TX_TS", "batch_id", "TX_AMOUNT")


@register("lookup_transaction", f"""WITH {_enriched_sql()}
SELECT * FROM en ORDER BY TX_TS DESC, TX_ID DESC LIMIT 1""")
def q_lookup_transaction(spark, sf_dir):
    """The newest labelled transaction, given as named parameters of one statement."""
    tx, lb = fixture(spark, sf_dir)
    given = tx.join(lb, "TX_ID").orderBy(F.desc("TX_TS"), F.desc("TX_ID")).first()
    snapshot = sc.read_snapshot(spark, _snapshot(spark, sf_dir))
    return sql_functions.lookup(spark, given.asDict(), snapshot["customer"], snapshot["terminal"])


@register("stream_score", f"""WITH {_enriched_sql()}
SELECT TX_ID, TX_TS AS prediction_timestamp, 'logreg' AS model_version, TRUE AS probability_agrees, TRUE AS flag_agrees FROM en""")
def q_stream_score(spark, sf_dir):
    """Score the topic with the logistic-regression model; every stored row against the sigmoid of the model's
    coefficients over the batch-enriched transaction."""
    model = _fitted(_train(spark, sf_dir), "logreg")
    paths = _snapshot(spark, sf_dir)
    topic = _topic(spark, sf_dir)
    sink, ckpt = scratch_path(spark, "scores"), scratch_path(spark, "ckpt")
    sc.run_scoring_stream(spark, _message_stream(spark, topic), paths, sink, ckpt, model=model,
                          model_version="logreg")
    stored = _read_batches(spark, sink)
    rows = sc.enrich_with(msg.parse_messages(spark.read.text(topic)), sc.read_snapshot(spark, paths))
    plain = rows.select("TX_ID", mc.logistic_probability(model, mo.FEATURES).alias("_own"))
    return stored.join(plain, "TX_ID").select(
        "TX_ID", "prediction_timestamp", "model_version", mc.close(F.col("fraud_probability"), F.col("_own")).alias("probability_agrees"),
        (F.col("is_fraud") == (F.col("_own") > 0.5)).alias("flag_agrees"))
