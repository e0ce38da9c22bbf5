"""Streaming: parsing and dead letters, stream = batch, replay without duplicates."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, make_tx
from riskflow.session import scratch_path
from riskflow.sources.fixtures import load_fixture, load_table, messages_from_events
from riskflow.streaming import messages as msg
from riskflow.streaming import scoring as sc

SNAP = "2024-01-20 00:00:00"


def test_dead_letter_reasons(spark):
    good = json.dumps({"TX_ID": "1", "TX_TS": "2024-01-21 10:00:00", "CUSTOMER_ID": "c", "TERMINAL_ID": "t",
                       "TX_AMOUNT": 3.5})
    rows = [good, "{not json", json.dumps({"k": 1}),
            json.dumps({"TX_ID": "2", "TX_TS": "yesterday", "CUSTOMER_ID": "c", "TERMINAL_ID": "t", "TX_AMOUNT": 1.0}),
            json.dumps({"TX_ID": "3", "TX_TS": "2024-01-21 10:00:00", "CUSTOMER_ID": "c", "TERMINAL_ID": "t", "TX_AMOUNT": None})]
    raw = spark.createDataFrame([(r,) for r in rows], "value string")
    parsed = msg.parse_messages(raw).collect()
    assert [r["TX_ID"] for r in parsed] == ["1"]
    reasons = sorted(r["reason"] for r in msg.dead_letters(raw).collect())
    assert reasons == sorted([msg.REASON_MALFORMED, msg.REASON_NO_ID, msg.REASON_BAD_TS, msg.REASON_NO_AMOUNT])


def test_unknown_customer_gets_zero_features(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    paths = sc.materialize_features(spark, tx, lb, SNAP, scratch_path(spark, "feat"))
    batch = make_tx(spark, [("n1", "2024-01-25 00:00:00", "no-such-customer", "no-such-terminal", 12.0)])
    out = sc.enrich_with(batch, sc.read_snapshot(spark, paths)).collect()
    assert len(out) == 1
    assert all(out[0][c] == 0.0 for c in sc.ENRICHED_FEATURES)


def test_prediction_row_rules(spark):
    scored = spark.createDataFrame([("a", 0.5), ("b", None), ("c", 0.51)], "TX_ID string, p double") \
        .withColumn("TX_TS", F.current_timestamp())
    rows = {r["TX_ID"]: r for r in sc.prediction_rows(scored, "p", "v1", "2024-01-31 00:00:00").collect()}
    assert rows["a"]["is_fraud"] is False and rows["c"]["is_fraud"] is True
    assert rows["b"]["fraud_probability"] == 0.0 and rows["b"]["is_fraud"] is False
    assert rows["a"]["model_version"] == "v1"


def _topic(spark):
    path = scratch_path(spark, "topic")
    messages_from_events(load_table(spark, SF_SMALL, "events")).repartition(3).write.text(path)
    return path


def test_stream_equals_batch_and_replay_is_idempotent(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    paths = sc.materialize_features(spark, tx, lb, SNAP, scratch_path(spark, "feat"))
    topic = _topic(spark)
    sink, ckpt = scratch_path(spark, "pred"), scratch_path(spark, "ckpt")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(topic)
    sc.run_scoring_stream(spark, stream, paths, sink, ckpt, model_version="fixed", created_at=SNAP,
                          score_col="terminal_id_risk_1day_window")
    first = sc.read_batches(spark, sink)
    assert first.select("batch_id").distinct().count() == 3  # one batch per file
    n = first.count()
    # batch computation of the same rows
    raw = spark.read.text(topic)
    batch = sc.score_batch(msg.parse_messages(raw), sc.read_snapshot(spark, paths), None, "fixed", SNAP,
                           "terminal_id_risk_1day_window")
    cols = sc.PREDICTION_COLUMNS
    assert first.select(*cols).exceptAll(batch.select(*cols)).count() == 0
    assert batch.count() == n
    # restart on the same checkpoint: nothing is reprocessed
    stream2 = spark.readStream.option("maxFilesPerTrigger", 1).text(topic)
    sc.run_scoring_stream(spark, stream2, paths, sink, ckpt, model_version="fixed", created_at=SNAP,
                          score_col="terminal_id_risk_1day_window")
    assert sc.read_batches(spark, sink).count() == n
    # a replayed batch (same id) overwrites its own output
    run = sc.run_of(ckpt)
    sc.write_batch(batch.limit(5), sink, 0, run)
    sc.write_batch(batch.limit(5), sink, 0, run)
    assert sc.read_batches(spark, sink).where("batch_id = 0").count() == 5


def test_latest_fast_path_equals_general_asof(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    paths = sc.materialize_features(spark, tx, lb, SNAP, scratch_path(spark, "feat"))
    snap = sc.read_snapshot(spark, paths)
    batch = tx  # the whole month: before, inside and after the snapshot history
    general = sc.enrich(batch, snap["customer"], snap["terminal"])
    live = batch.where(F.col("TX_TS") > F.lit(SNAP).cast("timestamp"))
    live_general = sc.enrich(live, snap["customer"], snap["terminal"])
    for rows, expected in ((batch, general), (live, live_general)):
        fast = sc.enrich_with(rows, snap)  # split by row in one plan
        keep = sc.Persisted()
        try:
            decided = sc.enrich_with(rows, snap, keep=keep)  # persisted: whole-batch decision
            for got in (fast, decided):
                assert got.count() == rows.count()
                assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
        finally:
            keep.release()


def test_parse_round_trip(spark):
    tx = make_tx(spark, [("1", "2024-01-21 10:00:07", "c", "t", 3.25)])
    back = msg.parse_messages(msg.to_message(tx)).collect()[0]
    assert back["TX_TS"].strftime("%Y-%m-%d %H:%M:%S") == "2024-01-21 10:00:07"
    assert back["TX_AMOUNT"] == pytest.approx(3.25)


def test_streams_with_other_checkpoints_append(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    paths = sc.materialize_features(spark, tx, lb, SNAP, scratch_path(spark, "feat"))
    sink = scratch_path(spark, "pred")
    for ids in (["a", "b", "c"], ["d"]):
        topic = scratch_path(spark, "topic")
        rows = make_tx(spark, [(i, "2024-01-25 00:00:00", "1", "t1", 12.0) for i in ids])
        msg.to_message(rows).coalesce(1).write.text(topic)
        sc.run_scoring_stream(spark, msg.message_stream(spark, "text", topic), paths, sink, scratch_path(spark, "ckpt"),
                              model_version="fixed", created_at=SNAP, score_col="terminal_id_risk_1day_window")
    assert sorted(r["TX_ID"] for r in sc.read_batches(spark, sink).collect()) == ["a", "b", "c", "d"]


def test_messages_without_their_parties_are_dead_letters(spark):
    body = {"TX_ID": "1", "TX_TS": "2024-01-21 10:00:00", "CUSTOMER_ID": "c", "TERMINAL_ID": "t", "TX_AMOUNT": 3.5}
    rows = [json.dumps({k: v for k, v in body.items() if k != gone}) for gone in ("CUSTOMER_ID", "TERMINAL_ID")]
    raw = spark.createDataFrame([(r,) for r in rows], "value string")
    assert msg.parse_messages(raw).count() == 0
    assert {r["reason"] for r in msg.dead_letters(raw).collect()} == {msg.REASON_NO_PARTY}


def test_single_transaction_lookup_matches_batch(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    paths = sc.materialize_features(spark, tx, lb, SNAP, scratch_path(spark, "feat"))
    snap = sc.read_snapshot(spark, paths)
    one = tx.where("TX_TS > TIMESTAMP '2024-01-25 00:00:00'").orderBy("TX_ID").first()
    params = {"TX_ID": one["TX_ID"], "TX_TS": one["TX_TS"].strftime("%Y-%m-%d %H:%M:%S"),
              "CUSTOMER_ID": one["CUSTOMER_ID"], "TERMINAL_ID": one["TERMINAL_ID"], "TX_AMOUNT": one["TX_AMOUNT"]}
    got = sc.lookup_features(spark, snap, params).collect()
    exp = sc.enrich_with(tx.where(F.col("TX_ID") == one["TX_ID"]), snap).collect()
    assert len(got) == 1 and got[0].asDict() == exp[0].asDict()


def test_failed_batch_is_replayed_without_duplicates(spark, monkeypatch):
    tx, lb = load_fixture(spark, SF_SMALL)
    paths = sc.materialize_features(spark, tx, lb, SNAP, scratch_path(spark, "feat"))
    topic = _topic(spark)
    sink, ckpt = scratch_path(spark, "pred"), scratch_path(spark, "ckpt")
    real_write = sc.write_batch
    failed = []

    def flaky_write(df, path, batch_id, run):
        if batch_id == 1 and not failed:  # the task/executor dies while batch 1 is written
            failed.append(batch_id)
            raise RuntimeError("lost executor")
        real_write(df, path, batch_id, run)

    monkeypatch.setattr(sc, "write_batch", flaky_write)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(topic)
    with pytest.raises(Exception):
        sc.run_scoring_stream(spark, stream, paths, sink, ckpt, model_version="fixed", created_at=SNAP,
                              score_col="terminal_id_risk_1day_window")
    assert failed == [1]
    # restart on the same checkpoint: batch 1 is replayed, batch 0 is not redone
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(topic)
    sc.run_scoring_stream(spark, stream, paths, sink, ckpt, model_version="fixed", created_at=SNAP,
                          score_col="terminal_id_risk_1day_window")
    out = sc.read_batches(spark, sink)
    expected = msg.parse_messages(spark.read.text(topic)).count()
    assert out.count() == expected
    assert out.select("TX_ID").distinct().count() == expected
    assert sorted(r[0] for r in out.select("batch_id").distinct().collect()) == [0, 1, 2]


def test_refreshed_snapshot_is_taken_and_the_old_one_stays(spark):
    tx, lb = load_fixture(spark, SF_SMALL)
    path = scratch_path(spark, "feat")
    old = sc.materialize_features(spark, tx, lb, "2024-01-10 00:00:00", path)
    before = sc.read_snapshot(spark, old)["customer"].count()
    new = sc.materialize_features(spark, tx, lb, SNAP, path)
    assert sc.newest_snapshot(spark, path)["customer"].endswith(new["customer"].split("/riskflow/")[-1])
    assert sc.read_snapshot(spark, old)["customer"].count() == before  # a running stream's files are still there
    one = tx.limit(1)
    plan = sc._keys_in(one, "CUSTOMER_ID", sc.read_snapshot(spark, path)["customer"], "customer_id")
    assert "PartitionFilters: [isnotnull(key_part" in plan._jdf.queryExecution().executedPlan().toString() or "key_part#" in plan._jdf.queryExecution().executedPlan().toString()


# --- commit log and prediction table ---------------------------------------------------------------------------------

def test_readers_see_the_old_batch_until_the_new_one_is_published(spark, monkeypatch):
    from riskflow.streaming import commit_log

    sink = scratch_path(spark, "log")
    a, b = (spark.range(n).withColumnRenamed("id", "v") for n in (3, 5))
    commit_log.publish(a, sink, 0, "r")
    commit_log.publish(a, sink, 1, "r")
    old = commit_log.read(spark, sink)
    seen = []
    put = commit_log._put

    def watched(*args):  # the new form is written, its entry is not yet in place
        seen.append(commit_log.read(spark, sink).where("batch_id = 1").count())
        put(*args)

    monkeypatch.setattr(commit_log, "_put", watched)
    commit_log.publish(b, sink, 1, "r")
    assert seen == [3] and commit_log.read(spark, sink).where("batch_id = 1").count() == 5
    assert old.where("batch_id = 1").count() == 3  # a reader that has the old files still reads them

    def broken(*args):
        raise RuntimeError("lost driver")

    monkeypatch.setattr(commit_log, "_put", broken)
    with pytest.raises(RuntimeError):
        commit_log.publish(a, sink, 1, "r")
    monkeypatch.setattr(commit_log, "_put", put)
    assert commit_log.read(spark, sink).count() == 8
    assert commit_log.vacuum(spark, sink) == 2 and commit_log.read(spark, sink).count() == 8


def test_compacted_log_gives_way_to_newer_entries(spark):
    from riskflow.streaming import commit_log

    sink = scratch_path(spark, "log")
    with pytest.raises(FileNotFoundError):
        commit_log.read(spark, sink)
    assert commit_log.read(spark, sink, sc.PREDICTION_SCHEMA).count() == 0
    for i in range(4):
        commit_log.publish(spark.range(i + 1), sink, i, "r")
    commit_log.publish(spark.range(7), sink, 0, "other")
    assert commit_log.compact(spark, sink) == 5 and commit_log._log_files(spark, sink) == [commit_log.COMPACTED]
    assert commit_log.read(spark, sink).count() == 17
    commit_log.publish(spark.range(100), sink, 2, "r")
    assert commit_log.read(spark, sink).count() == 114
    assert commit_log.compact(spark, sink) == 5 and commit_log.read(spark, sink).count() == 114


def test_prediction_table_fills_in_its_default(spark):
    from riskflow.session import unique_name
    from riskflow.sources import predictions, tables

    db = unique_name("predictions")
    tables.create_namespace(spark, db, scratch_path(spark, "warehouse"))
    name = predictions.create_prediction_table(spark, f"{db}.online_fraud_prediction")
    assert [f.name for f in spark.table(name).schema] == sc.PREDICTION_COLUMNS
    assert [f.dataType for f in spark.table(name).schema] == [f.dataType for f in sc.PREDICTION_SCHEMA]
    rows = spark.createDataFrame([("a", 0.9), ("b", None)], "TX_ID string, p double").withColumn("TX_TS", F.lit("2024-01-30 00:00:00").cast("timestamp"))
    full = sc.prediction_rows(rows, "p", "v", "2024-01-31 00:00:00")
    before = spark.sql("SELECT current_timestamp() AS t").first()["t"]
    predictions.insert_predictions(full, name)
    predictions.insert_predictions(full.drop("created_at").select(*reversed(sc.PREDICTION_COLUMNS[:-1])), name)  # by name
    got = spark.table(name).collect()
    assert sorted(r["fraud_probability"] for r in got) == [0.0, 0.0, 0.9, 0.9]
    late = [r for r in got if r["created_at"] >= before]
    assert len(late) == 2 and len(got) == 4
    assert predictions.create_prediction_table(spark, name) == name and spark.table(name).count() == 4
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_topic_is_built_in_one_pass(spark):
    """As many partitions as the events have, so that no file and no micro-batch is added by a second scan."""
    from riskflow.sources.fixtures import DEAD_MESSAGE, messages_from_events, transactions_from_events

    kinds = ["view", "signup", None, "error", "signup", "signup", "signup", "signup"]
    events = spark.createDataFrame([(i if i != 9 else None, k, i % 3, 1.5 if i % 4 else None, '{"k": 7}' if i % 5 else None) for i, k in enumerate(kinds * 4)],
                                   "event_id long, event_type string, user_id long, value double, props string")
    events = events.withColumn("ts", F.timestamp_seconds(F.lit(1705000000) + F.coalesce("event_id", F.lit(0)))).repartition(5)
    found = messages_from_events(events)
    assert found.rdd.getNumPartitions() == 5 and found.columns == ["value"]
    plain = msg.to_message(transactions_from_events(events.where("event_type <> 'signup'"))).unionByName(
        events.where("event_type = 'signup'").select(F.expr(DEAD_MESSAGE).alias("value")))
    assert sorted(str(r[0]) for r in found.collect()) == sorted(str(r[0]) for r in plain.collect()) and found.count() == 28
