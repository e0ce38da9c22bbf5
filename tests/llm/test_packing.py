"""Mixture-controlled packing against the plain tokenizer and the rule of the rounds."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import packing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


@pytest.fixture(scope="module")
def serialised():
    with open(packing.default_tokenizer(), encoding="utf-8") as f:
        return f.read()


# -- the rounds ---------------------------------------------------------------------------------------------------
def test_rounds_fill_rooms_and_keep_counters_small():
    rng = random.Random(1)
    for _ in range(100):
        tokens = np.array([rng.choice([0, 1, 2, 30, 500]) for _ in range(rng.randint(1, 12))])
        rooms = [16] * (int(tokens.sum()) // 16) + ([int(tokens.sum()) % 16] if tokens.sum() % 16 else [])
        dealt = packing.deficit_rounds(tokens, rooms)
        assert (dealt >= 0).all() and dealt.sum(axis=1).tolist() == rooms and (dealt.sum(axis=0) == tokens).all()
        if len(rooms):
            due = np.cumsum(rooms)[:, None] * tokens[None] / tokens.sum()
            assert np.abs(np.cumsum(dealt, axis=0) - due).max() < 2  # what is carried stays below two tokens


def test_rounds_with_numbers_beyond_a_long():
    tokens = np.array([10 ** 13, 3 * 10 ** 13, 1], object)
    rooms = [10 ** 13] * 4 + [1]
    dealt = packing.deficit_rounds(tokens, rooms)
    assert dealt.sum(axis=1).tolist() == rooms and dealt.sum(axis=0).tolist() == tokens.tolist()


@pytest.mark.parametrize("mixed", [False, True])
def test_schedule_places_every_token_once(mixed):
    rng = random.Random(2)
    for _ in range(25):
        q, window = rng.randint(1, 9), rng.choice([8, 64])
        totals = [rng.choice([0, 1, 3, 50, 1000, 20000]) for _ in range(q)]
        weights = [rng.random() * rng.choice([0, 1, 1]) for _ in range(q)] if mixed else None
        schedule = packing.Schedule(totals, weights, window)
        owner = {}
        for i, t in enumerate(totals):
            cells = [(w, place + k) for w, place, length in schedule.pieces(i, 0, t) for k in range(length)]
            assert len(cells) == t and cells == sorted(cells)
            if t:
                a = rng.randrange(t)
                n = rng.randint(1, t - a)
                assert [(w, place + k) for w, place, length in schedule.pieces(i, a, n) for k in range(length)] == cells[a:a + n]
            owner |= dict.fromkeys(cells, i)
        total = sum(totals)
        assert set(owner) == {(k // window, k % window) for k in range(total)}
        if not mixed:  # every whole window has each queue's share, but for rounding
            counts = np.zeros((total // window + 1, q))
            for (w, _), i in owner.items():
                counts[w, i] += 1
            share = window * np.array(totals) / max(total, 1)
            assert len(counts) == 1 or np.abs(counts[:-1] - share).max() < 4


def test_targets_hold_until_a_queue_runs_out():
    schedule = packing.Schedule([10_000, 50_000, 5_000], [0.5, 0.25, 0.25], 100)
    counts = np.zeros((650, 3))
    for q, t in enumerate([10_000, 50_000, 5_000]):
        for w, _, length in schedule.pieces(q, 0, t):
            counts[w, q] += length
    assert (counts.sum(axis=1) == 100).all()
    assert np.abs(counts[:195] - [50, 25, 25]).max() <= 2  # queues 0 and 2 last for 200 windows
    assert (counts[205:, 1] == 100).all()


# -- encoding -----------------------------------------------------------------------------------------------------
def test_words_encode_as_whole_texts(tokenizer, serialised):
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "é", "́", "İ", "ΟΔΟΣ", "Σ", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", " ", " ", "　",
                "'s", "'LL", "1", "٣", "²", "ﬁ", "Å", "한", "하", "👩‍👩‍👧", "<|endoftext|>", "<|end", "!", ".", ",", ")", "?", "H\u0331", "K", "Ⱥ", "<|ENDOFTEXT|>", "=\u0338", "_", "﻿", "\x00", "ß", "中文"]
    texts = ["", " ", "don't  STOP", *["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 40))) for _ in range(2000)]]
    encoder = packing.WordEncoder(serialised)
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_texts_encoded_together(tokenizer, serialised, monkeypatch):
    rng = random.Random(13)
    alphabet = ["a", "Bc", "é", "ö", "zß", " ", "\n", "7", "'s", "'t", "<|endoftext|>", "<|ENDOFTEXT|>", "\u0338", "中", *map(chr, range(33, 48)), *"<=>?@[\\]^_`{|}~"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    for part in (1 << 20, 100):
        monkeypatch.setattr(packing, "PART", part)
        got = packing.WordEncoder(serialised).encode_all(texts)
        assert [np.frombuffer(x, "<u2").tolist() for x in got] == want


def test_long_texts_and_a_full_memory(tokenizer, serialised, monkeypatch):
    monkeypatch.setattr(packing, "PART", 1000)
    monkeypatch.setattr(packing, "KNOWN", 200)
    rng = random.Random(4)
    encoder = packing.WordEncoder(serialised)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(n)) for n in (3, 2000, 0, 50)] + ["x" * 5000 + " y" * 700 + "z" * 1500]
    assert "".join(packing.parts(texts[1])) == texts[1] and max(map(len, packing.parts(texts[1]))) < 1000
    for t in texts:
        assert np.frombuffer(encoder.encode(t), "<u2").tolist() == tokenizer.encode(t, add_special_tokens=False).ids
    assert len(encoder) <= 200


# -- the operator -------------------------------------------------------------------------------------------------
def check(rows, texts, tokenizer, window):
    """``texts``: (doc_id, text), ids different. Every id in one piece, every window gapless."""
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == {i for i, _ in texts}
    for i, t in texts:
        ids, at = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sorted(windows) == list(range(len(windows)))
    for w, own in windows.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or (at < window and w == len(windows) - 1)


def test_awkward_documents(spark, tokenizer):
    rng = random.Random(5)
    words = "the Quick brown fox jumps over it's 42 lazy dogs naïve 中文".split()
    texts = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 300)))) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "\n \t"), (203, "word " * 60_000), (204, "y" * 30_000), (None, "no id")]
    source = lambda i: None if i is None or i % 7 == 0 else "hot" if i % 3 else f"s{i % 5}"
    df = spark.createDataFrame([(i, t, None, source(i), None) for i, t in texts], SCHEMA)
    for c in ("part", "before", "n", "ids", "width", "queue", "at", "base", "_part", "_source", "start", "length"):
        df = df.withColumn(c, F.lit("x"))
    check(packing.op13(df.repartition(6)).collect(), texts, tokenizer, 4096)
    rows = packing.pack(df.repartition(3), packing.default_tokenizer(), window=64).collect()
    check(rows, texts, tokenizer, 64)
    assert {r["source"] for r in rows} == {source(i) for i, _ in texts}
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)


def test_small_sources_share_a_queue_and_targets(spark, tokenizer, monkeypatch):
    """More sources than a window has tokens; both join forms; targets."""
    texts = [(i, f"document number {i} " * 5) for i in range(200)]
    df = spark.createDataFrame([(i, t, None, "big" if i < 80 else f"s{i}", None) for i, t in texts], SCHEMA).repartition(5)
    for most in (packing.MOST_BROADCAST, 0):
        monkeypatch.setattr(packing, "MOST_BROADCAST", most)
        rows = packing.pack(df, packing.default_tokenizer(), window=32).collect()
        check(rows, texts, tokenizer, 32)
    rows = packing.pack(df, packing.default_tokenizer(), targets={"big": 0.8, "absent": 0.1}, window=100).collect()
    check(rows, texts, tokenizer, 100)
    big = {}
    for r in rows:
        big[r["sequence_id"]] = big.get(r["sequence_id"], 0) + r["length"] * (r["source"] == "big")
    n = sum(r["length"] for r in rows if r["source"] == "big")
    share = 0.8  # the absent source's part is left to the others
    assert all(abs(big[w] - 100 * share) <= 2 for w in range(int(n / (100 * share)) - 1))


def test_repeated_rows_and_empty_table(spark, tokenizer):
    assert packing.op13(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "same text here", None, "a", None)] * 30, SCHEMA)
    rows = packing.pack(df, packing.default_tokenizer(), window=8).collect()
    assert sum(r["length"] for r in rows) == 30 * 4 and max(r["sequence_id"] for r in rows) == 14
