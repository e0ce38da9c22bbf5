"""The training-data operators against plain versions on small tables, with awkward rows."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import bpe, decontamination, graph, langid, near_dup, pii, quality, sharding, suffix_dedup, toxicity, warc
from riskflow.llm.common import materialize

SF_SMALL = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, texts, lang=None):
    """Rows with ids 0, 1, ...; a (id, text) pair gives the id itself."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, lang, "s", None) for i, t in rows], SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


def by_id(df):
    return {r["doc_id"]: r for r in rows(df)}


def clashing(df):
    """The same rows with extra columns named as operators name theirs."""
    out = df
    for c in ("kept", "score", "component_id", "text_key", "key", "n", "_near_n_", "spans", "digest"):
        out = out.withColumn(c, F.lit("x"))
    return out


def prose(rng, n, words=None):
    words = words or [a + b for a in "ba ke li mo nu ra se ti vo xa".split() for b in "dan fer gol hin jup".split()]
    return " ".join(rng.choice(words) for _ in range(n))


# -- 1 ------------------------------------------------------------------------------------------------------------
def test_maximal_segments_against_all_segments():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.choice([-2.0, -1.0, 1.0, 3.0]) for _ in range(rng.randint(1, 14))]
        got = toxicity.maximal_segments(list(enumerate(s)), len(s), 1.0)

        def split(lo, hi):  # the best segment, then left and right of it
            best = max(((sum(s[a:b]), -(b - a), -a, a, b) for a in range(lo, hi) for b in range(a + 1, hi + 1)), default=None)
            if best is None or best[0] <= 0:
                return []
            # shortest of the best, so that segments are minimal at both ends
            a, b = best[3], best[4]
            return [*split(lo, a), (a, b, best[0]), *split(b, hi)]
        assert sorted(x[2] for x in got) == sorted(x[2] for x in split(0, len(s)))
        assert got == sorted(got) and all(a[1] <= b[0] for a, b in zip(got, got[1:]))


def test_unscored_words_cost_the_drift():
    assert toxicity.maximal_segments([(0, 3.0), (2, 3.0)], 3, 1.0) == [(0, 3, 5.0)]
    assert toxicity.maximal_segments([(0, 3.0), (9, 3.0)], 10, 1.0) == [(0, 1, 3.0), (9, 10, 3.0)]


def test_toxicity_learns_and_handles_awkward_rows(spark):
    rng = random.Random(2)
    texts = [prose(rng, 40) + (" vile nasty scumbag" if i % 4 == 0 else "") for i in range(300)]
    docs = table(spark, [*texts, None, "", (0, texts[0]), (None, "vile nasty scumbag " + texts[1])])
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)] + [(None, None, None), (1, None, None)], "doc_id long, quality int, toxic int")
    out = rows(toxicity.op1(clashing(docs), labels))
    assert len(out) == 304
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 300]
    assert held and all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held)
    assert all(r["held_out"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert [r["predicted"] for r in out if r["doc_id"] is None] == [1]
    model = toxicity.fit(docs, labels)
    found = rows(toxicity.passages(docs.filter("doc_id = 4"), model))
    assert found and "nasty" in found[0]["passage"] and texts[4][found[0]["start"]:found[0]["end"]].lower() == found[0]["passage"]
    none = toxicity.op1(docs, labels.filter("toxic = 0"))
    assert {r["predicted"] for r in none.collect()} == {0}
    assert toxicity.op1(docs.limit(0), labels).count() == 0
    assert {r["predicted"] for r in toxicity.op1(docs, labels.limit(0)).collect()} == {0}


# -- 2 ------------------------------------------------------------------------------------------------------------
def test_bpe_equals_tiktoken_and_round_trips(spark):
    import public_tokenizers as P
    import tiktoken

    path, pattern = bpe.default_vocabulary()
    ranks = bpe.read_ranks(path)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["", None, "a", " \n\n  x\t", "naïve café ñandú ßÄ 漢字かな🙂👍🏽", "x" * 3000, "\u0000­  ▁ Ġ", "don't DON'T we're 12345 67 ... !!!\r\n",
             "<|endoftext|> <unk> <s>", "é" * 500 + " " * 700 + "é" * 50, prose(random.Random(3), 30_000)]
    got = by_id(bpe.op2(clashing(table(spark, texts))))
    codec = bpe.Codec(bpe.sentencepiece_model(ranks), pattern)
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert codec.encode(t) == ids and codec.decode(ids) == (t or "").encode()
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.op2(table(spark, []).limit(0)).count() == 0
    full = by_id(bpe.encode(table(spark, ["a b", None]), path, pattern))
    assert full[0]["token_ids"] == enc.encode_ordinary("a b") and bytes(full[0]["decoded"]) == b"a b" and full[1]["token_ids"] == []


def test_bpe_rejects_incomplete_vocabularies():
    with pytest.raises(ValueError):
        bpe.sentencepiece_model({b"a": 0})
    with pytest.raises(ValueError):
        bpe.sentencepiece_model({bytes([b]): b + 1 for b in range(256)})


# -- 3 ------------------------------------------------------------------------------------------------------------
def test_lookup_table_is_the_turn_by_turn_filling():
    names, size = sharding.shard_names(5), 101
    want, at = {}, {n: 0 for n in names}
    orders = {n: [(o + j * k) % size for j in range(size)] for n in names for o, k in [sharding.preference(n, size)]}
    while len(want) < size:
        for n in names:
            if len(want) < size:
                slot = next(s for s in orders[n] if s not in want)
                want[slot] = names.index(n)
    assert sharding.lookup_table(names, size) == [want[s] for s in range(size)]
    counts = collections.Counter(sharding.lookup_table(sharding.shard_names()))
    assert max(counts.values()) - min(counts.values()) <= 1


def test_removing_a_shard_moves_little():
    names = sharding.shard_names(10)
    a, b = sharding.lookup_table(names, 1009), sharding.lookup_table(names[:-1], 1009)
    moved = sum(x != y for x, y in zip(a, b) if x != 9)
    assert moved < 0.15 * 1009
    for bad in ((names, 1000), ([], 7), (["a", "a"], 7)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*bad)


def test_place(spark):
    docs = table(spark, ["a", None, (0, "again"), (None, "no id")])
    out = rows(sharding.op3(clashing(docs)))
    assert len(out) == 4 and len({r["shard"] for r in out if r["doc_id"] == 0}) == 1
    owner = sharding.lookup_table(sharding.shard_names())
    for r in out:
        slot = int(hashlib.md5(str("" if r["doc_id"] is None else r["doc_id"]).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r["slot"], r["shard"]) == (slot, owner[slot])
    assert sharding.op3(docs.limit(0)).count() == 0


# -- 4 ------------------------------------------------------------------------------------------------------------
def plain_removed(texts, length):
    found = collections.Counter()
    data = [(t or "").encode() for t in texts]
    for b in data:
        for k in range(len(b) - length + 1):
            found[b[k:k + length]] += 1
    out = []
    for b in data:
        mark = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if found[b[k:k + length]] > 1:
                mark[k:k + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark) if not m)
        out.append((len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(mark))), hashlib.sha256(kept).hexdigest()))
    return out


def awkward_texts():
    rng = random.Random(4)
    a, b, c = (prose(rng, 120) for _ in range(3))
    return ["", None, "short", a, a, b[:300] + c, c + b, "é" * 400, "z" * 2000, "ab" * 500, a[50:600], prose(rng, 200) + b[:430] + prose(rng, 10),
            c[:401], c[1:401], prose(rng, 3000), b[:200] + b[:600] + b[100:500], "q" * 399, *[prose(rng, 6) + " " + b[:420] + " " + prose(rng, 6) for _ in range(12)]]


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 3])
def test_repeated_bytes_against_all_windows(spark, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = awkward_texts()
    got = by_id(suffix_dedup.op4(clashing(table(spark, texts))))
    for i, want in enumerate(plain_removed(texts, 400)):
        assert tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == want, i


def test_repeated_windows_against_sets():
    rng = random.Random(5)
    for _ in range(30):
        core = "".join(rng.choice("ab") for _ in range(40))
        columns = []
        for _ in range(rng.randint(2, 9)):
            left, right = rng.randint(0, 12), rng.randint(20, 40)
            s = "".join(rng.choice("ab") for _ in range(left)) + core[:right]
            columns.append((s.encode(), left))
        found = suffix_dedup.repeated_windows(columns, 16)
        seen = collections.Counter((k - a, s[k:k + 16]) for s, a in columns for k in range(0, a + 1) if k + 16 <= len(s))
        for (s, a), got in zip(columns, found):
            assert got.tolist() == [k for k in range(0, a + 1) if k + 16 <= len(s) and seen[(k - a, s[k:k + 16])] > 1]


def test_repeated_bytes_rows_without_or_with_equal_ids(spark):
    texts = awkward_texts()
    docs = table(spark, [(None, t) for t in texts])
    got = sorted(tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in rows(suffix_dedup.op4(docs)))
    assert got == sorted(plain_removed(texts, 400))
    docs = table(spark, [(i % 2, t) for i, t in enumerate(texts)])
    got = sorted(tuple(r[c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in rows(suffix_dedup.op4(docs)))
    assert got == sorted(plain_removed(texts, 400))
    assert suffix_dedup.op4(docs.limit(0)).count() == 0


# -- 5 ------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("broadcast", [warc.MOST_BROADCAST, 0])
def test_warc_round_trip(spark, monkeypatch, broadcast):
    monkeypatch.setattr(warc, "MOST_BROADCAST", broadcast)
    html = ["<p>a</p>", "<p>a</p>", "", None, "x\r\n\r\ny", "WARC/1.0\r\n\r\n", "é漢" * 1000, "<p>a</p>", "big" * 50_000]
    urls = ["http://www.Example.com/a?b=1#c", "https://example.org", None, "not a url", "http://example.com:80/x y", "http://u@h.example.com/\r\nEvil: 1", "", "http://www.example.com/a?b=1", "ftp://z.example/q"]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(zip(urls, html))] + [(0, urls[0], html[0]), (None, "http://n.example/", "<p>a</p>"), (None, None, "only")],
                                  "page_id long, url string, html string").withColumn("digest", F.lit("x")).withColumn("archive", F.lit(3))
    at = warc.write(pages, archive_records=3)
    out = rows(warc.read(spark, at, payloads=True))
    assert len(out) == 12
    first = {}
    for i, h in enumerate(html):
        first.setdefault((h or "").encode(), i)
    for r in out:
        if r["page_id"] is not None:
            data = (html[r["page_id"]] or "").encode()
            assert r["payload_bytes"] == len(data) and r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
            revisit = first[data] != r["page_id"]
            assert (r["record_type"], r["refers_to"]) == (("revisit", first[data]) if revisit else ("response", None))
            assert r["payload"] is None if revisit else bytes(r["payload"]) == data
    assert sorted((r["record_type"], -1 if r["refers_to"] is None else r["refers_to"]) for r in out if r["page_id"] is None) == [("response", -1), ("revisit", 0)]
    hit = rows(warc.lookup(spark, at, ["http://www.example.com/a?b=1", "http://nowhere.example/"]))
    assert sorted(r["page_id"] for r in hit) == [0, 0, 7]
    keys = [r[0] for r in pages.select(warc.url_key(warc.clean_url(F.col("url")))).distinct().collect()]
    assert "com,example,www)/a?b=1" in keys and "org,example)/" in keys and "" in keys
    data = b"".join(bytes(r["content"]) for r in spark.read.format("binaryFile").load(at.records).select("content").collect())
    assert data.count(b"WARC/1.0\r\nWARC-Type") == 12 and data.endswith(b"\r\n\r\n")
    empty = warc.op5(pages.limit(0))
    assert empty.count() == 0 and empty.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    with pytest.raises(ValueError):
        warc.lookup(spark, at, ["x"] * (warc.MOST_URLS + 1))


def test_archives_are_bounded_by_bytes_and_lookups_read_those_named(spark, monkeypatch):
    """Pages of all sizes; an archive holds no more than its class allows, and a look-up loads no other archive."""
    monkeypatch.setattr(warc, "SIZES", ((100, 5), (10_000, 2), (1 << 62, 1)))
    sizes = [0, 50, 99, 100, 101, 3000, 9999, 10_001, 50_000, 2_000_000]
    pages = spark.createDataFrame([(i, f"http://h{i}.example.com/p", "x" * sizes[i % 10] + str(i) * (sizes[i % 10] > 0)) for i in range(80)],
                                  "page_id long, url string, html string").repartition(2)
    at = warc.write(pages, archive_records=5, most_bytes=1_000_000)
    files = {r["archive"]: len(r["content"]) for r in rows(warc._files(spark, at))}
    head = 700  # bytes of a record's headers at most
    assert all(n <= 5 * (100 + head) or n <= 2 * (10_000 + head) or n <= 2_000_000 + head for n in files.values())
    entries = rows(warc._opened(spark.read.parquet(at.blocks)))
    held = collections.defaultdict(list)
    for e in entries:
        held[e["archive"]].append(e["length"])
    assert sum(map(len, held.values())) == 80
    assert all(len(x) == 1 or (max(x) <= 10_000 + head and len(x) <= 2) or (max(x) <= 100 + head and len(x) <= 5) for x in held.values())
    out = {r["page_id"]: r for r in rows(warc.read(spark, at, payloads=True))}
    assert all(out[r["page_id"]]["payload"] == r["html"].encode() for r in rows(pages) if out[r["page_id"]]["record_type"] == "response")
    hit = warc.lookup(spark, at, ["http://h9.example.com/p", "http://h2.example.com/p"])
    assert {r["page_id"] for r in rows(hit)} == {2, 9}
    read = {f.rsplit("/", 1)[1] for f in hit.inputFiles() if f.endswith(".txt")}
    assert read == {e["archive"] for e in entries if e["key"] in ("com,example,h9)/p", "com,example,h2)/p")} and len(read) == 2 < len(files)


# -- 6 ------------------------------------------------------------------------------------------------------------
def test_block_max_wand_finds_all_above_threshold():
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(4, 60))) for i in range(120)]
    freq = collections.Counter(t for _, x in items for t in set(decontamination.words(x)))
    index = decontamination.Index(items, freq, len(items), 20.0)
    for _ in range(60):
        w = decontamination.words(rng.choice(items)[1])[:rng.randint(2, 40)] + decontamination.words(prose(rng, 5))
        terms = sorted({index.term[x] for x in w if x in index.term})
        total = collections.Counter()
        for t in terms:
            for p, s in zip(index.parts[t], index.scores[t]):
                total[p] += s
        for least in (0.2, 0.5, 0.8):
            got = dict(index.retrieve(terms, least))
            assert got.keys() == {p for p, s in total.items() if s >= least - 1e-9}
            assert all(abs(got[p] - total[p]) < 1e-9 for p in got)


def test_leaks(spark):
    rng = random.Random(7)
    vocabulary = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("ala", "emo", "iru", "ofe", "uti", "ane", "olu")]
    items = [prose(rng, n, vocabulary) + ".\n" + prose(rng, 5, vocabulary) + "." for n in (8, 20, 45, 120)]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(7, None), (8, ""), (9, items[0])], "item_id long, text string")
    clean = [prose(rng, 300, vocabulary) for _ in range(20)]
    half = prose(rng, 50, vocabulary) + " " + items[1].split("\n")[0]  # the question alone
    dirty = [prose(rng, k, vocabulary) + " " + (t.upper() if k % 2 else t) + " " + prose(rng, 200, vocabulary) for k, t in enumerate(items)]
    docs = table(spark, [*clean, half, *dirty, None, ""])
    got = {(r["doc_id"], r["item_id"]) for r in rows(decontamination.op6(clashing(docs), bench))}
    assert got == {(21, 0), (21, 9), (22, 1), (23, 2), (24, 3)}
    kept = decontamination.without_leaks(clashing(docs), bench)
    assert sorted(r["doc_id"] for r in rows(kept)) == [*range(21), 25, 26] and kept.columns == clashing(docs).columns
    assert decontamination.op6(docs.limit(0), bench).count() == 0 and decontamination.op6(docs, bench.limit(0)).count() == 0
    assert decontamination.without_leaks(docs, bench.limit(0)).count() == docs.count()


def test_leaks_do_not_depend_on_shards(spark, monkeypatch):
    rng = random.Random(8)
    bench = spark.createDataFrame([(i, prose(rng, 15) + ". " + prose(rng, 4)) for i in range(30)], "item_id long, text string")
    docs = table(spark, [prose(rng, 40) + " " + r["text"] + " " + prose(rng, 40) for r in bench.collect()])
    want = sorted(rows(decontamination.op6(docs, bench)), key=str)
    monkeypatch.setattr(decontamination, "SHARD", 7)
    got = sorted(rows(decontamination.op6(docs, bench)), key=str)
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(r["doc_id"], r["item_id"]) for r in want} and len(want) >= 30
    assert np.allclose([r["score"] for r in got], [r["score"] for r in want])
    stored = decontamination.shards(bench)
    assert stored.count() >= 4  # more than one pass
    monkeypatch.setattr(decontamination, "AT_ONCE", 2)
    kept = rows(decontamination.without_leaks(docs.unionByName(table(spark, [(99, prose(rng, 80))])), bench))
    assert {r["doc_id"] for r in kept} == {99} | ({r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in want})


def test_leaks_against_every_passage_and_item(spark):
    """Brute force: the BM25 score of every passage for every part of every item, then the shares of n-grams."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bcdfgklmnprst" for b in ("al", "em", "ir", "of", "ut") for c in ("a", "o", "en")]
    items = [(i, prose(rng, rng.choice([3, 9, 30, 90, 150]), vocabulary) + ". " + prose(rng, rng.randint(1, 6), vocabulary)) for i in range(25)]
    texts = []
    for i in range(60):
        w = decontamination.words(items[i % 25][1])
        for _ in range(i // 25 * len(w) // 8):  # some words of the item are changed
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join([prose(rng, rng.randint(0, 150), vocabulary), *w, prose(rng, rng.randint(0, 150), vocabulary)]))
    d = decontamination
    tokens = {i: d.words(t) for i, t in items}
    n, mean = len(items), max(1.0, min(d.PART, sum(map(len, tokens.values())) / len(items)))
    df = collections.Counter(t for w in tokens.values() for t in set(w))

    def impacts(part):
        norm = d.K1 * (1 - d.B + d.B * len(part) / mean)
        x = {t: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * c * (d.K1 + 1) / (c + norm) for t, c in collections.Counter(part).items()}
        return {t: v / sum(x.values()) for t, v in x.items()}

    def grams(w):
        k = min(d.GRAM, len(w))
        return {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}

    def share(part, around):
        k = min(d.GRAM, len(part))
        return len(grams(part) & {tuple(around[j:j + k]) for j in range(len(around) - k + 1)}) / len(grams(part))

    parts = [(i, impacts(w[at:at + d.PART])) for i, w in tokens.items() for at in range(0, max(1, len(w) - d.PART + d.PART_STEP), d.PART_STEP)]
    want = set()
    for doc, text in enumerate(texts):
        w = d.words(text)
        for at in range(0, max(1, len(w) - d.STEP), d.STEP):
            passage = set(w[at:at + d.PASSAGE])
            for i, impact in parts:
                if sum(v for t, v in impact.items() if t in passage) >= d.SHARE:
                    around = w[max(0, at - len(tokens[i])):at + d.PASSAGE + len(tokens[i])]
                    q, a = d.question_and_answer(dict(items)[i])
                    if min(share(q, around), share(a, around)) >= 0.6 or share(tokens[i], around) >= 0.9:
                        want.add((doc, i))
    got = rows(d.op6(table(spark, texts), spark.createDataFrame(items, "item_id long, text string")))
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(want) > 25


def test_leak_with_another_last_word(spark):
    rng = random.Random(12)
    item = prose(rng, 50) + ". " + "yes"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = table(spark, [prose(rng, 100) + " " + item[:-3] + "no " + prose(rng, 100), prose(rng, 100) + " " + item[:150] + prose(rng, 100)])
    assert [r["doc_id"] for r in rows(decontamination.op6(docs, bench))] == [0]


# -- 7 ------------------------------------------------------------------------------------------------------------
def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = rows(langid.op7(clashing(docs)))
    held = [r for r in out if r["held_out"]]
    assert len(out) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_id_learns_the_commonest_languages(spark):
    rng = random.Random(10)
    given = [(i, prose(rng, 30) if i % 2 else prose(rng, 30, ["ßaü", "öch", "ung", "keit"]), "aa" if i % 2 else "bb", "s", 1) for i in range(40)]
    dirty = [(100 + i, prose(rng, 10, ["qwx", "zzq", "xyv"]), f"x{i}", "s", 1) for i in range(30)]
    model = langid.fit(spark.createDataFrame(given + dirty, SCHEMA), most_langs=2)
    assert sorted(set(model.langs)) == ["aa", "bb"]
    assert len(set(langid.fit(spark.createDataFrame(given + dirty, SCHEMA)).langs)) == 32


def test_language_id_awkward_rows(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame(
        [(i, prose(rng, 30) if i % 2 else prose(rng, 30, ["ßaü", "öch", "ung", "keit"]), "aa" if i % 2 else "bb", "s", 1) for i in range(60)]
        + [(100, None, "aa", None, None), (101, "", "aa", "s", 0), (102, "123 !!", "aa", "s", 5), (103, "漢字 かな 漢字 かな 仮名交じり文", None, "s", 9), (None, prose(rng, 30), None, "s", 3)], SCHEMA)
    out = by_id(langid.op7(docs))
    assert len(rows(langid.op7(docs))) == 65
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 and out[i]["rejected"] for i in (100, 101, 102))
    assert out[103]["rejected"] and out[103]["lang_pred"] in ("aa", "bb") and out[None]["lang_pred"] == "aa"
    model = langid.fit(langid.training_rows(docs))
    kept = langid.accepted(clashing(docs), model)
    assert kept.columns == clashing(docs).columns and {r["doc_id"] for r in rows(kept)} == {*range(60), None}
    empty = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in rows(langid.identify(docs, empty))} == {"und"}


# -- 8 ------------------------------------------------------------------------------------------------------------
def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]


def test_quality_counts_and_verdicts(spark):
    rng = random.Random(10)
    good = [prose(rng, rng.randint(60, 300)) for _ in range(120)]
    bad = [" ".join(w + "***" for w in prose(rng, 80).split()) for _ in range(25)]
    odd = ["", None, "a b c", "x y z x y z", "l\nl\n\n \nl\n" + good[0], "a " * 200, " é漢 |<>| \x0b\x0c#"]
    docs = table(spark, [*good, *bad, *odd, (0, good[0])])
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(145)] + [(None, None, None), (3, 1, 1)], "doc_id long, quality int, toxic int")
    out = rows(quality.op8(clashing(docs), labels))
    assert len(out) == 153
    texts = {i: t for i, t in enumerate([*good, *bad, *odd])}
    for r in out:
        n = plain_counts(texts[r["doc_id"]])
        assert [r[c] for c in quality.COUNTS] == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0]) and not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"] for r in out if r["kept"]}
    assert len(kept & set(range(120))) >= 118 and len(kept & set(range(120, 145))) <= 2
    assert quality.op8(docs.limit(0), labels).count() == 0
    assert quality.op8(docs, labels.limit(0)).count() == 153


def test_forest_range_and_fallback_are_those_of_all_rows(spark, monkeypatch):
    rng = random.Random(18)
    docs = table(spark, [prose(rng, rng.randint(60, 300)) for _ in range(300)] + ["#" * 5000 + " " + prose(rng, 80)])
    boxes, fit = [], quality.IsolationForest.fit
    monkeypatch.setattr(quality.IsolationForest, "fit", lambda self, x, low, high: boxes.append((low, high)) or fit(self, x, low, high))
    labels = spark.createDataFrame([], "doc_id long, quality int")
    sampled = quality._sampled
    monkeypatch.setattr(quality, "_sampled", lambda df, n, total: sampled(df, n, total).filter("doc_id < 300"))  # the odd row is not sampled
    forest, cut = quality.fit(docs, labels, sample=100)
    every = np.array([quality.statistics(r["text"])[1] for r in docs.collect()])
    assert np.array_equal(boxes[0][0], every.min(axis=0)) and np.array_equal(boxes[0][1], every.max(axis=0))
    scores = forest.score(every)
    assert np.argmax(scores) == 300 and cut in scores and (scores > cut).sum() <= 0.02 * len(scores) < (scores >= cut).sum()


def test_quality_on_rows_not_used_to_fit(spark):
    """Labels of a third of the labelled rows fit the forest and the threshold; the others are judged."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    used = F.pmod(F.xxhash64(F.lit("split"), "doc_id"), F.lit(3)) == 0
    out = quality.op8(docs, labels.filter(used)).join(labels.filter(~used).filter("quality is not null"), "doc_id").filter("not base_failed")
    caught, lost = (out.filter(f"quality = {q}").agg(F.avg((F.col("kept") == bool(q)).cast("double"))).first()[0] for q in (0, 1))
    assert caught >= 0.8 and lost >= 0.98, (caught, lost)


def test_path_lengths_by_hand(spark):
    """The score of every row from walking its trees one by one, and the verdict on ties."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    forest = quality.IsolationForest(20, 64).fit(x[:200], x.min(axis=0), x.max(axis=0))
    for row, score in zip(x[::17], forest.score(x[::17])):
        total = 0.0
        for feature, cut, left, path in forest.forest:
            at = 0
            while feature[at] >= 0:
                at = left[at] + int(row[feature[at]] >= cut[at])
            total += path[at]
        assert score == pytest.approx(2 ** (-total / 20 / forest.norm))
    assert quality.threshold(np.array([0.1, 0.2, 0.3]), np.array([0.9, 0.8]), 0.0) == pytest.approx(0.55)
    assert quality.threshold(np.array([0.1, 0.2]), np.array([0.1, 0.15]), 0.0) == 0.2


def test_forest_and_threshold_are_those_of_all_labelled_rows(spark):
    """More rows than a tree used to take: each cell's path counts every row that grows, the cut every other labelled row."""
    rng = random.Random(23)
    docs = table(spark, [prose(rng, rng.randint(50, 90)) + " #" * rng.randint(0, 3) for _ in range(2600)])
    labels = spark.createDataFrame([(i, int(i % 13 > 0)) for i in range(2600)], "doc_id long, quality int")
    stats = materialize(quality.rule_statistics(docs), "statistics")
    forest, cut = quality.fit(docs, labels, trees=10, stats=stats)
    known = [r for r in stats.join(labels, "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id"), F.lit(2))).collect()
             if not quality.base_failed(r["n_words"], r["n_repeat_words"])]
    own = lambda keep: np.array([r["features"] for r in known if keep(r)])
    x = own(lambda r: r["quality"] and not r["half"])
    assert len(x) > 1024 and forest.norm == quality.IsolationForest.expected_path(len(x))
    for feature, threshold, left, path in forest.forest:
        todo, seen = [(0, x, 0)], 0
        while todo:
            at, inside, depth = todo.pop()
            if feature[at] < 0:
                assert len(inside) < 2 or depth == quality.DEPTH
                assert path[at] == pytest.approx(depth + forest.expected_path(len(inside)))
                seen += len(inside)
            else:
                above = inside[:, feature[at]] >= threshold[at]
                todo += [(left[at], inside[~above], depth + 1), (left[at] + 1, inside[above], depth + 1)]
        assert seen == len(x)
    good, bad = own(lambda r: r["quality"] and r["half"]), own(lambda r: not r["quality"])
    assert cut == quality.threshold(forest.score(good), forest.score(bad), 0.01)
    rng = np.random.default_rng(2)
    for _ in range(20):
        a, b = rng.integers(0, 40, 60) / 8, rng.integers(10, 60, 30) / 8
        floor = float(np.quantile(a, 0.9))
        cuts = np.unique(np.concatenate(([floor], a[a > floor], b[b > floor])))
        gain = [round((b > c).mean() - (a > c).mean(), 9) for c in cuts]
        assert quality.threshold(a, b, 0.1) in [(p + q) / 2 if g > 0 else p for p, q, g in zip(cuts, [*cuts[1:], cuts[-1]], gain) if g == max(gain)]


def test_isolation_paths_are_shorter_for_outliers():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(size=(500, 3)), [[9.0, 9, 9]]])
    s = quality.IsolationForest(50, 128).fit(x, x.min(axis=0), x.max(axis=0)).score(x)
    assert np.argmax(s) == 500 and s[500] > 0.6 > np.median(s)
    same = quality.IsolationForest(5, 16).fit(np.ones((20, 2)), np.ones(2), np.ones(2))
    assert len(set(same.score(np.ones((4, 2))))) == 1


# -- 9 ------------------------------------------------------------------------------------------------------------
def plain_components(texts, percent):
    sets = []
    for t in texts:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(sets)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_texts():
    rng = random.Random(11)
    base = [prose(rng, n).split() for n in (3, 5, 12, 60, 150, 400)]
    out = ["", None, "  ", "one", "ONE", "one two three four", "one two three four five"]
    for b in base:
        for _ in range(14):
            w = list(b)
            for _ in range(rng.randint(0, max(1, len(w) // 40))):
                w[rng.randrange(len(w))] = f"new{rng.randint(0, 9)}"
            out.append("\n".join([" ".join(w[:7]), " ".join(w[7:])]))
    return out + [prose(rng, 100) for _ in range(30)] + [" ".join(base[4]), " ".join(base[4]).upper()]


@pytest.mark.parametrize("block", [near_dup.BLOCK, 3])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", near_dup.BLOCK_SHINGLES if block > 3 else 500)
    texts = near_texts()
    for percent in (85, 80):
        got = by_id(near_dup.components(clashing(table(spark, texts)), percent))
        assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == plain_components(texts, percent)
        assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)


def test_near_duplicates_awkward_ids(spark):
    rng = random.Random(12)
    a, b, c = (prose(rng, 80) for _ in range(3))
    docs = table(spark, [(5, a), (5, a), (3, a), (None, a), (None, b), (None, b), (9, c), (9, c), (9, prose(rng, 70)), (1, None), (2, "")])
    out = rows(near_dup.op9(docs))
    assert len(out) == 11
    assert sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in out if r["n_shingles"] == 76 and r["component_id"] == 3) == [(0, 3, False), (3, 3, True), (5, 3, False), (5, 3, False)]
    kept = near_dup.representatives(clashing(docs), 80)
    assert kept.columns == clashing(docs).columns
    left = rows(kept)
    ids = collections.Counter(r["doc_id"] for r in left)
    # both of id 9's texts stay; the copy without id of id 3's text goes, of the two equal rows without id one stays
    assert ids[3] == ids[1] == ids[2] == 1 and ids[9] == 2 and ids[5] == 0 and ids[None] == 1
    assert len({r["text"] for r in left if r["doc_id"] == 9}) == 2 and {r["text"] for r in left if r["doc_id"] is None} == {b}
    near = c.split()
    near[40] = "other"
    more = table(spark, [(9, c), (9, " ".join(near)), (4, " ".join(near)), (None, " ".join(near) + " end"), (7, " \n"), (7, " \n"), (None, None)])
    left = rows(near_dup.representatives(more.withColumn("_near_key", F.lit(1)).withColumn("_near_id", F.lit(2)).withColumn("_near_n", F.lit(3)), 80))
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=str) == sorted([(4, " ".join(near)), (7, " \n"), (7, " \n"), (None, None)], key=str)
    assert near_dup.op9(docs.limit(0)).count() == 0 and near_dup.representatives(docs.limit(0)).count() == 0


def test_connected_components(spark):
    rng = random.Random(13)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(7, 7), (None, 3)]
    root = list(range(500))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in graph.connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in links if a is not None and a != b for n in (a, b)}
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# -- 10 -----------------------------------------------------------------------------------------------------------
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            v, d = m.group(), re.sub("[^0-9]", "", m.group())
            luhn = sum((2 * x - 9 * (x > 4)) if i % 2 else x for i, x in enumerate(map(int, d[::-1]))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in v.split(".")), "card": 14 <= len(d) <= 19 and luhn, "phone": 10 <= len(d) <= 15}[kind]:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def test_personal_data_spans(spark):
    rng = random.Random(14)
    pieces = ["4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "+1 (743) 555-3824", "+49.30.123456", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.4",
              "a@b.co", "a.b+c@d-e.f.g_h@i.j", "@", "x@y", "é@ü.de", "漢字 ", "12 34", "+", "++1 222 333 4444", ".", "-", " ", "5", "55 5", "no", "🙂", "\n", "a@b.c@d.e"]
    texts = ["", None, "9" * 5000, "a" * 5000 + "@", "1." * 3000, "+1" + " 2" * 3000, "8 " * 3000, "a@b." + "c." * 2000] + [
        "".join(rng.choice(pieces) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    got = by_id(pii.detect(clashing(table(spark, texts)), support=10**9))
    for i, t in enumerate(texts):
        want = plain_spans(t)
        text = ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in want)
        count = collections.Counter(x[2] for x in want)
        assert got[i]["spans"] == text and got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), t
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [count[k] for k in PATTERNS]
    assert pii.op10(table(spark, []).limit(0)).count() == 0


def test_disclosing_terms(spark):
    rng = random.Random(15)
    texts = [f"{prose(rng, 20)} account zorblatt of bob@x.org {prose(rng, 20)} {i}" for i in range(6)] + [prose(rng, 60) for _ in range(60)] + ["account " + prose(rng, 20) for _ in range(30)]
    docs = table(spark, [*texts, None, ""])
    got = by_id(pii.op10(docs))
    for i in range(6):
        at = texts[i].index("zorblatt")
        assert f"term:{at}:{at + 8}" in got[i]["spans"].split(",")  # only ever beside that address
        at = texts[i].index("account")
        assert f"term:{at}:{at + 7}" not in got[i]["spans"].split(",")  # mostly elsewhere
        assert got[i]["base_sha256"] == hashlib.sha256(f"email:{texts[i].index('bob@')}:{texts[i].index('bob@') + 9}".encode()).hexdigest()
    assert all(got[i]["spans"] == "" for i in range(6, 98))
    out = pii.sanitise(clashing(docs).withColumn("n_chars", F.length("text").cast("long")))
    clean = by_id(out)
    assert out.columns == clashing(docs).columns and len(clean) == 98 and clean[96]["text"] is None and clean[97]["text"] == ""
    for i in range(6):
        assert "bob@x.org" not in clean[i]["text"] and "zorblatt" not in clean[i]["text"] and "[EMAIL]" in clean[i]["text"] and clean[i]["n_chars"] == len(clean[i]["text"])
    assert all(clean[i]["text"] == texts[i] for i in range(6, 96))


def test_disclosing_terms_anywhere(spark, monkeypatch):
    rng = random.Random(16)
    far = [f"zorblatt {prose(rng, 400)} bob@x.org {prose(rng, 300)} Zorblatt {i}" for i in range(6)]
    alone = f"{prose(rng, 20)} ZORBLATT {prose(rng, 20)}"
    texts = [*far, alone, *(prose(rng, 60) for _ in range(60))]
    docs = table(spark, texts)
    for most in (pii.MOST_BROADCAST, 0):
        monkeypatch.setattr(pii, "MOST_BROADCAST", most)
        got, clean = by_id(pii.op10(docs)), by_id(pii.sanitise(docs))
        for i, t in enumerate(texts):
            want = sorted([(m.start(), "term", m.end()) for m in re.finditer("zorblatt", t, re.I)] + [(m.start(), "email", m.end()) for m in re.finditer("bob@x.org", t)])
            assert got[i]["spans"] == ",".join(f"{k}:{a}:{b}" for a, k, b in want)
            assert "zorblatt" not in clean[i]["text"].lower() and "bob@" not in clean[i]["text"]
        assert all(clean[i]["text"] == texts[i] for i in range(7, len(texts)))


def plain_disclosure(texts, support=3, disclose=0.9, z=3.0):
    """term -> the most it tells of an entity, from all pairs of terms and entities."""
    docs, values, wide, names = [], collections.Counter(), collections.Counter(), {}
    for t in texts:
        t = t or ""
        spans = plain_spans(t)
        free, at = [], 0
        for a, _, _, b in spans:
            free.append(t[at:max(at, a)])
            at = max(at, b)
        words = {w.lower() for x in [*free, t[at:]] for w in re.findall(r"[^\W\d_]+", x)}
        own, more = set(), set()
        for a, _, kind, b in spans:
            v = t[a:b].lower()
            d = re.sub("[^0-9]", "", v)
            own.add((kind, d if kind in ("card", "phone") else v))
            part = {"email": v.split("@")[-1], "ip": ".".join(v.split(".")[:2]), "card": d[:6], "phone": d[:5]}[kind]
            more |= {("part", kind, part), ("kind", kind)}
            if kind == "email":
                for w in set(re.findall(r"[^\W\d_]{4,}", v.split("@")[0])):
                    names.setdefault(w, set()).add((kind, v))
        docs.append((words, own, more))
        values.update(own)
        wide.update(more)
    total, n_term, both = len(texts), collections.Counter(w for d in docs for w in d[0]), collections.Counter()
    for words, own, more in docs:
        both.update((w, e) for e in own | more for w in words)
    told = {}
    for (w, e), k in both.items():
        n, n_e, p = n_term[w], (values | wide)[e], k / n_term[w]
        if n_e == total or k < support:
            continue
        if e in wide:
            p = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        told[w] = max(told.get(w, 0), 1 + math.log(p) / math.log(total / n_e) if p > 0 else 0)
    for w, own in names.items():
        n_e = min(values[e] for e in own)
        if n_term[w]:
            told[w] = max(told.get(w, 0), math.log(total / max(n_term[w], n_e)) / math.log(total / n_e))
    return {w: v for w, v in told.items() if v >= disclose - 1e-9}


def test_disclosure_against_all_pairs(spark):
    """Planted: a word that goes with a host, one with a kind, one with an address, a name out of its address; and words
    that meet personal data by chance, or go with much else."""
    rng = random.Random(18)
    texts = []
    for i in range(600):
        t = prose(rng, rng.randint(5, 40))
        if i < 40:
            t += f" quillmark says w{rng.randrange(10**6)}@corp7.example.com often"
        elif i < 80:
            t += f" a{i}x@other{i}.example.com often"
        elif i < 86:
            t += " zorblatt bob@x.org"
        elif i < 90:
            t += f" chancy +1 202 555 01{i} or 10.20.{i}.7"
        if 0 <= i < 86:
            t += " postbox"
        if i >= 400:
            t += " often says or"
        if i == 90:
            t += " Xanthippe.77@y.org"
        if i in (91, 300):
            t += " xanthippe" if i == 300 else " Xanthippe"
        texts.append(t)
    docs = table(spark, [*texts, None, "", "often " * 3]).repartition(4)
    scanned = materialize(pii.scan(docs), "scan")
    got = {r["term"]: r["told"] for r in pii.disclosing_terms(docs, scanned).collect()}
    want = plain_disclosure([*texts, None, "", "often " * 3])
    assert {w: round(v, 9) for w, v in got.items() if w in want} == {w: round(v, 9) for w, v in want.items()}
    spoken = {w for w in got if w not in want}  # names that stand nowhere else tell all, of no text
    assert all(not re.search(rf"(?<![\w.]){w}(?![\w@.])", " ".join(texts), re.I) for w in spoken)
    assert {"quillmark", "postbox", "zorblatt"} <= set(want) and "often" not in want and not any(w.startswith("chancy") for w in want)
    found = by_id(pii.op10(docs))
    for i, t in enumerate(texts):
        terms = [(m.start(), m.end()) for m in re.finditer(r"[^\W\d_]+", t) if m.group().lower() in want and not any(a <= m.start() < b for a, _, _, b in plain_spans(t))]
        assert [tuple(map(int, x.split(":")[1:])) for x in found[i]["spans"].split(",") if x.startswith("term:")] == terms


def test_positions_over_many_runs(spark):
    rng = random.Random(17)
    texts = ["", "a", "漢 🙂 b", *(" ".join(rng.choice(["ab", "é", "🙂", "漢字", "1"]) for _ in range(n)) for n in (127, 128, 129, 700))]
    df = table(spark, texts).select("doc_id", pii.found(F.col("text"), pii._TERM).alias("w"))
    for r in rows(df):
        assert [(x["s"], x["e"], x["v"]) for x in r["w"]] == [(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\W\d_]+", texts[r["doc_id"]])]


# -- 7, memory ----------------------------------------------------------------------------------------------------
def test_language_clusters_hold_their_rows_once():
    import tracemalloc

    rng = random.Random(31)
    texts, idf = [prose(rng, 30) for _ in range(200)], np.linspace(0.5, 2, langid.BINS)

    def peak(f):
        tracemalloc.start()
        try:
            return f(), tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
    x, most = peak(lambda: langid.vectors(texts, idf))
    assert np.array_equal(x, np.stack([langid.vector(langid.grams(t), idf) for t in texts])) and most < 1.2 * x.nbytes
    (c, sims), most = peak(lambda: langid._cluster(x, 1))
    assert most < 0.3 * x.nbytes  # a copy of the only cluster's rows would be as large as x
    m = x.mean(axis=0)
    assert np.array_equal(c[0], m / float(np.linalg.norm(m))) and len(sims) == 200
