"""The Merkle manifest against plain trees."""

import hashlib
import string
import zlib

import pytest
from pyspark.sql import functions as F

from riskflow.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    values = (doc_id, source, lang, n_chars, text)
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """All levels of a tree of fan-out 16."""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        first = i - i % 16
        out.append((nodes[first:i], nodes[i + 1:first + 16]))
        i //= 16
    return out


def plain(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        order = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[s] = order, tree([leaf(*r) for r in order])
    top = tree([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        order, levels = trees[s]
        for i, r in enumerate(order):
            path = siblings(levels, i) + siblings(top, k)
            now = levels[0][i]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = leaf(r[0], r[1] and r[1].translate(LOWER), *r[2:])
            for a, b in path:
                now = h("".join(a) + now + "".join(b))
            root = top[-1][0]
            out.append((r[0], levels[0][i], levels[-1][0], root, h("".join("".join(a + b) for a, b in path)), now, now == root))
    return out


def key(t):
    return tuple((v is not None, v or 0) if not isinstance(v, str) else v for v in t)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_blocks(n):
    digests = [h(str(i)) for i in range(n)]
    levels = merkle.block_levels(digests, True)
    assert levels == tree(digests)
    paths = merkle.block_paths(levels, ["l"], ["r"])
    for i, (lefts, rights) in enumerate(paths):
        assert list(zip(lefts, rights)) == [("".join(a), "".join(b)) for a, b in siblings(levels, i)] + [("l", "r")]
    part = merkle.block_levels(digests, False)  # a later block has all its levels
    assert len(part) == merkle.DEPTH + 1 and len(part[-1]) == 1


def test_awkward_rows(spark):
    rows = [(i, f"Text {i}", "en", f"s{i % 3}", i) for i in range(60)]
    rows += [(None, None, None, None, None), (None, "NULL id", "en", "s1", 1), (7, "ÄB \U0001f600 İ", None, "é", None), (5, None, "en", "s2", 3),
             (8, "", "", "", 0), (3, "Text 3", "en", "s0", 3), (3, "Text 3", "en", "s0", 3), (3, "other", "en", "s0", 3),
             (10, "A" * 3_000_000, "en", "long", 9), (15, "-", "5:", "s10", -1)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("idx", "block", "position", "digest", "part", "i", "before", "name", "leaf", "_row", "root"):
        df = df.withColumn(c, F.lit("x"))
    same(merkle.op12(df.repartition(4)).collect(), plain(rows))


def test_one_source_over_many_blocks_and_many_sources(spark):
    """A source of several blocks, among them a last block of one leaf, and more sources than one run holds."""
    n = 2 * 16 ** merkle.DEPTH + 1
    rows = [(i, f"Row {i}", "en", "hot", i) for i in range(n)] + [(i, "Row", "en", f"t{i:03}", i) for i in range(300)]
    want = plain(rows)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    same(merkle.op12(df).collect(), want)
    assert {r[6] for r in want} == {True, False}


def test_proofs_fold_to_the_root(spark):
    rows = [(i, "t", None, "a" if i % 2 else "b", None) for i in range(40)]
    for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect():
        assert merkle.fold(r["leaf"], r["lefts"], r["rights"]) == r["root"]
        assert h("".join(a + b for a, b in zip(r["lefts"], r["rights"]))) == r["proof_sha256"]
        assert not r["verified"] or r["folded_root"] == r["root"]


def test_empty_and_single(spark):
    assert merkle.op12(spark.createDataFrame([], SCHEMA)).collect() == []
    same(merkle.op12(spark.createDataFrame([(1, "A", None, None, 1)], SCHEMA)).collect(), plain([(1, "A", None, None, 1)]))
