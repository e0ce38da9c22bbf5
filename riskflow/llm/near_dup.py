"""MinHash near-duplicate detection by an inverted join of signature coordinates (operator 9).

1. Every text becomes its set of word shingles (64-bit hashes) and a signature of ``COORDINATES`` minima. Texts with
   equal sets form one class (grouped by the set's digest with map-side combine), so copies cost one row each.
2. Classes are posted under each (coordinate, value) pair. Values that only one class has are dropped, and so are
   classes with fewer than ``least`` shared values. Of what is left, a pair that agrees in ``least`` coordinates agrees
   in at least one of the first (shared - least + 1) in order of rising frequency: only that prefix is posted.
3. Within a posting list the agreeing coordinates are counted against the classes not reached yet (those reached are
   skipped), and a spanning forest of the pairs with ``least`` or more agreements is kept: at most one link a row,
   never all pairs. Lists longer than ``BLOCK`` are cut into blocks, and every pair of blocks is a group of its own.
4. The components of these candidate links are confirmed on the full shingle sets: inside each (again in blocks of
   bounded size) an inverted index of shingles counts the exact intersection of a class with all that are not linked
   yet. Links between different sets at or above the similarity give the components.

``least`` is set so that a pair exactly at the similarity misses it with probability below 1e-9.

Defined results: null or wordless text has an empty set, is linked with nothing and stays. A text of fewer words than
a shingle is one shingle. Repeated rows are copies of each other; every row is judged by its own text, whatever rows
share its id. A null id counts only where a component has no other id. Ties (several texts with the smallest id) go to the
smaller text digest. An empty table gives an empty result; other columns are not read, and may have any name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import fresh, join_apart, materialize, shipped, slices
from riskflow.llm.graph import connected_components

SHINGLE, COORDINATES = 5, 64
BLOCK, BLOCK_SHINGLES = 4096, 2_000_000
#: Small sides of up to so many rows (under 100 bytes and 16 bytes each) are broadcast; larger ones are joined by shuffle.
MOST_MEMBERS, MOST_IDS = 200_000, 2_000_000

_ANY_WORD = r"[^\x20\x09-\x0d]"

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _numbers(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit multipliers."""
    return _mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


_BY_WORD = _numbers(64, 2)
_BY_COORDINATE = _numbers(COORDINATES, 3)
_by_byte = _numbers(256, 1)


def _byte_numbers(n: int) -> np.ndarray:
    global _by_byte
    if n > len(_by_byte):
        _by_byte = _numbers(2 * n, 1)
    return _by_byte


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word (A-Z lower-cased; cut at space, tab, line and form feeds)."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    letters = raw[inside].astype(np.uint64) + np.uint64(1)
    first = np.cumsum(length) - length
    place = np.arange(len(letters)) - np.repeat(first, length)
    sums = np.add.reduceat(letters * _byte_numbers(int(length.max()))[place], first)
    return _mixed(sums + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    w = word_hashes(text)
    n = len(w)
    if not n:
        return w
    k = min(size, n)
    total = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        total += w[i:n - k + 1 + i] * _BY_WORD[i]
    return np.unique(_mixed(total + np.uint64(k)))


def signature(found: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):
        np.minimum(least, (found[at:at + 512, None] * _BY_COORDINATE).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def least_agreements(similarity: float, miss: float = 1e-9) -> int:
    """The largest number that a pair at ``similarity`` undercuts with probability of at most ``miss``."""
    below = 0.0
    for t in range(COORDINATES):
        below += math.comb(COORDINATES, t) * similarity ** t * (1 - similarity) ** (COORDINATES - t)
        if below > miss:
            return t
    return COORDINATES


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (digest of the text), key (digest of the shingle set; null for the empty set), n_shingles, sig: one
    row per row of ``docs``."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("key", pa.binary()), ("n_shingles", pa.int64()), ("sig", pa.list_(pa.int32()))])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                ids, texts = part.column(0), part.column(1).to_pylist()
                texts_of, keys, counts, sigs = [], [], [], []
                for t in texts:
                    s = shingles(t, size)
                    texts_of.append(hashlib.md5((t or "").encode("utf-8", "surrogatepass")).digest())
                    keys.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                    counts.append(len(s))
                    sigs.append(signature(s) if len(s) else None)
                yield pa.RecordBatch.from_arrays([ids, pa.array(texts_of, pa.binary()), pa.array(keys, pa.binary()), pa.array(counts, pa.int64()),
                                                  pa.array(sigs, pa.list_(pa.int32()))], schema=schema)

    return shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, text_key binary, key binary, n_shingles long, sig array<int>")


def _text_key(text) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def _grouped(batches, columns: int):
    """Lists of rows (as one concatenated batch) with equal leading columns, from batches sorted by these."""
    held: list = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        names = batch.column(0).to_pylist() if columns == 1 else list(zip(*(batch.column(i).to_pylist() for i in range(columns))))
        cut = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
        at = 0
        for end in [*cut, len(names)]:
            if held and last != names[at]:
                yield pa.Table.from_batches(held)
                held = []
            last = names[at]
            held.append(batch.slice(at, end - at))
            at = end
    if held:
        yield pa.Table.from_batches(held)


def _forest(n: int, agree) -> list[tuple[int, int]]:
    """A spanning forest; ``agree(i, rest)`` is a mask over ``rest``, the numbers not reached yet."""
    links, rest = [], np.arange(n)
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            i = queue.pop()
            hit = agree(i, rest)
            if hit.any():
                new = rest[hit]
                links += [(i, int(j)) for j in new]
                queue += new.tolist()
                rest = rest[~hit]
    return links


def _links_schema():
    return pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _emit(pairs):
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                                      schema=_links_schema())


def _candidate_links(least: int):
    def run(batches):
        out = []
        for group in _grouped(batches, 3):
            if group.num_rows > 1:
                keys = group.column("key").to_pylist()
                sigs = group.column("sig").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDINATES)
                out += [(keys[i], keys[j]) for i, j in _forest(
                    len(keys), lambda i, rest, s=sigs: (s[rest] == s[i]).sum(axis=1) >= least)]
            if len(out) > 5000:
                yield _emit(out)
                out = []
        yield _emit(out)
    return run


def _confirmed_links(percent: int, size: int):
    def run(batches):
        out = []
        for group in _grouped(batches, 3):
            keys, sets = [], []
            seen = set()
            for part in group.to_batches(max_chunksize=256):
                for key, text in zip(part.column(3).to_pylist(), part.column(4).to_pylist()):
                    if key not in seen:
                        s = shingles(text, size)
                        if hashlib.md5(s.tobytes()).digest() == key:  # an id may stand for several texts
                            seen.add(key)
                            keys.append(key)
                            sets.append(s)
            if len(keys) > 1:
                out += [(keys[i], keys[j]) for i, j in _forest(len(keys), _overlap(sets, percent))]
            if len(out) > 5000:
                yield _emit(out)
                out = []
        yield _emit(out)
    return run


def _overlap(sets: list[np.ndarray], percent: int):
    """Whether set i and the others meet ``percent`` of their union, counted over an inverted index of shingles."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    value, number = np.unique(np.concatenate(sets), return_inverse=True)
    lists = owner[np.argsort(number, kind="stable")]
    ends = np.cumsum(np.bincount(number, minlength=len(value)))
    first = np.concatenate(([0], ends[:-1]))
    starts = np.concatenate(([0], np.cumsum(sizes)))

    def agree(i, rest):
        own = number[starts[i]:starts[i + 1]]
        lo, n = first[own], ends[own] - first[own]
        at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        both = np.bincount(lists[at], minlength=len(sets))[rest]
        return 100 * both >= percent * (sizes[i] + sizes[rest] - both)
    return agree


def _in_blocks(df: DataFrame, group: str, blocks) -> DataFrame:
    """Rows of ``group`` dealt into ``blocks`` blocks, once for each pair of blocks that has theirs."""
    mine = F.pmod(F.xxhash64("key"), blocks).cast("int")
    return (df.withColumn("_n", blocks).withColumn("_m", mine)
            .withColumn("_o", F.explode(F.sequence(F.lit(0), (F.col("_n") - 1).cast("int"))))
            .withColumn("lo", F.least("_m", "_o")).withColumn("hi", F.greatest("_m", "_o"))
            .repartition(group, "lo", "hi").sortWithinPartitions(group, "lo", "hi"))


def _grouped_texts(docs: DataFrame, percent: int, size: int) -> tuple[DataFrame, DataFrame]:
    """The signature rows of ``docs``, and (key, rep, root): every different shingle set, its smallest id and the set that
    names its component."""
    least = least_agreements(percent / 100)
    base = materialize(signatures(docs, size), "signatures")
    classes = materialize(base.filter("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "text_key")).alias("at"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig")), "classes")

    posts = classes.select("key", F.posexplode("sig").alias("i", "v")).select(
        "key", (F.shiftleft(F.col("i").cast("long"), 32) + F.col("v").cast("long")).alias("post"))
    shared = posts.groupBy("post").agg(F.count(F.lit(1)).alias("freq")).filter("freq > 1")
    prefix = (join_apart(posts, shared, "post").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("freq", "post"))).alias("own"))
              .filter(F.size("own") >= least)
              .select("key", F.slice("own", F.lit(1), F.size("own") - (least - 1)).alias("own")))
    listed = (prefix.join(classes.select("key", "sig"), "key")
              .select("key", "sig", F.explode("own").alias("p")).select("p.post", "p.freq", "key", "sig"))
    blocks = F.ceil(F.col("freq") / BLOCK)
    candidates = _in_blocks(listed, "post", blocks).select("post", "lo", "hi", "key", "sig").mapInArrow(
        _candidate_links(least), "a binary, b binary")
    groups = connected_components(candidates)

    members = groups.join(classes.select(F.col("key").alias("node"), "at", "n_shingles"), "node")
    sizes = members.groupBy("root").agg(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES).alias("blocks"))
    members = join_apart(members, sizes, "root").select("root", "blocks", F.col("node").alias("key"), F.col("at.doc_id").alias("id"), F.col("at.text_key").alias("tk"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _text_key(F.col("text")).alias("text_key"))
    members = materialize(members, "members")
    if members.count() <= MOST_MEMBERS:  # a size check: then no text is shuffled for the look-up
        members = F.broadcast(members)
    texts = texts.join(members, (F.col("text_key") == F.col("tk")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("root", "blocks", "key", "text")
    links = _in_blocks(texts, "root", F.col("blocks")).select("root", "lo", "hi", "key", "text").mapInArrow(
        _confirmed_links(percent, size), "a binary, b binary")
    linked = connected_components(links).select(F.col("node").alias("key"), "root")

    return base, classes.select("key", "rep").join(linked, "key", "left").select("key", "rep", F.coalesce("root", "key").alias("root"))


def components(docs: DataFrame, percent: int = 80, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs``.

    Texts are linked where 100 * intersection >= ``percent`` * union of their shingle sets; component_id is the
    smallest id reachable over links, and the row with that id is kept.
    """
    base, owner = _grouped_texts(docs, percent, size)
    ids = owner.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = join_apart(owner, ids, "root").select("key", "component_id")
    out = base.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def representatives(docs: DataFrame, percent: int = 80, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one document of each component: all columns stay.

    A document is an id with a text: rows with one id and different texts are judged each by its text, and rows without an
    id are judged too. Of a component the row with the smallest (id, text digest) stays, one without id only where no row
    of it has one; of rows equal in both, one. Texts without words are in no component and all stay.
    """
    base, owner = _grouped_texts(docs, percent, size)
    # one row for each document, so that copies of one are counted before the components are looked up
    rows = base.filter("key is not null").groupBy("key", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("n"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key", "n")
    classes = rows.groupBy("key").agg(F.min(first).alias("first"))
    picked = owner.join(classes, "key").groupBy("root").agg(F.min("first").alias("first"))
    key, id_, tk, n = (fresh(docs, c) for c in ("_near_key", "_near_id", "_near_text", "_near_n"))
    picked = materialize(picked.select(F.col("first.doc_id").alias(id_), F.col("first.text_key").alias(tk), F.col("first.n").alias(n)), "kept")
    own = [F.col(f"`{c}`") for c in docs.columns]
    several = picked.filter(F.col(n) > 1).head(1)
    if picked.count() <= MOST_IDS:
        picked = F.broadcast(picked)
    keyed = docs.withColumn(key, _text_key(F.col("text")))
    found = keyed.join(picked, (F.col(key) == F.col(tk)) & F.col("doc_id").cast("long").eqNullSafe(F.col(id_)))
    out = found.filter(F.col(n) == 1).select(*own)
    if several:
        out = out.unionByName(found.filter(F.col(n) > 1).dropDuplicates([id_, tk]).select(*own))
    return out.unionByName(docs.filter(~F.coalesce(F.col("text"), F.lit("")).rlike(_ANY_WORD)))


def op9(docs: DataFrame) -> DataFrame:
    return components(docs, percent=85)


#: Shingle sets joined on their shingles, and reachability over the links.
ORACLE = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sh AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), link AS (
    SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2) p
    JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * k >= 85 * (x.n + y.n - k)
), reach AS (
    SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), root AS (
    SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
       doc_id = coalesce(component_id, doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN root USING (doc_id)
"""
