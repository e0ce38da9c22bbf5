"""Removal of repeated byte strings by column-wise suffix sorting of a collection (operator 4).

Every byte covered by a ``length``-byte string that also starts anywhere else is removed. Sorting all suffixes of a
corpus in one collection cannot be spread over tasks, so the collection is first cut into independent ones:

1. Each window of ``length`` bytes is assigned to its minimizer, the leftmost of its ``GRAM``-byte grams with the
   smallest hash. Equal windows have equal minimizers at equal offsets. Consecutive windows with one minimizer form a
   segment. Only minimizers that more than one segment has can hold repeats.
2. Equal segments are counted and kept once (map-side combine): all windows of a segment that occurs twice repeat.
3. The different segments of one minimizer, aligned at it, are a collection that is sorted column by column from the
   right: each round inserts one symbol per segment, a stable sort by that symbol turns the order of the suffixes
   from column c + 1 into that from column c (the column's part of the collection's Burrows-Wheeler transform), and
   the common prefixes of neighbours become one more than the smallest between them, or zero where the symbols
   differ. Windows whose suffix shares ``length`` symbols with a neighbour repeat. The columns come in sequence from
   the sorted shuffle files; a task holds the order, the common prefixes and one bounded batch of segments.
4. A minimizer with more than ``HOT`` different segments is not one collection: the digests of its single windows are
   counted instead, again with map-side combine. The result is the same, whatever the size.

The marked windows go back to all occurrences of their segment, and each text is rebuilt without the marked bytes.

Defined results: null text is the empty text; texts shorter than ``length`` bytes keep all bytes; repeated rows are
copies of each other and so lose everything from ``length`` bytes on; ids may be null or repeated; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import join_apart, materialize, shipped, slices

LENGTH, GRAM, HOT, BATCH, MOST_BROADCAST = 400, 32, 20_000, 4096, 200_000
_MULTIPLIER = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes (a power of two) from each position."""
    h = _mixed(b.astype(np.uint64) + np.uint64(_MULTIPLIER))
    step, factor = 1, _MULTIPLIER
    while step < GRAM:
        h = h[:-step] * np.uint64(factor) + h[step:]
        factor = factor * factor % (1 << 64)
        step *= 2
    return _mixed(h)


def minimizers(h: np.ndarray, width: int) -> np.ndarray:
    """The position of the leftmost smallest of ``width`` consecutive values, from each position."""
    value, at, span = h, np.arange(len(h), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        left = value[:-step] <= value[step:]
        at = np.where(left, at[:-step], at[step:])
        value = np.minimum(value[:-step], value[step:])
        span += step
    return at


def segments(b: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, place of the minimizer in the segment and its hash, of each segment."""
    if len(b) < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    h = gram_hashes(np.frombuffer(b, np.uint8))
    at = minimizers(h, length - GRAM + 1)
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    n = np.diff(np.concatenate((start, [len(at)])))
    return start, n, at[start] - start, h[at[start]].view(np.int64)


def repeated_windows(columns: list[tuple[bytes, int]], length: int) -> list[np.ndarray]:
    """Of segments (bytes, place of the minimizer), the windows that some other of them has at the same place.

    Rounds go from the last column to the first; ``order`` sorts the suffixes from the round's column on, and
    ``common[i]`` is the common prefix of the suffixes order[i - 1] and order[i].
    """
    m = len(columns)
    most_left = max(a for _, a in columns)
    width = most_left + max(len(s) - a for s, a in columns)
    absent = 256
    table = np.full((width, m), absent, np.uint16)
    for j, (s, a) in enumerate(columns):
        table[most_left - a:most_left - a + len(s), j] = np.frombuffer(s, np.uint8)
    hits = np.zeros((most_left + 1, m), bool)
    order, common = np.arange(m), np.zeros(m, np.int64)
    for c in range(width - 1, -1, -1):
        symbol = table[c][order]
        by_symbol = np.argsort(symbol, kind="stable")
        new = np.zeros(m, np.int64)
        done = 0
        counts = np.bincount(symbol, minlength=absent + 1)
        for s in np.flatnonzero(counts[:absent]):
            places = by_symbol[done:done + counts[s]]
            if counts[s] > 1:
                new[done + 1:done + counts[s]] = 1 + np.minimum.reduceat(common[:places[-1] + 1], places[:-1] + 1)
            done += counts[s]
        order, common = order[by_symbol], new
        if c <= most_left:
            same = common >= length
            if same.any():
                hits[c, order[same]] = True
                hits[c, order[np.flatnonzero(same) - 1]] = True
    return [np.flatnonzero(hits[most_left - a:most_left + 1, j]) for j, (_, a) in enumerate(columns)]


def _ranges(found: np.ndarray) -> list[tuple[int, int]]:
    """Runs of consecutive numbers as (first, end)."""
    if not len(found):
        return []
    cut = np.flatnonzero(np.diff(found) > 1)
    return list(zip(found[np.concatenate(([0], cut + 1))].tolist(), (found[np.concatenate((cut, [len(found) - 1]))] + 1).tolist()))


def _bytes(text) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _cut(docs: DataFrame, length: int) -> DataFrame:
    """doc_id, text_key, start, n, place, mini, digest of every segment of every text."""
    import xxhash

    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.binary()), ("start", pa.int32()), ("n", pa.int32()),
                        ("place", pa.int32()), ("mini", pa.int64()), ("digest", pa.int64())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, 64):
                out = [[] for _ in schema]
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    b = _bytes(text)
                    start, n, place, mini = segments(b, length)
                    if len(start):
                        key = hashlib.md5(b).digest()
                        ends = start + n + (length - 1)
                        digest = [xxhash.xxh3_64_intdigest(b[i:j]) - (1 << 63) for i, j in zip(start.tolist(), ends.tolist())]
                        for column, values in zip(out, ([doc_id] * len(start), [key] * len(start), start, n, place, mini, digest)):
                            column.extend(values)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)

    return shipped(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, text_key binary, start int, n int, place int, mini long, digest long")


def _only(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose text is in ``keys`` (text_key), dropped before any shuffle if the keys are few."""
    if keys.count() <= MOST_BROADCAST:
        return docs.join(F.broadcast(keys), "text_key", "left_semi")
    return docs


def _fetch(docs: DataFrame, wanted: DataFrame, length: int, single: bool) -> DataFrame:
    """The bytes of the ``wanted`` segments (doc_id, text_key, start, n, place, mini, digest), each once; with
    ``single`` the digests of their windows instead."""
    import xxhash

    per_text = wanted.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("start", "n", "place", "mini", "digest")).alias("own"))
    rows = (_only(docs, wanted.select("text_key").distinct()).join(
        per_text.withColumnRenamed("doc_id", "_id").withColumnRenamed("text_key", "_key"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key"))).select("text", "own"))
    schema = "mini long, digest long, " + ("window int, hash binary" if single else "place int, bytes binary")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 32):
                out = [[], [], [], []]
                for text, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    b = _bytes(text)
                    for x in own:
                        s = b[x["start"]:x["start"] + x["n"] + length - 1]
                        if single:
                            for w in range(x["n"]):
                                for column, v in zip(out, (x["mini"], x["digest"], w, xxhash.xxh3_128_digest(s[w:w + length]))):
                                    column.append(v)
                        else:
                            for column, v in zip(out, (x["mini"], x["digest"], x["place"], s)):
                                column.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.binary())],
                    names=[f.split()[0] for f in schema.split(", ")])

    return rows.mapInArrow(run, schema)


def _sorted_collections(length: int):
    """Marks (mini, digest, from, to) of collections that come in order of their minimizer."""
    def flush(held):
        out = []
        for (mini, digest, _, _), found in zip(held, repeated_windows([(b, a) for _, _, a, b in held], length)):
            out += [(mini, digest, i, j) for i, j in _ranges(found)]
        return pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            names=["mini", "digest", "from", "to"])

    def run(batches):
        held, group, seen = [], [], set()  # whole collections; the one being read
        for batch in batches:
            for mini, digest, place, b in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if group and group[0][0] != mini:
                    held += group if len(group) > 1 else []
                    group, seen = [], set()
                    if len(held) >= BATCH:
                        yield flush(held)
                        held = []
                if digest not in seen:  # rows with one id and one text
                    seen.add(digest)
                    group.append((mini, digest, place, b))
        held += group if len(group) > 1 else []
        if held:
            yield flush(held)
    return run


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """text_key, ranges array<struct<from, to>>: starts of windows that occur elsewhere, for each text that has any.

    ``docs`` has doc_id, text and text_key."""
    cut = materialize(_cut(docs, length), "segments")
    kinds = materialize(cut.groupBy("mini", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc_id", "text_key", "start", "n", "place")).alias("at")), "segment-kinds")
    crowds = kinds.groupBy("mini").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    members = join_apart(kinds, crowds, "mini").select("at.*", "mini", "digest", "kinds")
    members = materialize(members, "segment-members")
    normal = _fetch(docs, members.filter(F.col("kinds") <= HOT).drop("kinds"), length, False)
    marks = normal.repartition("mini").sortWithinPartitions("mini").mapInArrow(
        _sorted_collections(length), "mini long, digest long, from int, to int")
    hot = members.filter(F.col("kinds") > HOT).drop("kinds")
    if hot.head(1):
        windows = materialize(_fetch(docs, hot, length, True), "hot-windows").distinct()
        twice = windows.groupBy("mini", "hash").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c")
        marks = marks.unionByName(windows.join(twice, ["mini", "hash"]).select(
            "mini", "digest", F.col("window").alias("from"), (F.col("window") + 1).alias("to")))
    copied = kinds.filter("copies > 1").select("mini", "digest", F.lit(0).alias("from"), F.col("at.n").alias("to"))
    marks = marks.unionByName(copied)
    ranges = (cut.select("text_key", "start", "mini", "digest").join(marks, ["mini", "digest"])
              .select("text_key", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to")).distinct())
    return ranges.groupBy("text_key").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))


def _removed(ranges, size: int, length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by the windows that start in ``ranges``."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        b = min(size, b + length - 1)
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.unhex(F.md5(text.cast("binary"))).alias("text_key"))


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary), kept_sha256: one row per row of ``docs``."""
    rows = keyed(docs)
    found = materialize(repeats(rows, length), "repeats")
    # what has no repeat stays as it is; its text is not shuffled
    plain = rows.select("doc_id", "text_key", F.octet_length("text").cast("long").alias("n_bytes"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
    plain = plain.join(found.select("text_key"), "text_key", "left_anti").select(
        "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), "kept_sha256")
    marked = _only(rows, found.select("text_key")).join(found, "text_key").select("doc_id", "text", "ranges")

    def run(batches):
        for batch in batches:
            for part in slices(batch, 64):
                out = []
                for doc_id, text, ranges in zip(*(part.column(i).to_pylist() for i in range(3))):
                    b = _bytes(text)
                    spans = _removed([(r["from"], r["to"]) for r in ranges], len(b), length)
                    at, kept = 0, []
                    for i, j in spans:
                        kept.append(b[at:i])
                        at = j
                    kept = b"".join([*kept, b[at:]])
                    out.append((doc_id, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate(types)],
                                                 names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    changed = marked.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return plain.unionByName(changed).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4(docs: DataFrame) -> DataFrame:
    return deduplicate(docs)


#: All windows of all texts, counted; the marked runs are cut out of the text in hexadecimal.
ORACLE = """
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, encode(coalesce(text, '')) AS t FROM documents
), w AS (
    SELECT rid, i, md5(t[i + 1:i + 400]) AS s FROM (SELECT rid, t, unnest(range(octet_length(t) - 399)) AS i FROM d)
), hit AS (
    SELECT rid, i FROM w WHERE s IN (SELECT s FROM w GROUP BY s HAVING count(*) > 1)
), run AS (
    SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS g
    FROM (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 400 THEN 0 ELSE 1 END AS new FROM hit)
), span AS (
    SELECT rid, min(i) AS a, max(i) + 400 AS b FROM run GROUP BY rid, g
), spans AS (
    SELECT rid, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a) AS removed, count(*) AS n FROM span GROUP BY rid
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE array_to_string([
           substr(h, 2 * CASE WHEN k = 0 THEN 0 ELSE b[k] END + 1,
                  2 * (CASE WHEN k = n THEN length(h) // 2 ELSE a[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE b[k] END)) for k in range(n + 1)], '') END)) AS kept_sha256
FROM d LEFT JOIN spans USING (rid)
"""
