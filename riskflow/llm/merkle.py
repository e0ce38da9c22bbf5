"""Merkle dataset manifest by time-forward processing (operator 12).

A tree of fan-out ``FAN`` stands over the leaves of each source (ordered by id) and another over the sources' subroots.
Every node has a label (level, index); a digest is a message to the label of the parent, and nodes are processed in label
order, so that a node finds the messages of all its children at the head of a priority queue. The queue is external: a
block is ``FAN ** DEPTH`` consecutive nodes of one source and what lies above them for ``DEPTH`` levels; within a block
the queue is a heap that holds at most the block's own digests; messages that leave a block are written out, and Spark's
external sort by (source, block, position) brings them to the block that owns the label. Each such pass is ``DEPTH``
levels; their number is the logarithm of the largest source's size, whatever the number of rows of one source.

The reversed sweep runs the passes backwards: a block gets the message of its top node (the digests beside the path from
there to the root, level by level, as those left and those right of it), puts it before its own digests, and sends each
node the digests beside its path. At the leaves that is the whole proof. Messages come before the rows of their block by
the sort order, so a block holds one message and at most ``FAN ** DEPTH`` rows.

Defined results: a null field is hashed as ``-``; a null source is a source of its own, the first; leaves with equal ids
are ordered by their digest (equal rows are interchangeable) and null ids come first; a row without id is never tampered
with. A lone leaf is its subroot, a lone subroot the root; without siblings the proof is the hash of no bytes. An empty
table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import string

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import materialize, shipped

FAN, DEPTH, TAMPERED_MOD = 16, 3, 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# -- one block: a heap of messages in label order ------------------------------------------------------------------
def block_levels(digests: list[str], whole: bool) -> list[list[str]]:
    """The digests of each level of a block, from its nodes to its top. ``whole``: the block is all that its source has
    on this level, and the levels end when one node is left; else there are ``DEPTH`` of them."""
    levels = [digests]
    queue = [(1, i // FAN, i % FAN, d) for i, d in enumerate(digests)]  # already in label order, thus a heap
    while len(levels[-1]) > 1 or (not whole and len(levels) <= DEPTH):
        height, nodes = len(levels), []
        while queue and queue[0][0] == height:
            index, children = queue[0][1], []
            while queue and queue[0][:2] == (height, index):
                children.append(heapq.heappop(queue)[3])
            nodes.append(digest("".join(children)))
            heapq.heappush(queue, (height + 1, index // FAN, index % FAN, nodes[-1]))
        levels.append(nodes)
    return levels


def block_paths(levels: list[list[str]], lefts: list[str], rights: list[str]) -> list[tuple[list[str], list[str]]]:
    """For each node of a block the digests left and right of its path, from its own level up to the root; ``lefts``
    and ``rights`` are those of the block's top."""
    paths = [(lefts, rights)]
    for nodes in reversed(levels[:-1]):
        own = []
        for i in range(len(nodes)):
            first = i - i % FAN
            above = paths[i // FAN]
            own.append((["".join(nodes[first:i]), *above[0]], ["".join(nodes[i + 1:first + FAN]), *above[1]]))
        paths = own
    return paths


def _blocks(batches, columns: list[str]):
    """(source, block, rows) of rows that come ordered by source, block and position."""
    held, key = [], None
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in columns)):
            if held and row[:2] != key:
                yield *key, held
                held = []
            key = row[:2]
            held.append(row[2:])
    if held:
        yield *key, held


def _in_blocks(nodes: DataFrame, *columns) -> DataFrame:
    block, position = F.floor(F.col("idx") / (FAN ** DEPTH)).cast("long"), F.pmod("idx", F.lit(FAN ** DEPTH)).cast("int")
    return nodes.select("source", block.alias("block"), position.alias("position"), *columns)


def _is_whole(block: int, rows: int) -> bool:
    """Whether a block is all of its level; a full first block has ``DEPTH`` levels either way."""
    return block == 0 and rows < FAN ** DEPTH


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _up(nodes: DataFrame) -> DataFrame:
    """source, idx, digest of the tops of the blocks of ``nodes`` (source, idx, digest)."""
    schema = pa.schema([("source", pa.string()), ("idx", pa.int64()), ("digest", pa.string())])

    def run(batches):
        out = []
        for source, block, rows in _blocks(batches, ["source", "block", "position", "digest"]):
            out.append((source, block, block_levels([r[1] for r in rows], _is_whole(block, len(rows)))[-1][0]))
            if len(out) >= 1024:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    rows = _in_blocks(nodes, "digest").repartition("source", "block").sortWithinPartitions("source", "block", "position")
    return shipped(rows).mapInArrow(run, "source string, idx long, digest string")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` (source, idx, digest) and the stored tops of each pass, down to one node for each source."""
    passes = [nodes]
    while (passes[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        passes.append(materialize(_up(passes[-1]), "merkle-nodes"))
    return passes


def _down(nodes: DataFrame, messages: DataFrame, per_block, schema: str, *columns: str) -> DataFrame:
    """``per_block(source, rows, paths, message)`` -> rows of ``schema``, for every block of ``nodes``.

    ``messages`` (source, idx, lefts, rights, subroot, root) are those for the tops of the blocks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    types = dict(nodes.dtypes)
    told = messages.select(
        "source", F.col("idx").alias("block"), F.lit(-1).alias("position"), F.lit(None).cast("string").alias("digest"),
        *[F.lit(None).cast(types[c]).alias(c) for c in columns], "lefts", "rights", "subroot", "root")
    own = _in_blocks(nodes, "digest", *columns,
                     *[F.lit(None).cast(t).alias(c) for c, t in (("lefts", "array<string>"), ("rights", "array<string>"), ("subroot", "string"), ("root", "string"))])
    names = ["source", "block", "position", "digest", *columns, "lefts", "rights", "subroot", "root"]

    def run(batches):
        out = []
        for source, block, held in _blocks(batches, names):
            message, rows = held[0][-4:], held[1:]
            levels = block_levels([r[1] for r in rows], _is_whole(block, len(rows)))
            for i, path in enumerate(block_paths(levels, message[0], message[1])):
                out.append(per_block(source, block * FAN ** DEPTH + i, rows[i], path, message))
                if len(out) >= 512:
                    yield _batch(out, arrow)
                    out = []
        yield _batch(out, arrow)

    rows = own.unionByName(told).repartition("source", "block").sortWithinPartitions("source", "block", "position")
    return shipped(rows).mapInArrow(run, schema)


_MESSAGE = "source string, idx long, lefts array<string>, rights array<string>, subroot string, root string"


def _onward(source, idx, row, path, message):
    return source, idx, path[0], path[1], message[2], message[3]


def descend(passes: list[DataFrame], top: DataFrame) -> DataFrame:
    """The messages for the nodes of the first of ``passes`` but one, from those for its last."""
    for nodes in reversed(passes[1:-1]):
        top = materialize(_down(nodes, top, _onward, _MESSAGE), "merkle-messages")
    return top


# -- leaves --------------------------------------------------------------------------------------------------------
def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, digest (the leaf), tampered (the leaf of the tampered row; null where the row is not)."""
    others = [F.col(c) for c in FIELDS[:-1]]
    lower = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(TAMPERED_MOD)) == 0
    return docs.select("source", F.col("doc_id").cast("long").alias("doc_id"), leaf_of(*others, F.col("text")).alias("digest"),
                       F.when(chosen, leaf_of(*others, lower)).alias("tampered"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with idx, the row's number within its source by ``order``.

    One global range sort; a task numbers the sources it meets, and a source that began in earlier tasks starts from
    the rows they have of it (at most one such source a task, so this table has no more rows than there are tasks).
    """
    first = rows.withColumn("_row", F.monotonically_increasing_id())  # tells equal rows apart, so that no range is one key
    first = materialize(first, "merkle-leaves")
    keys = [F.col("source").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order], F.col("_row")]
    ranged = first.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_row").withColumn("part", F.spark_partition_id())

    def run(batches):
        source, n = None, -1
        for batch in batches:
            at = []
            for s in batch.column("source").to_pylist():
                n = n + 1 if s == source and n >= 0 else 0
                source = s
                at.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*batch.schema.names, "i"])

    kept = ", ".join(f"{n} {t}" for n, t in ranged.dtypes)
    ordered = materialize(ranged.mapInArrow(run, f"{kept}, i long"), "merkle-ordered")
    parts = ordered.groupBy("part", "source").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    begun = parts.select(F.col("part").alias("_part"), F.col("source").alias("_source"), before.alias("before")).filter("before > 0")
    return (ordered.join(F.broadcast(begun), (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_source")), "left")
            .withColumn("idx", F.col("i") + F.coalesce("before", F.lit(0))).drop("part", "i", "_part", "_source", "before"))


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf and the digests beside its path lead to."""
    for a, b in zip(lefts, rights):
        leaf = digest(a + leaf + b)
    return leaf


def manifest(docs: DataFrame, proofs: bool = True) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; with ``proofs`` also lefts and rights (the proof:
    the digests left and right of the path, from the leaf's level up)."""
    rows = materialize(numbered(leaves(docs), ["doc_id", "digest"]), "merkle-numbered")
    trees = climb(rows)
    # the sources are the leaves of one more tree
    tops = trees[-1].select(F.lit("").alias("source"), F.col("source").alias("name"), "digest")
    named = materialize(numbered(tops, ["name"]), "merkle-sources")
    upper = climb(named)
    nothing = F.array().cast("array<string>")
    root = upper[-1].select("source", "idx", nothing.alias("lefts"), nothing.alias("rights"), F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def to_source(source, idx, row, path, message):
        return row[2], 0, path[0], path[1], row[1], message[3]

    told = materialize(_down(named, descend(upper, root), to_source, _MESSAGE, "name"), "merkle-messages")

    def to_leaf(source, idx, row, path, message):
        leaf, doc_id, tampered = row[1:4]
        lefts, rights = path
        folded = fold(tampered or leaf, lefts, rights)
        out = (doc_id, leaf, message[2], message[3], digest("".join(a + b for a, b in zip(lefts, rights))), folded, folded == message[3])
        return (*out, lefts, rights) if proofs else out

    schema = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
              + ", lefts array<string>, rights array<string>" * proofs)
    return _down(rows, descend(trees, told), to_leaf, schema, "doc_id", "tampered")


def op12(docs: DataFrame) -> DataFrame:
    return manifest(docs, proofs=False)


def _oracle(levels: int = 5) -> str:
    """The trees level by level, for at most ``FAN ** levels`` leaves a source and as many sources; a level above a
    tree's top changes nothing. Proofs and the folding of tampered leaves go along."""
    def climbed(name: str) -> str:
        steps = []
        for i in range(levels):
            steps.append(f"""{name}{i + 1} AS MATERIALIZED (
    SELECT g, CASE WHEN size > 1 THEN i // {FAN} ELSE i END AS i, any_value(CASE WHEN size > 1 THEN h ELSE d END) AS d, any_value((size + {FAN - 1}) // {FAN}) AS size
    FROM (SELECT g, i, d, size, CASE WHEN size > 1 THEN sha256(string_agg(d, '' ORDER BY i) OVER (PARTITION BY g, i // {FAN} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) END AS h
          FROM {name}{i}) GROUP BY 1, 2)""")
        return ",\n".join(steps)

    def beside(name: str, level: int, alias: str) -> str:
        """The digests of the run of a path on a level, as a list, and the place of the path in it."""
        return f"""LEFT JOIN (SELECT g, i // {FAN} AS run, any_value(size) AS size, list(d ORDER BY i) AS ds FROM {name}{level} GROUP BY 1, 2) {alias}{level}
    ON {alias}{level}.g = {'l.g' if name == 't' else "''"} AND {alias}{level}.run = {'l.i' if name == 't' else 's.i'} // {FAN ** (level + 1)} AND {alias}{level}.size > 1"""

    folds = []
    for name, alias, at in (("t", "a", "i"), ("u", "b", "si")):
        for level in range(levels):
            ds, place = f"{alias}{level}", f"({at} // {FAN ** level}) % {FAN}"
            folds.append((ds, place))
    body, proof = "flat", []
    chain = []
    for n, (ds, place) in enumerate(folds):
        left = f"array_to_string({ds}[1:{place}], '')"
        right = f"array_to_string({ds}[{place} + 2:], '')"
        proof.append(f"CASE WHEN {ds} IS NULL THEN '' ELSE {left} || {right} END")
        chain.append(f"f{n + 1} AS (SELECT *, CASE WHEN {ds} IS NULL THEN c{n} ELSE sha256({left} || c{n} || {right}) END AS c{n + 1} FROM {f'f{n}' if n else body})")
    joins = "\n    ".join([beside("t", k, "a") for k in range(levels)] + [beside("u", k, "b") for k in range(levels)])
    lists = ", ".join(f"{alias}{k}.ds AS {alias}{k}" for alias in "ab" for k in range(levels))
    part = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || CAST({c} AS VARCHAR), '-')"
    others = " || ".join(part(c) for c in FIELDS[:-1])
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH RECURSIVE crc_table AS (
    SELECT list(v ORDER BY n) AS t FROM (
        SELECT n, list_reduce([n] || range(8), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(n))
), d AS (
    SELECT doc_id, source AS g, sha256({others} || {part('text')}) AS leaf,
           CASE WHEN xor(list_reduce([4294967295] || list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1), lambda p: CAST(ascii(substr(CAST(doc_id AS VARCHAR), p, 1)) AS BIGINT)),
                    lambda c, b: xor(c // 256, t[CAST(xor(c, b) % 256 AS INTEGER) + 1])), 4294967295) % {TAMPERED_MOD} = 0
                THEN sha256({others} || {part(lower)}) END AS tampered
    FROM documents, crc_table
), t0 AS MATERIALIZED (
    SELECT coalesce('+' || g, '') AS g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS d,
           count(*) OVER (PARTITION BY g) AS size, doc_id, tampered
    FROM d
),
{climbed("t")},
u0 AS MATERIALIZED (
    SELECT '' AS g, row_number() OVER (ORDER BY encode(g)) - 1 AS i, d, count(*) OVER () AS size, g AS name FROM t{levels}
),
{climbed("u")},
flat AS MATERIALIZED (
    SELECT l.doc_id, l.d AS leaf, l.i, s.i AS si, s.d AS subroot, u{levels}.d AS root, coalesce(l.tampered, l.d) AS c0, {lists}
    FROM t0 l JOIN u0 s ON s.name = l.g JOIN u{levels} ON true
    {joins}
),
{", ".join(chain)}
SELECT doc_id, leaf, subroot, root, sha256({" || ".join(proof)}) AS proof_sha256, c{len(folds)} AS folded_root, c{len(folds)} = root AS verified
FROM f{len(folds)}
"""


ORACLE = _oracle()
