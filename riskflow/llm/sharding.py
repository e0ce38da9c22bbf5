"""Sharding by a permutation-filled lookup table (operator 3).

Every shard has its own order of preference over the slots of a prime-sized table: slot (offset + j * skip) mod size
for j = 0, 1, 2, ..., with offset and skip from a hash of the shard's name. The shards take turns, each claiming its
next preferred free slot, until the table is full. Shards so own almost equally many slots, and removing one
shard moves few rows besides its own. A row's slot is its key's hash mod the table size; the table (``size`` small
rows, a fixed parameter that does not depend on the data) is broadcast, so that placing a row takes one look-up.

Main path: DataFrame functions only. The table itself is a driver-side constant of ``size`` numbers.

Defined results: a null key is placed as the empty text; repeated rows go to the same shard; an empty table gives an
empty result; other columns of ``docs`` are not read. Hot sources or texts do not matter: the key is the id.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Production parameters: 64 shards over a table of 8,191 slots (a prime, over 100 slots a shard).
SHARDS, SLOTS = 64, 8191


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def preference(name: str, size: int) -> tuple[int, int]:
    """Offset and skip of a shard's preference order; skip and the prime size have no common factor."""
    h = hashlib.md5(name.encode()).hexdigest()
    return int(h[:15], 16) % size, int(h[15:30], 16) % (size - 1) + 1


def lookup_table(names: list[str], size: int = SLOTS) -> list[int]:
    """Slot -> index of the shard that owns it."""
    if not _is_prime(size) or len(names) > size or not names or len(set(names)) < len(names):
        raise ValueError("the table size must be a prime of at least the number of shards, whose names differ")
    prefer = [preference(n, size) for n in names]
    tried = [0] * len(names)
    owner = [-1] * size
    free = size
    while True:
        for i, (offset, skip) in enumerate(prefer):
            while True:
                slot = (offset + tried[i] * skip) % size
                tried[i] += 1
                if owner[slot] < 0:
                    break
            owner[slot] = i
            free -= 1
            if not free:
                return owner


def slot_of(key: Column, size: int) -> Column:
    """The key's slot: the first 60 bits of its MD5 modulo the table size."""
    return F.pmod(F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(size)).cast("int")


def table(spark: SparkSession, names: list[str], size: int = SLOTS) -> DataFrame:
    """slot, shard, shard_name: ``size`` rows, from constants."""
    owners = F.split(F.lit(",".join(map(str, lookup_table(names, size)))), ",")
    shards = F.split(F.lit(",".join(names)), ",")
    return (spark.range(1).select(F.posexplode(owners).alias("slot", "s"))
            .select("slot", F.col("s").cast("int").alias("shard"))
            .withColumn("shard_name", F.get(shards, F.col("shard"))))


def place(docs: DataFrame, key: str = "doc_id", names: list[str] | None = None, size: int = SLOTS) -> DataFrame:
    """key column, slot, shard, shard_name: one row per row of ``docs``; no shuffle."""
    names = names or shard_names()
    owners = table(docs.sparkSession, names, size)
    return docs.select(key).withColumn("slot", slot_of(F.col(key), size)).join(F.broadcast(owners), "slot") \
        .select(key, "slot", "shard", "shard_name")


def op3(docs: DataFrame) -> DataFrame:
    return place(docs)


#: The claims are a loop over the free slots, too slow as a recursive query; SQL gets the filled table as a list (tests
#: check it against a plain simulation) and does hashing and placement by itself.
ORACLE = f"""
WITH placed AS (
    SELECT doc_id, CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {SLOTS} AS INTEGER) AS slot
    FROM documents
), owners AS (
    SELECT {lookup_table(shard_names())} AS owner
)
SELECT doc_id, slot, CAST(owner[slot + 1] AS INTEGER) AS shard, printf('shard-%05d', owner[slot + 1]) AS shard_name
FROM placed, owners
"""
