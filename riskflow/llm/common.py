"""Small helpers shared by the training-data operators.

Rows are handled in Arrow batches inside Spark tasks (``mapInArrow``); nothing here holds more than one batch,
and ``slices`` keeps the Python copy of a batch small when texts are long.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import riskflow
from riskflow.session import checkpoint_dir, materialize, scratch_path

__all__ = ["ASCII_LOWER", "WORD", "checkpoint_dir", "materialize", "scratch_path", "documents", "fold",
           "fresh", "join_apart", "map_rows", "parquet", "shipped", "slices"]

#: Words of the contracts: runs without space, tab, line feed, vertical tab, form feed or carriage return.
WORD = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def parquet(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet(spark, sf_dir, "documents")


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after its executors have been given this package (as ``--py-files`` does), once per application."""
    sc = df.sparkSession.sparkContext
    if getattr(sc, "_riskflow_shipped", None) is None:
        base = Path(riskflow.__file__).parent
        archive = os.path.join(tempfile.mkdtemp(prefix="riskflow-py-"), "riskflow-package.zip")  # on the driver; Spark serves it
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(base.rglob("*.py")):
                z.write(f, f"riskflow/{f.relative_to(base)}")
        sc.addPyFile(archive)
        sc._riskflow_shipped = archive
    return df


def fold(col: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit(""))), F.lit(mod))


def join_apart(rows: DataFrame, groups: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups``, which has one row for each ``key`` (an aggregation over it).

    Joined on the key itself, the aggregation and the join would share a shuffle, and then adaptive execution cannot
    split a key that holds very many of the rows. Joined on an expression of the key, both sides are shuffled for the
    join, and it can.
    """
    apart = F.bitwise_not if rows.schema[key].dataType.typeName() == "long" else F.hex
    other = groups.withColumnRenamed(key, "_apart")
    return rows.join(other, apart(rows[key]) == apart(other["_apart"]), how).drop("_apart")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have: ``name``, with as many underscores behind as it takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, rows: int = 64):
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_rows(df: DataFrame, per_batch, schema: str, rows: int = 64) -> DataFrame:
    """``per_batch(dict of column lists) -> dict of column lists``, applied to slices (of ``rows`` rows) of Arrow batches.

    ``per_batch`` may be a factory marked with ``.per_task = True``: it is then called once per task to build
    its state (a tokenizer, a table) and returns the function to apply.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(schema), error_on_duplicated_field_names_in_struct=True)

    def run(batches):
        f = per_batch() if getattr(per_batch, "per_task", False) else per_batch
        for batch in batches:
            for part in slices(batch, rows):
                found = f({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(found[x.name], type=x.type) for x in out_schema], schema=out_schema)

    return shipped(df).mapInArrow(run, schema)
