"""Helpers shared by the operators: table reading, fresh column names, cuts."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duetto.session import Tables, cut_lineage, ensure_checkpoint_dir

__all__ = ["Tables", "cut", "ensure_checkpoint_dir", "fold_of", "fresh", "per_process", "repeated", "table"]

#: One document in ``FOLDS`` is held out of every fit.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a test folder; only Spark's reader touches it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    return cut_lineage(df)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, k = f"_{stem}", 0
    while name.lower() in taken:
        k += 1
        name = f"_{stem}{k}"
    return name


def fold_of(doc_id: Column) -> Column:
    """Whether a row is held out: crc32 of the id as text mod 5 is 0.

    A null id has no remainder; such a row counts as held out, so that nothing
    is ever learned from it.
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def repeated(df: DataFrame, count: str) -> DataFrame:
    """Every row as often as its column ``count`` says, without that column.

    The numbers of copies are made in two steps, so that none is one long array.
    """
    n, part = F.col(count), 1 << 16
    block = fresh(df, "block")
    room = F.least(n - F.col(block) * part, F.lit(part).cast("bigint"))
    copy = fresh(df, "copy")
    return (df.filter(n > 0)
            .withColumn(block, F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(`{count}` - 1) div {part}"))))
            .withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), room)))
            .drop(count, block, copy))


def per_process(key: str, build: Callable[[], object]) -> object:
    """What ``build`` returns, made once in a process: later tasks of the same
    worker find it again, although their functions come anew with each task."""
    kept = vars(sys.modules.setdefault("_duetto_kept", types.ModuleType("_duetto_kept")))
    if key not in kept:
        kept[key] = build()
    return kept[key]
