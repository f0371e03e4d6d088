"""Helpers shared by the corpus operators: table access, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the corpus contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of a join is broadcast only if its counted rows times a row's bound stay under this many bytes.
BROADCAST_BYTES = 32 << 20

#: A key of more rows than this is hot: a join sends the rows that it meets to every task instead of dealing by the key. A side of up to
#: WHOLE_BYTES is sent whole, without a look at its keys.
HOT_ROWS, WHOLE_BYTES = 200_000, 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, so that the scan reads nothing else."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def ensure_shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or a temporary one where it is unset (tests)."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if not named:
            named = tempfile.mkdtemp(prefix="shared-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared folder: its lineage ends there and survives lost executors."""
    ensure_shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """df with a broadcast hint if rows * row_bytes is under BROADCAST_BYTES; else df, for a shuffled join."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def hot_join(many: DataFrame, one: DataFrame, key: str, weight: str, row_bytes: int, at_most: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of many with one, which has a row a key and in column weight the number of rows of many under that key.

    one is broadcast whole if its rows are few: counted here, unless at_most rows are known to be. Else its hot keys are (there are rows /
    hot_rows of them at most; that is checked too) and the others are shuffled, so that no task gets more than hot_rows rows of one key.
    """
    if at_most is not None and at_most * row_bytes <= WHOLE_BYTES:
        return many.join(F.broadcast(one), key)
    one = cut(one)
    size = one.agg(F.count("*").alias("n"), F.count_if(F.col(weight) > hot_rows).alias("hot")).first()
    if size["n"] * row_bytes <= WHOLE_BYTES:
        return many.join(F.broadcast(one), key)
    if not size["hot"]:
        return many.join(one, key)
    hot = one.where(F.col(weight) > hot_rows)
    met = many.join(small_side(hot.select(key, F.lit(True).alias("is_hot")), size["hot"], row_bytes), key, "left")
    cold = met.where("is_hot is null").drop("is_hot").join(one.where(F.col(weight) <= hot_rows), key)
    warm = met.where("is_hot").drop("is_hot").join(small_side(hot, size["hot"], row_bytes), key)
    return cold.unionByName(warm)


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores in front, so that it clashes with no column of df."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, however often body uses it, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
