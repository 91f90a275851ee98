"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinio.session import scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: cuts the lineage, is
    computed once, and survives the loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path  # for ``discard``
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialised tables that no later step reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` agrees on pure ASCII texts and is much faster there."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, ASCII_UPPER, ASCII_LOWER))


def crc_mod(id_col: str, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % m


def local_stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the edges ``a[i] - b[i]``."""
    root = np.arange(n)
    while len(a):
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if np.array_equal(before, root):
            break
    return root
