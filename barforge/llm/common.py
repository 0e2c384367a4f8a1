"""Helpers shared by the operators: scratch tables, file access, text rules."""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else (``lower`` would fold all of Unicode)."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder, on any store that Arrow knows."""
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def id_cuts(df: DataFrame, key: str, shards: int) -> list[int]:
    """Range cuts for a bigint key: the same for the same rows, in any order.

    The keys with the 32 x ``shards`` smallest hashes are a random but fixed sample;
    its quantiles are the cuts. Only the balance of the shards depends on it.
    """
    if shards < 2:
        return []
    rows = (df.select(key).where(F.col(key).isNotNull()).distinct()
            .orderBy(F.xxhash64(key), key).limit(32 * shards).collect())
    sample = sorted(r[0] for r in rows)
    return sorted({sample[i * len(sample) // shards] for i in range(1, shards)}) if sample else []


def shard_of(cuts: list[int], key: str) -> Column:
    """Index of the range that a bigint key falls in; null keys go to range 0."""
    edges = np.array(cuts, dtype=np.int64)

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, keys.to_numpy(), side="right").astype(np.int32))

    return F.when(F.col(key).isNotNull(), shard(F.coalesce(key, F.lit(0).cast("bigint")))).otherwise(0)
