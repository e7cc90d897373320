"""Deduplication by key, and sinks that insert what is absent. Joins are set-based; Spark broadcasts a side only where its size allows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def absent(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key isn't among ``existing``; null keys are always absent."""
    return new.join(existing.select(key).filter(F.col(key).isNotNull()).distinct(), key, "left_anti")


def present(new: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key is among ``existing``; null keys never are."""
    return new.join(existing.select(key).distinct(), key, "left_semi")


def first_arrivals(df: DataFrame, key: str, order: str) -> DataFrame:
    """The earliest row of each key, and all rows without one.

    The row is picked by an aggregate, which combines before the shuffle and never gathers the rows of a hot key.
    """
    first = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first")).select("_first")
    return df.join(first, df[order] == first["_first"], "left_semi").unionByName(df.filter(F.col(key).isNull()))


class Added(int):
    """How many rows were added; ``rejected()`` counts the others that had a null key, ``told`` has further counts of the added."""

    rejected: Callable[[], int]
    told: dict[str, int]


def insert_if_absent(df: DataFrame, path: str, keys: list[str], order: str | None = None, partition: str | None = None, rows_per_file: int = 0, told: dict[str, Column] | None = None) -> Added:
    """Append the rows whose keys a Parquet table lacks; returns how many were added.

    One set-based write takes the place of a check for each row, so that two equal keys of one batch can't both go in: of equal
    keys the row of least ``order`` goes in, without an order any. Rows with a null key could not be told again and are left
    out; the result can count them. ``partition`` lays the table out by a column, ``rows_per_file`` limits its files, ``told``
    names conditions whose rows are counted among the added.
    """
    spark: SparkSession = df.sparkSession
    null = F.greatest(*(F.col(k).isNull().cast("int") for k in keys), F.lit(0)) == 1
    known = df.filter(~null)
    if order:
        rest = [c for c in df.columns if c not in keys]
        first = known.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_first"))
        new = first.select(*(F.col("_first")[c].alias(c) if c in rest else F.col(c) for c in df.columns))
    else:
        new = known.dropDuplicates(keys)
    try:
        new = new.join(spark.read.parquet(path).select(*keys).distinct(), keys, "left_anti").select(*df.columns)
    except AnalysisException as e:  # the table doesn't exist yet
        if "PATH_NOT_FOUND" not in str(e):
            raise
    seen = Observation()  # counted while it is written
    counts = [F.count(F.lit(1)).alias("n"), *(F.count_if(c).alias(f"n_{n}") for n, c in (told or {}).items())]
    writer = new.observe(seen, *counts).write.mode("append").option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(partition) if partition else writer).parquet(path)
    out = Added(seen.get["n"])
    out.rejected = lambda: df.filter(null).count()
    out.told = {n: seen.get[f"n_{n}"] for n in told or {}}
    return out


def keyset_page(df: DataFrame, key: str, after: object, n: int) -> DataFrame:
    """The n rows that follow a key, in its order; ``after`` None gives the first page. Each task keeps n rows."""
    rows = df if after is None else df.filter(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(n)


def add_ids(known: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """The distinct ids of both, as text."""
    text = F.col(key).cast("string").alias(key)
    return known.select(text).unionByName(new.select(text)).filter(F.col(key).isNotNull()).distinct()
