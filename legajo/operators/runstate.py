"""Running state over an ordered log: error budgets, page cut-offs, counters.

A window over the whole log would put it into one task. The range of the order column is cut into chunks of equal width, about as
many as it has rows by ``CHUNK``, however sparse its values are; only one summary row for each chunk goes through a window over
all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1 << 16


def _chunked(df: DataFrame, order: str, chunk: int) -> DataFrame:
    """df with the number of each row's chunk."""
    lo, hi, n = df.agg(F.min(order), F.max(order), F.count("*")).first()
    wide = max(1, -(-(int(hi) - int(lo) + 1) // max(1, -(-n // chunk)))) if lo is not None else 1
    away = F.col(order).cast("decimal(20,0)") - F.lit(int(lo or 0)).cast("decimal(20,0)")  # the range may be wider than a bigint
    return df.withColumn("_chunk", F.floor(away / F.lit(wide).cast("decimal(20,0)")).cast("bigint"))


def ranked(df: DataFrame, order: str, chunk: int = CHUNK) -> DataFrame:
    """df with ``rn``: 1, 2, ... in the order of an integer column without ties."""
    rows = _chunked(df, order, chunk)
    sizes = rows.groupBy("_chunk").agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))).select("_chunk", F.coalesce("_before", F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_chunk").orderBy(order))
    return rows.join(before, "_chunk").withColumn("rn", F.col("_before") + own).drop("_chunk", "_before")


def batched(df: DataFrame, order: str, size: int, chunk: int = CHUNK) -> DataFrame:
    """df with ``batch_no``: 0, 1, ... for each ``size`` rows in the order of an integer column without ties."""
    return ranked(df, order, chunk).withColumn("batch_no", F.floor((F.col("rn") - 1) / size)).drop("rn")


def failures(df: DataFrame, order: str, failed: Column, chunk: int = CHUNK) -> DataFrame:
    """df with ``run``: how many rows up to this one failed in a row; 0 after a success."""
    rows = _chunked(df.withColumn("_f", failed.cast("int")), order, chunk)
    in_chunk = Window.partitionBy("_chunk").orderBy(order)
    rows = rows.withColumn("_last", F.max(F.when(F.col("_f") == 0, F.col(order))).over(in_chunk))
    rows = rows.withColumn("_run", F.sum("_f").over(Window.partitionBy("_chunk", "_last").orderBy(order)))
    # What a chunk hands on: the failures after its last success, with those before it if it has none.
    ends = rows.groupBy("_chunk").agg(F.max_by("_run", order).alias("_tail"), F.max("_last").isNotNull().alias("_ok"))
    all_chunks = Window.orderBy("_chunk")
    ends = ends.withColumn("_grp", F.sum(F.col("_ok").cast("int")).over(all_chunks))
    ends = ends.withColumn("_out", F.sum("_tail").over(Window.partitionBy("_grp").orderBy("_chunk")))
    ends = ends.select("_chunk", F.coalesce(F.lag("_out").over(all_chunks), F.lit(0)).alias("_in"))
    out = rows.join(ends, "_chunk").withColumn("run", F.when(F.col("_last").isNull(), F.col("_run") + F.col("_in")).otherwise(F.col("_run")))
    return out.drop("_f", "_chunk", "_last", "_run", "_in")


def stop_page(df: DataFrame, order: str, failed: Column, page: int = 50, budget: int = 10) -> DataFrame:
    """(page_no, run) of pages at whose end the budget of failures in a row is spent; the first is where a crawl stops."""
    rows = ranked(failures(df, order, failed), order)
    paged = rows.withColumn("page_no", F.floor((F.col("rn") - 1) / page))
    return paged.groupBy("page_no").agg(F.max_by("run", "rn").alias("run")).filter(F.col("run") >= budget)
