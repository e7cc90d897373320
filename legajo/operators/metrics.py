"""Figures of batches and runs. Only one row for each batch goes through a running total."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legajo.functions.scalars import throughput_class


def clock() -> int:
    """Milliseconds of a clock that only goes on."""
    return time.monotonic_ns() // 1_000_000


def batch_report(batches: DataFrame, batch: str, docs: str, chunks: str, embed_ms: str, total_ms: str, all_batches: Column | None = None) -> DataFrame:
    """(batch, done, chunks_done, batch_rate, overall_rate, chunks_per_doc, embed_ms_per_doc, rest_s) of rows, one a batch.

    Rates are documents a second; ``rest_s`` is what the batches to come take at the mean time of those done. A figure whose
    divisor is zero is null. ``all_batches`` is their number (that of the rows).
    """
    upto = Window.orderBy(batch)
    of = all_batches if all_batches is not None else F.count("*").over(Window.partitionBy())
    rows = batches.select(
        F.col(batch).alias("batch"),
        F.col(docs).alias("docs"),
        F.col(total_ms).alias("ms"),
        F.row_number().over(upto).alias("nth"),
        of.alias("of"),
        *(F.sum(c).over(upto).alias(a) for c, a in ((docs, "done"), (chunks, "chunks_done"), (embed_ms, "embed"), (total_ms, "time"))),
    )
    per = lambda a, b, digits=4: F.round(F.try_divide(a, b), digits)
    return rows.select(
        "batch",
        "done",
        "chunks_done",
        per(F.col("docs"), F.col("ms") / 1000.0).alias("batch_rate"),
        per(F.col("done"), F.col("time") / 1000.0).alias("overall_rate"),
        per(F.col("chunks_done"), F.col("done")).alias("chunks_per_doc"),
        per(F.col("embed"), F.col("done")).alias("embed_ms_per_doc"),
        F.round((F.col("of") - F.col("nth")) * F.col("time") / F.col("nth") / 1000.0, 4).alias("rest_s"),
    )


def run_report(success: Column, errors: Column, duplicates: Column, seconds: Column, target: Column) -> list[Column]:
    """settled, success_rate (per cent), docs_per_min, class, and hours that ``target`` documents take at that rate."""
    every = success + errors + duplicates
    rate = F.try_divide(every * 60.0, seconds)
    return [every.alias("settled"), F.round(F.try_divide(success * 100.0, every), 4).alias("success_rate"), F.round(rate, 4).alias("docs_per_min"), throughput_class(rate).alias("class"), F.round(F.try_divide(target, rate * 60.0), 4).alias("hours")]
