"""Problem 6: filling fixed-capacity containers with texts.

Cost-balanced packing: a text of n tokens costs ``LINEAR * n + QUADRATIC * n * n`` (its share of a sequence's attention).
Texts are taken in descending order and each goes to the container of least cost that has room for it.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITY = 4096
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
#: Pieces of one packing task. Each task packs alone and leaves at most a few containers less full.
SHARD_ROWS = 50_000


def byte_tokens(text: Column) -> Column:
    """Tokens of the public ByT5 tokenizer: one for each UTF-8 byte and one end token."""
    return F.octet_length(text) + F.lit(1)


class _Room:
    """The open containers by remaining room: the cheapest with at least so much room, in log2(capacity) steps."""

    def __init__(self, capacity: int):
        self.size = 1 << max(1, capacity.bit_length())
        self.best = [math.inf] * (2 * self.size)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.size)]

    def _set(self, room: int) -> None:
        k = room + self.size
        best, heap = self.best, self.heaps[room]
        best[k] = heap[0][0] if heap else math.inf
        k >>= 1
        while k:
            a, b = best[2 * k], best[2 * k + 1]
            best[k] = a if a < b else b
            k >>= 1

    def put(self, room: int, cost: float, container: int) -> None:
        if room > 0:
            heapq.heappush(self.heaps[room], (cost, container))
            self._set(room)

    def take(self, need: int) -> tuple[int, float, int] | None:
        """The cheapest container with room for ``need``: its room, cost and number."""
        best, size = self.best, self.size
        lo, hi, pick, least = need + size, 2 * size, 0, math.inf
        while lo < hi:
            if lo & 1:
                if best[lo] < least:
                    pick, least = lo, best[lo]
                lo += 1
            if hi & 1:
                hi -= 1
                if best[hi] < least:
                    pick, least = hi, best[hi]
            lo >>= 1
            hi >>= 1
        if not pick:
            return None
        while pick < size:
            pick = 2 * pick if best[2 * pick] == least else 2 * pick + 1
        room = pick - size
        cost, container = heapq.heappop(self.heaps[room])
        self._set(room)
        return room, cost, container


def assign(sizes: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC) -> np.ndarray:
    """The container (0, 1, ...) of each size; no size may exceed the capacity.

    As many containers as the sum of sizes needs at least are open from the start; another one is opened where none has
    room. Ties are settled by position.
    """
    out = np.zeros(len(sizes), dtype=np.int64)
    if not len(sizes):
        return out
    if int(sizes.max()) > capacity:
        raise ValueError("a size exceeds the capacity")
    room = _Room(capacity)
    opened = math.ceil(int(sizes.sum()) / capacity)
    for k in range(opened):
        room.heaps[capacity].append((0.0, k))
    room._set(capacity)
    for at in np.argsort(-sizes, kind="stable").tolist():
        need = int(sizes[at])
        found = room.take(need)
        if found is None:
            found = (capacity, 0.0, opened)
            opened += 1
        left, cost, container = found
        out[at] = container
        room.put(left - need, cost + linear * need + quadratic * need * need, container)
    return out


def parts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces to pack: (id, part_no, start_byte, end_byte, tokens); only texts beyond the capacity have several.

    A cut never falls inside a character: it is moved back to the character's first byte, for which each nominal piece is
    three bytes shorter than a container.
    """
    step = capacity - 4
    raw = F.encode(F.col("t"), "UTF-8")

    def aligned(k: Column) -> Column:
        at = k * F.lit(step)
        inner = lambda p: F.hex(F.substring(F.col("raw"), p + 1, F.lit(1))).between("80", "BF")
        return F.when(~inner(at), at).when(~inner(at - 1), at - 1).when(~inner(at - 2), at - 2).otherwise(at - 3)

    base = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).filter("t is not null").withColumn("bytes", F.octet_length("t").cast("bigint"))
    n = F.when(F.col("bytes") + 1 <= capacity, F.lit(1)).otherwise(F.ceil((F.col("bytes")) / F.lit(step))).cast("int")
    cut = base.select("i", "bytes", n.alias("n"), F.when(F.col("bytes") + 1 > capacity, raw).alias("raw"))
    edges = F.when(F.col("n") == 1, F.array(F.lit(0).cast("bigint"), F.col("bytes"))).otherwise(
        F.concat(F.array(F.lit(0).cast("bigint")), F.transform(F.sequence(F.lit(1), F.col("n") - 1), lambda k: aligned(k.cast("int")).cast("bigint")), F.array(F.col("bytes")))
    )
    each = cut.select("i", "n", edges.alias("e")).select("i", F.explode(F.transform(F.sequence(F.lit(1), "n"), lambda k: F.struct((k - 1).alias("part_no"), F.element_at("e", k).alias("start_byte"), F.element_at("e", k + 1).alias("end_byte")))).alias("p"))
    return each.select(F.col("i").alias(id_col), "p.*", (F.col("p.end_byte") - F.col("p.start_byte") + 1).cast("int").alias("tokens"))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Assign every text to a container: (id, part_no, start_byte, end_byte, tokens, container_id).

    Only ids and sizes are shuffled, never texts. Texts are spread over as many shards as ``shard_rows`` asks for, by a hash
    of their id and part, and each shard packs by itself, so a task holds about ``shard_rows`` sizes. Null texts have no row,
    an empty text takes its end token, repeated rows are packed each for itself.
    """
    bytes_ = F.octet_length(text_col)
    count = F.when(bytes_ + 1 <= capacity, F.lit(1)).otherwise(F.ceil(bytes_ / F.lit(capacity - 4)))
    shards = max(1, math.ceil((df.agg(F.sum(count)).first()[0] or 0) / shard_rows))
    pieces = parts(df, id_col, text_col, capacity)
    kind = df.schema[id_col].dataType.simpleString()

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["i", "part_no"], kind="stable").reset_index(drop=True)
        pdf["container_id"] = (int(key[0]) << 32) + assign(pdf["tokens"].to_numpy(), capacity)
        return pdf.drop(columns="shard")

    return (
        pieces.withColumnRenamed(id_col, "i")
        .withColumn("shard", F.pmod(F.xxhash64("i", "part_no"), F.lit(shards)).cast("int"))
        .repartition(min(shards, 4096), "shard")  # packing is work for the CPU; small shuffles must not be merged into one task
        .groupBy("shard")
        .applyInPandas(one, f"i {kind}, part_no int, start_byte bigint, end_byte bigint, tokens int, container_id bigint")
        .withColumnRenamed("i", id_col)
    )


def oversized(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents that a packing had to cut."""
    return packed.filter("part_no = 1").select(id_col).distinct()
