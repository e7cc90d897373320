"""Problem 3: splitting oversized texts at natural boundaries.

Balanced targets: the least number of pieces that limit and overlap allow is computed, as many targets are placed at equal
distances, each is moved to the strongest boundary nearby, and a piece is added as long as any exceeds the limit. Lengths are
UTF-16 units; positions that come out are code points.
"""

from __future__ import annotations

import bisect
import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 800, 80
#: From the strongest boundary to the weakest: paragraph, line, sentence, clause, word.
BOUNDARIES = tuple(
    (name, re.compile(rx))
    for name, rx in (
        ("paragraph", r"(?:\r\n?|\n)[ \t]*(?:\r\n?|\n)\s*"),
        ("line", r"(?:\r\n?|\n|\u2028|\u2029)[ \t]*"),
        ("sentence", r"[.!?…][\"'»”)\]]*\s+"),
        ("clause", r"[;:,][\"'»”)\]]*\s+"),
        ("word", r"[\s\ufeff]+"),
    )
)
_SOLID = re.compile(r"[^\s\ufeff]+")
_JOINED = re.compile("[\\u0300-\\u036f\\u200d\\ufe0e\\ufe0f\\u1ab0-\\u1aff\\u20d0-\\u20ff]")


class _Units:
    """UTF-16 lengths of slices of a text; the identity where it has no character beyond the basic plane."""

    def __init__(self, text: str):
        self.wide = [] if text.isascii() or max(text) <= "￿" else [k for k, c in enumerate(text) if c > "￿"]
        self.total = len(text) + len(self.wide)

    def at(self, k: int) -> int:
        """Units before code point ``k``."""
        return k + bisect.bisect_left(self.wide, k) if self.wide else k

    def back(self, u: int) -> int:
        """The last code point that begins at or before unit ``u``."""
        if not self.wide:
            return u
        lo, hi = 0, u
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.at(mid) <= u else (lo, mid - 1)
        return lo


def longest_solid(text: str) -> int:
    """Units of the longest stretch without any whitespace."""
    best = 0
    units = None
    for m in _SOLID.finditer(text):
        n = m.end() - m.start()
        if 2 * n > best:
            units = units or _Units(text)
            best = max(best, units.at(m.end()) - units.at(m.start()))
    return best


def _solid_over(text: str, limit: int) -> bool:
    """Whether a stretch without whitespace has more than ``limit`` units, counted only where some could."""
    return 2 * max(map(len, text.split()), default=0) > limit and longest_solid(text) > limit


def _whole(text: str, at: int, lo: int) -> int:
    """``at`` moved back so that it divides neither a letter from its marks nor a line end."""
    k = at
    while k > lo + 1 and k < len(text) and (_JOINED.match(text[k]) or text[k - 1] == "\u200d" or (text[k - 1] == "\r" and text[k] == "\n") or unicodedata.combining(text[k])):
        k -= 1
    return k if k > lo + 1 else at


def _snap(text: str, lo: int, target: int, hi: int) -> tuple[int, str]:
    """The strongest boundary in (lo, hi], of equal ones the nearest to the target."""
    for name, rx in BOUNDARIES:
        best = -1
        for m in rx.finditer(text, max(0, lo - 1), min(len(text), hi + 8)):
            k = m.end()
            if lo < k <= hi and (best < 0 or abs(k - target) < abs(best - target)):
                best = k
        if best >= 0:
            return best, name
    return _whole(text, max(lo + 1, min(target, hi)), lo), "none"


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, str]]:
    """Pieces (start, own_start, end, boundary): [start, end) in code points, [own_start, end) without the overlap.

    Own parts follow each other and cover the text; with one piece less some limit would fail. A piece repeats up to ``overlap`` units of the one before, from the
    first natural boundary among these. ``boundary`` names where the piece ends; ``none`` is a cut inside a word.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half of the limit")
    if not text:
        return []
    units = _Units(text)
    if units.total <= limit:
        return [(0, 0, len(text), "end")]
    n = max(2, math.ceil((units.total - overlap) / (limit - overlap)))
    # One piece more, two, four ... until no limit fails; then the least number between the last that failed and that one.
    failed, step = n - 1, 1
    while (found := _balanced(text, units, n, limit, overlap)) is None:
        failed, n, step = n, n + step, 2 * step
    while n - failed > 1:
        middle = (failed + n) // 2
        pieces = _balanced(text, units, middle, limit, overlap)
        if pieces is None:
            failed = middle
        else:
            n, found = middle, pieces
    return found


def _balanced(text: str, units: _Units, n: int, limit: int, overlap: int) -> list[tuple[int, int, int, str]] | None:
    share = units.total / n
    reach = max(1, int(min(share / 3, limit / 4)))
    ends: list[tuple[int, str]] = []
    before = 0
    for k in range(1, n):
        target = units.back(round(k * share))
        first = max(before, units.back(max(0, round(k * share) - reach)))
        last = min(units.back(round(k * share) + reach), len(text) - 1)
        # Own part and overlap together must stay under the limit.
        last = min(last, units.back(units.at(before) + limit - (overlap if before else 0)))
        if last <= first:
            return None
        end, kind = _snap(text, first, min(target, last), last)
        ends.append((end, kind))
        before = end
    if units.total - units.at(before) + overlap > limit:
        return None
    ends.append((len(text), "end"))
    out = []
    own = 0
    for end, kind in ends:
        start = own
        if own and overlap:
            low = units.back(max(0, units.at(own) - overlap))
            if units.at(own) - units.at(low) > overlap:
                low += 1
            m = BOUNDARIES[-1][1].search(text, low, own)
            start = m.end() if m and m.end() < own else own if m else _whole(text, low, max(0, low - 2))
            if units.at(own) - units.at(start) > overlap:
                start = own
        out.append((start, own, end, kind))
        own = end
    return out


_PIECES = pa.list_(pa.struct([("piece_no", pa.int32()), ("start_pos", pa.int32()), ("own_start", pa.int32()), ("end_pos", pa.int32()), ("boundary", pa.string())]))


def plan(df: DataFrame, id_cols: list[str], text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(id_cols, unbroken, pieces): where each non-blank text is to be cut.

    Null, empty and blank texts have no row. Texts under the limit have one piece. ``unbroken`` tells that a stretch without
    whitespace exceeds the limit, so that some piece ends inside it. Other columns are ignored.
    """
    names = [f"k{i}" for i in range(len(id_cols))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, solid, out = [], [], []
            for k, text in enumerate(batch.column("t").to_pylist()):
                if text is None or not _SOLID.search(text):
                    continue
                keep.append(k)
                pieces = split(text, limit, overlap)
                solid.append(len(pieces) > 1 and _solid_over(text, limit))
                out.append([{"piece_no": i, "start_pos": p[0], "own_start": p[1], "end_pos": p[2], "boundary": p[3]} for i, p in enumerate(pieces)])
            rows = batch.take(pa.array(keep, pa.int64()))
            cols = [rows.column(n) for n in names] + [pa.array(solid, pa.bool_()), pa.array(out, _PIECES)]
            yield pa.RecordBatch.from_arrays(cols, [*names, "unbroken", "pieces"])

    kinds = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, id_cols))
    schema = f"{kinds}, unbroken boolean, pieces array<struct<piece_no:int,start_pos:int,own_start:int,end_pos:int,boundary:string>>"
    out = df.select(*(F.col(c).alias(n) for n, c in zip(names, id_cols)), F.col(text_col).alias("t")).mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, id_cols)), "unbroken", "pieces")


_PIECE = pa.schema([("k", pa.int32()), ("piece_no", pa.int32()), ("start_pos", pa.int32()), ("own_start", pa.int32()), ("end_pos", pa.int32()), ("boundary", pa.string()), ("piece", pa.string())])
#: Characters of pieces that a batch of results holds about.
FLUSH = 1 << 23


def pieces(df: DataFrame, id_cols: list[str], text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row for each piece: id_cols, piece_no, start_pos, own_start, end_pos, boundary, piece.

    Texts are cut where they are read, so that the work grows with their length. Null, empty and blank texts have no pieces.
    """
    names = [f"k{i}" for i in range(len(id_cols))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _PIECE]
            size = 0

            def done(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                cols = [batch.column(n).take(pa.array(out[0], pa.int32())) for n in names] + [pa.array(x, f.type) for x, f in zip(out[1:], list(_PIECE)[1:])]
                return pa.RecordBatch.from_arrays(cols, [*names, *_PIECE.names[1:]])

            for k, cell in enumerate(batch.column("t")):
                text = cell.as_py()
                if text is None or not _SOLID.search(text):
                    continue
                for no, (start, own, end, kind) in enumerate(split(text, limit, overlap)):
                    for column, x in zip(out, (k, no, start, own, end, kind, text[start:end])):
                        column.append(x)
                    size += end - start
                    if size > FLUSH:
                        yield done()
                        out, size = [[] for _ in _PIECE], 0
            yield done()

    kinds = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, id_cols))
    out = df.select(*(F.col(c).alias(n) for n, c in zip(names, id_cols)), F.col(text_col).alias("t")).mapInArrow(run, f"{kinds}, piece_no int, start_pos int, own_start int, end_pos int, boundary string, piece string")
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, id_cols)), *_PIECE.names[1:])


def needs(planned: DataFrame, id_cols: list[str]) -> DataFrame:
    """``oversize`` for each text that was cut, and a further row ``unbroken`` where no boundary could help."""
    cut = planned.filter(F.size("pieces") > 1)
    kinds = F.when(F.col("unbroken"), F.array(F.lit("oversize"), F.lit("unbroken"))).otherwise(F.array(F.lit("oversize")))
    return cut.select(*id_cols, F.explode(kinds).alias("need"))
