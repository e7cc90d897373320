"""Statutes' recursive markup as text, and the recursive splitter of an index."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions.scalars import LINK, NOTE, SPAN, TAG
from legajo.operators.nested import _held, parse

_SPAN, _NOTE, _LINK = (re.compile(x, re.A) for x in (SPAN, NOTE, LINK))
_TAG = re.compile(TAG.replace("$", r"\Z"))
_SPACE = "\t\n\v\f\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"


def merged(nodes: object) -> str:
    """The markup of a node list in document order, without spans, notes and link tags; each level is trimmed by itself.

    Anything but a list gives '', null elements and nodes without text or children are passed over. Any depth is read.
    """
    if not isinstance(nodes, list):
        return ""
    open_lists: list[tuple[Iterator, list[str]]] = [(iter(nodes), [])]
    while True:
        rest, parts = open_lists[-1]
        inner = None
        for node in rest:
            if not isinstance(node, dict):
                continue
            t = node.get("t")
            if isinstance(t, str) and t:
                parts.append(_LINK.sub(r"\1", _NOTE.sub("", _SPAN.sub("", t))))
            if isinstance(node.get("h"), list):
                inner = node["h"]
                break
        if inner is not None:
            open_lists.append((iter(inner), []))
            continue
        open_lists.pop()
        text = "".join([p + "\n" for p in parts]).strip(_SPACE)
        if not open_lists:
            return text
        open_lists[-1][1].append(text)


def plain_text(markup: str | None) -> str:
    """Tags go first, then white space at the ends, then entities are decoded; what they decode to stays as it is."""
    return html.unescape(_TAG.sub("", markup).strip(_SPACE)) if markup else ""


def _statute(col: pd.Series) -> pd.DataFrame:
    markup = [merged(_held(parse(x))) if x is not None else "" for x in col]
    return pd.DataFrame({"markup": markup, "text": [plain_text(m) for m in markup]})


def statute_text(x: Column) -> Column:
    """struct(markup, text) of the JSON of a statute's nodes; '' for null and malformed JSON."""
    return F.pandas_udf(_statute, "struct<markup:string,text:string>")(x)


# --- recursive splitter --------------------------------------------------------------------------------------------------

SEPARATORS = ("\n\n", "\n", " ", "")


def _units(text: str) -> int:
    return len(text) + sum(c > "￿" for c in text) if not text.isascii() else len(text)


def _cut(text: str, separators: tuple[str, ...]) -> tuple[list[str], tuple[str, ...]]:
    """The text at its coarsest separator, which begins the following piece; what separators are left for longer pieces."""
    for k, sep in enumerate(separators):
        if sep == "":
            return list(text), ()
        if sep in text:
            first, *rest = text.split(sep)
            return [p for p in [first, *(sep + r for r in rest)] if p], separators[k + 1 :]
    return [text], ()


def recursive_chunks(text: str | None, size: int = 800, overlap: int = 80, separators: tuple[str, ...] = SEPARATORS) -> list[str]:
    """Chunks of at most ``size`` UTF-16 units; neighbours share up to ``overlap`` units. Chunks are trimmed, empty ones dropped."""
    if not text:
        return []
    pieces, finer = _cut(text, separators)
    out: list[str] = []
    held: list[tuple[str, int]] = []
    total = 0

    def emit() -> None:
        chunk = "".join(p for p, _ in held).strip(_SPACE)
        if chunk:
            out.append(chunk)

    for piece in pieces:
        n = _units(piece)
        if n > size:
            if held:
                emit()
                held, total = [], 0
            out += recursive_chunks(piece, size, overlap, finer)
            continue
        if held and total + n > size:
            emit()
            while held and (total > overlap or total + n > size):
                total -= held.pop(0)[1]
        held.append((piece, n))
        total += n
    if held:
        emit()
    return out


def chunked(df: DataFrame, text_col: str, size: int = 800, overlap: int = 80) -> DataFrame:
    """df without its text, with chunk_index, total_chunks and chunk; blank and null texts have no chunks."""

    @F.pandas_udf("array<string>")
    def cut(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda t: recursive_chunks(t, size, overlap))

    split = df.withColumn("_chunks", cut(F.col(text_col)))
    return split.select(*(c for c in df.columns if c != text_col), F.size("_chunks").alias("total_chunks"), F.posexplode("_chunks").alias("chunk_index", "chunk"))
