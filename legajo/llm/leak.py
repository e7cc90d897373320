"""Problem 7: evaluation passages in training text.

Template canonicalisation: numbers, names and units become typed placeholders, windows of the resulting template are joined
by hash, and the values in the placeholders' places (slots) are compared. Equal slots are a verbatim passage: these windows are
joined by the digest of their slots too, so that a common template makes no large group. Slots that differ by one consistent
substitution are a re-parameterised passage; there names of any number of words are one placeholder.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legajo.llm import fold

WINDOW = 15
#: Window hashes of the evaluation set that a task may hold; a larger set is tested by a bit table of fixed size first.
MAX_HASHES = 1 << 22
FILTER_BITS = 1 << 27
#: Words of a re-parameterised window that are no placeholders, at least; numbers and names alone make no question.
LEAST_LITERAL = 5
#: Characters of evaluation texts that are looked for in one pass over the documents.
BLOCK_CHARS = 1 << 24

# Words that measure or count something, in the languages of the corpus.
UNITS = set(
    "cuota cuotas unidad unidades peso pesos dia dias mes meses ano anos hora horas metro metros km kilometro kilometros hectarea hectareas "
    "uf utm foja fojas litro litros kilo kilos kg dolares euros por ciento units days months years hours pesos dias reais quotas unidades".split()
)
_OTHER, _NUM, _UNIT, _NAME = 0, 1, 2, 3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SENTENCE = re.compile(r"[.!?:;\n]\s*")


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word) | 8  # never one of the placeholder codes


class Names:
    """The words of evaluation texts that are names: written large inside a sentence and never small, in any of the texts."""

    def __init__(self) -> None:
        self.large: set[str] = set()
        self.small: set[str] = set()
        self.every: set[str] = set()

    def add(self, text: str) -> None:
        for sentence in _SENTENCE.split(text):
            for k, w in enumerate(fold.words(sentence, lower=False)):
                if w[:1].islower():
                    self.small.add(w.lower())
                elif k and w[:1].isupper():
                    self.large.add(w.lower())
        self.every.update(fold.words(text))

    def told(self) -> tuple[set[str], set[str]]:
        """(names, other words)."""
        names = self.large - self.small
        return names, self.every - names


def names_of(texts: list[str]) -> tuple[set[str], set[str]]:
    """(names, other words) of evaluation texts."""
    found = Names()
    for text in texts:
        found.add(text)
    return found.told()


class _Codes(dict):
    """Word as written (without accents) -> code of its template; equal words have equal codes in any case."""

    def __init__(self, names: set[str], others: set[str]):
        super().__init__()
        self.names, self.others = names, others

    def __missing__(self, word: str) -> int:
        low = word.lower()
        if any(c.isdigit() for c in low):
            code = _NUM
        elif low in UNITS:
            code = _UNIT
        elif low in self.names:
            code = _NAME
        elif low in self.others:
            code = _hash(low)
        else:
            code = _NAME if word[:1].isupper() else _OTHER
        if len(self) > 500_000:
            self.clear()
        self[word] = code
        return code


def window_hashes(codes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """A 64-bit hash for each window of codes, by doubling: a block of 2k words is two blocks of k."""
    n = len(codes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        block, size, power = codes * np.uint64(0xC2B2AE3D27D4EB4F) ^ (codes >> np.uint64(29)), 1, _BASE
        out, done = np.zeros(n, np.uint64), 0
        rest = window
        while rest:
            if rest & 1:
                out = out * power + block[done : done + n]
                done += size
            rest >>= 1
            if rest:
                block = block[:-size] * power + block[size:]
                power = power * power
                size *= 2
        return out ^ (out >> np.uint64(31))


_SCHEMA = "i bigint, hash bigint, at int, slots array<string>, digest bigint"
_ARROW = pa.schema([("i", pa.int64()), ("hash", pa.int64()), ("at", pa.int32()), ("slots", pa.list_(pa.string())), ("digest", pa.int64())])


def _collapsed(words: list[str], codes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The same with each run of names as one."""
    name = codes == _NAME
    first = ~name | ~np.r_[False, name[:-1]]
    if first.all():
        return words, codes
    at = np.nonzero(first)[0]
    ends = np.r_[at[1:], len(words)]
    return [words[a] if b == a + 1 else " ".join(words[a:b]) for a, b in zip(at.tolist(), ends.tolist())], codes[at]


def _rows(ids: list, texts: list[str | None], codes: _Codes, window: int, keep, exact: bool = True) -> pa.RecordBatch:
    """The windows of a batch of texts whose hash ``keep`` accepts, hashed all at once.

    ``exact``: windows of words, with the digest of their slots. Else windows of the template, with the slots, of which
    LEAST_LITERAL words at least are no placeholders.
    """
    get = codes.__getitem__
    where, words, arrays = [], [], []
    for i, text in zip(ids, texts):
        if not text or i is None:
            continue
        found = fold.words(text, lower=False)
        if len(found) >= window:
            coded = np.fromiter(map(get, found), dtype=np.uint64, count=len(found))
            if not exact:
                found, coded = _collapsed(found, coded)
            where.append(i)
            words.append(found)
            arrays.append(coded)
    out: tuple[list, ...] = ([], [], [], [], [])
    if arrays:
        every = np.concatenate(arrays)
        starts = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
        hashes = window_hashes(every, window)
        # No window may reach over the end of its text, or hold a word of no code.
        bad = np.concatenate([[0], np.cumsum(every == _OTHER)])
        n = len(hashes)
        ok = (bad[window : window + n] == bad[:n]) if n else np.zeros(0, bool)
        if not exact and n:
            literal = np.concatenate([[0], np.cumsum(every > _NAME)])
            ok &= literal[window : window + n] - literal[:n] >= min(LEAST_LITERAL, window)
        doc = np.searchsorted(starts, np.arange(n), side="right") - 1
        ok &= np.arange(n) + window <= starts[doc + 1]
        at = np.nonzero(ok)[0]
        at = at[keep(hashes[at])]
        for p in at.tolist():
            d = int(doc[p])
            k = p - int(starts[d])
            slots = [words[d][k + j].lower() for j in np.nonzero(arrays[d][k : k + window] <= _NAME)[0].tolist()]
            out[0].append(where[d])
            out[1].append(int(hashes[p].astype(np.int64)))
            out[2].append(k)
            out[3].append(None if exact else slots)
            out[4].append(xxhash.xxh3_64_intdigest("\n".join(slots)) - (1 << 63) if exact else None)
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _ARROW)], schema=_ARROW)


def _filter(hashes: np.ndarray):
    """What a task needs to drop windows that no evaluation text has: the hashes, or a bit table of fixed size."""
    if len(hashes) <= MAX_HASHES:
        table = np.unique(hashes)

        def exact(h: np.ndarray) -> np.ndarray:
            if not len(table):
                return np.zeros(len(h), bool)
            return table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h

        return exact
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    at = hashes % np.uint64(FILTER_BITS)
    np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def maybe(h: np.ndarray) -> np.ndarray:
        a = h % np.uint64(FILTER_BITS)
        return (bits[(a >> np.uint64(3)).astype(np.int64)] >> (a & np.uint64(7)).astype(np.uint8)) & 1 == 1

    return maybe


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The evaluation texts in blocks of at most BLOCK_CHARS characters (or one text)."""
    rows: list[tuple[int, str]] = []
    size = 0
    for i, text in items.select(F.col(item_col).cast("bigint"), text_col).toLocalIterator():
        if i is None or not text:
            continue
        if rows and size + len(text) > BLOCK_CHARS:
            yield rows
            rows, size = [], 0
        rows.append((i, text))
        size += len(text)
    yield rows


def _named(items: DataFrame, item_col: str, text_col: str) -> tuple[set[str], set[str]]:
    """Names and other words of the whole evaluation set, whatever blocks it is read in; the driver holds its vocabulary."""
    found = Names()
    for rows in _blocks(items, item_col, text_col):
        for _, text in rows:
            found.add(text)
    return found.told()


def leaks(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, exact_only: bool = False) -> DataFrame:
    """(doc, item, kind, windows): documents that share template windows with evaluation items.

    ``kind`` is ``verbatim`` (slots equal), ``reparameterised`` (slots differ by a one-to-one substitution) or ``template``
    (slots contradict each other); ``windows`` counts the windows of that kind. The evaluation items are a stated query set:
    the driver reads them in blocks of a fixed size, each of which goes to the tasks. Windows of documents leave a task only
    where some item has them. Null and short texts and null ids have no windows, repeated rows of an id count together, empty
    tables give none. With ``exact_only`` just the verbatim windows are looked for.
    """
    told = _named(items, item_col, text_col)
    parts = []
    for rows in _blocks(items, item_col, text_col):
        parts.append(_leaks(docs, rows, told, doc_col, item_col, text_col, window, True))
        if not exact_only:
            parts.append(_leaks(docs, rows, told, doc_col, item_col, text_col, window, False))
    return reduce(DataFrame.unionByName, parts)


def _leaks(docs: DataFrame, rows: list[tuple[int, str]], told: tuple[set[str], set[str]], doc_col: str, item_col: str, text_col: str, window: int, exact: bool) -> DataFrame:
    names, others = told
    mine = _rows([i for i, _ in rows], [t for _, t in rows], _Codes(names, others), window, lambda h: np.ones(len(h), bool), exact)
    keep = _filter(mine.column("hash").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
    spark = docs.sparkSession
    columns = ["item", "hash", "item_at", "item_slots", "item_digest"]
    asked = spark.createDataFrame(pa.Table.from_batches([mine]).rename_columns(columns)) if mine.num_rows else spark.createDataFrame([], "item bigint, hash bigint, item_at int, item_slots array<string>, item_digest bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes(names, others)
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                yield _rows(part.column("i").to_pylist(), part.column("t").to_pylist(), codes, window, keep, exact)

    found = docs.select(F.col(doc_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).mapInArrow(run, _SCHEMA)
    if exact:
        both = found.join(asked.select("item", "hash", F.col("item_digest").alias("digest")), ["hash", "digest"]).withColumn("kind", F.lit("verbatim"))
    else:
        both = found.join(asked, "hash").filter(F.col("slots") != F.col("item_slots"))
        pairs = F.array_distinct(F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
        one_to_one = (F.size(pairs) == F.size(F.array_distinct("item_slots"))) & (F.size(pairs) == F.size(F.array_distinct("slots")))
        both = both.withColumn("kind", F.when(one_to_one, "reparameterised").otherwise("template"))
    return both.select(F.col("i").alias(doc_col), F.col("item").alias(item_col), "kind", "at").groupBy(doc_col, item_col, "kind").agg(F.count_distinct("at").alias("windows"))


def verbatim(found: DataFrame, doc_col: str = "doc_id", item_col: str = "item_id") -> DataFrame:
    """The pairs that share at least one window word by word."""
    return found.filter("kind = 'verbatim'").select(doc_col, item_col).distinct()
