"""Problem 8: visually identical text with different characters."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legajo.llm import fold
from legajo.session import materialise, shared_folder


def _texts(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(name).to_pylist()


def normalise(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text in its canonical form, with what was found in its tokens.

    Returns (id_col, canonical, changed, mixed_tokens, whole_tokens). Null texts stay null and count as unchanged; empty
    texts stay empty. Other columns are ignored, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, changed, mixed, whole = [], [], [], []
            for text in _texts(batch, "t"):
                kinds: Counter[str] = Counter()
                if text is not None and fold.ODD.search(text):
                    form = fold.canonical(text)
                    bare = fold.unicodedata.normalize("NFD", text.translate(fold.FORMS))
                    kinds.update(fold.resolve(t)[1] for t in fold._TOKEN.findall(bare) if fold._FOREIGN.search(t))
                else:
                    form = text
                out.append(form)
                changed.append(form != text)
                mixed.append(kinds["mixed"])
                whole.append(kinds["whole"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(out, pa.string()), pa.array(changed, pa.bool_()), pa.array(mixed, pa.int32()), pa.array(whole, pa.int32())],
                ["i", "canonical", "changed", "mixed_tokens", "whole_tokens"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    return (
        df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
        .mapInArrow(run, f"i {kind}, canonical string, changed boolean, mixed_tokens int, whole_tokens int")
        .withColumnRenamed("i", id_col)
    )


def looks(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(i, look, chars): 128-bit digests of each non-blank text's canonical form and of its characters.

    Only digests leave the tasks, so what is shuffled doesn't grow with the length of the texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, look, chars = [], [], []
            for i, text in zip(batch.column("i").to_pylist(), _texts(batch, "t")):
                if text is None or not text.strip() or i is None:
                    continue
                form = fold.canonical(text)
                raw = xxhash.xxh3_128_digest(text.encode("utf-8", "surrogatepass"))
                ids.append(i)
                chars.append(raw)
                look.append(raw if form == text else xxhash.xxh3_128_digest(form.encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(look, pa.binary()), pa.array(chars, pa.binary())], ["i", "look", "chars"])

    return df.select(F.col(id_col).cast("bigint").alias("i"), F.col(text_col).alias("t")).mapInArrow(run, "i bigint, look binary, chars binary")


def variants(found: DataFrame) -> DataFrame:
    """One row for each distinct spelling of a look that has several: look, chars, the first document and the second (or null)."""
    spelled = found.groupBy("look", "chars").agg(F.min("i").alias("first"))
    # Not a window over the look: a look has few spellings, but a hot one must not gather its rows in a task.
    several = spelled.groupBy("look").agg(F.count("*").alias("n")).filter("n > 1").select("look")
    spelled = spelled.join(several, "look", "left_semi")
    later = found.join(spelled, ["look", "chars"]).filter("i > first").groupBy("look", "chars").agg(F.min("i").alias("second"))
    return spelled.join(later, ["look", "chars"], "left")


def look_alikes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pairs (doc_a < doc_b) of non-blank texts that look the same but aren't the same characters.

    Each document is paired with the first two documents of every other spelling of its look, so that no link between different
    texts is lost and exact copies grow the result only in proportion; :func:`classes` has one row for each document instead.
    Null and blank texts and null ids have no pairs, repeated rows of one id with one text count once, an empty table gives
    none.
    """
    # The digests are used several times; written out, they are made once.
    found = materialise(looks(df, id_col, text_col), shared_folder(df.sparkSession), "looks")
    kinds = variants(found)
    other = kinds.select("look", F.col("chars").alias("other_chars"), F.explode(F.array_compact(F.array("first", "second"))).alias("j"))
    return (
        found.join(other, "look")
        .filter((F.col("chars") != F.col("other_chars")) & (F.col("i") != F.col("j")))
        .select(F.least("i", "j").alias("doc_a"), F.greatest("i", "j").alias("doc_b"))
        .distinct()
    )


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, look_id, spelling_id) of each non-blank text: the first document of its look, and of its look and characters.

    One row for each document, however many spellings a look has. Null ids and blank texts have no row.
    """
    found = materialise(looks(df, id_col, text_col), shared_folder(df.sparkSession), "looks")
    spelled = found.groupBy("look", "chars").agg(F.min("i").alias("spelling_id"))
    named = spelled.join(spelled.groupBy("look").agg(F.min("spelling_id").alias("look_id")), "look")
    return found.join(named, ["look", "chars"]).select(F.col("i").alias(id_col), "look_id", "spelling_id").distinct()
