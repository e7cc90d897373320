"""The queries of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legajo.llm import history, leak, lookalike, pack, pii, split
from legajo.session import table


def _long_texts(spark: SparkSession, sf: str) -> DataFrame:
    rulings = table(spark, sf, "sentencias").select(F.lit("sentencias").alias("source_table"), "row_id", F.col("texto_sentencia").alias("t"))
    opinions = table(spark, sf, "contraloria").select(F.lit("contraloria").alias("source_table"), "row_id", F.col("documento_completo").alias("t"))
    return rulings.unionByName(opinions)


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    rulings = table(spark, sf, "sentencias")
    return pii.detect(rulings, pii.fit_lexicon(rulings))


def p1_redacted(spark: SparkSession, sf: str) -> DataFrame:
    rulings = table(spark, sf, "sentencias")
    return pii.redact(rulings, pii.fit_lexicon(rulings))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["source_table", "row_id"]
    return split.needs(split.plan(_long_texts(spark, sf), keys, "t"), keys)


def p3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return split.pieces(_long_texts(spark, sf), ["source_table", "row_id"], "t")


def _batches(spark: SparkSession, sf: str) -> DataFrame:
    kinds = (("sentencias", "lote", "row_id", "id", "texto_sentencia"), ("contraloria", "lote", "row_id", "doc_id", "documento_completo"), ("documents", "batch_no", "doc_id", "id", "text"))
    parts = [table(spark, sf, t).select(F.lit(t).alias("source"), F.col(b).alias("batch"), F.col(r).alias("row"), F.col(k).alias("key"), F.col(x).alias("text")) for t, b, r, k, x in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return history.repeats(_batches(spark, sf)).withColumnRenamed("source", "source_table")


def p5_by_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The same by a history that takes the batches in three turns and looks each up in what it has stored."""
    return history.repeats_by_batch(_batches(spark, sf), 3).withColumnRenamed("source", "source_table")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return pack.oversized(pack.pack(table(spark, sf, "documents")))


def p6_assignment(spark: SparkSession, sf: str) -> DataFrame:
    return pack.pack(table(spark, sf, "documents"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leak.verbatim(leak.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"), exact_only=True))


def p7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leak.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.look_alikes(table(spark, sf, "documents"))


def p8_texts(spark: SparkSession, sf: str) -> DataFrame:
    return lookalike.normalise(table(spark, sf, "documents"))


def p8_classes(spark: SparkSession, sf: str) -> DataFrame:
    """The class of each document: the first one that looks like it, and the first one of the same characters."""
    return lookalike.classes(table(spark, sf, "documents"))


def p3_check(spark: SparkSession, sf: str) -> DataFrame:
    """What pieces must be, for each text that isn't blank: they cover it, stay under the limit, and repeat 80 units at most."""
    keys = ["source_table", "row_id"]
    texts = _long_texts(spark, sf)
    units = lambda t: (F.octet_length(F.encode(t, "UTF-16BE")) / 2).cast("bigint")
    own = F.col("piece").substr(F.col("own_start") - F.col("start_pos") + 1, F.length("piece"))
    repeated = F.col("piece").substr(F.lit(1), F.col("own_start") - F.col("start_pos"))
    each = split.pieces(texts, keys, "t").withColumns({"own": own, "repeated": units(repeated)})
    told = each.groupBy(*keys).agg(
        F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece_no", "own"))), lambda x: x["own"]), "").cast("binary")).alias("text"),
        (F.max(units(F.col("piece"))) <= split.LIMIT).alias("within"),
        (F.max("repeated") <= split.OVERLAP).alias("overlapping"),
    )
    return told


def p6_check(spark: SparkSession, sf: str) -> DataFrame:
    """What an assignment must be, for each text: all its bytes once, no container too full; and whether it was cut."""
    packed = p6_assignment(spark, sf)
    full = packed.groupBy("container_id").agg((F.sum("tokens") <= pack.CAPACITY).alias("fits"))
    w = packed.join(full, "container_id")
    return w.groupBy("doc_id").agg(F.sum(F.col("end_byte") - F.col("start_byte")).alias("bytes"), F.bool_and("fits").alias("fits"), (F.count("*") > 1).alias("cut"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_redacted, p3_found, p3_pieces, p3_check, p5_found, p5_by_batch, p6_found, p6_assignment, p6_check, p7_found, p7_leaks, p8_found, p8_texts, p8_classes)}


#: Blank as Python and Java script see it: Unicode spaces, the byte order mark, line ends.
_SPACE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"

_UNITS = "(length(t) + length(regexp_replace(t, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))"

_P3 = f"""
WITH x AS (
  SELECT 'sentencias' AS source_table, row_id, texto_sentencia AS t FROM sentencias
  UNION ALL SELECT 'contraloria', row_id, documento_completo FROM contraloria),
y AS (
  SELECT source_table, row_id, {_UNITS} AS units,
    list_max(list_transform(string_split_regex(t, '{_SPACE}+'), lambda t: {_UNITS})) AS solid
  FROM x WHERE length(regexp_replace(t, '{_SPACE}', '', 'g')) > 0)
SELECT source_table, row_id, 'oversize' AS need FROM y WHERE units > 800
UNION ALL SELECT source_table, row_id, 'unbroken' FROM y WHERE units > 800 AND solid > 800
"""

_P6 = "SELECT doc_id FROM documents WHERE octet_length(encode(text)) + 1 > 4096"


_P3_CHECK = f"""
SELECT source_table, row_id, md5(t) AS text, true AS within, true AS overlapping FROM (
  SELECT 'sentencias' AS source_table, row_id, texto_sentencia AS t FROM sentencias
  UNION ALL SELECT 'contraloria', row_id, documento_completo FROM contraloria)
WHERE length(regexp_replace(t, '{_SPACE}', '', 'g')) > 0
"""

_P6_CHECK = "SELECT doc_id, octet_length(encode(text)) AS bytes, true AS fits, octet_length(encode(text)) + 1 > 4096 AS cut FROM documents WHERE text IS NOT NULL"

# What a character looks like, for SQL: the letters of other scripts and full-width signs that the test tables hold.
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_PLAIN = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
_OTHERS = "\u0391\u0392\u0395\u0397\u0399\u039c\u039d\u039f\u03a1\u03a4\u03bd\u03bf\u0405\u0406\u0408\u0410\u0412\u0415\u041c\u041d\u041e\u0420\u0421\u0422\u0430\u0435\u043e\u0440\u0441\u0443\u0445\u0455\u0456\u0458\u038c\u03cc\u00a0\u2007\u202f\u3000\u2010\u2011"
_LATIN = "ABEHIMNOPTvoSIJABEMHOPCTaeopcyxsij\u00d3\u00f3    --"
_INVISIBLE = r"[\x{AD}\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]"


def _look(t: str) -> str:
    wide = f"translate({t}, '{_WIDE}', '{_PLAIN.replace(chr(39), chr(39) * 2)}')"
    return f"nfc_normalize(replace(regexp_replace(translate({wide}, '{_OTHERS}', '{_LATIN}'), '{_INVISIBLE}', '', 'g'), '\ufb01', 'fi'))"


_P8 = f"""
WITH x AS (SELECT doc_id, text, {_look('text')} AS look FROM documents WHERE length(regexp_replace(text, '{_SPACE}', '', 'g')) > 0),
f AS (SELECT look, text, doc_id AS j FROM (SELECT *, row_number() OVER (PARTITION BY look, text ORDER BY doc_id) AS k FROM x) WHERE k <= 2)
SELECT DISTINCT least(x.doc_id, f.j) AS doc_a, greatest(x.doc_id, f.j) AS doc_b FROM x JOIN f USING (look) WHERE x.text <> f.text
"""

_P8_CLASSES = f"""
WITH x AS (SELECT doc_id, text, {_look('text')} AS look FROM documents WHERE length(regexp_replace(text, '{_SPACE}', '', 'g')) > 0)
SELECT DISTINCT doc_id, min(doc_id) OVER (PARTITION BY look) AS look_id, min(doc_id) OVER (PARTITION BY look, text) AS spelling_id FROM x
"""

_P7 = f"""
WITH w AS (SELECT doc_id AS i, false AS item, regexp_extract_all(lower(strip_accents({_look('text')})), '[\\p{{L}}\\p{{Nd}}\u00b2\u00b3\u00b9]+') AS words FROM documents
  UNION ALL SELECT item_id, true, regexp_extract_all(lower(strip_accents({_look('text')})), '[\\p{{L}}\\p{{Nd}}\u00b2\u00b3\u00b9]+') FROM eval_items),
g AS (SELECT i, item, hash(list_slice(words, k, k + 14)) AS h, list_slice(words, k, k + 14) AS words FROM (SELECT i, item, words, unnest(range(1, len(words) - 13)) AS k FROM w WHERE len(words) >= 15))
SELECT DISTINCT d.i AS doc_id, e.i AS item_id FROM g d JOIN g e ON d.h = e.h AND NOT d.item AND e.item AND d.words = e.words
"""


def oracle_sql() -> dict[str, str]:
    return {"p3_found": _P3, "p3_check": _P3_CHECK, "p6_found": _P6, "p6_check": _P6_CHECK, "p7_found": _P7, "p8_found": _P8, "p8_classes": _P8_CLASSES}
