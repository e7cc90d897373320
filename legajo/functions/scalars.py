"""Scalar functions with the semantics that document pipelines written for JavaScript rely on; all are built-in expressions."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What JavaScript trims: Unicode spaces, line ends and the byte order mark. Spark's trim removes U+0020 only.
JS_SPACE = "[\\t-\\r \\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff]"


def js_trim(x: Column) -> Column:
    return F.regexp_replace(x, f"^{JS_SPACE}+|{JS_SPACE}+\\z", "")


def is_blank(x: Column) -> Column:
    """Null, empty or white space only; never null."""
    # One character that is no space decides; trimming would go through the whole text.
    return F.coalesce(~x.rlike("[^" + JS_SPACE[1:]), F.lit(True))


def or_text(x: Column, default: str = "") -> Column:
    """``x || ''`` of a string."""
    return F.coalesce(x, F.lit(default)) if default == "" else F.coalesce(F.nullif(x, F.lit("")), F.lit(default))


def or_number(x: Column, default: int = 0) -> Column:
    """``x || 0`` of a number: null and zero give the default."""
    return F.coalesce(F.nullif(x, F.lit(0)), F.lit(default))


def text_list(x: Column) -> Column:
    """A field that holds a scalar or the text of a JSON array, as array<string>; null and '' give an empty array."""
    parsed = F.try_variant_get(F.try_parse_json(x), "$", "array<string>")
    scalar = F.when(F.coalesce(x, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array(x))
    return F.when(F.ltrim(x).startswith("["), F.coalesce(parsed, scalar)).otherwise(scalar)


def parse_int(x: Column, default: int | None = None) -> Column:
    """Leading digits after optional white space and sign, as parseInt reads them; with a default also for 0."""
    n = F.nullif(F.regexp_extract(x, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("bigint")
    return n if default is None else F.coalesce(F.nullif(n, F.lit(0)), F.lit(default))


def utf16_length(x: Column) -> Column:
    """Length in UTF-16 units, which counts characters beyond the basic plane twice."""
    return (F.octet_length(F.encode(x, "UTF-16BE")) / 2).cast("bigint")


def js_round(x: Column) -> Column:
    """Halves go up, also below zero."""
    return F.floor(x + F.lit(0.5))


def first_of(x: Column, field: str) -> Column:
    """``a?.[0]?.field || ''``"""
    return or_text(F.try_element_at(x, F.lit(1))[field])


# Markup rules, in the order in which they are applied. The patterns are fixed values: what they match must match alike. They are
# written so that Java and Python read them the same way; "any character" is any but JavaScript's line ends.
_ANY = "[^\\n\\r\\u2028\\u2029]"
SPAN = rf"(?i)<span[^>]*>{_ANY}*?</span>"
NOTE = r"""(?is)<div[^>]*class=["']?n rnp["']?[^>]*>.*?</div>"""
LINK = rf"(?i)<a[^>]*>({_ANY}*?)</a>"
TAG = r"</?[^>]+(?:>|$)"


def drop_spans(x: Column) -> Column:
    return F.regexp_replace(x, SPAN, "")


def drop_notes(x: Column) -> Column:
    """Blocks whose class holds ``n rnp``, over line ends too."""
    return F.regexp_replace(x, NOTE, "")


def unwrap_links(x: Column) -> Column:
    """Keep what links enclose. Any tag that begins with an a is taken for a link."""
    return F.regexp_replace(x, LINK, "$1")


def strip_tags(x: Column) -> Column:
    """Tags and an unclosed rest; null gives ''. White space at the ends goes after the tags, before entities are decoded."""
    return js_trim(F.regexp_replace(F.coalesce(x, F.lit("")), TAG.replace("$", r"\z"), ""))


# Vectors.


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null where a vector is null or zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def quantise(v: Column, scale: Column) -> Column:
    """int8 values of a vector, clipped at ``scale``."""
    return F.transform(v, lambda x: F.greatest(F.lit(-127), F.least(F.lit(127), F.floor(x.cast("double") / scale * 127 + F.lit(0.5)))).cast("int"))


# Small things that crawls and reports need.


def to_fixed(x: Column, digits: int) -> Column:
    """A number as text with so many digits, rounded by its exact binary value (1.005 gives 1.00), halves away from zero.

    For figures of reports: Spark's own rounding goes by a double's shortest decimal form, so this is a Python function.
    """
    unit = Decimal(1).scaleb(-digits)

    def fixed(part: pd.Series) -> pd.Series:
        return part.map(lambda v: None if pd.isna(v) else str(Decimal(float(v)).quantize(unit, ROUND_HALF_UP)))

    return F.pandas_udf(fixed, "string")(x)


def backoff_ms(base_ms: int, attempt: Column) -> Column:
    """The wait before an attempt, doubling from ``base_ms``."""
    return (F.lit(base_ms) * F.pow(F.lit(2), attempt - 1)).cast("bigint")


def form_token(html: Column) -> Column:
    """The value of a page's hidden ``_token`` field; null where it has none."""
    return F.nullif(F.regexp_extract(html, r"""name=["']_token["'][^>]*value=["']([^"']*)["']""", 1), F.lit(""))


def cookie_map(header: Column) -> Column:
    """The pairs of a cookie header; a value keeps its own equals signs."""
    pairs = F.filter(F.transform(F.split(header, ";"), lambda p: F.trim(p)), lambda p: p.contains("="))
    return F.map_from_entries(F.transform(pairs, lambda p: F.struct(F.substring_index(p, "=", 1).alias("k"), F.substring(p, F.instr(p, "=") + 1, F.length(p)).alias("v"))))


def iso_stamp(ts: Column) -> Column:
    """A time as ISO 8601 in UTC with milliseconds, as ``toISOString`` writes it."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def file_stamp(ts: Column) -> Column:
    """A time as part of a file name: ISO 8601 with hyphens for colons and dots."""
    return F.translate(iso_stamp(ts), ":.", "--")


def throughput_class(per_minute: Column) -> Column:
    return F.when(per_minute >= 100, "excellent").when(per_minute >= 60, "good").when(per_minute >= 30, "moderate").otherwise("slow")


def is_critical(message: Column) -> Column:
    """Errors of the connection, which end a run."""
    return message.contains("ECONNREFUSED") | message.contains("timeout")


def random_delay_ms(seed: int | None = None, least: int = 1000, span: int = 9000) -> Column:
    """A wait of ``least`` to ``least + span - 1`` milliseconds."""
    return (F.floor((F.rand(seed) if seed is not None else F.rand()) * span) + least).cast("bigint")


def session_expired(now: Column, started: Column, ttl_ms: int = 6_000_000) -> Column:
    """Whether a session of a remote site is too old to be used again; a session that never began is."""
    return F.coalesce(F.unix_millis(now) - F.unix_millis(started) > ttl_ms, F.lit(True))


def cache_stale(size: Column, total: Column, slack: int = 1000) -> Column:
    """Whether a cache of ids must be read anew: it is empty, or far from the number that the index tells."""
    return F.coalesce(size == 0, F.lit(True)) | F.coalesce(F.abs(size - total) > slack, F.lit(False))
