"""Distinct values of a document's fields in the order of their first occurrence."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def facets(df: DataFrame, order: str, fields: dict[str, tuple[Column, bool]]) -> DataFrame:
    """(facet, value, n, first_seen) of each distinct value; nulls count as ''.

    ``fields``: facet -> (column, whether it is an array, of which each element counts).

    One pass: each row becomes its (facet, value) pairs, which are combined before the only shuffle.
    """
    none = F.array().cast("array<struct<facet:string,value:string>>")

    def pair(facet: str, value: Column) -> Column:
        return F.struct(F.lit(facet).alias("facet"), F.coalesce(value.cast("string"), F.lit("")).alias("value"))

    def pairs(facet: str, column: Column, many: bool) -> Column:
        return F.coalesce(F.transform(column, lambda v: pair(facet, v)), none) if many else F.array(pair(facet, column))

    each = df.select(F.col(order).alias("o"), F.explode(F.flatten(F.array(*(pairs(f, *c) for f, c in fields.items())))).alias("p"))
    return each.groupBy("p.facet", "p.value").agg(F.count("*").alias("n"), F.min("o").alias("first_seen"))


def statute_facets(df: DataFrame, order: str = "row_id") -> DataFrame:
    """The ten facets of statutes; rows without metadata are left out."""
    m = F.col("metadatos")
    return facets(
        df.filter(m.isNotNull()),
        order,
        {
            "id": (F.col("id_norm"), False),
            "fecha_publicacion": (m["fecha_publicacion"], False),
            "fecha_promulgacion": (m["fecha_promulgacion"], False),
            "compuesto": (F.transform(m["tipos_numeros"], lambda t: t["compuesto"]), True),
            "titulo_norma": (m["titulo_norma"], False),
            "organismos": (m["organismos"], True),
            "fuente": (m["fuente"], False),
            "inicio_vigencia": (m["vigencia"]["inicio_vigencia"], False),
            "fin_vigencia": (m["vigencia"]["fin_vigencia"], False),
            "tipo_version_s": (m["tipo_version_s"], False),
        },
    )


def merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Facets of earlier runs and a new one; values never go."""
    return old.unionByName(new).groupBy("facet", "value").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))


def lists(found: DataFrame) -> DataFrame:
    """One ordered array for each facet."""
    return found.groupBy("facet").agg(F.transform(F.array_sort(F.collect_list(F.struct("first_seen", "value"))), lambda x: x["value"]).alias("values"))


def save_json(found: DataFrame, path: str) -> None:
    """Write facets as JSON, one object (facet, value, n, first_seen) a line, in place of what was there."""
    found.select("facet", "value", "n", "first_seen").write.mode("overwrite").json(path)


def load_json(spark: SparkSession, path: str) -> DataFrame:
    """Facets (facet, value, n, first_seen) of JSON files: lines as :func:`save_json` writes them, or one object of lists.

    A list's values count once each and are first seen at their places. A missing path and files of other contents give none.
    """
    shape = "facet string, value string, n bigint, first_seen bigint"
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], shape)
    objects = text.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("facet", "values"))
    old = objects.select("facet", F.posexplode("values").alias("pos", "value")).select("facet", "value", F.lit(1).cast("bigint").alias("n"), F.col("pos").cast("bigint").alias("first_seen"))
    lines = text.select(F.explode(F.split("value", "\\n")).alias("value")).select(F.from_json("value", shape).alias("r")).select("r.*").filter("facet is not null")
    return merge(old, lines)
