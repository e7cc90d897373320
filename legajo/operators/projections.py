"""Typed metadata of rulings, comptroller hits and statutes.

The rulings' mapping is a table (base -> output field, source field, default); it compiles to one projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legajo.functions.scalars import first_of, or_number, or_text, text_list, utf16_length

# Output field, source field and kind of each base. The default of text is "", of a list [], of an int 0.
MATRIX: dict[str, list[tuple[str, str, str]]] = {
    "civil": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("tribunal", "gls_juz_s", "text"),
        ("juez", "gls_juez_ss", "list"),
        ("materia", "gls_materia_s", "list"),
    ],
    "penal": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("tribunal", "gls_juz_s", "text"),
        ("materia", "gls_materia_ss", "list"),
        ("juez", "gls_juez_ss", "list"),
        ("resultado", "sent__GLS_DECISION_s", "text"),
    ],
    "familia": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("tribunal", "gls_juz_s", "text"),
        ("materia", "cod_materia_s", "list"),
        ("juez", "gls_juez_ss", "list"),
    ],
    "salud_corte_de_apelaciones": [
        ("rol", "rol_era_ape_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("corte", "gls_corte_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("sala", "gls_sala_sup_s", "text"),
        ("resultado", "resultado_recurso_sup_s", "text"),
        ("tematicaDeSalud", "tematica_ss", "list"),
        ("era", "era_sup_i", "int"),
        ("isapre", "isapre_ss", "list"),
    ],
    "salud_corte_suprema": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("institucionesRecurridas", "organismo_ss", "list"),
        ("tematicaDeSalud", "tematica_ss", "list"),
        ("medicamento", "medicamento_ss", "list"),
        ("enfermedad", "enfermedad_ss", "list"),
        ("corte", "gls_corte_s", "text"),
        ("resultado", "resultado_recurso_sup_s", "text"),
        ("sala", "gls_sala_sup_s", "text"),
        ("era", "era_sup_i", "int"),
        ("tipoRecurso", "gls_tip_recurso_sup_s", "text"),
    ],
    "cobranza": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("tribunal", "gls_juz_s", "text"),
        ("juez", "gls_juez_ss", "list"),
    ],
    "corte_suprema": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("sala", "gls_sala_sup_s", "text"),
        ("corte", "gls_corte_s", "text"),
        ("era", "era_sup_i", "int"),
        ("categorizacion", "sent__categorizacion_s", "list"),
        ("resultado", "resultado_recurso_sup_s", "text"),
        ("redactor", "gls_relator_s", "text"),
        ("ministro", "gls_ministro_ss", "list"),
        ("tipoRecurso", "gls_tip_recurso_sup_s", "text"),
        ("descriptores", "gls_descriptor_ss", "list"),
        ("idNorm", "id_norma_ss", "list"),
        ("articulo", "norma_articulo_ss", "list"),
    ],
    "laboral": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("era", "era_sup_i", "int"),
        ("categorizacion", "gls_materia_s", "list"),
        ("tribunal", "gls_juz_s", "text"),
        ("juez", "gls_juez_ss", "list"),
    ],
    "corte_de_apelaciones": [
        ("rol", "rol_era_ape_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("era", "era_sup_i", "int"),
        ("categorizacion", "gls_materia_s", "list"),
        ("sala", "gls_sala_sup_s", "text"),
        ("corte", "gls_corte_s", "text"),
        ("resultado", "resultado_recurso_sup_s", "text"),
        ("tipoRecurso", "tip_recurso_s", "text"),
        ("juzgado", "gls_juz_s", "text"),
    ],
    "": [
        ("rol", "rol_era_sup_s", "text"),
        ("caratulado", "caratulado_s", "text"),
        ("fechaSentencia", "fec_sentencia_sup_dt", "text"),
        ("tribunal", "gls_juz_s", "text"),
        ("juez", "gls_juez_ss", "list"),
    ],
}
OUTPUTS = list(dict.fromkeys((out, kind) for rows in MATRIX.values() for out, _, kind in rows))


def _read(df: DataFrame, source: str, kind: str) -> Column:
    """A source field with its default; a field that the table lacks is missing in every row."""
    if source not in df.columns:
        return {"text": F.lit(""), "int": F.lit(0), "list": F.array().cast("array<string>")}[kind]
    x = F.col(source)
    if kind == "int":
        return or_number(x.cast("int")).cast("int")
    if kind == "list":
        return F.coalesce(x, F.array().cast("array<string>")) if df.schema[source].dataType.typeName() == "array" else text_list(x.cast("string"))
    return or_text(x.cast("string"))


def ruling_metadata(df: DataFrame, base_col: str = "base") -> DataFrame:
    """idSentence, base, url and the fields of the row's base; fields of other bases are null.

    The base is compared without letter case; unknown and null bases have the default fields. Fields that some bases read as a
    list and others as a scalar are lists everywhere. One scan, no shuffle: every field is one CASE over the base.
    """
    base = F.lower(F.col(base_col))
    known = base.isin(*(b for b in MATRIX if b))
    cols = []
    for out, kind in OUTPUTS:
        by_source: dict[str, list[str]] = {}
        for b, rows in MATRIX.items():
            for o, source, _ in rows:
                if o == out:
                    by_source.setdefault(source, []).append(b)
        case = None
        for source, bases in by_source.items():
            cond = base.isin(*(b for b in bases if b))
            if "" in bases:
                cond = F.coalesce(cond, F.lit(False)) | ~F.coalesce(known, F.lit(False))
            case = F.when(cond, _read(df, source, kind)) if case is None else case.when(cond, _read(df, source, kind))
        cols.append(case.alias(out))
    return df.select(F.col("id").alias("idSentence"), F.col(base_col).alias("base"), or_text(F.col("url_corta_acceso_sentencia")).alias("url"), *cols)


def statute_metadata(df: DataFrame, id_col: str = "id_norm", meta_col: str = "metadatos") -> DataFrame:
    """The ten fields of a statute; rows without metadata are not valid answers and have none."""
    m = F.col(meta_col)
    return df.filter(m.isNotNull()).select(
        F.col(id_col).alias("idNorm"),
        first_of(m["tipos_numeros"], "compuesto").alias("compuesto"),
        or_text(m["titulo_norma"]).alias("titulo_norma"),
        F.coalesce(m["organismos"], F.array().cast("array<string>")).alias("organismos"),
        or_text(m["fecha_publicacion"]).alias("fecha_publicacion"),
        or_text(m["fecha_promulgacion"]).alias("fecha_promulgacion"),
        or_text(m["tipo_version_s"]).alias("tipo_version_s"),
        or_text(m["vigencia"]["inicio_vigencia"]).alias("inicio_vigencia"),
        or_text(m["vigencia"]["fin_vigencia"]).alias("fin_vigencia"),
        or_text(m["fuente"]).alias("fuente"),
        F.lit("norma").alias("tag"),
    )


def hit_metadata(df: DataFrame, source_col: str = "_source", id_col: str = "doc_id", text_field: str = "documento_completo", keep: tuple[str, ...] = ()) -> DataFrame:
    """A comptroller hit's object without its long text, as a map of JSON values, with ``idSentence``.

    ``idSentence`` is the hit's id unless the object has its own. Objects delivered as a JSON string are read; null and malformed
    ones give only ``idSentence``.
    """
    # Only a string is read through a variant, which would put an object's members in another order.
    inner = F.when(F.ltrim(F.col(source_col)).startswith('"'), F.try_variant_get(F.try_parse_json(F.col(source_col)), "$", "string"))
    held = F.coalesce(inner, F.col(source_col))
    fields = F.coalesce(F.from_json(held, "map<string,string>"), F.create_map().cast("map<string,string>"))
    rest = F.map_filter(fields, lambda k, v: k != text_field)
    own = F.coalesce(rest["idSentence"], F.col(id_col))
    return df.select(*keep, F.col(id_col), own.alias("idSentence"), F.map_filter(rest, lambda k, v: k != "idSentence").alias("fields"))


def row_form(df: DataFrame, id_col: str, collection: Column, document: Column, metadata: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The relational row of a document: id, collection, filename, file_path, content, metadata (JSON), file_size.

    ``document`` is a struct; ``content`` is its JSON with all members, null ones too, and ``file_size`` the length of that in
    UTF-16 units. A null id gives a null filename.
    """
    key = F.col(id_col).cast("string")
    content = F.to_json(document, {"ignoreNullFields": "false"})
    return df.select(
        *keep,
        key.alias("id"),
        collection.alias("collection"),
        F.concat(key, F.lit(".json")).alias("filename"),
        F.concat(F.lit("/path/to/"), key, F.lit(".json")).alias("file_path"),
        content.alias("content"),
        F.to_json(metadata, {"ignoreNullFields": "false"}).alias("metadata"),
        utf16_length(content).alias("file_size"),
    )


def load_tier(n: Column) -> Column:
    """The batch size for so many files."""
    tier = lambda name, size: F.struct(F.lit(name).alias("tier"), F.lit(size).alias("batch_size"))
    return F.when(n > 5000, tier("HEAVY", 100)).when(n > 500, tier("MEDIUM", 75)).otherwise(tier("LIGHT", 50))
