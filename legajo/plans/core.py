"""The queries of the core operators on the test tables, with the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legajo.functions import scalars as S
from legajo.operators import dedup, facets, html, metrics, projections, runstate, vectors
from legajo.plans import problems
from legajo.session import shared_folder, table
from legajo.sources import landed

_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query and its SQL."""

    def add(f):
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


#: JavaScript's white space for DuckDB's regular expressions.
_WS = r"[\t-\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


_COS = "list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"


def _cos(a: str, b: str) -> str:
    return f"round({_COS.format(a=a, b=b)} / (sqrt({_COS.format(a=a, b=a)}) * sqrt({_COS.format(a=b, b=b)})), 4)"


# --- search --------------------------------------------------------------------------------------------------------------


@query(f"SELECT p.vec_id, p.label, {_cos('p.embedding', 'q.embedding')} AS score FROM embeddings p, (SELECT embedding FROM embeddings WHERE vec_id = 0) q WHERE p.vec_id <> 0 AND {_cos('p.embedding', 'q.embedding')} >= 0.2 ORDER BY score DESC, vec_id LIMIT 5")
def topk_cosine(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "embeddings")
    first = points.filter("vec_id = 0").select("embedding").first()
    return vectors.search(points.filter("vec_id <> 0"), list(first[0]) if first else [0.0], 5, 0.2)


@query(
    f"""WITH s AS (SELECT q.vec_id AS query_id, p.vec_id, {_cos('p.embedding', 'q.embedding')} AS score FROM embeddings p JOIN embeddings q ON q.vec_id % 100 = 0 AND p.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s WHERE score >= 0.2)
SELECT query_id, vec_id, score, rank::INTEGER AS rank FROM r WHERE rank <= 5"""
)
def topk_all(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "embeddings")
    return vectors.search_many(points, points.filter("vec_id % 100 = 0"), 5, 0.2)


@query(
    """WITH s AS (SELECT quantile_cont(abs(x), 0.99) AS q FROM (SELECT unnest(embedding)::DOUBLE AS x FROM embeddings))
SELECT vec_id, array_to_string(list_transform(embedding, lambda x: greatest(-127, least(127, floor(x::DOUBLE / s.q * 127 + 0.5)))::INTEGER), ' ') AS int8 FROM embeddings, s"""
)
def quantise_int8(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "embeddings")
    scale = points.select(F.explode("embedding").alias("x")).agg(F.percentile(F.abs(F.col("x").cast("double")), 0.99).alias("q"))
    q8 = points.crossJoin(F.broadcast(scale)).withColumn("v", S.quantise(F.col("embedding"), F.col("q")))  # one row
    return q8.select("vec_id", F.array_join(F.transform("v", lambda x: x.cast("string")), " ").alias("int8"))


@query("SELECT count(*) AS vectors_count, count(*) FILTER (WHERE len(embedding) <> 64) AS wrong_dim FROM embeddings")
def vectors_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").agg(F.count("*").alias("vectors_count"), F.count_if(F.size("embedding") != 64).alias("wrong_dim"))


# --- projections ---------------------------------------------------------------------------------------------------------

_COLUMNS = set("id url_corta_acceso_sentencia texto_sentencia caratulado_s fec_sentencia_sup_dt rol_era_sup_s rol_era_ape_s gls_juz_s gls_juez_ss gls_materia_s gls_materia_ss cod_materia_s gls_corte_s gls_sala_sup_s resultado_recurso_sup_s era_sup_i tematica_ss".split())


def _ruling_sql() -> str:
    def read(source: str, kind: str) -> str:
        if source not in _COLUMNS:
            return {"text": "''", "int": "'0'", "list": "''"}[kind]
        if kind == "int":
            return f"coalesce({source}, 0)::VARCHAR"
        if kind == "text":
            return f"coalesce({source}, '')"
        if source in ("gls_materia_ss", "tematica_ss"):
            return f"coalesce(array_to_string({source}, '|'), '')"
        return f"CASE WHEN ltrim({source}, ' ') LIKE '[%' AND json_valid({source}) THEN array_to_string(from_json({source}, '[\"VARCHAR\"]'), '|') ELSE coalesce({source}, '') END"

    known = ", ".join(f"'{b}'" for b in projections.MATRIX if b)
    cols = []
    for out, kind in projections.OUTPUTS:
        case = []
        for b, rows in projections.MATRIX.items():
            for o, source, _ in rows:
                if o == out:
                    cond = f"lower(base) = '{b}'" if b else f"base IS NULL OR lower(base) NOT IN ({known})"
                    case.append(f"WHEN {cond} THEN {read(source, kind)}")
        cols.append(f'CASE {" ".join(case)} END AS "{out}"')
    return f"SELECT id AS \"idSentence\", base, coalesce(url_corta_acceso_sentencia, '') AS url, {', '.join(cols)} FROM sentencias"


@query(_ruling_sql())
def project_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """Lists are joined and numbers written out, so that both sides compare as text."""
    meta = projections.ruling_metadata(table(spark, sf, "sentencias"))
    as_text = {out: F.array_join(out, "|") if kind == "list" else F.col(out).cast("string") for out, kind in projections.OUTPUTS if kind != "text"}
    return meta.withColumns(as_text)


@query(
    """SELECT id_norm AS "idNorm", coalesce(metadatos.tipos_numeros[1].compuesto, '') AS compuesto, coalesce(metadatos.titulo_norma, '') AS titulo_norma, coalesce(array_to_string(metadatos.organismos, '|'), '') AS organismos,
coalesce(metadatos.fecha_publicacion, '') AS fecha_publicacion, coalesce(metadatos.fecha_promulgacion, '') AS fecha_promulgacion, coalesce(metadatos.tipo_version_s, '') AS tipo_version_s,
coalesce(metadatos.vigencia.inicio_vigencia, '') AS inicio_vigencia, coalesce(metadatos.vigencia.fin_vigencia, '') AS fin_vigencia, coalesce(metadatos.fuente, '') AS fuente, 'norma' AS tag FROM normas WHERE metadatos IS NOT NULL"""
)
def norm_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return projections.statute_metadata(table(spark, sf, "normas")).withColumn("organismos", F.array_join("organismos", "|"))


@query(
    f"""WITH s AS (SELECT row_id, doc_id, try_cast(_source AS JSON) AS j FROM contraloria), h AS (SELECT row_id, doc_id, {problems.held('j')} AS j FROM s),
o AS (SELECT row_id, doc_id, CASE WHEN json_type(j) = 'OBJECT' THEN j END AS j FROM h),
e AS (SELECT o.row_id, e.key AS k, e.value AS v FROM o, LATERAL json_each(o.j) e WHERE e.key NOT IN ('documento_completo', 'idSentence')),
f AS (SELECT row_id, string_agg(k || '=' || coalesce(CASE WHEN json_type(v) = 'VARCHAR' THEN v ->> '$' WHEN json_type(v) <> 'NULL' THEN v::VARCHAR END, '<null>'), '|' ORDER BY k) AS fields FROM e GROUP BY row_id)
SELECT o.row_id, o.doc_id, coalesce(o.j ->> '$.idSentence', o.doc_id) AS "idSentence", coalesce(f.fields, '') AS fields FROM o LEFT JOIN f USING (row_id)"""
)
def hit_metadata(spark: SparkSession, sf: str) -> DataFrame:
    """The members are written out in order, so that both sides compare as text."""
    hits = projections.hit_metadata(table(spark, sf, "contraloria"), keep=("row_id",))
    shown = F.transform(F.array_sort(F.map_entries("fields")), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("<null>"))))
    return hits.withColumn("fields", F.array_join(shown, "|"))


@query(
    """WITH x AS (SELECT row_id, doc_id, CASE WHEN json_valid(_source) THEN CASE WHEN json_type(_source) = 'VARCHAR' THEN json_extract_string(_source, '$') ELSE _source END END AS j FROM contraloria)
SELECT row_id, coalesce(CASE WHEN json_valid(j) THEN json_extract_string(j, '$.idSentence') END, doc_id) AS "idSentence", CASE WHEN json_valid(j) THEN json_extract_string(j, '$.criterio') END AS criterio FROM x"""
)
def spread_override(spark: SparkSession, sf: str) -> DataFrame:
    """The hit's own members win over those that are added."""
    hits = projections.hit_metadata(table(spark, sf, "contraloria"), keep=("row_id",))
    return hits.select("row_id", "idSentence", F.col("fields")["criterio"].alias("criterio"))


_DOC = "id base url_corta_acceso_sentencia texto_sentencia caratulado_s era_sup_i tematica_ss".split()
_JS_UNITS = "(length(c) + length(regexp_replace(c, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))::BIGINT"


@query(
    f"""WITH x AS (SELECT row_id, id, lower(base) AS collection, to_json(struct_pack({', '.join(f'{c} := {c}' for c in _DOC)}))::VARCHAR AS c, to_json(struct_pack("idSentence" := id, url := coalesce(url_corta_acceso_sentencia, '')))::VARCHAR AS metadata FROM sentencias)
SELECT row_id, id, collection, id || '.json' AS filename, '/path/to/' || id || '.json' AS file_path, md5(c) AS content, metadata, {_JS_UNITS} AS file_size FROM x"""
)
def relational_row(spark: SparkSession, sf: str) -> DataFrame:
    """The size is that of the serialised document; the document itself is shown by its digest."""
    meta = F.struct(F.col("id").alias("idSentence"), S.or_text(F.col("url_corta_acceso_sentencia")).alias("url"))
    rows = projections.row_form(table(spark, sf, "sentencias"), "id", F.lower("base"), F.struct(*_DOC), meta, keep=("row_id",))
    return rows.withColumn("content", F.md5(F.col("content").cast("binary")))


# --- filters and joins ---------------------------------------------------------------------------------------------------


@query(f"SELECT row_id FROM sentencias WHERE length({_trim('texto_sentencia')}) > 0")
def filter_nonblank(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sentencias").filter(~S.is_blank(F.col("texto_sentencia"))).select("row_id")


@query("SELECT doc_id, id, collection FROM documents WHERE batch_no = (SELECT max(batch_no) FROM documents) AND id NOT IN (SELECT id FROM documents WHERE batch_no < (SELECT max(batch_no) FROM documents) AND id IS NOT NULL)")
def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """The last batch without what earlier batches delivered under the same id."""
    docs = table(spark, sf, "documents").select("doc_id", "id", "collection", "batch_no")
    last = docs.agg(F.max("batch_no")).first()[0]
    return dedup.absent(docs.filter(F.col("batch_no") == last), docs.filter(F.col("batch_no") < last), "id").select("doc_id", "id", "collection")


@query("SELECT d.doc_id FROM documents d WHERE d.id IN (SELECT collection || '-' || s.id FROM (SELECT lower(base) AS collection, id FROM sentencias) s)")
def already_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose origin is a ruling that the rulings' table holds."""
    known = table(spark, sf, "sentencias").select(F.concat_ws("-", F.lower("base"), "id").alias("id"))
    return dedup.present(table(spark, sf, "documents").select("doc_id", "id"), known, "id").select("doc_id")


@query("SELECT row_id, id FROM sentencias WHERE id IS NULL OR row_id IN (SELECT min(row_id) FROM sentencias WHERE id IS NOT NULL GROUP BY id)")
def dedup_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.first_arrivals(table(spark, sf, "sentencias").select("row_id", "id"), "id", "row_id")


@query("SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY md5(text)")
def dedup_by_text(spark: SparkSession, sf: str) -> DataFrame:
    """Exact copies by digest; texts are not shuffled."""
    return table(spark, sf, "documents").groupBy(F.md5(F.col("text").cast("binary")).alias("h")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).drop("h")


@query("SELECT s.row_id, b.id_buscador, b.referer FROM sentencias s JOIN bases b ON lower(s.base) = b.base")
def lookup_dim(spark: SparkSession, sf: str) -> DataFrame:
    """Unknown bases are rejected. Spark sees by the dimension's size whether to broadcast it."""
    return table(spark, sf, "sentencias").withColumn("base", F.lower("base")).join(table(spark, sf, "bases"), "base").select("row_id", "id_buscador", "referer")


@query("SELECT n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")
def lookup_region(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")


@query("SELECT event_id FROM events WHERE hour(ts) >= 0 AND hour(ts) < 6")
def blackout_hours(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").filter((F.hour("ts") >= 0) & (F.hour("ts") < 6)).select("event_id")


# --- aggregations --------------------------------------------------------------------------------------------------------

_FACETS = "WITH m AS (SELECT * FROM normas WHERE metadatos IS NOT NULL), f AS (" + " UNION ALL ".join(
    [f"SELECT row_id, '{n}' AS facet, coalesce({e}, '') AS value FROM m" for n, e in (("id", "id_norm::VARCHAR"), ("fecha_publicacion", "metadatos.fecha_publicacion"), ("fecha_promulgacion", "metadatos.fecha_promulgacion"), ("titulo_norma", "metadatos.titulo_norma"), ("fuente", "metadatos.fuente"), ("inicio_vigencia", "metadatos.vigencia.inicio_vigencia"), ("fin_vigencia", "metadatos.vigencia.fin_vigencia"), ("tipo_version_s", "metadatos.tipo_version_s"))]
    + ["SELECT row_id, 'compuesto', coalesce(t.compuesto, '') FROM (SELECT row_id, unnest(metadatos.tipos_numeros) AS t FROM m)", "SELECT row_id, 'organismos', coalesce(o, '') FROM (SELECT row_id, unnest(metadatos.organismos) AS o FROM m)"]
) + ")"


@query(f"{_FACETS} SELECT facet, value, count(*) AS n, min(row_id) AS first_seen FROM f GROUP BY facet, value")
def facet_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    return facets.statute_facets(table(spark, sf, "normas"))


@query(f"{_FACETS} SELECT facet, string_agg(value, '|' ORDER BY first_seen, value) AS list FROM (SELECT facet, value, min(row_id) AS first_seen FROM f GROUP BY facet, value) GROUP BY facet")
def facet_lists(spark: SparkSession, sf: str) -> DataFrame:
    return facets.lists(facets.statute_facets(table(spark, sf, "normas"))).select("facet", F.array_join("values", "|").alias("list"))


@query("SELECT source, collection, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY source, collection")
def facet_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy("source", "collection").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_seen"))


@query("SELECT value, min(o) AS first_seen FROM (SELECT gls_juz_s AS value, row_id AS o FROM sentencias WHERE gls_juz_s IS NOT NULL UNION ALL SELECT source, doc_id + 1000000000 FROM documents WHERE source IS NOT NULL) GROUP BY value")
def union_facets(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs' facets, the first run's before the second's."""
    old = table(spark, sf, "sentencias").filter("gls_juz_s is not null").select(F.lit("court").alias("facet"), F.col("gls_juz_s").alias("value"), F.lit(1).alias("n"), F.col("row_id").alias("first_seen"))
    new = table(spark, sf, "documents").filter("source is not null").select(F.lit("court").alias("facet"), F.col("source").alias("value"), F.lit(1).alias("n"), (F.col("doc_id") + 1000000000).alias("first_seen"))
    return facets.merge(old, new).select("value", "first_seen")


@query("SELECT count(DISTINCT id) AS ids FROM documents")
def distinct_ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").agg(F.count_distinct("id").alias("ids"))


_OUTCOME = f"""o AS (SELECT s.lote, s.ingested_at, CASE WHEN {_trim('s.texto_sentencia')} = '' OR s.texto_sentencia IS NULL THEN 'error' WHEN s.id IS NOT NULL AND f.first IS DISTINCT FROM s.row_id THEN 'duplicate' ELSE 'success' END AS outcome
FROM sentencias s LEFT JOIN (SELECT id, min(row_id) AS first FROM sentencias GROUP BY id) f ON s.id = f.id)"""


def _outcomes(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "sentencias").select("row_id", "id", "lote", "ingested_at", S.is_blank(F.col("texto_sentencia")).alias("blank"))
    first = rows.filter("id is not null").groupBy("id").agg(F.min("row_id").alias("first"))
    outcome = F.when(F.col("blank"), "error").when(F.col("id").isNotNull() & (F.col("first") != F.col("row_id")), "duplicate").otherwise("success")
    return rows.join(first, "id", "left").select("lote", "ingested_at", outcome.alias("outcome"))


@query(
    f"""WITH {_OUTCOME}, b AS (SELECT lote, count(*) AS n, count(*) FILTER (outcome = 'success') AS success, count(*) FILTER (outcome = 'duplicate') AS duplicates, count(*) FILTER (outcome = 'error') AS errors FROM o GROUP BY lote)
SELECT *, (sum(n) OVER (ORDER BY lote))::BIGINT AS processed FROM b"""
)
def batch_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Only one row for each batch goes through the running total."""
    b = _outcomes(spark, sf).groupBy("lote").agg(F.count("*").alias("n"), *(F.count_if(F.col("outcome") == o).alias(a) for o, a in (("success", "success"), ("duplicate", "duplicates"), ("error", "errors"))))
    return b.withColumn("processed", F.sum("n").over(Window.orderBy("lote")))


@query(
    """WITH b AS (SELECT lote, count(*) AS n, max(epoch_us(ingested_at)) AS t FROM sentencias GROUP BY lote),
d AS (SELECT *, t - lag(t) OVER (ORDER BY lote) AS us, sum(n) OVER (ORDER BY lote) AS done, sum(n) OVER () AS total FROM b)
SELECT lote, n, round(CASE WHEN us <> 0 THEN n / (us / 86400000000.0) END, 4) AS docs_per_day, round((total - done) * 1.0 / done, 4) AS rest FROM d"""
)
def batch_rates(spark: SparkSession, sf: str) -> DataFrame:
    b = table(spark, sf, "sentencias").groupBy("lote").agg(F.count("*").alias("n"), F.max(F.unix_micros(F.col("ingested_at").cast("timestamp"))).alias("t"))
    w = Window.orderBy("lote")
    d = b.withColumns({"us": F.col("t") - F.lag("t").over(w), "done": F.sum("n").over(w), "total": F.sum("n").over(Window.partitionBy())})
    return d.select("lote", "n", F.round(F.try_divide(F.col("n"), F.col("us") / 86400000000.0), 4).alias("docs_per_day"), F.round(F.try_divide(F.col("total") - F.col("done"), F.col("done")), 4).alias("rest"))


@query("SELECT feed_id, count(*) AS n, CASE WHEN count(*) > 5000 THEN 'HEAVY' WHEN count(*) > 500 THEN 'MEDIUM' ELSE 'LIGHT' END AS tier, CASE WHEN count(*) > 5000 THEN 100 WHEN count(*) > 500 THEN 75 ELSE 50 END AS batch_size FROM archivos GROUP BY feed_id")
def tier_config(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "archivos").groupBy("feed_id").agg(F.count("*").alias("n")).withColumn("t", projections.load_tier(F.col("n"))).select("feed_id", "n", "t.tier", "t.batch_size")


@query(
    """WITH r AS (SELECT source, count(*) * 60.0 / nullif((max(epoch_us(stored_at)) - min(epoch_us(stored_at))) / 1e6, 0) AS rate FROM documents GROUP BY source)
SELECT source, round(rate, 4) AS docs_per_min, CASE WHEN rate >= 100 THEN 'excellent' WHEN rate >= 60 THEN 'good' WHEN rate >= 30 THEN 'moderate' ELSE 'slow' END AS class FROM r"""
)
def throughput_class(spark: SparkSession, sf: str) -> DataFrame:
    t = F.unix_micros(F.col("stored_at").cast("timestamp"))
    rate = table(spark, sf, "documents").groupBy("source").agg(F.try_divide(F.count("*") * 60.0, (F.max(t) - F.min(t)) / 1e6).alias("rate"))
    return rate.select("source", F.round("rate", 4).alias("docs_per_min"), S.throughput_class(F.col("rate")).alias("class"))


@query(
    """WITH b AS (SELECT batch_no AS batch, count(*) AS docs, sum(greatest(1, ceil((n_chars - 80) / 720.0)))::BIGINT AS chunks, sum(n_chars)::BIGINT AS embed_ms, ((max(epoch_us(stored_at)) - min(epoch_us(stored_at))) // 1000)::BIGINT AS ms FROM documents GROUP BY batch_no),
w AS (SELECT *, row_number() OVER o AS nth, count(*) OVER () AS of, sum(docs) OVER o AS done, sum(chunks) OVER o AS chunks_done, sum(embed_ms) OVER o AS embed, sum(ms) OVER o AS time FROM b WINDOW o AS (ORDER BY batch))
SELECT batch, done::BIGINT AS done, chunks_done::BIGINT AS chunks_done, round(docs / nullif(ms / 1000.0, 0), 4) AS batch_rate, round(done / nullif(time / 1000.0, 0), 4) AS overall_rate, round(chunks_done * 1.0 / nullif(done, 0), 4) AS chunks_per_doc,
round(embed * 1.0 / nullif(done, 0), 4) AS embed_ms_per_doc, round((of - nth) * time / nth / 1000.0, 4) AS rest_s FROM w"""
)
def batch_report(spark: SparkSession, sf: str) -> DataFrame:
    """Sums, rates, means and the time that is left. Characters stand for the milliseconds of a model, which the table lacks."""
    t = F.unix_micros(F.col("stored_at").cast("timestamp"))
    chunks = F.greatest(F.lit(1), F.ceil((F.col("n_chars") - 80) / F.lit(720.0)))
    b = table(spark, sf, "documents").groupBy("batch_no").agg(F.count("*").alias("docs"), F.sum(chunks).cast("bigint").alias("chunks"), F.sum("n_chars").alias("embed_ms"), F.floor((F.max(t) - F.min(t)) / 1000).alias("ms"))
    return metrics.batch_report(b, "batch_no", "docs", "chunks", "embed_ms", "ms")


@query(
    f"""WITH {_OUTCOME}, b AS (SELECT lote, count(*) FILTER (outcome = 'success') AS s, count(*) AS n, (max(epoch_us(ingested_at)) - min(epoch_us(ingested_at))) / 1e6 AS sec FROM o GROUP BY lote), r AS (SELECT *, n * 60.0 / nullif(sec, 0) AS rate FROM b)
SELECT lote, n AS settled, round(s * 100.0 / n, 4) AS success_rate, round(rate, 4) AS docs_per_min, CASE WHEN rate >= 100 THEN 'excellent' WHEN rate >= 60 THEN 'good' WHEN rate >= 30 THEN 'moderate' ELSE 'slow' END AS class, round(10000 / nullif(rate * 60.0, 0), 4) AS hours FROM r"""
)
def run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Settled documents, success rate, throughput and its class, and how long ten thousand documents would take."""
    t = F.unix_micros(F.col("ingested_at").cast("timestamp"))
    count = lambda o: F.count_if(F.col("outcome") == o).alias(o)
    b = _outcomes(spark, sf).groupBy("lote").agg(count("success"), count("error"), count("duplicate"), ((F.max(t) - F.min(t)) / 1e6).alias("sec"))
    return b.select("lote", *metrics.run_report(F.col("success"), F.col("error"), F.col("duplicate"), F.col("sec"), F.lit(10000)))


@query("SELECT event_id, epoch_ms((SELECT max(ts) FROM events)) - epoch_ms(ts) > 6000000 AS expired FROM events")
def session_expired(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a session that began with an event is too old at the last one."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    last = events.agg(F.max("ts").alias("now"))
    return events.crossJoin(F.broadcast(last)).select("event_id", S.session_expired(F.col("now"), F.col("ts")).alias("expired"))  # one row


@query("WITH x AS (SELECT collection, count(DISTINCT id) AS size, count(*) AS total FROM documents GROUP BY collection) SELECT collection, size = 0 OR abs(size - total) > 20 AS stale FROM x")
def cache_stale(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a cache of distinct ids is off by more than twenty from what a collection holds."""
    x = table(spark, sf, "documents").groupBy("collection").agg(F.count_distinct("id").alias("size"), F.count("*").alias("total"))
    return x.select("collection", S.cache_stale(F.col("size"), F.col("total"), 20).alias("stale"))


@query("SELECT DISTINCT file_name FROM archivos ORDER BY file_name LIMIT 50")
def sample_files(spark: SparkSession, sf: str) -> DataFrame:
    """A sample of at most fifty files, the feature of a speed test."""
    return table(spark, sf, "archivos").select("file_name").distinct().orderBy("file_name").limit(50)


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS stamp, translate(strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z', ':.', '--') AS file FROM events")
def iso_stamps(spark: SparkSession, sf: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf, "events").select("event_id", S.iso_stamp(ts).alias("stamp"), S.file_stamp(ts).alias("file"))


@query("SELECT event_id, true AS within, (2000 * 2 ** (event_id % 5))::BIGINT AS wait FROM events")
def waits(spark: SparkSession, sf: str) -> DataFrame:
    """Random waits stay within one to ten seconds, waits before an attempt double."""
    return table(spark, sf, "events").select("event_id", S.random_delay_ms(7).between(1000, 9999).alias("within"), S.backoff_ms(2000, F.pmod("event_id", F.lit(5)) + 1).alias("wait"))


@query("SELECT DISTINCT id FROM documents WHERE id IS NOT NULL")
def id_cache(spark: SparkSession, sf: str) -> DataFrame:
    """The ids of all documents, written as a cache and read from it."""
    path = f"{shared_folder(spark)}/ids"
    landed.save_id_cache(table(spark, sf, "documents").select("id"), path)
    return landed.id_cache(spark, path)


@query(f"{_FACETS} SELECT facet, value, count(*) AS n, min(row_id) AS first_seen FROM f GROUP BY facet, value")
def facet_file(spark: SparkSession, sf: str) -> DataFrame:
    """The facets of all statutes, written as JSON and read from it."""
    path = f"{shared_folder(spark)}/facets"
    facets.save_json(facets.statute_facets(table(spark, sf, "normas")), path)
    return facets.load_json(spark, path)


# --- running state -------------------------------------------------------------------------------------------------------

_RUNS = "r AS (SELECT event_id, event_type = 'error' AS bad, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (ORDER BY event_id) AS g FROM events), c AS (SELECT event_id, sum(bad::INT) OVER (PARTITION BY g ORDER BY event_id) AS run FROM r)"


@query(f"WITH {_RUNS} SELECT event_id, run::BIGINT AS run FROM c WHERE run >= 3")
def error_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Events at which at least three in a row have failed."""
    return runstate.failures(table(spark, sf, "events").select("event_id", "event_type"), "event_id", F.col("event_type") == "error").filter("run >= 3").select("event_id", "run")


@query(f"WITH {_RUNS}, p AS (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 50 AS page_no FROM c) SELECT page_no::BIGINT AS page_no, max_by(run, event_id)::BIGINT AS run FROM p GROUP BY page_no HAVING max_by(run, event_id) >= 2")
def error_budget_paged(spark: SparkSession, sf: str) -> DataFrame:
    return runstate.stop_page(table(spark, sf, "events").select("event_id", "event_type"), "event_id", F.col("event_type") == "error", 50, 2)


@query("SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) // 100)::BIGINT AS pause_no FROM events")
def throttle_points(spark: SparkSession, sf: str) -> DataFrame:
    return runstate.batched(table(spark, sf, "events").select("event_id"), "event_id", 100).withColumnRenamed("batch_no", "pause_no")


@query("WITH x AS (SELECT rec_id, count(*) OVER () AS n, row_number() OVER (ORDER BY rec_id) AS rn FROM archivos) SELECT rec_id, ((rn - 1) // CASE WHEN n > 5000 THEN 100 WHEN n > 500 THEN 75 ELSE 50 END)::BIGINT AS batch_no FROM x")
def file_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Landed records in batches of the size that their number asks for."""
    files = table(spark, sf, "archivos").select("rec_id")
    n = files.count()
    return runstate.batched(files, "rec_id", 100 if n > 5000 else 75 if n > 500 else 50)


@query("SELECT doc_id, collection FROM documents ORDER BY doc_id LIMIT 50 OFFSET 50")
def page_slice(spark: SparkSession, sf: str) -> DataFrame:
    """The second page of fifty; Spark keeps only offset + limit rows of each task."""
    return table(spark, sf, "documents").select("doc_id", "collection").orderBy("doc_id").offset(50).limit(50)


# --- text ----------------------------------------------------------------------------------------------------------------


@query("SELECT row_id, md5(regexp_replace(html, '(?i)<span[^>]*>.*?</span>', '', 'g')) AS h FROM normas")
def drop_span(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "normas").select("row_id", F.md5(S.drop_spans(F.col("html")).cast("binary")).alias("h"))


@query("""SELECT row_id, md5(regexp_replace(html, '(?is)<div[^>]*class=["'']?n rnp["'']?[^>]*>.*?</div>', '', 'g')) AS h FROM (SELECT row_id, replace(html, '\\"', '"') AS html FROM normas)""")
def drop_div_class(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "normas").select("row_id", F.md5(S.drop_notes(F.replace(F.col("html"), F.lit('\\"'), F.lit('"'))).cast("binary")).alias("h"))


@query("SELECT row_id, md5(regexp_replace(html, '(?i)<a[^>]*>(.*?)</a>', '\\1', 'g')) AS h FROM normas")
def unwrap_anchor(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "normas").select("row_id", F.md5(S.unwrap_links(F.col("html")).cast("binary")).alias("h"))


@query(f"SELECT row_id, md5({_trim("regexp_replace(coalesce(html, ''), '</?[^>]+(>|$)', '', 'g')")}) AS h FROM normas")
def strip_tags(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "normas").select("row_id", F.md5(S.strip_tags(F.col("html")).cast("binary")).alias("h"))


def _markup(t: str) -> str:
    t = f"regexp_replace({t}, '(?i)<span[^>]*>[^\\n\\r\\x{{2028}}\\x{{2029}}]*?</span>', '', 'g')"
    t = f"""regexp_replace({t}, '(?is)<div[^>]*class=["'']?n rnp["'']?[^>]*>.*?</div>', '', 'g')"""
    return f"regexp_replace({t}, '(?i)<a[^>]*>([^\\n\\r\\x{{2028}}\\x{{2029}}]*?)</a>', '\\1', 'g')"


# The entities that the test tables hold; an ampersand is decoded last.
_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", "\u00a0"), ("&amp;", "&"))


def _decoded(t: str) -> str:
    for entity, sign in _ENTITIES:
        t = f"replace({t}, '{entity}', '{sign}')"
    return t


# Nodes from the top down, then the text of each list from the deepest level up.
_STATUTE = f"""WITH RECURSIVE s AS (SELECT row_id, id_norm, try_cast(html AS JSON) AS j FROM normas), s1 AS (SELECT row_id, id_norm, {problems.held('j')} AS j FROM s), s2 AS (SELECT row_id, id_norm, {problems.held('j')} AS j FROM s1),
n AS (
  SELECT row_id, '' AS list, e.key::INTEGER AS pos, 0 AS d, CASE WHEN json_type(e.value) = 'OBJECT' THEN e.value END AS node FROM s2, LATERAL json_each(s2.j) e WHERE json_type(s2.j) = 'ARRAY'
  UNION ALL
  SELECT n.row_id, n.list || '/' || n.pos, e.key::INTEGER, n.d + 1, CASE WHEN json_type(e.value) = 'OBJECT' THEN e.value END FROM n, LATERAL json_each(n.node -> 'h') e WHERE json_type(n.node -> 'h') = 'ARRAY'),
p AS (SELECT row_id, list, pos, d, CASE WHEN json_type(node -> 't') = 'VARCHAR' AND node ->> 't' <> '' THEN {_markup("(node ->> 't')")} || chr(10) ELSE '' END AS own, coalesce(json_type(node -> 'h') = 'ARRAY', false) AS has FROM n),
m AS (
  SELECT row_id, list, d, {_trim("string_agg(own || CASE WHEN has THEN chr(10) ELSE '' END, '' ORDER BY pos)")} AS t FROM p WHERE d = (SELECT max(d) FROM p) GROUP BY row_id, list, d
  UNION ALL
  SELECT p.row_id, p.list, p.d, {_trim("string_agg(p.own || CASE WHEN p.has THEN coalesce(m.t, '') || chr(10) ELSE '' END, '' ORDER BY p.pos)")}
  FROM p LEFT JOIN m ON m.row_id = p.row_id AND m.list = p.list || '/' || p.pos WHERE p.d = (SELECT max(d) FROM m) - 1 GROUP BY p.row_id, p.list, p.d),
r AS (SELECT s.row_id, s.id_norm, coalesce(m.t, '') AS markup FROM s LEFT JOIN m ON m.row_id = s.row_id AND m.list = '' AND m.d = 0)
SELECT row_id, id_norm, markup, {_decoded(_trim("regexp_replace(markup, '</?[^>]+(>|$)', '', 'g')"))} AS text FROM r"""


@query(_STATUTE)
def statute_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "normas").withColumn("s", html.statute_text(F.col("html"))).select("row_id", "id_norm", "s.markup", "s.text")


@query(
    """WITH RECURSIVE x AS (SELECT doc_id, text, greatest(1, ceil((length(text) - 80) / 720.0))::BIGINT AS k FROM documents)
SELECT doc_id, i AS chunk_index, k AS total_chunks, md5(substr(text, (i * 720 + 1)::BIGINT, 800)) AS h FROM (SELECT doc_id, text, k, unnest(range(k)) AS i FROM x)"""
)
def chunk_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of 800 characters, each repeating 80 of the one before."""
    k = F.greatest(F.lit(1), F.ceil((F.length("text") - 80) / F.lit(720.0))).cast("bigint")
    rows = table(spark, sf, "documents").select("doc_id", "text", k.alias("total_chunks")).withColumn("chunk_index", F.explode(F.sequence(F.lit(0), F.col("total_chunks") - 1)))
    return rows.select("doc_id", "chunk_index", "total_chunks", F.md5(F.col("text").substr((F.col("chunk_index") * 720 + 1).cast("int"), F.lit(800)).cast("binary")).alias("h"))


@query()
def chunk_recursive(spark: SparkSession, sf: str) -> DataFrame:
    return html.chunked(table(spark, sf, "documents").select("doc_id", "text"), "text")


@query()
def embed_text(spark: SparkSession, sf: str) -> DataFrame:
    return vectors.embed(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


_NONBLANK = f"length({_trim('text')}) > 0"


@query(f"SELECT doc_id, true AS numbered, true AS within, true AS whole FROM documents WHERE {_NONBLANK}")
def chunk_check(spark: SparkSession, sf: str) -> DataFrame:
    """What chunks must be, for each text that isn't blank: numbered without gaps, at most 800 units long, found in the text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    chunks = html.chunked(docs.withColumn("t", F.col("text")), "t")
    return chunks.groupBy("doc_id").agg(
        ((F.count_distinct("chunk_index") == F.count("*")) & (F.max("chunk_index") == F.count("*") - 1) & (F.max("total_chunks") == F.count("*"))).alias("numbered"),
        (F.max(S.utf16_length(F.col("chunk"))) <= 800).alias("within"),
        F.bool_and(F.col("text").contains(F.col("chunk"))).alias("whole"),
    )


@query(f"SELECT doc_id, true AS same FROM documents WHERE {_NONBLANK}")
def double_split(spark: SparkSession, sf: str) -> DataFrame:
    """Splitting the chunks once more changes nothing."""
    once = html.chunked(table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", F.col("chunk_index").alias("first"), F.col("chunk").alias("text"), F.col("chunk").alias("was"))
    twice = html.chunked(once, "text")
    return twice.groupBy("doc_id").agg(F.bool_and((F.col("chunk") == F.col("was")) & (F.col("total_chunks") == 1)).alias("same"))


def _indexed(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", F.struct("id", "collection", "lang", "source").alias("metadata"))
    return vectors.points(html.chunked(docs, "text"), "doc_id", "chunk_index", "chunk", metadata="metadata", stamp=F.timestamp_seconds(F.lit(0)))


@query()
def index_points(spark: SparkSession, sf: str) -> DataFrame:
    """Every chunk of every document with its vector and a payload that has the document's metadata."""
    return _indexed(spark, sf)


@query(f"SELECT doc_id, id, collection, source, '1970-01-01T00:00:00.000Z' AS stamp, true AS own, true AS unit FROM documents WHERE {_NONBLANK}")
def index_check(spark: SparkSession, sf: str) -> DataFrame:
    """What points must be, for each document: distinct ids, vectors of length 1 (0 for texts without words), the document's metadata."""
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    p = F.col("payload")
    return _indexed(spark, sf).groupBy("doc_id", p["id"].alias("id"), p["collection"].alias("collection"), p["source"].alias("source"), p["timestamp"].alias("stamp")).agg(
        ((F.count_distinct("point_id") == F.count("*")) & (F.max(p["total_chunks"]) == F.count("*")) & (F.max(p["doc_id"]) == F.col("doc_id").cast("string"))).alias("own"), F.bool_and((F.abs(norm - 1) < 1e-5) | (norm == 0)).alias("unit")
    )


@query("SELECT label AS namespace, count(*) AS n, count(*) FILTER (len(embedding) <> 64) AS wrong_dim FROM embeddings GROUP BY label")
def upsert_namespaces(spark: SparkSession, sf: str) -> DataFrame:
    """Points written to a collection by namespace, twice, and counted; each namespace is a partition."""
    path = f"{shared_folder(spark)}/collection"
    new = table(spark, sf, "embeddings").select(F.col("vec_id").cast("string").alias("point_id"), F.col("embedding").alias("vector"), F.col("label").alias("namespace"))
    for _ in range(2):
        vectors.upsert(new, path, dim=64, namespace="namespace")
    return spark.read.parquet(f"{path}/points").groupBy("namespace").agg(F.count("*").alias("n"), F.count_if(F.size("vector") != 64).alias("wrong_dim"))


@query("SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"))


@query("WITH x AS (SELECT feed_id, file_no, CASE WHEN json_valid(payload) THEN json_type(CASE WHEN json_valid(payload) THEN payload ELSE '0' END) = 'OBJECT' ELSE false END AS ok FROM archivos) SELECT feed_id, file_no, count(*) FILTER (ok) AS good, count(*) FILTER (NOT ok) AS bad FROM x GROUP BY feed_id, file_no")
def bad_records(spark: SparkSession, sf: str) -> DataFrame:
    """Well-formed payloads and the others, for each landed file."""
    good = F.coalesce(F.schema_of_variant(F.try_parse_json("payload")).startswith("OBJECT"), F.lit(False))
    return table(spark, sf, "archivos").groupBy("feed_id", "file_no").agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"))


@query("SELECT row_id, coalesce(nullif(try_cast(nullif(regexp_extract(rol, '^\\s*([+-]?\\d+)', 1), '') AS BIGINT), 0), 1) AS n FROM (SELECT row_id, regexp_replace(coalesce(rol_era_sup_s, rol_era_ape_s), '^[A-Z]-', '') AS rol FROM sentencias)")
def parse_roles(spark: SparkSession, sf: str) -> DataFrame:
    rol = F.regexp_replace(F.coalesce("rol_era_sup_s", "rol_era_ape_s"), "^[A-Z]-", "")
    return table(spark, sf, "sentencias").select("row_id", S.parse_int(rol, 1).alias("n"))


@query("SELECT row_id, (length(t) + length(regexp_replace(t, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')))::BIGINT AS units FROM (SELECT row_id, texto_sentencia AS t FROM sentencias)")
def text_units(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "sentencias").select("row_id", S.utf16_length(F.col("texto_sentencia")).alias("units"))


@query("SELECT event_id, floor(value + 0.5)::BIGINT AS rounded FROM events")
def round_values(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", S.js_round(F.col("value")).alias("rounded"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_Q, **{f.__name__: f for f in problems.QUERIES}}


def oracle_sql() -> dict[str, str]:
    return {**_SQL, **problems.SQL}
