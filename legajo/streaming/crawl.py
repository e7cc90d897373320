"""Resumable crawls with Structured Streaming: each run takes what is new, commits after its sinks, and can be repeated."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legajo.functions.scalars import is_blank, is_critical
from legajo.operators import facets, html, metrics, projections, vectors
from legajo.operators.dedup import insert_if_absent
from legajo.session import drop_folder, materialise, shared_folder
from legajo.sources import landed

STATUTE = "metadatos struct<tipos_numeros:array<struct<compuesto:string>>,titulo_norma:string,fecha_publicacion:string,fecha_promulgacion:string,tipo_version_s:string,fuente:string,organismos:array<string>,vigencia:struct<inicio_vigencia:string,fin_vigencia:string>>, html string"


def statutes(answers: DataFrame) -> DataFrame:
    """Answers (id, body) as statutes: row_id, id_norm, metadatos, html (JSON text), markup, text."""
    doc = F.from_json("body", STATUTE)
    rows = answers.select(F.col("id").alias("row_id"), F.col("id").alias("id_norm"), doc.alias("d")).select("row_id", "id_norm", "d.metadatos", "d.html")
    return rows.withColumn("s", html.statute_text(F.col("html"))).select("row_id", "id_norm", "metadatos", "html", "s.markup", "s.text")


def store(answers: DataFrame, out: str, model: vectors.Model | None = None, batch: int = 0) -> None:
    """Write one batch of answers to the tables documents, points, facets and errors below ``out``.

    Every write leaves out what is there already, so a batch that is repeated after a failure changes nothing. Points follow
    from the documents and not from what was inserted, so that a lost write of points is made up for. The facets of a batch
    are those of the documents it brought, in a partition of its own; :func:`facet_table` adds them up.
    """
    spark = answers.sparkSession
    valid = statutes(answers.filter("error is null and body is not null")).filter("metadatos is not null").persist()
    meta = projections.statute_metadata(valid).join(valid.select(F.col("id_norm").alias("idNorm"), "markup", "text"), "idNorm")
    insert_if_absent(meta.withColumns({"id": F.col("idNorm").cast("string"), "batch": F.lit(batch)}), f"{out}/documents", ["id"], order="idNorm")
    shown = F.struct(*(c for c in meta.columns if c not in ("markup", "text")))
    chunks = html.chunked(meta.select(F.col("idNorm").alias("doc_id"), "text", shown.alias("metadata")), "text")
    insert_if_absent(vectors.points(chunks, "doc_id", "chunk_index", "chunk", model, metadata="metadata"), f"{out}/points", ["point_id"])
    brought = spark.read.parquet(f"{out}/documents").filter(F.col("batch") == batch).select(F.col("idNorm").alias("id_norm"))
    facets.statute_facets(valid.join(brought, "id_norm", "left_semi")).write.mode("overwrite").parquet(f"{out}/facets/batch={batch}")
    # A failed write of a batch is repeated with the same ids and messages: one error row for each.
    wrong = answers.join(valid.select(F.col("row_id").alias("id")), "id", "left_anti").select("id", F.coalesce("error", F.lit("not a statute")).alias("message"))
    insert_if_absent(wrong.withColumn("at", F.current_timestamp()), f"{out}/errors", ["id", "message"])
    valid.unpersist()


def facet_table(spark: SparkSession, out: str) -> DataFrame:
    """The facets of all batches of a crawl: facet, value, n, first_seen."""
    return spark.read.parquet(f"{out}/facets").groupBy("facet", "value").agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))


def crawl_ids(spark: SparkSession, out: str, checkpoint: str, model: vectors.Model | None = None, every: str = "0 seconds", **options: object) -> int:
    """Run an id crawl until its source has nothing new; returns the number of micro-batches.

    The checkpoint holds the next id. It moves on only after all sinks have written, and a run after a crash repeats the last
    batch. Options are those of the source ``id_crawl``; without ``stop`` a run ends when ``budget`` (100) answers in a row
    were no statutes. ``every`` is the time from one micro-batch to the next.
    """
    landed.register(spark)
    given = {"valid": "legajo.sources.landed:statute_answer", **{k: str(v) for k, v in options.items()}}
    stream = spark.readStream.format("id_crawl").options(**given).load()
    batches: list[int] = []

    def sink(df: DataFrame, number: int) -> None:
        df = df.persist()
        try:
            if not df.isEmpty():
                store(df, out, model, number)
                batches.append(number)
        finally:
            df.unpersist()

    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return len(batches)


def crawl_pages(spark: SparkSession, out: str, bases: list[str], round_pages: int = 20, budget: int = 10, **options: object) -> dict[str, int]:
    """Read the result pages of all bases side by side, ``round_pages`` of each at a time, and insert the rulings that are absent.

    An id is known if any base has brought it before. A base ends at its last page, or at the first page at whose end ``budget``
    rulings in a row were known (0: never); a failed page has a row in ``errors`` and the base goes on. Returns how many
    rulings were added for each base.
    """
    landed.register(spark)
    added = dict.fromkeys(bases, 0)
    run = dict.fromkeys(bases, 0)
    size = int(options.get("page_size", 50))
    folder = shared_folder(spark)
    active, first = list(bases), 0
    while active:
        source = spark.read.format("page_crawl").options(bases=",".join(active), first_page=first, pages=round_pages, **{k: str(v) for k, v in options.items()})
        pages = materialise(source.load(), folder, f"pages-{first}")
        rows = pages.filter("doc is not null").select("base", "offset", "place", F.get_json_object("doc", "$.id").alias("id"), F.col("doc").alias("content"))
        known = rows.filter("id is not null").select("id").distinct()
        try:
            known = known.join(spark.read.parquet(f"{out}/documents").select("id").distinct(), "id", "left_semi")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            known = known.limit(0)
        # Windows hold the pages of one base and round, or the rows of one id among them.
        ahead = Window.partitionBy("id").orderBy("base", "offset", "place")
        order = Window.partitionBy("base").orderBy("offset", "place")
        carried = F.create_map(*(F.lit(x) for b in active for x in (b, run[b])))[F.col("base")]
        seen = rows.join(known.withColumn("known", F.lit(True)), "id", "left").withColumn("bad", F.col("id").isNull() | F.col("known").isNotNull() | ((F.row_number().over(ahead) > 1) & F.col("id").isNotNull()))
        seen = seen.withColumn("good", F.sum((~F.col("bad")).cast("int")).over(order))
        seen = seen.withColumn("run", F.sum(F.col("bad").cast("int")).over(Window.partitionBy("base", "good").orderBy("offset", "place")) + F.when(F.col("good") == 0, carried).otherwise(0))
        seen = materialise(seen.select("base", "offset", "place", "id", "content", "run"), folder, f"seen-{first}")
        ends = seen.groupBy("base", "offset").agg(F.max_by("run", "place").alias("run"))
        stops = {r.base: r.offset for r in ends.filter(F.col("run") >= budget).groupBy("base").agg(F.min("offset").alias("offset")).collect()} if budget else {}
        for r in ends.groupBy("base").agg(F.max_by("run", "offset").alias("run")).collect():
            run[r.base] = r.run
        over = {r.base for r in pages.filter("place = -1").select("base").distinct().collect()}
        until = F.create_map(*(F.lit(x) for b in active for x in (b, stops.get(b, (first + round_pages) * size))))[F.col("base")]
        taken = seen.filter(F.col("id").isNotNull() & (F.col("offset") <= until)).withColumn("nth", F.struct("base", "offset", "place"))
        # Counted by base before the write: what is absent is known.
        fresh = materialise(taken.filter("run = 0").groupBy("id").agg(F.min_by(F.struct(F.col("base").alias("collection"), "content"), "nth").alias("r")).select("r.collection", "id", "r.content"), folder, f"fresh-{first}")
        counts = {r.collection: r["count"] for r in fresh.groupBy("collection").count().collect()}
        insert_if_absent(fresh, f"{out}/documents", ["id"])
        for b, n in counts.items():
            added[b] += n
        wrong = pages.filter("error is not null").select("base", "offset", F.col("error").alias("message"))
        insert_if_absent(wrong.withColumn("at", F.current_timestamp()), f"{out}/errors", ["base", "offset", "message"])
        active = [b for b in active if b not in stops and b not in over]
        first += round_pages
    drop_folder(spark, folder)
    return added


def index_directory(spark: SparkSession, folder: str, out: str, checkpoint: str, done: str | None = None, text_field: str = "documento_completo", id_field: str = "doc_id", model: vectors.Model | None = None, collection: str = "contraloria") -> DataFrame:
    """Index the JSON files of a directory that no earlier run has taken; returns one row of figures for each micro-batch.

    A file holds one document, as it is or as the ``_source`` of a hit. Files that aren't JSON, have no id or a blank text go
    to ``<out>/errors`` with their content, metadata, collection, time, and what was wrong; the others to ``documents``, if
    their id is absent there, and to ``points``, with the document's other members. With ``done`` the stream moves files there
    after the batch that follows theirs; what went wrong is kept in ``errors``.
    """
    source = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.json")
    if done:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", done)
    files = source.load(folder).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"), "value")

    def sink(df: DataFrame, number: int) -> None:
        began = metrics.clock()
        body = F.coalesce(F.get_json_object("value", "$._source"), F.when(F.try_parse_json("value").isNotNull(), F.col("value")))
        other = F.map_filter(F.coalesce(F.from_json(body, "map<string,string>"), F.create_map().cast("map<string,string>")), lambda k, v: k != text_field)
        rows = df.select("name", "value", F.get_json_object(body, f"$.{id_field}").alias("id"), F.get_json_object(body, f"$.{text_field}").alias("text"), body.alias("content"), other.alias("metadata")).persist()
        try:
            good = rows.filter(F.col("id").isNotNull() & ~is_blank(F.col("text")))
            message = F.when(F.col("content").isNull(), "not JSON").when(F.col("id").isNull(), "no id").otherwise("blank text")
            bad = rows.join(good.select("name"), "name", "left_anti").select("name", "value", message.alias("message"), F.struct(F.lit("ValueError").alias("kind"), message.alias("message"), is_critical(message).alias("critical")).alias("error"), F.to_json("metadata").alias("metadata"), F.lit(collection).alias("collection"), F.current_timestamp().alias("at"))
            added = insert_if_absent(good.select("id", "content", "text", "name"), f"{out}/documents", ["id"], order="name")
            embedding = metrics.clock()
            chunks = html.chunked(good.select(F.col("id").alias("doc_id"), "text", "metadata"), "text")
            points = insert_if_absent(vectors.points(chunks, "doc_id", "chunk_index", "chunk", model, metadata="metadata"), f"{out}/points", ["point_id"])
            ended = metrics.clock()
            insert_if_absent(bad, f"{out}/errors", ["name"])
            total, wrong = rows.count(), bad.count()
            figures = spark.createDataFrame(
                [(number, total, int(added), total - added - wrong, wrong, int(points), ended - embedding, metrics.clock() - began)],
                "batch bigint, files bigint, success bigint, duplicates bigint, errors bigint, points bigint, embed_ms bigint, total_ms bigint",
            )
            insert_if_absent(figures, f"{out}/batches", ["batch"])
        finally:
            rows.unpersist()

    query = files.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{out}/batches")
