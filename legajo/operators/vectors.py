"""Embeddings and search."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legajo.functions.scalars import cosine, iso_stamp
from legajo.operators.dedup import insert_if_absent

Model = Callable[[list[str]], list[list[float]]]
#: Scores that a task of a search holds at a time.
CELLS = 1 << 22


def hash_model(dim: int = 64) -> Model:
    """An offline stand-in for an embedding service: signed counts of hashed words, scaled to length 1."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = np.zeros((len(texts), dim), np.float32)
        for k, text in enumerate(texts):
            for word in text.lower().split():
                h = xxhash.xxh3_64_intdigest(word)
                out[k, h % dim] += 1.0 if h >> 63 else -1.0
            n = float(np.sqrt((out[k] ** 2).sum()))
            if n:
                out[k] /= n
        return out.tolist()

    return embed


def embed(df: DataFrame, text_col: str, model: Model | None = None, batch: int = 128, out_col: str = "vector", warm: str | None = None) -> DataFrame:
    """df with the vector of each text. The model gets ``batch`` texts at once; where a batch fails, its texts go one by one.

    A text that fails alone has a null vector, as have null texts; an empty text has what the model gives for it. With ``warm``
    each task calls the model once before the first batch and passes over what goes wrong there.
    """
    call = model or hash_model()

    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(texts: list[str]) -> list:
            try:
                found = call(texts)
                if len(texts) == 1 and found and not isinstance(found[0], (list, tuple)):
                    found = [found]
                if len(found) != len(texts):
                    raise ValueError("the model gave another number of vectors")
                return list(found)
            except Exception:
                if len(texts) > 1:
                    return [v for t in texts for v in one([t])]
                return [None]

        if warm is not None:
            one([warm])
        for part in parts:
            texts = part.tolist()
            at = [k for k, t in enumerate(texts) if t is not None]
            out: list = [None] * len(texts)
            for lo in range(0, len(at), batch):
                some = at[lo : lo + batch]
                for k, v in zip(some, one([texts[k] for k in some])):
                    out[k] = v
            yield pd.Series(out)

    udf = F.pandas_udf(vectors, "array<float>")
    return df.withColumn(out_col, udf(F.col(text_col)))


def search(points: DataFrame, query: list[float], k: int = 5, threshold: float = 0.7, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k points most similar to a vector, none below the threshold; ties go to the lower id. Vectors are not returned."""
    q = F.array(*(F.lit(float(x)) for x in query))
    scored = points.withColumn("score", F.round(cosine(F.col(vector_col), q), 4)).drop(vector_col)
    return scored.filter(F.col("score") >= threshold).orderBy(F.desc("score"), id_col).limit(k)


def _kept(ids: np.ndarray, held: tuple[np.ndarray, np.ndarray], pid: np.ndarray, sim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of each query among those held and new ones; ties go to the lower id."""
    score = np.concatenate([held[0], sim], axis=1)
    point = np.concatenate([held[1], np.broadcast_to(pid, sim.shape)], axis=1)
    if score.shape[1] > k:
        # All that reach the k-th best score, in order of score and id.
        least = np.partition(score, score.shape[1] - k, axis=1)[:, -k, None]
        width = max(k, int((score >= least).sum(axis=1).max()))
        some = np.argpartition(-score, width - 1, axis=1)[:, :width] if width < score.shape[1] else np.broadcast_to(np.arange(score.shape[1]), score.shape)
        score, point = np.take_along_axis(score, some, 1), np.take_along_axis(point, some, 1)
        best = np.lexsort((point, -score), axis=1)[:, :k]
        score, point = np.take_along_axis(score, best, 1), np.take_along_axis(point, best, 1)
    return score, point


def search_many(points: DataFrame, queries: DataFrame, k: int = 5, threshold: float = 0.7, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 1024) -> DataFrame:
    """(query_id, id, score, rank): for each query its k nearest other points, by exact comparison in blocks.

    A task multiplies its points, by CELLS scores at a time, with a block of the queries and keeps k for each query all along, so
    that it hands on k rows for each query at most and holds little more than CELLS scores. The query set is read by the driver
    in blocks of a fixed size, each shipped on its own. Ties go to the lower id. Points of another dimension than the block's
    queries are compared with none of them; :func:`wrong_dimension` counts them.
    """
    out = None
    rows: list = []

    def scan(block_rows: list) -> DataFrame:
        ids = np.array([r[0] for r in block_rows], np.int64)
        matrix = np.array([r[1] for r in block_rows], np.float64)
        norm = np.linalg.norm(matrix, axis=1, keepdims=True)
        matrix = np.divide(matrix, norm, out=np.zeros_like(matrix), where=norm > 0)
        step = max(1, CELLS // len(ids))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.zeros((len(ids), 0)), np.zeros((len(ids), 0), np.int64)
            for batch in batches:
                for lo in range(0, batch.num_rows, step):
                    part = batch.slice(lo, step)
                    pid = part.column("i").to_numpy(zero_copy_only=False)
                    v = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(pid), -1)
                    n = np.linalg.norm(v, axis=1)
                    sim = np.round((matrix @ v.T) / np.where(n > 0, n, np.inf), 4)
                    sim[(ids[:, None] == pid[None, :]) | ~(sim >= threshold)] = -np.inf
                    held = _kept(ids, held, pid, sim, k)
            ok = held[0] > -np.inf
            q = np.broadcast_to(ids[:, None], ok.shape)
            yield pa.RecordBatch.from_arrays([pa.array(q[ok]), pa.array(held[1][ok]), pa.array(held[0][ok])], ["query_id", "i", "score"])

        src = points.filter(F.col(id_col).isNotNull() & (F.size(vector_col) == matrix.shape[1]) & ~F.exists(vector_col, lambda x: x.isNull())).select(F.col(id_col).cast("bigint").alias("i"), F.col(vector_col).cast("array<double>").alias("v"))
        return src.mapInArrow(run, "query_id bigint, i bigint, score double")

    dim = None
    for r in queries.select(id_col, vector_col).filter(F.col(vector_col).isNotNull()).toLocalIterator():
        if rows and (len(rows) == block or len(r[1]) != dim):
            part = scan(rows)
            out, rows = part if out is None else out.unionByName(part), []
        dim = len(r[1])
        rows.append(r)
    if rows or out is None:
        part = scan(rows) if rows else points.sparkSession.createDataFrame([], "query_id bigint, i bigint, score double")
        out = part if out is None else out.unionByName(part)
    # k rows for each query and task; ranked by a window that drops the rest before the shuffle's result is kept.
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "i")
    best = out.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("i").alias(id_col), "score", "rank")


def wrong_dimension(points: DataFrame, dim: int, vector_col: str = "embedding") -> DataFrame:
    """(points, wrong): how many points there are, and how many have another dimension or no vector."""
    return points.agg(F.count("*").alias("points"), F.count_if(F.coalesce(F.size(vector_col), F.lit(-1)) != dim).alias("wrong"))


def search_text(points: DataFrame, text: str, model: Model | None = None, **options: object) -> DataFrame:
    """The points most similar to a text, by the model that made their vectors. Options as for ``search``."""
    return search(points, [float(x) for x in (model or hash_model())([text])[0]], **options)


def points(chunks: DataFrame, doc_col: str, index_col: str, text_col: str, model: Model | None = None, metadata: str | None = None, stamp: Column | None = None, warm: str | None = None) -> DataFrame:
    """Chunks as points: point_id, vector, doc_id, payload.

    The id follows from document and place, so that writing a point again changes nothing. The payload has the members of the
    struct or map column ``metadata``, then doc_id, text, chunk_index, total_chunks and timestamp, which win over members of
    these names. ``stamp`` is the time that is told (now), ``warm`` a text that wakes the model.
    """
    own = {
        "doc_id": F.col(doc_col).cast("string"),
        "text": F.col(text_col),
        "chunk_index": F.col(index_col),
        "total_chunks": F.col("total_chunks") if "total_chunks" in chunks.columns else F.lit(None).cast("int"),
        "timestamp": iso_stamp(stamp if stamp is not None else F.current_timestamp()),
    }
    if metadata and chunks.schema[metadata].dataType.typeName() == "map":
        rest = F.map_filter(F.coalesce(F.col(metadata), F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*own))
        payload = F.map_concat(rest, F.create_map(*(x for n, c in own.items() for x in (F.lit(n), c.cast("string")))))
    else:
        given = [F.col(metadata)[n].alias(n) for n in chunks.schema[metadata].dataType.names if n not in own] if metadata else []
        payload = F.struct(*given, *(c.alias(n) for n, c in own.items()))
    made = embed(chunks, text_col, model, warm=warm)
    key = F.sha2(F.concat_ws(":", F.col(doc_col).cast("string"), F.col(index_col).cast("string")), 256)
    return made.select(key.alias("point_id"), "vector", F.col(doc_col).alias("doc_id"), payload.alias("payload"))


def ensure_collection(spark: SparkSession, path: str, dim: int, metric: str = "cosine", quantised: bool = True) -> dict:
    """The properties of a collection of points, written if there are none yet; those that are there win."""
    where = f"{path}/_collection"
    try:
        return json.loads(spark.read.text(where, wholetext=True).first()[0])
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    spec = {"dim": dim, "metric": metric, "quantised": quantised}
    spark.createDataFrame([(json.dumps(spec),)], "value string").coalesce(1).write.mode("overwrite").text(where)
    return spec


def upsert(new: DataFrame, path: str, dim: int | None = None, slice_rows: int = 200, namespace: str | None = None) -> dict:
    """Write points that a collection lacks, in files of ``slice_rows`` points at most; the first failure ends the job.

    Points without a vector are left out. Points of another dimension than the collection's are stored, as the check only
    warns, and counted. ``namespace`` is a column by which the table is laid out. Returns {added, wrong_dim}.
    """
    spec = ensure_collection(new.sparkSession, path, dim or 1024)
    wrong = F.size("vector") != spec["dim"]
    added = insert_if_absent(new.filter(F.col("vector").isNotNull()), f"{path}/points", ["point_id"], partition=namespace, rows_per_file=slice_rows, told={"wrong_dim": wrong})
    return {"added": int(added), **added.told}
