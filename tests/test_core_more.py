"""Inserts, collections, searches with ties, sparse logs, and the shared folder."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from legajo import session
from legajo.operators import dedup, metrics, runstate, vectors


def test_inserts_by_order_and_null_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 3, "late"), ("a", 1, "first"), (None, 2, "x"), ("b", 5, None)], "id string, at int, v string")
    added = dedup.insert_if_absent(df, path, ["id"], order="at")
    assert (added, added.rejected()) == (2, 1)
    for _ in range(2):
        assert dedup.insert_if_absent(df, path, ["id"], order="at") == 0
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1, "first"), ("b", 5, None)]
    assert dedup.insert_if_absent(df.limit(0), path, ["id"]) == 0


def test_ties_go_to_the_lower_id(spark):
    rows = [(20 - k, [1.0, 0.0]) for k in range(20)] + [(50, [0.0, 1.0]), (51, [1.0]), (None, [1.0, 0.0]), (52, None), (53, [1.0, None])]
    pts = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    ask = spark.createDataFrame([(0, [2.0, 0.0]), (5, [1.0, 0.0])], "vec_id bigint, embedding array<double>")
    got = [(r.query_id, r.vec_id, r["rank"]) for r in vectors.search_many(pts.repartition(3), ask, 3).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (5, 1, 1), (5, 2, 2), (5, 3, 3)]
    assert tuple(vectors.wrong_dimension(pts, 2).first()) == (25, 2)


def test_running_best_is_exact():
    rng = np.random.default_rng(2)
    for k in (1, 3, 40):
        sim = np.round(rng.random((5, 60)), 1)
        pid = rng.permutation(60)
        held = np.zeros((5, 0)), np.zeros((5, 0), np.int64)
        for lo in range(0, 60, 7):
            held = vectors._kept(np.arange(5), held, pid[lo : lo + 7], sim[:, lo : lo + 7], k)
        for q in range(5):
            want = sorted(zip(-sim[q], pid))[:k]
            assert list(zip(-held[0][q], held[1][q])) == want


def test_sparse_orders(spark):
    rng = np.random.default_rng(3)
    ids = sorted({int(x) for x in rng.integers(-(1 << 62), 1 << 62, 300)})
    bad = rng.random(len(ids)) < 0.6
    df = spark.createDataFrame(list(zip(ids, map(bool, bad))), "i bigint, bad boolean")
    got = {r.i: (r.rn, r.run) for r in runstate.failures(runstate.ranked(df, "i", 16), "i", F.col("bad"), 16).collect()}
    run = 0
    for k, (i, b) in enumerate(zip(ids, bad)):
        run = run + 1 if b else 0
        assert got[i] == (k + 1, run)
    chunks = runstate._chunked(df, "i", 16).select("_chunk").distinct().count()
    assert 10 <= chunks <= 20
    assert runstate.ranked(df.limit(0), "i").count() == 0


def test_collection(spark, tmp_path):
    path = str(tmp_path / "c")
    assert vectors.ensure_collection(spark, path, 2) == {"dim": 2, "metric": "cosine", "quantised": True}
    assert vectors.ensure_collection(spark, path, 9)["dim"] == 2
    new = spark.createDataFrame([("a", [1.0, 2.0], "n"), ("b", [1.0], "m"), ("c", None, "n")], "point_id string, vector array<double>, ns string")
    assert vectors.upsert(new, path, namespace="ns") == {"added": 2, "wrong_dim": 1}
    assert vectors.upsert(new, path, namespace="ns") == {"added": 0, "wrong_dim": 0}
    assert spark.read.parquet(f"{path}/points").filter("ns = 'm'").count() == 1


def test_payload_of_a_map_and_of_a_struct(spark):
    chunks = spark.createDataFrame([(7, 0, 1, "t", {"text": "old", "court": "x"}, ("o", "y"))], "d bigint, chunk_index int, total_chunks int, chunk string, m map<string,string>, s struct<doc_id:string,court:string>")
    by_map = vectors.points(chunks, "d", "chunk_index", "chunk", metadata="m").first().payload
    by_struct = vectors.points(chunks, "d", "chunk_index", "chunk", metadata="s", stamp=F.timestamp_seconds(F.lit(0))).first().payload
    assert (by_map["text"], by_map["court"], by_map["doc_id"], by_map["total_chunks"]) == ("t", "x", "7", "1")
    assert by_struct.asDict() == {"court": "y", "doc_id": "7", "text": "t", "chunk_index": 0, "total_chunks": 1, "timestamp": "1970-01-01T00:00:00.000Z"}


def test_warm_up_and_its_failure(spark):
    df = spark.createDataFrame([("a",), ("warm",)], "t string")

    def model(texts):
        if texts == ["warm"]:
            raise RuntimeError("cold")
        return [[float(len(t))] for t in texts]

    assert [r.v for r in vectors.embed(df.coalesce(1), "t", model, warm="warm", out_col="v", batch=1).collect()] == [[1.0], None]


def test_reports(spark):
    b = spark.createDataFrame([(1, 10, 30, 100, 2000), (2, 10, 50, 300, 0)], "b int, docs int, chunks int, e int, ms int")
    got = metrics.batch_report(b, "b", "docs", "chunks", "e", "ms").orderBy("batch").collect()
    assert [tuple(r) for r in got] == [(1, 10, 30, 5.0, 5.0, 3.0, 10.0, 2.0), (2, 20, 80, None, 10.0, 4.0, 20.0, 0.0)]
    r = spark.range(1).select(*metrics.run_report(F.lit(90), F.lit(5), F.lit(5), F.lit(60.0), F.lit(6000))).first()
    assert tuple(r) == (100, 90.0, 100.0, "excellent", 1.0)


def test_shared_folder_on_a_cluster_needs_its_setting(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match=r"spark\.checkpoint\.dir"):
        session.shared_folder(Session())
    assert "legajo-" in session.shared_folder(spark)


def test_row_form_sizes(spark):
    from legajo.operators import projections

    df = spark.createDataFrame([("1", "é\U0001f4ce\n", None)], "id string, t string, x string")
    r = projections.row_form(df, "id", F.lit("c"), F.struct("id", "t", "x"), F.struct("id")).first()
    doc = json.dumps({"id": "1", "t": "é\U0001f4ce\n", "x": None}, ensure_ascii=False, separators=(",", ":"))
    assert (r.content, r.file_size, r.filename, r.metadata) == (doc, len(doc.encode("utf-16-le")) // 2, "1.json", '{"id":"1"}')
