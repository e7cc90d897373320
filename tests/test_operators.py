import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from legajo.operators import dedup, facets, html, projections, runstate, vectors

RULING = "id string, base string, url_corta_acceso_sentencia string, rol_era_sup_s string, rol_era_ape_s string, caratulado_s string, gls_juez_ss string, gls_materia_s string, gls_materia_ss array<string>, era_sup_i int, base_extra string"


def test_ruling_metadata(spark):
    rows = [
        ("1", "PENAL", None, "R1", "A1", "c", '["x","y"]', "m", None, 3, "k"),
        ("2", "corte_de_apelaciones", "u", "R2", "A2", None, None, "m", ["z"], None, "k"),
        ("3", "desconocida", "u", None, None, None, "", None, None, 0, "k"),
        ("4", None, None, None, None, None, "j", None, None, None, None),
    ]
    out = {r.idSentence: r for r in projections.ruling_metadata(spark.createDataFrame(rows, RULING)).collect()}
    assert (out["1"].rol, out["1"].juez, out["1"].materia, out["1"].era, out["1"].url) == ("R1", ["x", "y"], [], None, "")
    assert (out["2"].rol, out["2"].categorizacion, out["2"].era, out["2"].juez) == ("A2", ["m"], 0, None)
    assert (out["3"].rol, out["3"].juez, out["3"].materia) == ("", [], None)
    assert out["4"].juez == ["j"]
    assert projections.ruling_metadata(spark.createDataFrame([], RULING)).count() == 0


def test_hit_metadata(spark):
    own = json.dumps({"documento_completo": "long", "a": 1, "idSentence": "own"})
    rows = [(1, "d1", own), (2, "d2", json.dumps(own)), (3, "d3", "{broken"), (4, None, None)]
    out = projections.hit_metadata(spark.createDataFrame(rows, "row_id int, doc_id string, _source string"), keep=("row_id",)).orderBy("row_id").collect()
    assert [r.idSentence for r in out] == ["own", "own", "d3", None]
    assert out[0].fields == {"a": "1"} == out[1].fields
    assert out[2].fields == {} == out[3].fields


def test_dedup(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "id string, n int")
    old = spark.createDataFrame([("a",), (None,)], "id string")
    assert sorted((r.id or "", r.n) for r in dedup.absent(new, old, "id").collect()) == [("", 3), ("b", 2)]
    assert sorted(r.n for r in dedup.present(new, old, "id").collect()) == [1, 4]
    assert sorted(r.n for r in dedup.first_arrivals(new, "id", "n").collect()) == [1, 2, 3]


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "id string, n int")
    assert dedup.insert_if_absent(df, path, ["id"]) == 2
    assert dedup.insert_if_absent(df.unionByName(spark.createDataFrame([("c", 1)], df.schema)), path, ["id"]) == 1
    assert dedup.insert_if_absent(df, path, ["id"]) == 0


META = "row_id bigint, id_norm bigint, metadatos struct<tipos_numeros:array<struct<compuesto:string>>,titulo_norma:string,fecha_publicacion:string,fecha_promulgacion:string,tipo_version_s:string,fuente:string,organismos:array<string>,vigencia:struct<inicio_vigencia:string,fin_vigencia:string>>"


def test_facets_tolerate_missing_members(spark):
    rows = [(2, 7, ([("L 1",), (None,)], "t", None, "", None, "f", ["o", "o"], None)), (1, 8, (None, "t", None, None, None, None, [], ("a", None))), (3, 9, None)]
    out = {(r.facet, r.value): (r.n, r.first_seen) for r in facets.statute_facets(spark.createDataFrame(rows, META)).collect()}
    assert out["titulo_norma", "t"] == (2, 1)
    assert out["organismos", "o"] == (2, 2)
    assert out["compuesto", ""] == (1, 2)
    assert out["inicio_vigencia", ""] == (1, 2)
    assert ("id", "9") not in out
    lists = {r.facet: r["values"] for r in facets.lists(facets.statute_facets(spark.createDataFrame(rows, META))).collect()}
    assert lists["id"] == ["8", "7"]


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_failures_across_chunks(spark, chunk):
    rng = random.Random(chunk)
    bad = [rng.random() < 0.7 for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(bad)), "k bigint, bad boolean")
    want, run = [], 0
    for b in bad:
        run = run + 1 if b else 0
        want.append(run)
    got = runstate.failures(df, "k", F.col("bad"), chunk).orderBy("k").collect()
    assert [r.run for r in got] == want
    ranks = runstate.ranked(df.filter("k % 3 != 1"), "k", chunk).orderBy("k").collect()
    assert [r.rn for r in ranks] == list(range(1, len(ranks) + 1))


def test_stop_page(spark):
    df = spark.createDataFrame([(k, k not in (3, 4)) for k in range(9)], "k bigint, bad boolean")
    assert [tuple(r) for r in runstate.stop_page(df, "k", F.col("bad"), 3, 3).orderBy("page_no").collect()] == [(0, 3), (2, 4)]


def node(t=None, h=None):
    return {k: v for k, v in (("t", t), ("h", h)) if v is not None}


def test_statute_markup():
    nodes = [node("<p>a<span>x</span></p>", [node("<a>b</a>"), None, node(h=[])]), node(), "s"]
    assert html.merged(nodes) == "<p>a</p>\nb"
    assert html.merged(None) == "" == html.merged("x")
    assert html.plain_text("<p>\u00a0x &amp; &lt;b&gt;&nbsp;</p> <tag") == "x & <b>\u00a0"
    assert html.plain_text(None) == ""


def test_statute_text_column(spark):
    nested = json.dumps([node("<b>x</b>")])
    df = spark.createDataFrame([(1, nested), (2, json.dumps(nested)), (3, "{"), (4, None)], "k int, j string")
    assert [r.text for r in df.select("k", html.statute_text(F.col("j"))["text"].alias("text")).orderBy("k").collect()] == ["x", "x", "", ""]


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab \n\U0001f4ce"), max_size=400))
def test_recursive_chunks(text):
    chunks = html.recursive_chunks(text, 50, 8)
    assert all(0 < html._units(c) <= 50 and c == c.strip() for c in chunks)
    if text.strip() and html._units(text) <= 50:
        assert len(chunks) == 1
    solid = lambda s: [c for c in s if not c.isspace()]
    assert len(solid("".join(chunks))) >= len(solid(text))
    assert set(solid(text)) == set(solid("".join(chunks)))


def test_chunked_numbers_pieces(spark):
    df = spark.createDataFrame([(1, "ab " * 500), (2, " "), (3, None)], "d int, t string")
    out = html.chunked(df, "t").orderBy("chunk_index").collect()
    assert {r.d for r in out} == {1}
    assert [r.chunk_index for r in out] == list(range(out[0].total_chunks))


def test_search(spark):
    pts = spark.createDataFrame([(k, [float(k % 3), 1.0]) for k in range(7)] + [(9, None)], "vec_id bigint, embedding array<float>")
    assert [r.vec_id for r in vectors.search(pts, [0.0, 1.0], 2, 0.5).collect()] == [0, 3]
    many = vectors.search_many(pts, pts.filter("vec_id in (0, 1)"), 2, 0.5, block=1).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in many] == [(0, 3, 1.0), (0, 6, 1.0), (1, 4, 1.0), (1, 2, 0.9487)]
    assert vectors.search_many(pts, pts.limit(0)).count() == 0


def test_embed_falls_back_to_single_texts(spark):
    def model(texts):
        if len(texts) > 1 or texts[0] == "bad":
            raise RuntimeError
        return [1.0, 2.0]

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None)], "k int, t string").coalesce(1)
    assert [r.vector for r in vectors.embed(df, "t", model).orderBy("k").collect()] == [[1.0, 2.0], None, None]


def test_plans(spark):
    a = spark.createDataFrame([(1,)], "id bigint")
    plan = dedup.absent(a, a, "id")._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan
    pts = spark.createDataFrame([(1, [1.0])], "vec_id bigint, embedding array<float>")
    assert "TakeOrderedAndProject" in vectors.search(pts, [1.0])._jdf.queryExecution().executedPlan().toString()


def test_load_tier(spark):
    df = spark.createDataFrame([(5001,), (501,), (500,)], "n int").select(projections.load_tier(F.col("n")).alias("t"))
    assert [r.t.batch_size for r in df.collect()] == [100, 75, 50]


def test_pages_and_ids(spark):
    df = spark.createDataFrame([(k,) for k in (5, 3, 9, 1)], "id bigint")
    assert [r.id for r in dedup.keyset_page(df, "id", None, 2).collect()] == [1, 3]
    assert [r.id for r in dedup.keyset_page(df, "id", 3, 2).collect()] == [5, 9]
    assert sorted(r.id for r in dedup.add_ids(df, spark.createDataFrame([(1,), (2,), (None,)], "id int")).collect()) == ["1", "2", "3", "5", "9"]


def test_scans_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a", "x" * 10, None)], "row_id bigint, id string, texto_sentencia string, other string").write.parquet(path)
    df = spark.read.parquet(path)
    plan = dedup.first_arrivals(df.select("row_id", "id"), "id", "row_id")._jdf.queryExecution().executedPlan().toString()
    assert "texto_sentencia" not in plan
    plan = df.filter("row_id > 3").select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(row_id), GreaterThan(row_id,3)]" in plan
