import gzip
import json
import re
from datetime import datetime

import pytest

from legajo.operators import facets
from legajo.sources import landed, remote
from legajo.streaming import crawl


def statute(k):
    return json.dumps({"metadatos": {"titulo_norma": f"t{k}", "tipos_numeros": [{"compuesto": f"L {k}"}]}, "html": [{"t": f"<p>texto {k}</p>"}]})


def test_id_crawl_resumes(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    for k in (1, 2, 4):
        (root / f"{k}.json").write_text(statute(k))
    (root / "5.json").write_text('{"html": []}')
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    assert crawl.crawl_ids(spark, out, ck, path=root, start=1, stop=4, step=10) == 1
    assert sorted(r.id for r in spark.read.parquet(f"{out}/documents").collect()) == ["1", "2"]
    # The next run goes on behind the last committed id; nothing is written twice.
    assert crawl.crawl_ids(spark, out, ck, path=root, start=1, stop=7, step=10) == 1
    assert crawl.crawl_ids(spark, out, ck, path=root, start=1, stop=7, step=10) == 0
    docs = spark.read.parquet(f"{out}/documents")
    assert sorted((r.id, r.text) for r in docs.collect()) == [("1", "texto 1"), ("2", "texto 2"), ("4", "texto 4")]
    assert sorted((r.id, r.message) for r in spark.read.parquet(f"{out}/errors").collect()) == [(3, "no answer"), (5, "not a statute"), (6, "no answer")]
    assert spark.read.parquet(f"{out}/points").count() == 3


def test_repeated_batch_changes_nothing(spark, tmp_path):
    answers = spark.createDataFrame([(1, statute(1), None), (2, None, "no answer")], "id bigint, body string, error string")
    out = str(tmp_path / "out")
    for _ in range(2):
        crawl.store(answers, out)
    assert [spark.read.parquet(f"{out}/{t}").count() for t in ("documents", "points", "errors")] == [1, 1, 1]
    # A later batch brings the statute again and a new one; another failure of an id is kept, facets count documents once.
    crawl.store(spark.createDataFrame([(1, statute(1), None), (3, statute(3), None), (2, None, "timeout")], "id bigint, body string, error string"), out, batch=1)
    assert [spark.read.parquet(f"{out}/{t}").count() for t in ("documents", "points", "errors")] == [2, 2, 2]
    assert {(r.value, r.n, r.first_seen) for r in crawl.facet_table(spark, out).filter("facet = 'titulo_norma'").collect()} == {("t1", 1, 1), ("t3", 1, 3)}
    point = spark.read.parquet(f"{out}/points").filter("doc_id = 3").first()
    assert (point.payload.titulo_norma, point.payload.doc_id, point.payload.chunk_index, point.payload.total_chunks, point.payload.text) == ("t3", "3", 0, 1, "texto 3")
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT[\d:]{8}\.\d{3}Z", point.payload.timestamp)


def test_open_ended_crawl(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    for k in (5, 6, 9):
        (root / f"{k}.json").write_text(statute(k))
    log = tmp_path / "last_norm.log"
    log.write_text("5\n")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    crawl.crawl_ids(spark, out, ck, path=root, log=log, budget=4, step=3)
    assert sorted(r.idNorm for r in spark.read.parquet(f"{out}/documents").collect()) == [5, 6, 9]
    assert sorted(r.id for r in spark.read.parquet(f"{out}/errors").collect()) == [7, 8, 10, 11, 12, 13]
    # What was not there at the end is asked for again by the next run.
    (root / "11.json").write_text(statute(11))
    crawl.crawl_ids(spark, out, ck, path=root, log=log, budget=4, step=3)
    assert sorted(r.idNorm for r in spark.read.parquet(f"{out}/documents").collect()) == [5, 6, 9, 11]
    assert sorted(r.id for r in spark.read.parquet(f"{out}/errors").collect()) == [7, 8, 10, 11, 12, 13, 14, 15]
    assert crawl.crawl_ids(spark, out, ck, path=root, log=log, budget=4, step=3) > 0
    assert spark.read.parquet(f"{out}/documents").count() == 4


def test_scan_start(tmp_path):
    f = tmp_path / "last"
    assert landed.scan_start(str(f), 77) == 77
    for text, want in (("12 x", 12), ("", 1), ("x", 1), ("0", 1)):
        f.write_text(text)
        assert landed.scan_start(str(f), 77) == want


def test_pace():
    waits = []
    hour = [3]
    pace = remote.Pace({"delay_ms": 1000, "delay_span_ms": 9000, "pause_every": 2, "pause_ms": 300_000, "closed": "0-6", "fetch": "x", "retries": 3}, waits.append, lambda: datetime(2024, 1, 1, hour[0]))
    assert pace.fetch(lambda k: "a", 1) == ("a", None)
    assert waits[0] == 3 * 3600 and 1 <= waits[1] < 10 and len(waits) == 2
    hour[0] = 6
    waits.clear()
    assert pace.fetch(lambda k: "b", 2)[0] == "b"
    assert waits[1:] == [300]
    waits.clear()
    assert pace.fetch(lambda k: 1 / 0, 3) == (None, "ZeroDivisionError: division by zero")
    assert waits[:2] == [2.0, 4.0] and len(waits) == 3
    assert remote.Pace({}, waits.append).fetch(lambda: "c") == ("c", None) and len(waits) == 3


def test_sessions():
    made, now = [], [0.0]
    s = remote.Sessions(lambda: made.append(1) or remote.bootstrap('<input type="hidden" name="_token" value="t%d">' % len(made), ["a=1; path=/", "b=2"]), 6000, lambda: now[0])
    assert s.get() == s.get() == {"token": "t1", "cookie": "a=1; b=2"}
    now[0] = 6000.5
    assert s.get()["token"] == "t2"
    with pytest.raises(ValueError):
        remote.bootstrap("<html>", [])


def test_batch_reader(spark, tmp_path):
    (tmp_path / "3.json").write_text("{}")
    landed.register(spark)
    df = spark.read.format("id_crawl").options(path=str(tmp_path), start="1", stop="6", parts="2").load()
    assert sorted((r.id, r.body) for r in df.collect() if r.body) == [(3, "{}")]
    assert df.count() == 5


def test_page_crawl(spark, tmp_path):
    for base, pages in (("civil", [[{"id": 1}, {"id": 2}], [{"id": 2}, {"id": 3}], []]), ("penal", [[{"id": 1}]])):
        (tmp_path / base).mkdir()
        for k, docs in enumerate(pages):
            (tmp_path / base / f"{2 * k}.json").write_text(json.dumps({"response": {"docs": docs}}))
    (tmp_path / "penal" / "2.json").write_text("<html>")
    out = str(tmp_path / "out")
    first = crawl.crawl_pages(spark, out, ["civil", "penal", "none"], path=tmp_path, page_size=2)
    # An id is known whichever base brought it; a page that is none has an error, and the base goes on.
    assert first == {"civil": 3, "penal": 0, "none": 0}
    assert [(r.base, r.offset, r.message) for r in spark.read.parquet(f"{out}/errors").collect()] == [("penal", 2, "not a result page")]
    assert crawl.crawl_pages(spark, out, ["civil"], path=tmp_path, page_size=2, budget=0) == {"civil": 0}


def test_failing_middle_page_and_large_base(spark, tmp_path):
    landed.register(spark)
    read = lambda **o: spark.read.format("page_crawl").options(fetch="tests.pages:page", bases="big", backoff_ms="0", **o).load()
    rows = read(lanes="3")
    assert rows.filter("doc is not null").count() == 60_000 - 50
    assert [(r.offset, r.error) for r in rows.filter("error is not null").collect()] == [(1000, "TimeoutError: page 1000")]
    assert rows.filter("place = -1").count() == 3
    out = str(tmp_path / "out")
    assert crawl.crawl_pages(spark, out, ["small"], round_pages=4, fetch="tests.pages:page", backoff_ms=0) == {"small": 520}
    assert spark.read.parquet(f"{out}/errors").count() == 0


def test_page_budget(spark, tmp_path):
    (tmp_path / "b").mkdir()
    pages = [[1, 2], [3, 4], [5, 6], [7, 8]]
    for k, ids in enumerate(pages):
        (tmp_path / "b" / f"{2 * k}.json").write_text(json.dumps({"response": {"docs": [{"id": i} for i in ids]}}))
    out = str(tmp_path / "out")
    crawl.insert_if_absent(spark.createDataFrame([("x", str(k), "") for k in (2, 3, 4, 5)], "collection string, id string, content string"), f"{out}/documents", ["id"])
    # The run of known ids is told at a page's end only: three at the end of the second page; the run goes over rounds.
    for budget, pages, want in ((3, 20, 1), (3, 1, 0), (0, 20, 3)):
        assert crawl.crawl_pages(spark, out, ["b"], round_pages=pages, budget=budget, path=tmp_path, page_size=2) == {"b": want}


def test_id_cache_round_trip(spark, tmp_path):
    path = str(tmp_path / "cache")
    ids = spark.createDataFrame([("a",), ("b",), (None,), ("a",), ('q"\n',)], "id string")
    landed.save_id_cache(ids, path)
    assert sorted(r.id for r in landed.id_cache(spark, path).collect()) == ["a", "b", 'q"\n']
    (tmp_path / "old").mkdir()
    with gzip.open(tmp_path / "old" / "ids.json.gz", "wt") as f:
        f.write('["x", 1]')
    (tmp_path / "old" / "bad.json.gz").write_bytes(b"no gzip")
    assert sorted(r.id for r in landed.id_cache(spark, str(tmp_path / "old")).collect()) == ["1", "x"]
    landed.save_id_cache(ids.limit(0), path)
    assert landed.id_cache(spark, path).count() == 0


def test_facet_files(spark, tmp_path):
    path = str(tmp_path / "facets")
    found = spark.createDataFrame([("a", "x", 2, 5), ("a", "", 1, 7)], "facet string, value string, n bigint, first_seen bigint")
    assert facets.load_json(spark, path).count() == 0
    facets.save_json(found, path)
    facets.save_json(found, path)
    assert sorted(map(tuple, facets.load_json(spark, path).collect())) == [("a", "", 1, 7), ("a", "x", 2, 5)]
    (tmp_path / "old.json").write_text(json.dumps({"id": ["1", "2"], "organismos": ["o"]}, indent=2))
    assert sorted(map(tuple, facets.load_json(spark, str(tmp_path / "old.json")).collect())) == [("id", "1", 1, 0), ("id", "2", 1, 1), ("organismos", "o", 1, 0)]


def test_directory(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"x": 1}')
    (tmp_path / "b.json").write_text("{")
    (tmp_path / "c.txt").write_text("{}")
    assert sorted((r.name, r.ok) for r in landed.json_directory(spark, str(tmp_path)).select("name", "ok").collect()) == [("a.json", True), ("b.json", False)]


def test_request():
    fields = landed.search_request("t", 528, 50, 100, rol="1")
    assert json.loads(fields["filtros"])["rol"] == "1"
    assert landed.multipart({"a": "1"}, "B") == '--B\r\nContent-Disposition: form-data; name="a"\r\n\r\n1\r\n--B--'


def test_index_directory(spark, tmp_path):
    root = tmp_path / "in"
    root.mkdir()
    (root / "1.json").write_text(json.dumps({"_source": {"doc_id": "a", "documento_completo": "texto uno", "x": 1}}))
    (root / "2.json").write_text(json.dumps({"doc_id": "b", "documento_completo": "texto dos"}))
    (root / "3.json").write_text("{broken")
    (root / "4.json").write_text(json.dumps({"doc_id": "c", "documento_completo": " \u00a0"}))
    (root / "5.json").write_text(json.dumps({"documento_completo": "x"}))
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    row = crawl.index_directory(spark, str(root), out, ck).collect()
    assert [(r.files, r.success, r.duplicates, r.errors, r.points) for r in row] == [(5, 2, 0, 3, 2)]
    wrong = {r.name: r for r in spark.read.parquet(f"{out}/errors").collect()}
    assert wrong["5.json"].error.message == "no id" and not wrong["5.json"].error.critical and wrong["3.json"].collection == "contraloria" and json.loads(wrong["4.json"].metadata) == {"doc_id": "c"}
    assert {r.payload["x"] for r in spark.read.parquet(f"{out}/points").filter("doc_id = 'a'").collect()} == {"1"}
    assert sorted((r.name, r.message) for r in wrong.values()) == [("3.json", "not JSON"), ("4.json", "blank text"), ("5.json", "no id")]
    (root / "6.json").write_text(json.dumps({"doc_id": "a", "documento_completo": "texto uno"}))
    row = crawl.index_directory(spark, str(root), out, ck).orderBy("batch").collect()[-1]
    assert (row.files, row.success, row.duplicates, row.points) == (1, 0, 1, 0)
    assert sorted(r.id for r in spark.read.parquet(f"{out}/documents").collect()) == ["a", "b"]
