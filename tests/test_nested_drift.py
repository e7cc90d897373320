import json
import random

import numpy as np

from legajo.operators import drift, html, nested


def paths(value, root="r"):
    return [(r[0], r[1]) for r in nested.walk(json.dumps(value), root)]


def test_paths_and_parents():
    tree = {"a": [{"b": {"c": [{"x": 1}, None, 3, {"d": [[{"y": 2}]]}]}}]}
    assert paths(tree) == [("r.a[0]", ""), ("r.a[0].b.c[0]", "r.a[0]"), ("r.a[0].b.c[3]", "r.a[0]"), ("r.a[0].b.c[3].d[0][0]", "r.a[0].b.c[3]")]
    assert paths([{"h": [{"h": []}]}], "html") == [("html[0]", ""), ("html[0].h[0]", "html[0]")]


def test_json_in_strings_and_malformed():
    inner = json.dumps({"a": [{"k": 1}]})
    assert paths(json.loads(json.dumps(inner))) == [("r.a[0]", "")]
    assert paths({"z": json.dumps([{"k": 1}])}) == [("r.z[0]", "")]
    for bad in ("", "{", '{"a": [{}]', "NaN", "12", '"x"', None, '{"a": [{"b": NaN}]}'):
        assert nested.walk(bad, "r") == []
    assert nested.walk("[" * 100_000 + "]" * 100_000, "r") == []
    assert nested.walk("[" * 100_000 + "{}" + "]" * 99_999, "r") == []
    assert len(nested.walk("[1" + "0" * 9000 + ', {"a": 1e5}]', "r")) == 1
    assert len(nested.walk("[" * 400 + "{}" + "]" * 400, "r")) == 1


def test_any_depth():
    n = 10_000
    text = '[{"t": "a", "h": ' * n + "[]" + "}]" * n
    rows = nested._rows(text, "html", False)
    assert next(rows)[:4] == ("html[0]", "", 0, 0)
    assert sum(1 for _ in rows) == n - 1
    assert html.merged(nested.parse(text)) == "\n".join("a" * n)


def test_parsers_agree():
    rng = random.Random(5)

    def value(depth):
        kind = rng.randrange(8 if depth < 5 else 5)
        if kind < 5:
            return [None, True, rng.randrange(-99, 99), rng.random() * 1e9, rng.choice(["", "á\n\"x\\", "\u2028{", "[1"])][kind]
        if kind == 5:
            return {rng.choice(["a", "b", "", "$object", "ñ"]): value(depth + 1) for _ in range(rng.randrange(4))}
        return [value(depth + 1) for _ in range(rng.randrange(4))]

    for _ in range(300):
        text = json.dumps(value(0), indent=rng.choice([None, 2]), ensure_ascii=rng.random() < 0.5)
        assert nested._parse_deep(text) == json.loads(text)
        cut = text[: rng.randrange(len(text) + 1)] + rng.choice(["", ",", "}", "]", "x"])
        try:
            want = json.loads(cut)
        except ValueError:
            want = ValueError
        try:
            got = nested._parse_deep(cut)
        except ValueError:
            got = ValueError
        assert got == want


def test_nothing_is_lost():
    for text in (
        '[{"a": {"b": 1, "c": 2}, "tags": ["u", "v"], "k": 1}]',
        '{"r": 1, "s": {"t": [[{"x": null}, 3], []]}, "$object": "y", "u": [{"$object": "z"}, {"$object": "z"}], "v": "[1, {}]"}',
        '{"x": "plain", "y": [true, {"m": {"n": [{}]}}]}',
        "[]",
    ):
        rows = list(nested._rows(text, "r", True))
        tree = json.loads(text)
        if "v" in tree:
            tree["v"] = [1, {}]
        assert nested.rebuilt(rows[0][4], {r[4]: r[6] for r in rows}) == tree
    assert [r[4:] for r in nested._rows('{"x": "[1]"}', "r", True)] == [r[4:] for r in nested._rows('{"x": [1]}', "r", True)]


def test_equal_subtrees_have_one_identity():
    rows = nested.walk('{"a": [{"x": 1, "y": [{"z": 2}]}, {"y": [{"z": 2}], "x": 1}, {"x": "1", "y": []}]}', "r")
    ids = {r[0]: r[4] for r in rows}
    assert ids["r.a[0]"] == ids["r.a[1]"] != ids["r.a[2]"]
    assert ids["r.a[0].y[0]"] == ids["r.a[1].y[0]"]


def test_occurrences(spark):
    df = spark.createDataFrame([(1, '[{"t": "a", "h": [{"t": "b"}]}]', "x"), (1, '[{"t": "b"}]', "x"), (None, None, "x"), (2, "{", "x")], "row_id int, html string, node_path string")
    out = nested.occurrences(df, ["row_id"], "html", "html")
    rows = sorted(tuple(r) for r in out.select("row_id", "node_path", "parent_path", "ordinal", "members").collect())
    assert rows == [(1, "html[0]", "", 0, '{"h": [{"$object": "%s"}], "t": "a"}' % nested._identity('{"t": "b"}')), (1, "html[0]", "", 0, '{"t": "b"}'), (1, "html[0].h[0]", "html[0]", 0, '{"t": "b"}')]
    assert sorted(r.n for r in nested.objects(out).collect()) == [1, 2]
    assert nested.occurrences(df.limit(0), ["row_id"], "html", "html").count() == 0


def feed(spark, *files):
    rows = [(i * 100 + k, "f", i + 1, p if isinstance(p, str) or p is None else json.dumps(p)) for i, f in enumerate(files) for k, p in enumerate(f)]
    return spark.createDataFrame(rows, "rec_id bigint, feed_id string, file_no int, payload string")


def changes(spark, *files):
    out = drift.changes(drift.profile(feed(spark, *files)))
    return sorted((r.file, r.field_name, r.change_kind, r.new_name) for r in out.collect())


def test_renames_by_content(spark):
    a = [{"id": str(k), "old": f"v {k}", "twin": f"t {k}", "n": k} for k in range(5)]
    b = [{"id": str(k), "fresh": [f"v {k}"], "twin_new": f"t {k}", "n": str(k)} for k in range(3, 8)]
    assert changes(spark, a, b) == [(2, "fresh", "type_changed", ""), (2, "n", "type_changed", ""), (2, "old", "renamed", "fresh"), (2, "twin", "renamed", "twin_new")]


def test_added_and_removed_of_other_content(spark):
    a = [{"id": "1", "x": "aa"}, {"id": "2", "x": "bb"}]
    b = [{"id": "1", "x2": "zz"}, {"id": "2", "x2": "yy"}]
    assert changes(spark, a, b) == [(2, "x", "removed", ""), (2, "x2", "added", "")]


def test_nulls_case_and_bad_payloads(spark):
    a = [{"id": "1", "f": "v w", "g": None}, "{broken", "", None, "[1]"]
    b = [{"id": "1", "F": "v w", "g": None}]
    assert changes(spark, a, ["{"], b) == [(3, "f", "renamed", "F")]
    assert changes(spark, a) == []
    assert drift.changes(drift.profile(feed(spark, []))).count() == 0


def test_values_in_other_wrapping():
    assert sorted(drift.atoms({"tipo": "T", "numero": 5960, "anio": 2023})) == sorted(drift.atoms("T-5960-2023"))
    assert drift.atoms(["x", None, True]) == ["x"]


def test_assignment_is_best():
    rng = np.random.default_rng(3)
    from itertools import permutations

    for n, m in ((1, 1), (2, 4), (4, 2), (4, 4)):
        for _ in range(20):
            c = rng.random((n, m))
            got = sum(c[i, j] for i, j in drift.match(c))
            small, big = (c, m) if n <= m else (c.T, n)
            want = min(sum(small[i, p[i]] for i in range(len(small))) for p in permutations(range(big), len(small)))
            assert abs(got - want) < 1e-9


def test_unify(spark):
    a = [{"id": "1", "old": "v 1", "n": 1, "F": True}, {"id": "2", "old": "v 2", "n": 2, "f": {"x": 1}}]
    b = [{"id": "1", "new": ["v 1"], "n": 1.5, "F": True}, {"id": "3", "new": None, "rec_id": "r", "F": False}]
    rows = feed(spark, a, b, ["{"], b)
    profiles = drift.profile(rows)
    out = drift.unify(rows, profiles, drift.changes(profiles))
    assert out.dtypes == [("rec_id", "bigint"), ("feed_id", "string"), ("file_no", "int"), ("F", "boolean"), ("f_2", "string"), ("id", "string"), ("n", "double"), ("old", "array<string>"), ("rec_id_2", "string")]
    got = out.orderBy("rec_id").collect()
    assert [(r.old, r.n, r.F, r.f_2, r.rec_id_2) for r in got] == [(["v 1"], 1.0, True, None, None), (["v 2"], 2.0, None, '{"x": 1}', None), (["v 1"], 1.5, True, None, None), (None, None, False, None, "r"), (["v 1"], 1.5, True, None, None), (None, None, False, None, "r")]
    told = {r.field_name: (r.type, r.widened, r.names) for r in drift.unified_schema(profiles, drift.changes(profiles)).collect()}
    assert told["old"] == ("array<string>", True, ["new", "old"]) and told["n"] == ("double", False, ["n"])
    none = feed(spark, ["{"])
    profiles = drift.profile(none)
    assert drift.unify(none, profiles, drift.changes(profiles)).columns == ["rec_id", "feed_id", "file_no"]


def test_values_alone_must_be_several(spark):
    assert changes(spark, [{"id": "1", "a": "x"}, {"id": "2", "a": "x"}], [{"id": "3", "b": "x"}, {"id": "4", "b": "x"}]) == [(2, "a", "removed", ""), (2, "b", "added", "")]
    assert changes(spark, [{"id": str(k), "a": f"v{k}"} for k in range(3)], [{"id": str(9 + k), "b": f"v{k}"} for k in range(3)]) == [(2, "a", "renamed", "b")]


def test_renames_of_booleans_and_signs(spark):
    a = [{"id": str(k), "open": k % 3 == 0, "mark": "+-*"[k % 3], "late": k % 2 == 0} for k in range(12)]
    b = [{"id": str(k), "is_open": k % 3 == 0, "sign": ["+-*"[k % 3]], "other": k < 6} for k in range(12)]
    assert changes(spark, a, b) == [(2, "late", "removed", ""), (2, "mark", "renamed", "sign"), (2, "open", "renamed", "is_open"), (2, "other", "added", ""), (2, "sign", "type_changed", "")]
