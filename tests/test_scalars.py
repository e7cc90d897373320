import pytest
from pyspark.sql import functions as F

from legajo.functions import scalars as S


def values(spark, column, *inputs, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_trim_takes_unicode_space(spark):
    assert values(spark, S.js_trim, " \u00a0\tx\ufeff\u3000", "a b", "", None, "\u200bz") == ["x", "a b", "", None, "\u200bz"]


def test_blank(spark):
    assert values(spark, S.is_blank, None, "", "\u00a0\n", "x") == [True, True, True, False]


def test_parse_int(spark):
    assert values(spark, S.parse_int, "12abc", " -7", "x", "", None) == [12, -7, None, None, None]
    assert values(spark, lambda x: S.parse_int(x, 1), "0", "x", "5") == [1, 1, 5]


def test_text_list(spark):
    assert values(spark, S.text_list, '["a","b"]', "a", "", None, "[broken") == [["a", "b"], ["a"], [], [], ["[broken"]]


def test_units_and_rounding(spark):
    assert values(spark, S.utf16_length, "a\U0001f4ce", "", None) == [3, 0, None]
    assert values(spark, S.js_round, -2.5, 2.5, 1.4, kind="double") == [-2, 3, 1]


@pytest.mark.parametrize(
    ("f", "given", "want"),
    [
        (S.drop_spans, "a<span x>b</span>c<SPAN>d</SPAN>", "ac"),
        (S.drop_spans, "a<span>b\nc</span>", "a<span>b\nc</span>"),
        (S.drop_notes, '<div class="n rnp">x\ny</div>z<div class="n">k</div>', 'z<div class="n">k</div>'),
        (S.unwrap_links, '<a href="x">t</a> <abbr>u</a>', "t u"),
        (S.strip_tags, " <p>x</p> <tag", "x"),
        (S.strip_tags, None, ""),
        (S.strip_tags, "<>&lt;b&gt;", "<>&lt;b&gt;"),
    ],
)
def test_markup(spark, f, given, want):
    assert values(spark, f, given) == [want]


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [2.0, 0.0]), ([1.0, 0.0], [0.0, 0.0]), (None, [1.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(S.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, None, None]


def test_small_things(spark):
    assert values(spark, lambda x: S.to_fixed(x, 2), 1.005, 0.125, -0.125, None, kind="double") == ["1.00", "0.13", "-0.13", None]
    assert values(spark, lambda x: S.backoff_ms(2000, x), 1, 3, kind="int") == [2000, 8000]
    assert values(spark, S.form_token, '<input name="_token" type="hidden" value="abc">', "<p>") == ["abc", None]
    assert values(spark, S.cookie_map, "a=1; b=x=y; c") == [{"a": "1", "b": "x=y"}]
    assert values(spark, S.throughput_class, 100.0, 60.0, 30.0, 1.0, kind="double") == ["excellent", "good", "moderate", "slow"]
    assert values(spark, S.is_critical, "connect ECONNREFUSED", "x timeout", "other") == [True, True, False]
