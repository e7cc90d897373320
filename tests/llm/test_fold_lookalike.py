import pytest

from legajo.llm import fold, lookalike


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("ＡＢ１２－３", "AB12-3"),
        ("oﬁcio", "oficio"),
        ("cafe\u0301 n\u0303", "café ñ"),
        ("so\u00adl\u200bo\ufeff\u2060\u200d", "solo"),
        ("a\u00a0b\u202fc\u2007d\u3000e", "a b c d e"),
        ("a‐b‑c", "a-b-c"),
        ("Саso", "Caso"),
        ("сор", "cop"),
        ("nοta", "nota"),
        ("acciо\u0301n", "acción"),
        ("года", "гoдa"),
        ("νόμος", "vóμoς"),
        ("ϲϳρυ", "cjpu"),
        ("օսհ", "ouh"),
        ("ᎪᏴᏟ"[:2], "AB"),
        ("ꓮꓐ", "AB"),
        ("ɡɑto", "gato"),
        ("Ӏd", "Id"),
        ("art. ⅳ Ⅻ", "art. iv XII"),
        ("𝐚𝑥𝟗", "ax9"),
        ("−3", "-3"),
    ],
)
def test_same_look(a, b):
    assert fold.canonical(a) == fold.canonical(b)


@pytest.mark.parametrize(("a", "b"), [("A", "a"), ("a", "á"), ("á", "à"), ("5º", "5o"), ("x²", "x2"), ("a\nb", "a b"), ("a  b", "a b"), ("a.", "a"), ("a–b", "a-b"), ("…", "..."), ("½", "1/2"), ("ø", "o"), ("год", "roA"), ("ı", "i"), ("ⓐ", "a"), ("α", "a")])
def test_other_look(a, b):
    assert fold.canonical(a) != fold.canonical(b)


def test_script_of_a_token():
    assert fold.resolve("cаso") == ("caso", "mixed")
    assert fold.resolve("сор") == ("cop", "whole")
    assert fold.resolve("гoд") == ("год", "mixed")
    assert fold.resolve("год") == ("год", "single")
    assert fold.resolve("гμo") == ("гμo", "mixed")


def test_canonical_is_stable():
    for t in ("", " ", "Ｆｏｏ ﬁ Сор", "e\u0301\u0301", "\u200b", "abc"):
        assert fold.canonical(fold.canonical(t)) == fold.canonical(t)


def test_words():
    assert fold.words("Según el «ACTA» N° 12.345, co\u00adbró\u200b ＄5º") == ["segun", "el", "acta", "n", "12", "345", "cobro", "5º"]
    assert fold.words("Саso-Uno") == ["caso", "uno"]
    assert fold.words("") == [] == fold.words("… !")


def test_pairs(spark):
    rows = [(1, "caso", 0), (2, "cаso", 0), (3, "caso", 0), (4, "Caso", 0), (5, None, 0), (6, " ", 0), (7, "", 0), (8, "ca\u200bso", 0), (2, "cаso", 0), (None, "caso", 0), (9, "\u00a0", 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, look int")
    got = sorted(tuple(r) for r in lookalike.look_alikes(df).collect())
    assert got == [(1, 2), (1, 8), (2, 3), (2, 8), (3, 8)]
    assert lookalike.look_alikes(df.limit(0)).count() == 0


def test_copies_of_two_spellings(spark):
    df = spark.createDataFrame([(1, "caso"), (2, "caso"), (3, "cаso"), (4, "cаso")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in lookalike.look_alikes(df).collect()) == [(1, 3), (1, 4), (2, 3), (2, 4)]


def test_classes_grow_with_documents(spark):
    # A thousand spellings of one line by invisible characters: a row for each document.
    rows = [(k, "".join(c + "\u200b" * (k >> j & 1) for j, c in enumerate("abcdefghij"))) for k in range(1000)] + [(2000, None), (2001, "z"), (None, "z"), (2002, "z")]
    out = {r.doc_id: (r.look_id, r.spelling_id) for r in lookalike.classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert len(out) == 1002 and all(out[k] == (0, k) for k in range(1000)) and out[2002] == (2001, 2001)


def test_script_extensions():
    assert fold.scripts("a") == {"Latin"} and fold.scripts("а") == {"Cyrillic"} and {"Greek"} <= fold.scripts("α")
    assert fold.scripts("中") != fold.scripts("a")


def test_normalise(spark):
    df = spark.createDataFrame([(1, "cаso сор"), (2, None), (3, ""), (4, "x")], "doc_id bigint, text string")
    out = [tuple(r) for r in lookalike.normalise(df).orderBy("doc_id").collect()]
    assert out == [(1, "caso cop", True, 1, 1), (2, None, False, 0, 0), (3, "", False, 0, 0), (4, "x", False, 0, 0)]
