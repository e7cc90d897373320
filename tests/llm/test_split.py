import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from legajo.llm import split


def units(s):
    return len(s.encode("utf-16-le", "surrogatepass")) // 2


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab. \n,;\U0001f4ceé\u0301\r"), min_size=1, max_size=900), st.sampled_from([(40, 8), (60, 0), (50, 24), (97, 13)]))
def test_pieces(text, sizes):
    limit, overlap = sizes
    out = split.split(text, limit, overlap)
    assert out[0][:2] == (0, 0)
    assert out[-1][2] == len(text)
    for (start, own, end, _), after in zip(out, [*out[1:], None]):
        assert start <= own < end
        assert units(text[start:end]) <= limit
        assert units(text[start:own]) <= overlap
        if after:
            assert after[1] == end
    assert len(out) == 1 or units(text) > limit


def test_number_of_pieces_is_near_the_least():
    text = "palabra corta. " * 400
    n = len(split.split(text))
    assert n <= -(-(len(text) - 80) // 720) + 2
    own = [e - o for _, o, e, _ in split.split(text)]
    assert max(own) < 2 * min(own)


def test_strongest_boundary_wins():
    text = "x " * 200 + "fin.\n\n" + "y " * 195 + "z " * 200
    assert split.split(text, 800, 0)[0][2] == 406
    assert split.split(text, 800, 0)[0][3] == "paragraph"


def test_solid_text():
    out = split.split("a" * 2000, 800, 80)
    assert [p[3] for p in out] == ["none"] * (len(out) - 1) + ["end"]
    assert all(p[2] - p[0] <= 800 for p in out)
    assert split.split("") == []
    with pytest.raises(ValueError, match="overlap"):
        split.split("x", 10, 5)


def test_solid_stretch():
    assert split.longest_solid("ab \U0001f4ce\U0001f4ce\U0001f4ce cd") == 6
    assert split._solid_over("\U0001f4ce" * 401 + " x", 800)
    assert not split._solid_over("a" * 800 + " x", 800)
    assert not split._solid_over("\u3000 ", 800)


def test_frames(spark):
    rows = [("a", 1, "x" * 801, 0), ("a", 2, "palabra " * 200, 0), ("a", 3, "corto", 0), ("a", 4, None, 0), ("a", 5, " \n\u00a0", 0), ("a", 6, "", 0), ("a", None, "y" * 900, 0), ("a", 2, "palabra " * 200, 0)]
    df = spark.createDataFrame(rows, "s string, row_id bigint, t string, pieces int")
    got = sorted((r.row_id or -1, r.need) for r in split.needs(split.plan(df, ["s", "row_id"], "t"), ["s", "row_id"]).collect())
    assert got == [(-1, "oversize"), (-1, "unbroken"), (1, "oversize"), (1, "unbroken"), (2, "oversize"), (2, "oversize")]
    pieces = split.pieces(df.filter("row_id = 2").limit(1), ["row_id"], "t").orderBy("piece_no").collect()
    assert "".join(("palabra " * 200)[p.own_start : p.end_pos] for p in pieces) == "palabra " * 200
    assert all(len(p.piece) <= 800 and p.piece == ("palabra " * 200)[p.start_pos : p.end_pos] for p in pieces)
    assert split.plan(df.limit(0), ["row_id"], "t").count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abcd  .\n,"), min_size=200, max_size=4000))
def test_one_piece_less_would_not_do(text):
    out = split.split(text, 60, 6)
    n = len(out)
    least = max(2, -(-(units(text) - 6) // 54))
    if n > least:
        assert split._balanced(text, split._Units(text), n - 1, 60, 6) is None
