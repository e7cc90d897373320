import time

import numpy as np

from legajo.llm import fold, history, leak, lookalike, pack, pii, split

PART = "Que comparece don Juan Soto Rojas, RUT 39.769.340-6, fono 9 1887 1140, mail ana [arroba] correo [punto] example, en calle Diez Sur N\u00b0 4732 antes. Dictada por la se\u00f1ora Soto.\n"
LONG = PART * 6000  # about a million characters


def within(seconds, f):
    began = time.process_time()
    out = f()
    assert time.process_time() - began < seconds
    return out


def test_personal_information():
    names = pii.Names(pii.Lexicon.fit(["JUAN SOTO ROJAS c/ FISCO", "ANA ROJAS SOTO c/ FISCO"]))
    found = within(60, lambda: pii.find(LONG, names))
    assert len(found) == 6 * 6000


def test_split():
    pieces = within(60, lambda: split.split(LONG))
    assert all(p[2] - p[0] <= 800 for p in pieces)
    assert len(within(60, lambda: split.split("a" * 1_000_000))) >= 1250


def test_words_and_forms():
    assert len(within(20, lambda: fold.words(LONG))) > 100_000
    assert within(20, lambda: fold.canonical(LONG + "\u0430")) == LONG + "a"


def test_common_words():
    a = np.arange(60_000, dtype=np.uint32)
    b = np.concatenate([a[1:30_000], a[30_001:-1]])
    assert within(60, lambda: history.shared_words(a, b)) == 59_997


def test_frames(spark):
    df = spark.createDataFrame([(1, LONG), (2, LONG.replace("Soto", "S\u043eto"))], "doc_id bigint, text string")
    assert [tuple(r) for r in lookalike.look_alikes(df).collect()] == [(1, 2)]
    assert pack.parts(df).filter("doc_id = 1").count() == -(-len(LONG.encode()) // 4092)
    items = spark.createDataFrame([(7, PART)], "item_id bigint, text string")
    assert sorted(r.doc_id for r in leak.verbatim(leak.leaks(df, items)).collect()) == [1, 2]
    rows = df.selectExpr("'s' source", "0 batch", "doc_id row", "cast(null as string) key", "text")
    assert [(r.row_a, r.row_b) for r in history.repeats(rows).collect()] == [(1, 2)]
