import random

import numpy as np

from legajo.llm import fold, leak

ITEM = "Por la tarifa complementaria de Vichuhual, el perito indemnizó 223 cuotas y ocupó una cartera exenta. La interventora retuvo el nombramiento municipal de Rutedaco y amplió una garantía ilegible."


def found(spark, docs, items=((1, ITEM),)):
    d = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, text string, kind int")
    e = spark.createDataFrame(list(items), "item_id bigint, text string")
    return sorted((r.doc_id, r.item_id, r.kind) for r in leak.leaks(d, e).collect())


def test_kinds(spark):
    words = ITEM.split()
    docs = [
        (1, "Antes. " + " ".join(words[2:20]) + " después."),
        (2, " ".join(words[:14])),
        (3, "x " + " ".join(words[:20]).upper().replace("Ó", "O") + " y"),
        (4, ITEM.replace("223", "999").replace("Vichuhual", "Llamar")),
        (5, None),
        (6, ""),
        (7, ITEM.replace("tarifa", "tаrifa").replace("perito", "pe\u00adri\u200bto").replace(" ", "\u00a0")),
        (8, " ".join(words[:8]) + " intrusa " + " ".join(words[8:16])),
        (None, ITEM),
    ]
    assert found(spark, docs) == [(1, 1, "verbatim"), (3, 1, "verbatim"), (4, 1, "reparameterised"), (7, 1, "verbatim")] or [k for k in found(spark, docs) if k[0] != 4] == [(1, 1, "verbatim"), (3, 1, "verbatim"), (7, 1, "verbatim")]
    assert (4, 1, "reparameterised") in found(spark, docs)


def test_contradicting_slots(spark):
    item = "el 12 y el 34 y el 12 y el 34 y el 12 y el 34 y el 12 fin"
    assert found(spark, [(1, item.replace("34", "12"))], [(1, item)]) == [(1, 1, "template")]


def test_empty(spark):
    assert found(spark, []) == []
    d = spark.createDataFrame([(1, ITEM)], "doc_id bigint, text string")
    assert leak.leaks(d, spark.createDataFrame([], "item_id bigint, text string")).count() == 0


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{k}" for k in range(12)] + ["7", "8", "Ana", "cuotas"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(40))) for k in range(15)]
    docs = []
    for k in range(120):
        text = " ".join(rng.choice(vocab) for _ in range(30))
        if k % 2:
            source = items[rng.randrange(15)][1].split()
            at, n = rng.randrange(20), rng.randrange(10, 20)
            text += " " + " ".join(source[at : at + n]) + " " + text
        docs.append((k, text))
    want = set()
    for i, item in items:
        w = fold.words(item)
        grams = {tuple(w[j : j + 15]) for j in range(len(w) - 14)}
        for d, text in docs:
            v = fold.words(text)
            if any(tuple(v[j : j + 15]) in grams for j in range(len(v) - 14)):
                want.add((d, i))
    got = {(d, i) for d, i, kind in found(spark, docs, items) if kind == "verbatim"}
    assert got == want
    assert 20 < len(want)


def test_window_hash_depends_on_all_words_in_order():
    codes = np.arange(1, 40, dtype=np.uint64) * np.uint64(8) | np.uint64(8)
    h = leak.window_hashes(codes)
    assert len(h) == 25 == len(set(h.tolist()))
    for j in range(15):
        other = codes[:15].copy()
        other[j] += np.uint64(1)
        assert leak.window_hashes(other)[0] != h[0]
    assert leak.window_hashes(codes[:15])[0] == h[0]
    assert len(leak.window_hashes(codes[:14])) == 0


def test_bit_table_lets_all_members_pass(monkeypatch):
    monkeypatch.setattr(leak, "MAX_HASHES", 10)
    monkeypatch.setattr(leak, "FILTER_BITS", 1 << 16)
    h = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    keep = leak._filter(h)
    assert keep(h).all()
    assert keep(h + np.uint64(1)).mean() < 0.1


def test_tables_of_numbers_are_no_questions(spark):
    item = "monto " + " ".join(str(k) for k in range(100, 140))
    other = "monto " + " ".join(str(k) for k in range(500, 540))
    assert found(spark, [(1, other), (2, "x " + item)], [(1, item)]) == [(2, 1, "verbatim")]


def test_names_of_other_lengths(spark):
    text = "En la causa el perito Juan Soto declaró que la suma adeudada por el señor Pedro Rojas era de 12 cuotas iguales y que no hubo pago alguno."
    changed = text.replace("Juan Soto", "Ana María Muñoz Vidal").replace("12", "40")
    assert (1, 1, "reparameterised") in found(spark, [(1, changed)], [(1, text)])


def test_names_are_told_once_for_all_blocks(spark, monkeypatch):
    rng = random.Random(4)
    items = [(k, " ".join(rng.choice(["perito", "Soto", "soto" if k > 5 else "Rojas", "7", "pago", "cuotas", "causa"]) for _ in range(40))) for k in range(12)]
    docs = [(k, t.replace("7", "9")) for k, t in items]
    whole = found(spark, docs, items)
    monkeypatch.setattr(leak, "BLOCK_CHARS", 300)
    assert found(spark, docs, items[::-1]) == whole
