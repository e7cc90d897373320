import pytest
from pyspark.sql import functions as F

from legajo.llm import pii

TITLES = ["JUAN SOTO ROJAS c/ BANCO NORTE", "Ana María Pérez Soto con FISCO", "Pedro Rojas Muñoz / Clínica Pérez S.A.", "ANA SOTO PÉREZ C/ Muñoz", "Pedro Muñoz Rojas c/ Rojas", None, "", "María Muñoz Pérez / MUÑOZ"] * 2
NAMES = pii.Names(pii.Lexicon.fit(TITLES))


def found(text, kind=None):
    return [text[a:b] if kind else (k, text[a:b]) for k, a, b in pii.find(text, NAMES) if kind in (None, k)]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Escriba a ana.soto+1@correo.example.", "ana.soto+1@correo.example"),
        ("mail ANA_1 [arroba] correo [punto] example.", "ANA_1 [arroba] correo [punto] example"),
        ("a ana(at)correo.example;", "ana(at)correo.example"),
        ("(ana @ correo.example)", "ana @ correo.example"),
        ("es ana arroba correo punto example, sí", "ana arroba correo punto example"),
        ("es аna@c\u200borreo.example!", "аna@c\u200borreo.example"),
    ],
)
def test_email(text, want):
    assert found(text, "email") == [want]


@pytest.mark.parametrize("number", ["+56 9 0928 6710", "(+56) 9 01979705", "+56-2-05532975", "0056 9 1941 6305", "56 2 1365 6042", "9 1887 1140", "9-1250-8127", "9.0661.5484", "907186554", "(02) 0863 1304", "+56906455520", "+56\u00a09\u00a00364\u00a06916", "nueve uno dos tres cuatro cinco seis siete ocho"])
def test_phone(number):
    assert found(f"fono {number}; luego", "phone") == [number]


def test_not_phones():
    assert found("Rol N° O-28444-2013, suma $44.819.841, folio 90718, boleta N° 907186554, V-98444-2013", "phone") == []


@pytest.mark.parametrize("number", ["43747890-2", "39.769.340-6", "437952663", "42,256,584-1", "44 485 868-0", "32.486.883 - 6", "32.749.179–2", "34536031-k"])
def test_id_number(number):
    assert found(f"RUT: {number}, domiciliado", "id_number") == [number]


def test_not_id_numbers():
    assert found("Que el oficio 39.769.340-6 dio cuenta; RUT 39.769.340-7; partida 43747890-2", "id_number") == []


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("en calle Diez Sur N° 4732 antes", "calle Diez Sur N° 4732"),
        ("en calle Cerro Pelado,\nnúmero 230, Paracora.", "calle Cerro Pelado,\nnúmero 230"),
        ("en Pasaje El Mirador 8921, Población Padre Pérez, ciudad de X", "Pasaje El Mirador 8921, Población Padre Pérez"),
        ("oficina en Tres Oriente Nº2129, local 567, Villa Llapulli.", "Tres Oriente Nº2129, local 567"),
        ("en Almirante Lon #2472 antes", "Almirante Lon #2472"),
        ("en AVENIDA Los Olmos 8506, departamento 521, comuna de R", "AVENIDA Los Olmos 8506, departamento 521"),
        ("en camino Padre Pérez km 9, parcela 47, Rute.", "camino Padre Pérez km 9, parcela 47"),
        ("en Av. El Mirador 7332, dpto 552 antes", "Av. El Mirador 7332, dpto 552"),
    ],
)
def test_address(text, want):
    assert found(text, "address") == [want]


def test_not_addresses():
    assert found("gravó un camino ilegible avaluado en 5684 unidades; Ley N° 19.300; Rol N° 12; vías Tres Oriente y Rucamalal", "address") == []


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("la testigo doña Ana María Pérez Soto declaró", ["Ana María Pérez Soto"]),
        ("Dictada por ROJAS MUÑOZ, PEDRO, juez", ["ROJAS MUÑOZ, PEDRO"]),
        ("los hijos Soto Rojas, Juan y Ana Muñoz con su padre", ["Soto Rojas, Juan", "Ana Muñoz"]),
        ("Autoriza doña Ana J. Soto de la Rojas, secretaria", ["Ana J. Soto de la Rojas"]),
        ("el abogado Pedro\nMuñoz-Soto Rojas (x)", ["Pedro\nMuñoz-Soto Rojas"]),
        ("el señor Muñoz guardó silencio", ["Muñoz"]),
        ("Clínica Pérez S.A. y Constructora Soto SpA y Comercial Rojas y Compañía", []),
        ("calle Doctora Pérez, Fundación Capitán Rojas, N.N.", []),
        ("JUAN SOTO ROJAS c/ BANCO PÉREZ", ["JUAN SOTO ROJAS"]),
        ("EL PERITO IMPUTÓ UNA ACEQUIA DE ANA SOTO", ["ANA SOTO"]),
        ("el perito Zzyxx Qwert informó", ["Zzyxx Qwert"]),
    ],
)
def test_name(text, want):
    assert found(text, "name") == want


def test_spans_point_into_the_source():
    text = "\u200bRUN ４３.747.890-2 de A\u200bna Sоto, fono nueve, uno, dos, tres, cuatro, cinco, seis, siete, ocho."
    assert found(text) == [("id_number", "４３.747.890-2"), ("name", "A\u200bna Sоto"), ("phone", "nueve, uno, dos, tres, cuatro, cinco, seis, siete, ocho")]


def test_tape_maps_every_character():
    tape = pii.plain("x\u200by ﬁn [arroba] \U0001d7d9")
    assert "".join(tape.text) == "xy fin [arroba] 1"
    assert tape.source(0, 2) == (0, 3)
    assert tape.source(3, 5) == (4, 5)


def test_frames(spark):
    rows = [(1, "mail a@b.cl y a@b.cl", "ANA SOTO c/ FISCO", "x"), (2, None, None, "x"), (3, "", "", "x"), (None, "fono 907186554", None, "x"), (1, "mail a@b.cl", None, "x")]
    df = spark.createDataFrame(rows, "row_id bigint, texto_sentencia string, caratulado_s string, field string")
    out = sorted((r.row_id or 0, r.field, r.kind, r.start_pos, r.end_pos) for r in pii.detect(df, NAMES.lexicon).collect())
    assert out == [(0, "texto_sentencia", "phone", 5, 14), (1, "caratulado_s", "name", 0, 8), (1, "texto_sentencia", "email", 5, 11), (1, "texto_sentencia", "email", 5, 11), (1, "texto_sentencia", "email", 14, 20)]
    clean = sorted((r.row_id or 0, r.texto_sentencia or "", r.caratulado_s or "") for r in pii.redact(df, NAMES.lexicon).collect())
    assert clean == [(0, "fono [TELEFONO]", ""), (1, "mail [CORREO]", ""), (1, "mail [CORREO] y [CORREO]", "[NOMBRE] c/ FISCO"), (2, "", ""), (3, "", "")]
    assert pii.detect(df.limit(0), pii.fit_lexicon(df.limit(0))).count() == 0


def test_sample_is_bounded_and_repeatable(spark):
    df = spark.createDataFrame([(k, f"Ana Soto{k % 50} Rojas c/ FISCO") for k in range(500)], "row_id bigint, caratulado_s string")
    a, b = pii.fit_lexicon(df, sample=40), pii.fit_lexicon(df.repartition(5), sample=40)
    assert a.family == b.family
    assert len(a.family) <= 41


def test_every_title_counts(spark, monkeypatch):
    # More titles than a sample of 50,000 would hold; forty names stand in one of them each, Zutano in three and in more bodies.
    common = spark.range(60_000).select(F.col("id").alias("row_id"), F.lit("Ana Soto Rojas c/ FISCO").alias("caratulado_s"))
    rare = ["Qwert" + chr(97 + k % 26) + chr(97 + k // 26) for k in range(40)]
    odd = [f"Ana María {w} con FISCO" for w in rare] + ["Zutano Soto Rojas c/ FISCO"] * 3 + ["Banco Zutano / Banco Nada"] * 9 + ["Ana María Nada / FISCO", None, ""]
    df = common.unionByName(spark.createDataFrame([(60_000 + k, t) for k, t in enumerate(odd)], "row_id bigint, caratulado_s string"))
    whole = pii.Lexicon.fit([r.caratulado_s for r in df.collect()])
    assert {w.lower() for w in rare} <= whole.family and "zutano" in whole.given and "nada" not in whole.family
    for held in (200_000, 3):
        monkeypatch.setattr(pii, "HELD_WORDS", held)
        got = pii.fit_lexicon(df.repartition(3))
        assert (got.given, got.family, got.near) == (whole.given, whole.family, whole.near)


@pytest.mark.parametrize("sign", [",", ".", "-", ", "])
def test_spelled_digits_glued_by_signs(sign):
    number = sign.join("nueve ocho siete seis cinco cuatro tres dos uno".split())
    assert found(f"fono {number}; luego", "phone") == [number]


@pytest.mark.parametrize("mark", ["{a}", "<a>", "( at  )", "{ arroba }", "<\tat\t>"])
def test_bracketed_at(mark):
    assert found(f"mail ana {mark} correo.example hoy", "email") == [f"ana {mark} correo.example"]


@pytest.mark.parametrize(
    ("text", "kind", "want"),
    [
        ("a ana(@)correo.example", "email", "ana(@)correo.example"),
        ("a ana[ @ ]correo[ . ]example;", "email", "ana[ @ ]correo[ . ]example"),
        ("a " + "x" * 95 + " arroba correo punto example", "email", "x" * 95 + " arroba correo punto example"),
        ("fono nueve,uno,dos,tres,cuatro,cinco,seis,siete,ocho.", "phone", "nueve,uno,dos,tres,cuatro,cinco,seis,siete,ocho"),
        ("RUT uno dos punto tres cuatro cinco punto seis siete ocho guion cinco.", "id_number", "uno dos punto tres cuatro cinco punto seis siete ocho guion cinco"),
        ("el señor don\n" + " " * 40 + "Zutano Soto", "name", "Zutano Soto"),
    ],
)
def test_no_length_of_what_stands_around_matters(text, kind, want):
    assert found(text, kind) == [want]


def test_case_words_far_before_a_number():
    assert found("boleta   n°" + " " * 60 + "907186554", "phone") == []
