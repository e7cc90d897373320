"""Problem 1: personal information inside free text.

A text runs through transducers that undo disguises (look-alike and invisible characters, spelled digits, written-out @ and
dots) and remember where each character came from. Identifiers are detected in the plain form, and their spans are mapped back
to the characters of the source. Names are told by a lexicon that is fitted to all case titles.
"""

from __future__ import annotations

import bisect
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legajo.llm import fold

#: Words whose counts a task holds before it hands them on.
HELD_WORDS = 200_000
KINDS = ("email", "phone", "id_number", "address", "name")


# --- transducers ---------------------------------------------------------------------------------------------------------


class Tape:
    """A text and, once it was changed, the source span [start, end) of each of its characters."""

    __slots__ = ("end", "start", "text")

    def __init__(self, text: str):
        self.text, self.start, self.end = text, None, None

    def _track(self) -> None:
        if self.start is None:
            self.start, self.end = list(range(len(self.text))), list(range(1, len(self.text) + 1))

    def characters(self, form) -> None:
        """Replace each character by ``form(character)``, which may be longer or empty."""
        out, start, end = [], [], []
        self._track()
        for k, c in enumerate(self.text):
            new = form(c)
            out.append(new)
            start += [self.start[k]] * len(new)
            end += [self.end[k]] * len(new)
        self.text, self.start, self.end = "".join(out), start, end

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace spans (lo, hi, new), in order; all of the new characters stand for all of the old."""
        out, start, end, at = [], [], [], 0
        self._track()
        for lo, hi, new in edits:
            if lo < at:
                continue
            out += [self.text[at:lo], new]
            start += self.start[at:lo] + [self.start[lo]] * len(new)
            end += self.end[at:lo] + [self.end[hi - 1]] * len(new)
            at = hi
        self.text = "".join([*out, self.text[at:]])
        self.start, self.end = start + self.start[at:], end + self.end[at:]

    def rewrite(self, rx: re.Pattern, form) -> None:
        """Replace each match by ``form(match)``."""
        edits = [(m.start(), m.end(), new) for m in rx.finditer(self.text) if m.start() < m.end() and (new := form(m)) != m.group()]
        if edits:
            self.replace(edits)

    def source(self, lo: int, hi: int) -> tuple[int, int]:
        return (lo, hi) if self.start is None else (self.start[lo], self.end[hi - 1])


_LATIN = {c: row["Latin"] for c, row in fold.ALIKE.items() if "Latin" in row and c != row["Latin"]}


def _shape(c: str) -> str:
    """A character as its plain form: no look-alikes, full-width, styled or invisible ones."""
    if c < "\x80":
        return c
    if c in _LATIN:
        return _LATIN[c]
    if ord(c) in fold.FORMS:
        return fold.FORMS[ord(c)] or ""
    if unicodedata.decomposition(c).startswith("<font>"):
        return unicodedata.normalize("NFKC", c)
    return c


# Digits in words, and what stands for @, a dot and a hyphen.
_DIGITS = {w: str(i) for i, words in enumerate(("cero", "uno", "dos", "tres", "cuatro", "cinco", "seis", "siete", "ocho", "nueve")) for w in words.split()}
_SPELLED = re.compile(r"\b(?:(?:{0}|\d)\b(?:\s+punto\s+|[\s,.\-]{{0,3}})){{4,}}(?:{0}|\d)\b(?:\s+(?:gui[oó]n|raya)\s+(?:{0}|k)\b)?".format("|".join(_DIGITS)), re.I)
#: So many spelled digits in a row of five or more make a number.
LEAST_SPELLED = 3
_BETWEEN = re.compile(r"\W+")
_DIGIT_WORD = re.compile(r"\b(?:%s)\b" % "|".join(_DIGITS), re.I)
_HYPHEN_WORD = re.compile(r"(?<=\d)\s+(?:gui[oó]n|raya)\s+(?=[\dkK]\b)", re.I)
_AT_MARK = re.compile(r"@|[\[({<]\s*(?:@|at|arroba|a)\s*[\])}>]|\barroba\b|(?<=\s)at(?=\s)", re.I)
_DOT = r"(?:\s*[\[({<]\s*(?:punto|dot|pto|\.)\s*[\])}>]\s*|\s+(?:punto|dot)\s+|\.)"
_DOT_RX = re.compile(_DOT, re.I)
#: Read from right to left, so that no length of what stands before matters.
_LOCAL = regex.compile(rf"(?r)(?<![\w+%.-])[\w+%-]+(?:{_DOT}[\w+%-]+){{0,4}}\s*", regex.I)
_DOMAIN = re.compile(rf"\s*[\w-]+(?:{_DOT}[\w-]+){{1,4}}", re.I)


def _spelled(m: re.Match) -> str:
    found = m.group()
    if len(_DIGIT_WORD.findall(found)) < LEAST_SPELLED:
        return found
    return re.sub(r"(?i)(?<=\d)(\s+(?:gui[oó]n|raya)\s+(?=[\dk]))?(?:\s+punto\s+|[\s,.\-]+)?(?=[\dk])", lambda j: "-" if j[1] else "", _DIGIT_WORD.sub(lambda d: _DIGITS[d.group().lower()], found))


def _undisguise(tape: Tape) -> None:
    """Write e-mail addresses with @ and dots: from each mark of an @, the local part to its left and the domain to its right."""
    text, spans = tape.text, {}
    for m in _AT_MARK.finditer(text):
        right = _DOMAIN.match(text, m.end())
        left = right and _LOCAL.match(text, 0, m.start())
        if left:
            local, domain = _DOT_RX.sub(".", left.group().strip()), _DOT_RX.sub(".", right.group().strip())
            if text[left.start() : right.end()] != f"{local}@{domain}" and re.fullmatch(r"[\w+%-]+(?:\.[\w+%-]+)*", local) and re.fullmatch(r"[\w-]+(?:\.[\w-]+)+", domain):
                spans[left.start()] = (right.end(), f"{local}@{domain}")
    if spans:
        tape.replace([(lo, hi, new) for lo, (hi, new) in sorted(spans.items())])


def plain(text: str) -> Tape:
    """The text without disguises. Most texts have none and pass as they are."""
    tape = Tape(text)
    if fold.ODD.search(text):
        tape.characters(_shape)
    low = tape.text.lower()
    _undisguise(tape)
    # The rules are slow; a plain search tells most texts that cannot match.
    if sum(map(_DIGITS.__contains__, _BETWEEN.split(low))) >= LEAST_SPELLED:
        tape.rewrite(_SPELLED, _spelled)
    if "gui" in low or "raya" in low:
        tape.rewrite(_HYPHEN_WORD, lambda m: "-")
    return tape


# --- identifiers ---------------------------------------------------------------------------------------------------------

_EMAIL = re.compile(r"(?<![\w.+%-])[\w+%-]+(?:\.[\w+%-]+)*@[\w-]+(?:\.[\w-]*\w)+")
_GAP = r"[ \t\xa0.\-–\n\r]{0,3}"
#: A stretch that may hold a number of a person: digits and the signs between them.
_NUMERIC = re.compile(r"(?:[+(]\s?){0,2}\d(?:[\d.,\s()\-–—]*[\d])?(?:[\s\-–—]{0,3}[kK]\b)?")
_PREFIX = rf"(?:\(\s*\+?\s*56\s*\)|\+\s*56|0056|56(?=[ .\-\xa0]))"
_PHONE = re.compile(
    rf"(?<![\w$#/@\-])(?<!\d[.,–])(?:{_PREFIX}{_GAP}(?:9|2|[3-7]\d){_GAP}\d{{3,4}}{_GAP}\d{{4}}|(?:{_PREFIX}{_GAP})?\(\s*0?\d{{1,2}}\s*\){_GAP}\d{{3,4}}{_GAP}\d{{4}}|9{_GAP}\d{{4}}{_GAP}\d{{4}}|0(?:2|[3-7]\d){_GAP}\d{{3,4}}{_GAP}\d{{4}})(?!\d|[.,\-–]\d|\s*[-–]\s*[\dkK]\b)"
)
_RUT = re.compile(r"(?<![\w$])(?<![\d][.,\-–])(\d{1,2})[.,\s]?(\d{3})[.,\s]?(\d{3})\s?[-–—]?\s?([\dkK])(?![\w]|[.,]\d|-\d)")
# What numbers of this form are when they are not a person's.
_NUMBERED = re.compile(r"(?:oficios?|partidas?|folios?|boletas?|facturas?|fojas|rol|rit|ruc|causa|expediente|dictamen|decretos?|reglamentos?|ley|resoluci[oó]n|cuenta|p[oó]liza|patente|licitaci[oó]n|orden de compra|serie|\$)\s*(?:n(?:[°ºo.]|ro\.?|[uú]mero)*\s*)?[:.]?\s*$", re.I)


def check_digit(number: int) -> str:
    """The modulo-11 check digit of a RUT."""
    total, factor = 0, 2
    while number:
        number, d = divmod(number, 10)
        total += d * factor
        factor = factor + 1 if factor < 7 else 2
    return "0123456789K"[(11 - total % 11) % 11]


_W = r"(?!(?:EN|QUE|A|CON|POR|SOBRE|SE|E|AL|UN|UNA|AVALUAD[OA])\b)[A-ZÁ-ÖØ-Þ0-9][\w'’\-]*"
_LINK = r"(?:del?|las?|los|el|y)"
_NUMBER = r"(?:\s*,?\s*(?:N\s*[°ºo]\.?|N(?:ro|RO)\.?|(?i:n[uú]m(?:ero)?)\.?|#)\s*\d{1,6}(?:\s?-?[A-Z]\b)?|\s*,?\s+(?i:km)\.?\s*\d+(?:[.,]\d+)?|\s+\d{1,5}\b(?![.,]\d))"
_INNER = r"(?:\s*,?\s+(?i:depto|dpto|dep|departamento|of|oficina|piso|local|casa|block|torre|parcela|lote|sitio|bodega)\b\.?\s*(?:N\s*[°º]\s*|#\s*)?\d[\w\-]*)"
_ESTATE = rf"(?:\s*,\s*(?i:villa|poblaci[oó]n|pobl\.|condominio)\s+{_W}(?:\s+(?:{_W}|{_LINK})){{0,5}}?(?=\s*(?:[,.;)\n]|$|\s(?i:antes|comuna|ciudad)\b)))"
_STREET = re.compile(rf"\b(?P<word>(?i:calle|avenida|avda\.?|av\.|pasaje|psje\.?|pje\.?|camino))\s+(?:{_W}(?:\s+(?:{_W}|{_LINK})){{0,6}}?)(?P<no>{_NUMBER})(?P<in>{_INNER}*)(?P<estate>{_ESTATE}?)")
_STREET_WORDS = ("calle", "aven", "avda", "av.", "av ", "pasaje", "psje", "pje", "camino")
_HOUSE = re.compile(rf"(?:N\s*[°º]|#)\s*\d{{1,6}}\b(?!\.\d)(?P<in>{_INNER}*)(?P<estate>{_ESTATE}?)")
_BEFORE = re.compile(rf"(?<![\w.])(?:(?:{_W}|{_LINK})\s+){{1,6}}$")
_IN = re.compile(r"\ben\s$", re.I)
_TOWN_NEXT = re.compile(r"\s*,\s*(?:comuna|ciudad|[A-ZÁ-ÖØ-Þ])")
_NO_STREET = {"ley", "decreto", "resolucion", "rol", "causa", "oficio", "articulo", "reglamento", "boleta", "factura", "folio", "dictamen", "identidad", "cedula", "rut", "run", "rit", "ruc", "acta", "expediente", "numero"}


def _back(text: str, at: int, words: int) -> int:
    """Where so many words and the spaces around them begin before ``at``, however long they are."""
    for _ in range(words):
        while at and text[at - 1].isspace():
            at -= 1
        while at and not text[at - 1].isspace():
            at -= 1
    return at


def _bare(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    found = []
    low = text.lower()
    if len(low) != len(text):
        low = text
    places = set()
    for word in _STREET_WORDS:
        at = low.find(word)
        while at >= 0:
            places.add(at)
            at = low.find(word, at + 1)
    for at in sorted(places):
        m = _STREET.match(text, at) if not found or at >= found[-1][1] else None
        if not m:
            continue
        end = m.end()
        if m["estate"] and not (m["word"].lower()[0] == "p" or _TOWN_NEXT.match(text, end)):
            end = m.start("estate")
        found.append((m.start(), end))
        yield found[-1]
    if "#" not in text and "º" not in text and "°" not in text:
        return
    for m in _HOUSE.finditer(text):
        k = bisect.bisect_right(found, (m.start(), len(text)))
        if k and m.start() < found[k - 1][1]:
            continue
        before = _BEFORE.search(text, _back(text, m.start(), 7), m.start())
        if not before:
            continue
        start = before.start() + before.group().rstrip().rfind("\n") + 1
        words = text[start : m.start()].split()
        upper = [k for k, w in enumerate(words) if w[0].isupper() or w[0].isdigit()]
        if not upper or _bare(words[-1].strip(".")) in _NO_STREET:
            continue
        start = text.index(words[upper[0]], start)
        if text[start : m.start()].isupper() and not _IN.search(text, max(0, start - 4), start):
            continue
        end = m.end() if not m["estate"] or _TOWN_NEXT.match(text, m.end()) else m.start("estate")
        yield start, end


# --- names ---------------------------------------------------------------------------------------------------------------

# Words that begin the name of a body or a street, and words that end a company's.
_BODIES = set(
    "agricola administradora aguas asociacion banco caja camara centro clinica colegio comercial compania comunidad condominio consejo constructora contraloria cooperativa corporacion corte "
    "direccion distribuidora empresa empresas exportadora fabrica ferreteria fisco fundacion gobernacion hospital ilustre importadora inmobiliaria instituto intendencia inversiones isapre juzgado "
    "liceo ministerio minera municipalidad nueva pesquera publico salud seguros servicio servicios sindicato sociedad supermercado tesoreria transportes tribunal universidad vina estado isapres".split()
)
_TITLES = set("almirante general doctora doctor capitan padre madre santa santo san coronel teniente sargento obispo presidente presidenta comandante cardenal monsenor fray sor calle avenida pasaje camino villa poblacion puerto alto alta los las el la cerro portal".split())
_ENDS = re.compile(r"\s+(?:S\.\s?A\.|SpA\b|SPA\b|Ltda\b|LTDA\b|Limitada\b|LIMITADA\b|E\.I\.R\.L|EIRL\b|(?i:y)\s+(?i:compa[nñ][ií]a)|(?i:hermanos)\s|(?i:e\s+hijos)\b)")
_SIDES = re.compile(r"\s*/\s*|\s+(?i:con|contra)\s+|\b(?i:c)/\s*|\s+(?i:y\s+otr[oa]s?)\b.*|\s+(?i:rut|run)\b.*")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_CAPITAL = re.compile(r"[A-ZÁ-ÖØ-Þ](?<![\w@.].)[^\W\d_]*(?:['’\-][A-ZÁ-ÖØ-Þ]?[^\W\d_]+)*")
_CONNECT = {"de", "del", "la", "las", "los", "von", "van", "da", "dos"}
_JOIN = re.compile(r"\s+(?:(?:de|del|la|las|los|von|van|da)\s+){0,2}$")
# Words before a person's name, in any case.
_CUES = set("don doña dona señor señora señorita senor senora sr sra srta abogado abogada perito perita testigo paciente funcionario funcionaria imputado imputada menor contador contadora notario notaria".split())


#: A word that is so often part of a name is one, however often bodies have it.
LEAST_NAMED = 3


class WordCounts:
    """How often each word of titles is the first word of a name, another one, and a word of a body or company."""

    def __init__(self):
        self.first: Counter[str] = Counter()
        self.other: Counter[str] = Counter()
        self.bodies: Counter[str] = Counter()

    def __len__(self) -> int:
        return len(self.first) + len(self.other) + len(self.bodies)

    def add(self, title: str | None) -> None:
        for side in _SIDES.split(plain(title).text) if title else ():
            words = [_bare(w) for w in _WORD.findall(side or "")]
            words = [w for w in words if w not in _CONNECT and len(w) > 1 and w != "otro" and w != "otra"]
            if not words:
                continue
            if any(w in _BODIES or w in _TITLES for w in words) or _ENDS.search(" " + side + " ") or any(c.isdigit() for c in side):
                self.bodies.update(words)
            elif len(words) <= 6:
                if len(words) >= 3:
                    self.first[words[0]] += 1
                    self.other.update(words[2:])
                else:
                    self.other.update(words[1:] or words)

    def rows(self) -> list[tuple[str, int, int, int]]:
        """(word, first, other, bodies)."""
        return [(w, self.first[w], self.other[w], self.bodies[w]) for w in {*self.first, *self.other, *self.bodies}]


class Lexicon:
    """Name words with their part (given or family), and their forms with one letter left out, for misread ones."""

    def __init__(self, given: set[str], family: set[str]):
        self.given, self.family = given, family
        self.near = {w[:i] + w[i + 1 :] for w in given | family if len(w) > 4 for i in range(len(w))}

    @classmethod
    def fit(cls, titles: list[str | None]) -> Lexicon:
        """From titles "plaintiff c/ defendant": the words of sides that no word of a body or company gives away."""
        counts = WordCounts()
        for title in titles:
            counts.add(title)
        return cls.of((w, f, o) for w, f, o, b in counts.rows() if 2 * (f + o) > b or f + o >= LEAST_NAMED)

    @classmethod
    def of(cls, named: Iterable[tuple[str, int, int]]) -> Lexicon:
        """From words of names and how often each was first and another word of one."""
        given, family = set(), set()
        for word, first, other in named:
            if first + other and word not in _BODIES:
                (given if first > other else family).add(word)
        return cls(given, family)

    def part(self, word: str) -> str:
        """G, F, ~ (close to a name word) or an empty string."""
        low = _bare(word)
        if low in self.given:
            return "G"
        if low in self.family:
            return "F"
        if "-" in low:
            parts = [self.part(w) for w in low.split("-")]
            return "F" if "F" in parts else ""
        if len(low) > 4 and (low in self.near or any(low[:i] + low[i + 1 :] in self.near or low[:i] + low[i + 1 :] in self.family for i in range(len(low)))):
            return "~"
        return ""


class Names:
    """Finds names with a lexicon; words are looked up once for each spelling."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.seen: dict[str, str] = {}

    def _kind(self, word: str) -> str:
        kind = self.seen.get(word)
        if kind is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            low = _bare(word)
            kind = "i" if len(word) == 1 else "c" if low in _CONNECT else "b" if low in _BODIES or low in _TITLES else self.lexicon.part(word) or "u"
            self.seen[word] = kind
        return kind

    def find(self, text: str, taken: bytearray | None = None) -> Iterator[tuple[int, int]]:
        """Spans of names outside of what is ``taken`` (a byte for each character)."""
        seen = self.seen
        words = [(m.start(), m.end(), seen.get(w := m.group()) or self._kind(w)) for m in _CAPITAL.finditer(text)]
        if taken:
            words = [w for w in words if taken.find(1, w[0], w[1]) < 0]
        k = 0
        while k < len(words):
            kind = words[k][2]
            cue = False
            if kind not in "GF":
                before = text[_back(text, words[k][0], 1) : words[k][0]].split() if kind in "~u" else ()
                # In a text of capitals any word may follow.
                cue = bool(before) and before[-1].lower().rstrip(".") in _CUES and not before[-1].isupper()
                if not cue and kind != "~":
                    k += 1
                    continue
            last = k
            run = [k]
            while last + 1 < len(words):
                gap = text[words[last][1] : words[last + 1][0]]
                after = words[last + 1][2]
                tied = _JOIN.match(gap) or (words[last][2] == "i" and re.fullmatch(r"\.\s*", gap))
                if not tied or after not in ("GF~ic" if not cue else "GF~icu"):
                    break
                last += 1
                run.append(last)
            while run and words[run[-1]][2] in "ic":
                run.pop()
            kinds = "".join(words[r][2] for r in run)
            k = last + 1
            # Family names first: "Soto Rojas, Ana".
            if "G" not in kinds and "F" in kinds and k < len(words) and words[k][2] == "G" and re.fullmatch(r",\s+", text[words[run[-1]][1] : words[k][0]]):
                stop = k
                while stop + 1 < len(words) and words[stop + 1][2] in "G" and _JOIN.match(text[words[stop][1] : words[stop + 1][0]]):
                    stop += 1
                alone = stop + 1 >= len(words) or words[stop + 1][2] not in "F~" or not _JOIN.match(text[words[stop][1] : words[stop + 1][0]])
                if alone:
                    run += range(k, stop + 1)
                    k = stop + 1
            if not ("F" in kinds or ("G" in kinds and "~" in kinds) or cue):
                continue
            lo, hi = words[run[0]][0], words[run[-1]][1]
            before = words[run[0] - 1] if run[0] else None
            if before and before[2] == "b" and _JOIN.match(text[before[1] : lo]) and not (text[before[1] : lo].strip() and _bare(text[before[0] : before[1]]) not in _TITLES | {"aguas"}):
                continue
            if _ENDS.match(text, hi):
                continue
            yield lo, hi


def find(text: str | None, names: Names) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each piece of personal information, in code points of ``text``; spans don't overlap."""
    if not text:
        return []
    tape = plain(text)
    t = tape.text
    found: list[tuple[str, int, int]] = []
    taken = bytearray(len(t))

    def take(kind: str, lo: int, hi: int) -> None:
        if hi > lo and taken.find(1, lo, hi) < 0:
            taken[lo:hi] = b"\1" * (hi - lo)
            found.append((kind, *tape.source(lo, hi)))

    if "@" in t:
        for m in _EMAIL.finditer(t):
            take("email", m.start(), m.end())
    for stretch in _NUMERIC.finditer(t):
        lo, hi = stretch.span()
        if hi - lo < 8:
            continue
        for m in _PHONE.finditer(t, lo, hi):
            if not _NUMBERED.search(t, _back(t, m.start(), 6), m.start()):
                take("phone", m.start(), m.end())
        for m in _RUT.finditer(t, lo, hi):
            if check_digit(int(m[1] + m[2] + m[3])) == m[4].upper() and not _NUMBERED.search(t, _back(t, m.start(), 6), m.start()):
                take("id_number", m.start(), m.end())
    for lo, hi in _addresses(t):
        take("address", lo, hi)
    for lo, hi in names.find(t, taken if found else None):
        take("name", lo, hi)
    found.sort(key=lambda x: x[1])
    return found


def fit_lexicon(df: DataFrame, id_col: str = "row_id", title_col: str = "caratulado_s", sample: int | None = None) -> Lexicon:
    """The lexicon of all titles: ``Lexicon.fit`` with words counted by tasks, so that only those of names go to the driver.

    A caller may ask for no more than ``sample`` titles instead, those with the least hash of their id.
    """
    rows = df.filter(F.col(title_col).isNotNull())
    if sample is not None:
        rows = rows.orderBy(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)), F.xxhash64(F.col(id_col)), F.col(id_col)).limit(sample)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = WordCounts()

        def told() -> pa.RecordBatch:
            rows = counts.rows()
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64() if k else pa.string()) for k in range(4)], ["word", "first", "other", "bodies"])

        for batch in batches:
            for title in batch.column("t").to_pylist():
                counts.add(title)
                if len(counts) > HELD_WORDS:
                    yield told()
                    counts = WordCounts()
        yield told()

    words = rows.select(F.col(title_col).alias("t")).mapInArrow(count, "word string, first bigint, other bigint, bodies bigint")
    words = words.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("first", "other", "bodies")))
    named = F.col("first") + F.col("other")
    words = words.filter((named > 0) & ((2 * named > F.col("bodies")) | (named >= LEAST_NAMED)) & ~F.col("word").isin(*_BODIES))
    return Lexicon.of((r.word, r["first"], r.other) for r in words.collect())


def detect(df: DataFrame, lexicon: Lexicon, id_col: str = "row_id", text_cols: tuple[str, ...] = ("texto_sentencia", "caratulado_s")) -> DataFrame:
    """(id_col, field, kind, start_pos, end_pos) of each piece in the text columns.

    Null and empty texts have no rows; repeated rows are repeated; null ids are kept. Other columns are ignored, whatever
    their names. Whole texts are read.
    """
    names = [f"t{i}" for i in range(len(text_cols))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Names(lexicon)
        for batch in batches:
            at, field, kind, start, end = [], [], [], [], []
            for col, name in zip(text_cols, names):
                for k, text in enumerate(batch.column(name).to_pylist()):
                    for what, lo, hi in find(text, finder):
                        at.append(k)
                        field.append(col)
                        kind.append(what)
                        start.append(lo)
                        end.append(hi)
            yield pa.RecordBatch.from_arrays(
                [batch.column("i").take(pa.array(at, pa.int64())), pa.array(field, pa.string()), pa.array(kind, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["i", "field", "kind", "start_pos", "end_pos"]
            )

    id_kind = df.schema[id_col].dataType.simpleString()
    return (
        df.select(F.col(id_col).alias("i"), *(F.col(c).alias(n) for c, n in zip(text_cols, names)))
        .mapInArrow(run, f"i {id_kind}, field string, kind string, start_pos bigint, end_pos bigint")
        .withColumnRenamed("i", id_col)
    )


# The placeholders.
PLACEHOLDER = {"email": "[CORREO]", "phone": "[TELEFONO]", "id_number": "[RUT]", "address": "[DIRECCION]", "name": "[NOMBRE]"}


def redact(df: DataFrame, lexicon: Lexicon, id_col: str = "row_id", text_cols: tuple[str, ...] = ("texto_sentencia", "caratulado_s")) -> DataFrame:
    """id_col and the text columns with each piece replaced by the placeholder of its type, all else untouched."""
    names = [f"t{i}" for i in range(len(text_cols))]

    def clean(text: str | None, finder: Names) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for kind, lo, hi in find(text, finder):
            out += [text[at:lo], PLACEHOLDER[kind]]
            at = hi
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Names(lexicon)
        for batch in batches:
            cols = [pa.array([clean(t, finder) for t in batch.column(n).to_pylist()], pa.string()) for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("i"), *cols], ["i", *names])

    id_kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("i"), *(F.col(c).alias(n) for c, n in zip(text_cols, names))).mapInArrow(run, f"i {id_kind}, " + ", ".join(f"{n} string" for n in names))
    return out.withColumnsRenamed({"i": id_col, **dict(zip(names, text_cols))})
