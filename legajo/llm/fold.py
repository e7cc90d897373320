"""Characters as they look: one form for text whose glyphs are the same.

``canonical`` keeps every visible difference (case, accents, punctuation, line breaks, number of spaces).
``words`` goes further and gives the words of a text without case and accents.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import regex

# Letters of one shape, one row each, by script in the order of SCRIPTS; "." where a script has none.
SCRIPTS = ("Latin", "Greek", "Cyrillic", "Armenian", "Cherokee", "Lisu")
SHAPES = """
A Α А . Ꭺ ꓮ
B Β В . Ᏼ ꓐ
C Ϲ С . Ꮯ ꓚ
D . . . Ꭰ ꓓ
E Ε Е . Ꭼ ꓰ
F Ϝ . . . ꓝ
G . Ԍ . Ꮐ ꓖ
H Η Н . Ꮋ ꓧ
I Ι І . . ꓲ
J Ϳ Ј . Ꭻ ꓙ
K Κ К . Ꮶ ꓗ
L . . . Ꮮ ꓡ
M Μ М . Ꮇ ꓟ
N Ν . . . ꓠ
O Ο О Օ . ꓳ
P Ρ Р . Ꮲ ꓑ
Q . Ԛ . . .
R . . . Ꭱ ꓣ
S . Ѕ Տ Ꮪ ꓢ
T Τ Т . Ꭲ ꓔ
U . . Ս . ꓴ
V . Ѵ . Ꮩ ꓦ
W . Ԝ . Ꮃ ꓪ
X Χ Х . . ꓫ
Y Υ Ү . . ꓬ
Z Ζ . . Ꮓ ꓜ
a . а . . .
c ϲ с . . .
d . ԁ . . .
e . е . . .
g . . ց . .
h . һ հ . .
i . і . . .
j ϳ ј յ . .
l . ӏ . . .
n . . ո . .
o ο о օ . .
p ρ р . . .
q . ԛ զ . .
s . ѕ . . .
u υ . ս . .
v ν ѵ . . .
w . ԝ . . .
x . х . . .
y . у . . .
"""
# Further letters of a script with the shape of a row's Latin letter.
MORE = {"Ӏ": "I", "Ꮢ": "R", "ɑ": "a", "ɡ": "g"}

#: letter -> {script: letter of the same shape}
ALIKE: dict[str, dict[str, str]] = {}
for _row in SHAPES.split("\n"):
    _shapes = {s: c for s, c in zip(SCRIPTS, _row.split()) if c != "."}
    ALIKE |= dict.fromkeys(_shapes.values(), _shapes)
for _letter, _latin in MORE.items():
    _own = next(s for s in SCRIPTS if regex.fullmatch(rf"\p{{scx={s}}}", _letter))
    # As a letter of its own script it stays what it is, unless that is Latin.
    ALIKE[_letter] = ALIKE[_latin] if _own == "Latin" else {**ALIKE[_latin], _own: _letter}


def _forms() -> dict[int, str | None]:
    """Full-width, ligature, styled, numeral, space, hyphen and invisible characters and what they become."""
    out: dict[int, str | None] = {}
    for cp in [*range(0x80, 0x3400), *range(0xA000, 0xAC00), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800), *range(0xE0100, 0xE01F0)]:
        c = chr(cp)
        kind = unicodedata.decomposition(c)
        name = unicodedata.name(c, "")
        if unicodedata.category(c) == "Zs":
            out[cp] = " "
        elif (unicodedata.category(c) == "Cf" and "NUMBER" not in name and "SIGN" not in name and "END OF AYAH" not in name) or "VARIATION SELECTOR" in name or name.endswith(("FILLER", "GRAPHEME JOINER")):
            out[cp] = None
        elif name in ("HYPHEN", "NON-BREAKING HYPHEN", "MINUS SIGN"):
            out[cp] = "-"
        elif kind.startswith(("<wide>", "<narrow>", "<font>")) or (kind.startswith("<compat>") and ("LIGATURE" in name or "ROMAN NUMERAL" in name)):
            out[cp] = unicodedata.normalize("NFKD", c)
    return out


FORMS = _forms()
#: Anything beyond composed Latin letters and signs; without it a text is in canonical form already.
ODD = re.compile("[^\\x00-\\x9f\\xa1-\\xac\\xae-\\u0250\\u0252-\\u0260\\u0262-\\u02af\\u2013\\u2014\\u2018-\\u201f\\u2022\\u2026\\u20ac]")
_FOREIGN = re.compile("[\\u0251\\u0261\\u0370-\\u052f\\u0531-\\u0587\\u13a0-\\u13ff\\ua4d0-\\ua4ff]")
_TOKEN = re.compile(r"(?:[^\W\d_][\u0300-\u036f]*)+")


@lru_cache(maxsize=65536)
def scripts(letter: str) -> frozenset[str]:
    """The scripts that a letter is used in (Script_Extensions); of others than SCRIPTS the first word of its name."""
    found = frozenset(s for s in SCRIPTS if regex.fullmatch(rf"\p{{scx={s}}}", letter))
    return found or frozenset({unicodedata.name(letter, "NONE").split(" ")[0].title()})


@lru_cache(maxsize=65536)
def resolve(token: str) -> tuple[str, str]:
    """A token of decomposed letters in the spelling of one script, and what it was.

    The script sets of its letters are intersected: ``single`` when they have a script in common, ``mixed`` when they have
    none, ``whole`` when they have one but all letters have the shapes of Latin ones too. A token becomes Latin where
    that spells it wholly, else the script that does; where no script does, each letter takes its first shape.
    """
    own: frozenset[str] | None = None
    able: frozenset[str] | None = None
    for c in token:
        if unicodedata.combining(c):
            continue
        mine = scripts(c)
        own = mine if own is None else own & mine
        shapes = mine | ALIKE[c].keys() if c in ALIKE else mine
        able = shapes if able is None else able & shapes
    if not able:
        return "".join(next(iter(ALIKE[c].values())) if c in ALIKE else c for c in token), "mixed"
    target = next((s for s in SCRIPTS if s in able), None) or min(able)
    kind = "mixed" if not own else "single" if target in own else "whole"
    return "".join(ALIKE[c].get(target, c) if c in ALIKE else c for c in token), kind


def _consistent(m: re.Match) -> str:
    token = m.group()
    return resolve(token)[0] if _FOREIGN.search(token) else token


def canonical(text: str) -> str:
    """The one form of all texts that look like ``text``."""
    if not ODD.search(text):
        return text
    text = unicodedata.normalize("NFD", text.translate(FORMS))
    if _FOREIGN.search(text):
        text = _TOKEN.sub(_consistent, text)
    return unicodedata.normalize("NFC", text)


@lru_cache(maxsize=65536)
def _plain(c: str) -> str:
    """A character beyond ASCII without accents; a space where it is neither letter nor digit."""
    bare = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
    if c in "ªº" or bare.isalpha() or bare.isdigit():
        return bare
    return "" if unicodedata.combining(c) else " "


_GAPS = {i: " " for i in range(128) if not chr(i).isalnum()}


def words(text: str, lower: bool = True) -> list[str]:
    """The words of a text: runs of letters and digits as they look, without accents and (by default) case."""
    text = canonical(text)
    if lower:
        text = text.lower()
    if not text.isascii():
        for c in set(text):
            if c > "\x7f":
                text = text.replace(c, _plain(c))
    return text.translate(_GAPS).split()
