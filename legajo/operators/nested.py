"""Problem 4: deeply nested records as flat tables.

Every object gets a Merkle identity: its members are written in canonical order, objects that are elements of arrays are replaced
by their own identities, and the digest of that text is the object's identity. Equal subtrees have one id wherever they occur.
``occurrences`` is the bridge (one row for each object that is an element of an array, with its place and its parent, and with
``roots`` one for each record), ``objects`` stores each identity once; ``rebuilt`` puts records together again from both.

Nothing recurses, so that a record may nest as deeply as it likes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from decimal import Decimal
from json.decoder import scanstring

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEMA = pa.schema(
    [("k", pa.int32()), ("node_path", pa.string()), ("parent_path", pa.string()), ("depth", pa.int32()), ("ordinal", pa.int32()), ("object_id", pa.string()), ("parent_id", pa.string()), ("members", pa.string())]
)
#: Characters of paths and members that a batch of results holds at least before it is handed on.
FLUSH = 1 << 22
#: The member by which an object's text refers to another object; own names that begin so get one more sign.
REFERENCE = "$object"


def _refuse(name: str) -> None:
    raise ValueError(f"{name} is not JSON")


_DECODER = json.JSONDecoder(parse_constant=_refuse)
_BLANK = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"-?(?:0|[1-9][0-9]*)(\.[0-9]+)?([eE][-+]?[0-9]+)?")
_LITERALS = {"t": ("true", True), "f": ("false", False), "n": ("null", None)}


def _number(m: re.Match) -> int | float | Decimal:
    if m[1] or m[2]:
        return float(m[0])
    return int(m[0]) if len(m[0]) < 4000 else Decimal(m[0])


def _parse_deep(text: str) -> object:
    """The value of a JSON text of any depth, with a stack of its own."""
    stack: list[tuple[object, str]] = []  # open containers, and the member that waits for a value
    at = _BLANK.match(text).end()
    while True:
        # A value begins here.
        c = text[at : at + 1]
        if c == "{" or c == "[":
            here: object = {} if c == "{" else []
            at = _BLANK.match(text, at + 1).end()
            if text[at : at + 1] != ("}" if c == "{" else "]"):
                key = ""
                if c == "{":
                    key, at = _member(text, at)
                stack.append((here, key))
                continue
            at += 1
        elif c == '"':
            here, at = scanstring(text, at + 1, True)
        elif c in _LITERALS and text.startswith(_LITERALS[c][0], at):
            here = _LITERALS[c][1]
            at += len(_LITERALS[c][0])
        elif m := _NUMBER.match(text, at):
            here, at = _number(m), m.end()
        else:
            raise ValueError("not JSON")
        # It ends here, and so may what encloses it.
        while True:
            at = _BLANK.match(text, at).end()
            if not stack:
                if at != len(text):
                    raise ValueError("not JSON")
                return here
            outer, key = stack.pop()
            if isinstance(outer, dict):
                outer[key] = here
            else:
                outer.append(here)
            c = text[at : at + 1]
            if c == ",":
                at = _BLANK.match(text, at + 1).end()
                key = ""
                if isinstance(outer, dict):
                    key, at = _member(text, at)
                stack.append((outer, key))
                break
            if c != ("}" if isinstance(outer, dict) else "]"):
                raise ValueError("not JSON")
            here, at = outer, at + 1


def _member(text: str, at: int) -> tuple[str, int]:
    """A member's name and where its value begins."""
    if text[at : at + 1] != '"':
        raise ValueError("not JSON")
    key, at = scanstring(text, at + 1, True)
    at = _BLANK.match(text, at).end()
    if text[at : at + 1] != ":":
        raise ValueError("not JSON")
    return key, _BLANK.match(text, at + 1).end()


def parse(text: str | None) -> object | None:
    """The value of a JSON text; None for null and malformed text."""
    if text is None:
        return None
    try:
        return _DECODER.decode(text)
    except json.JSONDecodeError:
        return None
    except (ValueError, RecursionError):
        # A name that is no JSON, a number of very many digits, or deep nesting.
        try:
            return _parse_deep(text)
        except ValueError:
            return None


def _held(value: object) -> object:
    """A string that holds a JSON object or array is read as that, however often it was encoded."""
    while isinstance(value, str):
        inner: object = value
        # Encoded texts of encoded texts: what is inside decides.
        while isinstance(inner, str) and inner.strip()[:1] in ("{", "[", '"'):
            inner = parse(inner)
        if not isinstance(inner, (dict, list)):
            return value
        value = inner
    return value


def _identity(text: str) -> str:
    return xxhash.xxh3_128_hexdigest(text.encode("utf-8", "surrogatepass"))


def _scalar(value: object) -> str:
    return str(value) if isinstance(value, Decimal) else json.dumps(value)


def _name(key: str) -> str:
    return json.dumps("$" + key if key.startswith("$") else key)


class _Open:
    """A container whose elements are being read."""

    __slots__ = ("case", "kind", "place", "rest", "texts", "way")

    def __init__(self, value: dict | list, case: int, place: int, way: str):
        self.kind = type(value)
        self.rest = iter(sorted(value.items()) if self.kind is dict else enumerate(value))
        self.texts: list[str] = []
        self.case, self.place, self.way = case, place, way  # its own or the nearest enclosing case; its number if it is one; last step of its path


class _Cases:
    """The cases of one record, in the order in which they begin: parent, place, path from the parent, canonical text."""

    def __init__(self, tree: dict | list):
        self.parent: list[int] = []
        self.place: list[int] = []
        self.way: list[str] = []
        self.text: list[str] = []
        self.id: list[str] = []
        self.root = self._read(tree)

    def _read(self, tree: dict | list) -> str:
        stack = [_Open(tree, -1, -1, "")]
        while True:
            top = stack[-1]
            deeper = False
            for key, value in top.rest:
                if top.kind is dict:
                    way, element = f".{key}", -1
                    top.texts.append(_name(key) + ": ")
                else:
                    way, element = f"[{key}]", key
                if isinstance(value, str):
                    value = _held(value)
                if isinstance(value, (dict, list)):
                    case, place = top.case, -1
                    if element >= 0 and isinstance(value, dict):
                        place = len(self.parent)
                        self.parent.append(case)
                        self.place.append(element)
                        steps = [way]
                        for outer in reversed(stack):
                            if outer.place >= 0:
                                break
                            steps.append(outer.way)
                        self.way.append("".join(reversed(steps)))
                        self.text.append("")
                        self.id.append("")
                        case = place
                    stack.append(_Open(value, case, place, way))
                    deeper = True
                    break
                top.texts.append(_scalar(value))
            if deeper:
                continue
            stack.pop()
            t = top.texts
            text = "{" + ", ".join(map("".join, zip(t[::2], t[1::2]))) + "}" if top.kind is dict else "[" + ", ".join(t) + "]"
            if top.place >= 0:
                self.text[top.place] = text
                self.id[top.place] = _identity(text)
                text = f'{{"{REFERENCE}": "{self.id[top.place]}"}}'
            if not stack:
                return text
            stack[-1].texts.append(text)


def _rows(text: str | None, root: str, roots: bool) -> Iterator[tuple]:
    """(path, parent path, depth, ordinal, object id, parent's id, members) of each case of a record, and first of the record if asked for."""
    tree = _held(parse(text))
    if not isinstance(tree, (dict, list)):
        return
    found = _Cases(tree)
    if roots:
        yield root, None, None, None, _identity(found.root), None, found.root
    above: list[int] = []
    for k, parent in enumerate(found.parent):
        while above and above[-1] != parent:
            above.pop()
        # Paths are put together one by one: those of a deep record take the square of its depth.
        before = root + "".join([found.way[i] for i in above])
        yield before + found.way[k], before if above else "", len(above), found.place[k], found.id[k], found.id[parent] if parent >= 0 else None, found.text[k]
        above.append(k)


def walk(text: str | None, root: str) -> list[tuple]:
    """(path, parent path, depth, ordinal, object id, parent's id, members) of each object in an array; none if malformed."""
    return list(_rows(text, root, False))


def occurrences(df: DataFrame, key_cols: list[str], json_col: str, root: str, roots: bool = False) -> DataFrame:
    """key_cols, node_path, parent_path, depth, ordinal, object_id, parent_id, members for each object in an array.

    ``parent_id`` is null where no enclosing object is a case itself, ``parent_path`` then is ''. ``members`` is the object's
    canonical text: all its members, with {"$object": id} for each object in an array; names that begin with $ have one more. JSON
    in strings is read as what it holds. With ``roots`` each record has a row of its own, of path ``root``, whose parent_path, depth,
    ordinal and parent_id are null. Null, empty, scalar and malformed texts have no rows; null and scalar elements only count
    for positions; of members of one name the last counts. Any depth is read. Null keys and other columns, whatever their
    names, are kept apart.
    """
    names = [f"c{i}" for i in range(len(key_cols))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _SCHEMA]
            size = 0

            def done(batch: pa.RecordBatch = batch) -> pa.RecordBatch:
                cols = [batch.column(n).take(pa.array(out[0], pa.int32())) for n in names] + [pa.array(x, f.type) for x, f in zip(out[1:], list(_SCHEMA)[1:])]
                return pa.RecordBatch.from_arrays(cols, [*names, *_SCHEMA.names[1:]])

            for k, text in enumerate(batch.column("j")):
                for row in _rows(text.as_py(), root, roots):
                    for column, x in zip(out, (k, *row)):
                        column.append(x)
                    size += 2 * len(row[0]) + len(row[6])
                    if size > FLUSH:
                        yield done()
                        out, size = [[] for _ in _SCHEMA], 0
            yield done()

    kinds = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip(names, key_cols))
    out = df.select(*(F.col(c).alias(n) for n, c in zip(names, key_cols)), F.col(json_col).alias("j")).mapInArrow(
        run, f"{kinds}, node_path string, parent_path string, depth int, ordinal int, object_id string, parent_id string, members string"
    )
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, key_cols)), *_SCHEMA.names[1:])


def objects(bridge: DataFrame) -> DataFrame:
    """Each identity once: object_id, members, and how often it occurs. Equal identities have equal members."""
    return bridge.groupBy("object_id").agg(F.first("members").alias("members"), F.count("*").alias("n"))


def rebuilt(root_id: str, members: dict[str, str]) -> object:
    """A record from the identity of its root and the members of all identities; JSON in strings comes out as what it holds."""

    top: list[object] = [None]
    work: list[tuple[object, object, object]] = [(top, 0, parse(members[root_id]))]
    while work:
        holder, key, value = work.pop()
        if isinstance(value, dict) and set(value) == {REFERENCE}:
            value = parse(members[value[REFERENCE]])
        if isinstance(value, dict):
            new: object = {}
            work += [(new, k[1:] if k.startswith("$") else k, v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            new = [None] * len(value)
            work += [(new, i, v) for i, v in enumerate(value)]
        else:
            new = value
        holder[key] = new
    return top[0]
