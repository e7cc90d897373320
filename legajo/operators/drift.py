"""Problem 2: schemas that drift between the files of a feed.

Each file's fields are profiled (JSON types, a sketch of keyed values). Fields that vanish and fields that appear in the next
file are matched one to one by content, type and name; matched ones are renames. All files are then read into one table of typed
columns, each of a type that holds all values of its field, and what was widened is told.
"""

from __future__ import annotations

import difflib
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from legajo.operators.nested import parse
from legajo.session import materialise, shared_folder

#: Values that a field's sketch keeps: those of the records with the least key hashes, the same records in every file.
SKETCH = 1024
SALT = 64
#: Share of common records whose values must agree for a rename.
AGREE = 0.5
#: Distinct values that each of two fields has at least, if they share no record and only their values tell that they are one.
LEAST_DISTINCT = 3
_ATOM = re.compile(r"[^\W\d_]+|\d+")
_KINDS = {bool: "boolean", int: "number", float: "number", str: "string", list: "array", dict: "object"}


def atoms(value: object) -> list[str]:
    """The words and numbers of a value in any wrapping: a string, a list around it, or an object of its parts."""
    if value is None or isinstance(value, bool):
        return []
    if isinstance(value, list):
        return [a for v in value for a in atoms(v)]
    if isinstance(value, dict):
        return [a for v in value.values() for a in atoms(v)]
    return [a.lstrip("0") or "0" for a in _ATOM.findall(str(value).lower())]


def _bare(value: object) -> list[str]:
    """What stands for a value without words and numbers: booleans, and strings of signs."""
    if isinstance(value, list):
        return [a for v in value for a in _bare(v)]
    if isinstance(value, dict):
        return [a for v in value.values() for a in _bare(v)]
    return [a] if value is not None and (a := str(value).strip().lower()) else []


def _value_hash(value: object) -> int | None:
    found = sorted(atoms(value) or _bare(value))
    return xxhash.xxh3_64_intdigest(" ".join(found)) >> 1 if found else None


def profile(records: DataFrame, payload_col: str = "payload", feed_col: str = "feed_id", file_col: str = "file_no", key_field: str = "id") -> DataFrame:
    """(feed, file, field, kinds, n, whole, sketch) of each field of each file.

    Only payloads that are JSON objects count; null, empty, truncated and other payloads have no fields. ``whole`` tells that no number has a fraction or more than 64 bits. ``sketch`` holds
    (hash of the record's key, hash of the value) for at most ``SKETCH`` records. Tasks send one row for each field of each
    file they saw, so a hot feed is combined before the shuffle.
    """

    def rows(seen: dict[tuple, list]) -> pa.RecordBatch:
        keys = list(seen)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([k[2].encode("utf-8", "replace").decode() for k in keys], pa.string()),
                pa.array([sorted(seen[k][0]) for k in keys], pa.list_(pa.string())),
                pa.array([seen[k][1] for k in keys], pa.int64()),
                pa.array([seen[k][3] for k in keys], pa.bool_()),
                pa.array([[{"key": a, "value": b} for a, b in sorted(seen[k][2].items())[:SKETCH]] for k in keys], pa.list_(pa.struct([("key", pa.int64()), ("value", pa.int64())]))),
            ],
            ["feed", "file", "field", "kinds", "n", "whole", "sketch"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list] = {}
        for batch in batches:
            for feed, file, text in zip(*(batch.column(c).to_pylist() for c in ("feed", "file", "p"))):
                record = parse(text)
                if not isinstance(record, dict):
                    continue
                key = record.get(key_field)
                mark = xxhash.xxh3_64_intdigest(" ".join(atoms(key))) >> 1 if atoms(key) else None
                for field, value in record.items():
                    entry = seen.setdefault((feed, file, field), [set(), 0, {}, True])
                    entry[1] += 1
                    if value is not None:
                        kind = _KINDS.get(type(value), "number")
                        entry[0].add(kind)
                        if kind == "number" and not (isinstance(value, int) and -(1 << 63) <= value < 1 << 63):
                            entry[3] = False
                        if mark is not None and (h := _value_hash(value)) is not None:
                            entry[2][mark] = h
                            if len(entry[2]) > 4 * SKETCH:
                                entry[2] = dict(sorted(entry[2].items())[:SKETCH])
            if len(seen) > 20_000:
                yield rows(seen)
                seen = {}
        yield rows(seen)

    parts = records.select(F.col(feed_col).alias("feed"), F.col(file_col).cast("int").alias("file"), F.col(payload_col).alias("p")).mapInArrow(
        run, "feed string, file int, field string, kinds array<string>, n bigint, whole boolean, sketch array<struct<key:bigint,value:bigint>>"
    )

    def combined(df: DataFrame, *by: str) -> DataFrame:
        return df.groupBy(*by).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))).alias("kinds"),
            F.sum("n").alias("n"),
            F.bool_and("whole").alias("whole"),
            F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sketch")))), 1, SKETCH).alias("sketch"),
        )

    # In two steps, so that a file that many tasks saw gathers SALT sketches at most.
    salted = parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALT)))
    return combined(combined(salted, "feed", "file", "field", "salt"), "feed", "file", "field")


def match(cost: np.ndarray) -> list[tuple[int, int]]:
    """The assignment of rows to columns of least total cost (Hungarian method with potentials)."""
    turned = cost.shape[0] > cost.shape[1]
    a = cost.T if turned else cost
    n, m = a.shape
    u, v, p, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        p[0], j0 = i, 0
        least, used = np.full(m + 1, np.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            free = ~used[1:]
            slack = a[p[j0] - 1] - u[p[j0]] - v[1:]
            better = free & (slack < least[1:])
            least[1:][better], way[1:][better] = slack[better], j0
            j1 = int(np.argmin(np.where(free, least[1:], np.inf))) + 1
            delta = least[j1]
            u[p[used]] += delta
            v[used] -= delta
            least[~used] -= delta
            j0 = j1
            if not p[j0]:
                break
        while j0:
            p[j0], j0 = p[way[j0]], way[j0]
    pairs = [(int(p[j]) - 1, j - 1) for j in range(1, m + 1) if p[j]]
    return [(j, i) for i, j in pairs] if turned else pairs


def likeness(old: dict, new: dict) -> float:
    """How well a new field carries an old one's content; 0 where the contents don't agree.

    Values are compared record by record where the files share records, else as sets. Types and names only break ties.
    """
    a, b = old["sketch"], new["sketch"]
    common = a.keys() & b.keys()
    if common:
        content = sum(a[k] == b[k] for k in common) / len(common)
    else:
        x, y = set(a.values()), set(b.values())
        content = len(x & y) / min(len(x), len(y)) if min(len(x), len(y)) >= LEAST_DISTINCT else 0.0
    if common and content < 1 and "boolean" in {*old["kinds"], *new["kinds"]}:
        # Two values agree often by chance; only what is beyond counts.
        x, y = (Counter(f[k] for k in common) for f in (a, b))
        chance = sum(n * y[v] for v, n in x.items()) / len(common) ** 2
        content = (content - chance) / (1 - chance) if chance < 1 else 0.0
    if content < AGREE:
        return 0.0
    kinds = len(set(old["kinds"]) & set(new["kinds"])) / max(1, len(set(old["kinds"]) | set(new["kinds"])))
    name = difflib.SequenceMatcher(None, old["field"].lower(), new["field"].lower()).ratio()
    return content + 0.05 * kinds + 0.1 * name


def _renames(fields: list[dict]) -> list[tuple[str, str, bool]]:
    """(old, new, retyped) of the vanished fields of a pair of files that a new one carries on."""
    rows = [{**r, "sketch": {x["key"]: x["value"] for x in r["sketch"]}} for r in sorted(fields, key=lambda r: r["field"])]
    old, new = [r for r in rows if r["gone"]], [r for r in rows if not r["gone"]]
    if not old or not new:
        return []
    like = np.array([[likeness(o, n) for n in new] for o in old])
    return [(old[i]["field"], new[j]["field"], sorted(old[i]["kinds"]) != sorted(new[j]["kinds"])) for i, j in match(-like) if like[i, j] > 0]


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[tuple] = [(feed, file, *r) for feed, file, fields in zip(*(batch.column(c).to_pylist() for c in ("feed", "file", "fields"))) for r in _renames(fields)]
        cols = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()))], ["feed", "file", "old", "new", "retyped"])


def changes(profiles: DataFrame) -> DataFrame:
    """(feed, file, field_name, change_kind, new_name) between each file and the one before it in its feed.

    Files without any well-formed record are passed over. Only vanished and new fields of a pair of files are gathered for
    matching, which are as many as a file has fields at most.
    """
    # Profiles and what differs are small and used several times; written out, they are made once.
    folder = shared_folder(profiles.sparkSession)
    profiles = materialise(profiles, folder, "profiles")
    files = profiles.select("feed", "file").distinct()
    pairs = files.withColumn("before", F.lag("file").over(Window.partitionBy("feed").orderBy("file"))).filter("before is not null")
    now = profiles.join(pairs.select("feed", "file"), ["feed", "file"]).select("feed", "file", "field", F.col("kinds").alias("kinds_b"), F.col("sketch").alias("sketch_b"))
    then = profiles.withColumnRenamed("file", "before").join(pairs, ["feed", "before"]).select("feed", "file", "field", F.col("kinds").alias("kinds_a"), F.col("sketch").alias("sketch_a"))
    both = materialise(then.join(now, ["feed", "file", "field"], "full"), folder, "both")
    gone, new = F.col("kinds_b").isNull(), F.col("kinds_a").isNull()
    loose = both.filter(gone | new).select("feed", "file", "field", gone.alias("gone"), F.coalesce("kinds_a", "kinds_b").alias("kinds"), F.coalesce("sketch_a", "sketch_b").alias("sketch"))
    # Only pairs of files with fields of both kinds have anything to match.
    mixed = loose.groupBy("feed", "file").agg(F.count_if("gone").alias("a"), F.count_if(~F.col("gone")).alias("b")).filter("a > 0 and b > 0").select("feed", "file")
    # One row for each pair of files, spread evenly: the step takes time by its number of pairs, not by their bytes.
    ready = loose.join(mixed, ["feed", "file"], "left_semi").groupBy("feed", "file").agg(F.collect_list(F.struct("field", "gone", "kinds", "sketch")).alias("fields"))
    tasks = max(2, profiles.sparkSession.sparkContext.defaultParallelism)
    renamed = materialise(ready.repartition(tasks, "feed", "file").mapInArrow(_matched, "feed string, file int, old string, new string, retyped boolean"), folder, "renamed")
    taken = renamed.select("feed", "file", F.explode(F.array("old", "new")).alias("field"))
    plain = loose.join(taken, ["feed", "file", "field"], "left_anti").select("feed", "file", F.col("field").alias("field_name"), F.when(F.col("gone"), "removed").otherwise("added").alias("change_kind"), F.lit("").alias("new_name"))
    retyped = both.filter(~gone & ~new & (F.col("kinds_a") != F.col("kinds_b"))).select("feed", "file", F.col("field").alias("field_name"), F.lit("type_changed").alias("change_kind"), F.lit("").alias("new_name"))
    moved = renamed.select(
        "feed", "file", F.explode(F.concat(F.array(F.struct(F.col("old").alias("f"), F.lit("renamed").alias("k"), F.col("new").alias("n"))), F.when(F.col("retyped"), F.array(F.struct(F.col("new").alias("f"), F.lit("type_changed").alias("k"), F.lit("").alias("n")))).otherwise(F.array()))).alias("x")
    ).select("feed", "file", F.col("x.f").alias("field_name"), F.col("x.k").alias("change_kind"), F.col("x.n").alias("new_name"))
    return plain.unionByName(retyped).unionByName(moved)


def _chains(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """The name under which each field of each file of a feed is read: its first name in the feed."""
    out = []
    names: dict[str, str] = {}
    for file, rows in pdf.sort_values("file", kind="stable").groupby("file", sort=True):
        moved = {r.new_name: names.get(r.field_name, r.field_name) for r in rows.itertuples() if r.new_name}
        names.update(moved)
        out += [(key[0], int(file), new, first) for new, first in names.items() if new != first]
        for r in rows.itertuples():
            if r.change_kind == "added":
                names.pop(r.field_name, None)
    return pd.DataFrame(out, columns=["feed", "file", "name", "first_name"])


def _column_names(fields: list[str], taken: list[str]) -> dict[str, str]:
    """A column for each field; Spark's columns know no letter case, so of names that differ by it the later ones get a number."""
    used = {c.lower() for c in taken}
    out = {}
    for f in sorted(fields):
        name, k = f or "_", 1
        while name.lower() in used:
            k += 1
            name = f"{f}_{k}"
        used.add(name.lower())
        out[f] = name
    return out


def _widest(kinds: set[str], whole: bool) -> str:
    """The narrowest type that holds all values of these JSON types."""
    if not kinds <= {"string", "number", "boolean"}:
        return "string" if kinds == {"object"} else "array<string>"
    if kinds == {"boolean"}:
        return "boolean"
    if kinds == {"number"}:
        return "bigint" if whole else "double"
    return "string"


def _names(changed: DataFrame) -> DataFrame:
    """(feed, file, until, names): from which file to which one fields have other names than their first ones."""
    moves = changed.filter("change_kind in ('renamed', 'added')")
    names = moves.groupBy("feed").applyInPandas(_chains, "feed string, file int, name string, first_name string")
    # A file without changes keeps the names of the one before it: names hold from their file to the next one that has any.
    spans = names.groupBy("feed", "file").agg(F.map_from_arrays(F.collect_list("name"), F.collect_list("first_name")).alias("names"))
    return spans.withColumn("until", F.lead("file").over(Window.partitionBy("feed").orderBy("file")))


def _held_names(files: DataFrame, changed: DataFrame) -> DataFrame:
    f, s = files.alias("f"), _names(changed).alias("s")
    return f.join(s, (F.col("f.feed") == F.col("s.feed")) & (F.col("f.file") >= F.col("s.file")) & (F.col("f.file") < F.coalesce("s.until", F.lit(2**31 - 1)))).select("f.feed", "f.file", "s.names")


def unified_schema(profiles: DataFrame, changed: DataFrame, taken: tuple[str, ...] = ("rec_id", "feed_id", "file_no")) -> DataFrame:
    """(field_name, column_name, type, kinds, names, files, widened): each field of the unified table.

    ``field_name`` is its first name, ``names`` all it ever had, ``kinds`` the JSON types of its values, ``type`` the narrowest
    type that holds them all, ``widened`` tells that there were several. There is one row for each field, of which the driver
    reads the names.
    """
    spark = profiles.sparkSession
    named = profiles.join(_held_names(profiles.select("feed", "file").distinct(), changed), ["feed", "file"], "left")
    first = F.coalesce(F.try_element_at("names", "field"), F.col("field"))
    fields = named.groupBy(first.alias("field_name")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("kinds")))).alias("kinds"), F.array_sort(F.collect_set("field")).alias("names"), F.count("*").alias("files"), F.bool_and("whole").alias("whole")
    )
    rows = fields.collect()
    columns = _column_names([r.field_name for r in rows], list(taken))
    out = [(r.field_name, columns[r.field_name], _widest(set(r.kinds), r.whole), r.kinds, r.names, r.files, len(r.kinds) > 1) for r in sorted(rows, key=lambda r: r.field_name)]
    return spark.createDataFrame(out, "field_name string, column_name string, type string, kinds array<string>, names array<string>, files bigint, widened boolean")


def _text(value: object) -> str | None:
    text = value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)
    return text and text.encode("utf-8", "replace").decode()


def _typed(value: object, kind: str) -> object:
    if value is None:
        return None
    if kind == "array<string>":
        return [_text(v) for v in value] if isinstance(value, list) else [_text(value)]
    return _text(value) if kind == "string" else float(value) if kind == "double" else value


_ARROW = {"boolean": pa.bool_(), "bigint": pa.int64(), "double": pa.float64(), "string": pa.string(), "array<string>": pa.list_(pa.string())}


def unify(records: DataFrame, profiles: DataFrame, changed: DataFrame, id_col: str = "rec_id", payload_col: str = "payload", feed_col: str = "feed_id", file_col: str = "file_no") -> DataFrame:
    """All well-formed records in one table: id, feed, file, and a typed column for each field.

    A renamed field is found under its first name in its feed. A field that is a list somewhere is a list of texts, one that
    holds several scalar types is text, objects are JSON text; :func:`unified_schema` says what was widened. A null and a missing
    member are both null; records that aren't objects have no row.
    """
    schema = [(r.field_name, r.column_name, r.type) for r in unified_schema(profiles, changed, (id_col, feed_col, file_col)).collect()]
    rows = records.select(F.col(id_col).alias("i"), F.col(feed_col).alias("feed"), F.col(file_col).cast("int").alias("file"), F.col(payload_col).alias("p"))
    joined = rows.join(_held_names(rows.select("feed", "file").distinct(), changed), ["feed", "file"], "left")
    kinds = {f: (k, t) for k, (f, _, t) in enumerate(schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep: list[int] = []
            out: list[list] = [[] for _ in schema]
            for k, (text, names) in enumerate(zip(batch.column("p").to_pylist(), batch.column("names").to_pylist())):
                record = parse(text)
                if isinstance(record, dict):
                    first = dict(names or [])
                    keep.append(k)
                    for column in out:
                        column.append(None)
                    for name, value in record.items():
                        name = name.encode("utf-8", "replace").decode()
                        place, kind = kinds[first.get(name, name)]
                        if value is not None:
                            out[place][-1] = _typed(value, kind)
            cols = [batch.column(c).take(pa.array(keep, pa.int64())) for c in ("i", "feed", "file")]
            yield pa.RecordBatch.from_arrays(cols + [pa.array(x, _ARROW[t]) for x, (_, _, t) in zip(out, schema)], ["i", "feed", "file", *(f"c{k}" for k in range(len(schema)))])

    kind = records.schema[id_col].dataType.simpleString()
    sql = ", ".join([f"i {kind}, feed string, file int", *(f"c{k} {t}" for k, (_, _, t) in enumerate(schema))])
    read = joined.select("i", "feed", "file", "p", "names").mapInArrow(run, sql)
    return read.withColumnsRenamed({"i": id_col, "feed": feed_col, "file": file_col, **{f"c{k}": c for k, (_, c, _) in enumerate(schema)}})
