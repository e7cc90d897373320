"""Sources: directories of JSON documents, and crawls over ascending ids or result pages as Python data sources.

The two crawls read what a fetcher has landed (a directory of answers); ``fetch`` names another callable that gives an answer.
"""

from __future__ import annotations

import importlib
import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from legajo.operators.nested import parse
from legajo.sources.remote import Pace


def json_directory(spark: SparkSession, path: str) -> DataFrame:
    """(name, text, doc, ok): one row for each *.json file of a directory; files that aren't JSON stay, with ok = false."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    doc = F.try_parse_json("value")
    return files.select(name.alias("name"), F.col("value").alias("text"), doc.alias("doc"), doc.isNotNull().alias("ok"))


#: Ids that one array of an id cache holds at most, about.
CACHE_SLICE = 10_000


def id_cache(spark: SparkSession, path: str) -> DataFrame:
    """The distinct ids of a cache: files of JSON arrays, gzipped or not, each array in a line; a corrupt file gives none."""
    text = spark.read.option("ignoreCorruptFiles", True).text(path, wholetext=True)
    arrays = text.select(F.explode(F.split("value", "\\n")).alias("value"))
    return arrays.select(F.explode(F.from_json("value", "array<string>")).alias("id")).filter("id is not null").distinct()


def save_id_cache(ids: DataFrame, path: str) -> None:
    """Write the distinct ids of a column as gzipped JSON arrays of about CACHE_SLICE ids."""
    own = ids.select(F.col(ids.columns[0]).cast("string").alias("id")).filter("id is not null").distinct()
    slices = max(1, own.count() // CACHE_SLICE)
    arrays = own.groupBy(F.pmod(F.xxhash64("id"), F.lit(slices))).agg(F.to_json(F.sort_array(F.collect_list("id"))).alias("value"))
    arrays.select("value").write.mode("overwrite").option("compression", "gzip").text(path)


def filesystem(path: str) -> tuple[object, str]:
    """The file system of a path or URI, so that tasks on any machine read the same files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _fetcher(options: dict) -> Callable[..., str | None]:
    """The callable of option ``fetch`` (module:function), or one that reads ``<path>/<id>.json`` or ``<path>/<base>/<offset>.json``.

    ``path`` is a folder that all executors share, or the URI of one.
    """
    if options.get("fetch"):
        return _named(options["fetch"])
    files, root = filesystem(options["path"])

    def landed(*key: object) -> str | None:
        try:
            with files.open_input_stream(f"{root.rstrip('/')}/{'/'.join(str(k) for k in key)}.json", compression=None) as f:
                return f.read().decode("utf-8", "replace")
        except FileNotFoundError:
            return None

    return landed


def _named(what: str) -> Callable:
    module, _, name = what.partition(":")
    return getattr(importlib.import_module(module), name)


def scan_start(path: str, default: int = 1) -> int:
    """Where a scan goes on: the leading digits of a log file, 1 if it has none, ``default`` without a file."""
    files, name = filesystem(path)
    try:
        with files.open_input_stream(name) as f:
            m = re.match(r"\s*(\d+)", f.read().decode("utf-8", "replace"))
    except FileNotFoundError:
        return default
    return (int(m[1]) if m else 0) or 1


def statute_answer(body: str | None) -> bool:
    """Whether an answer is a statute: an object with metadata."""
    found = parse(body)
    return isinstance(found, dict) and bool(found.get("metadatos"))


class IdCrawl(DataSource):
    """format("id_crawl"): (id, body, error) for start <= id < stop. As a stream it goes on from the last committed id.

    Options: path or fetch, start (1) or log (a file that names it), stop, step (ids of a micro-batch, 100), parts (partitions of a
    batch read, 8), budget and valid (module:function), and those of :class:`Pace`. A stream without ``stop`` goes on until
    ``budget`` (100) answers in a row were not ``valid``; its next run begins anew behind the last valid one, so that ids which
    did not exist yet are asked for again.
    """

    @classmethod
    def name(cls) -> str:
        return "id_crawl"

    def schema(self) -> str:
        return "id bigint, body string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _IdReader(dict(self.options))

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return _IdStream(dict(self.options))


def _start(options: dict) -> int:
    return scan_start(options["log"], int(options.get("start", 1))) if options.get("log") else int(options.get("start", 1))


def _ids(options: dict, lo: int, hi: int) -> Iterator[tuple]:
    fetch, pace = _fetcher(options), Pace(options)
    for k in range(lo, hi):
        body, error = pace.fetch(fetch, k)
        yield k, body, error or (None if body is not None else "no answer")


class _Span(InputPartition):
    def __init__(self, lo: int, hi: int):
        super().__init__((lo, hi))


class _IdReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        lo, hi, n = _start(self.options), int(self.options["stop"]), int(self.options.get("parts", 8))
        edges = [lo + (hi - lo) * k // n for k in range(n + 1)]
        return [_Span(a, b) for a, b in zip(edges, edges[1:]) if a < b]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        return _ids(self.options, *partition.value)


class _IdStream(SimpleDataSourceStreamReader):
    """Offsets are {id: the next one, run: answers in a row up to it that were not valid, since: where the batch began}."""

    def __init__(self, options: dict):
        self.options, self.begun = options, False
        self.budget = int(options.get("budget", 0 if options.get("stop") else 100))
        self.valid = _named(options["valid"]) if options.get("valid") else None

    def initialOffset(self) -> dict:
        lo = _start(self.options)
        return {"id": lo, "run": 0, "since": lo}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        lo, run = start["id"], start["run"]
        if self.budget and not self.begun:
            # A new program asks again for what was not there at the end of the last one.
            lo, run = lo - run, 0
        self.begun = True
        hi = lo + int(self.options.get("step", 100))
        if self.options.get("stop"):
            hi = min(hi, int(self.options["stop"]))
        rows = []
        if not (self.budget and run >= self.budget):
            for row in _ids(self.options, lo, hi):
                rows.append(row)
                good = row[2] is None and (self.valid is None or self.valid(row[1]))
                run = 0 if good else run + 1
                if self.budget and run >= self.budget:
                    break
        return iter(rows), {"id": lo + len(rows), "run": run, "since": lo} if rows else start

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return _ids(self.options, end["since"] if end != start else end["id"], end["id"])

    def commit(self, end: dict) -> None:
        pass


class PageCrawl(DataSource):
    """format("page_crawl"): (base, offset, place, doc, error), one row for each document of the result pages of each base.

    Options: path or fetch, bases (comma-separated), page_size (50), lanes (partitions of a base, 4), first_page (0), pages (as
    many as there are), budget (failed pages in a row that end a lane, 10), and those of :class:`Pace`. Lane i of n reads the
    pages i, i + n, ... up to the first one without documents. A page that fails has a row with its error, and the lane
    goes on with its next one. The end has a row of place -1 without document and error.
    """

    @classmethod
    def name(cls) -> str:
        return "page_crawl"

    def schema(self) -> str:
        return "base string, offset bigint, place int, doc string, error string"

    def reader(self, schema) -> DataSourceReader:
        return _PageReader(dict(self.options))


class _PageReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        lanes = int(self.options.get("lanes", 4))
        return [InputPartition((b.strip(), lane, lanes)) for b in self.options["bases"].split(",") if b.strip() for lane in range(lanes)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        base, lane, lanes = partition.value
        fetch, pace, size, budget = _fetcher(self.options), Pace(self.options), int(self.options.get("page_size", 50)), int(self.options.get("budget", 10))
        first, pages = int(self.options.get("first_page", 0)), self.options.get("pages")
        page, failed = first + lane, 0
        while pages is None or page < first + int(pages):
            offset = page * size
            page += lanes
            body, error = pace.fetch(fetch, base, offset)
            if not error and body:
                found = parse(body)
                docs = found.get("response") if isinstance(found, dict) else None
                docs = docs.get("docs") if isinstance(docs, dict) else None
                if not isinstance(docs, list):
                    error = "not a result page"
            elif not error:
                docs = []
            if error:
                yield base, offset, None, None, error
                failed += 1
                if failed >= budget:
                    yield base, offset, -1, None, None
                    return
                continue
            failed = 0
            if not docs:
                yield base, offset, -1, None, None
                return
            for place, doc in enumerate(docs):
                yield base, offset, place, json.dumps(doc, ensure_ascii=False), None


def register(spark: SparkSession) -> None:
    """Make both crawls known to a session."""
    spark.dataSource.register(IdCrawl)
    spark.dataSource.register(PageCrawl)


# The fields of a search request's filter in the order in which they are sent; text fields are sent blank.
FILTER_FIELDS = "rol era fec_desde fec_hasta tipo_norma num_norma num_art num_inciso todas algunas excluir literal proximidad distancia analisis_s submaterias facetas_seleccionadas filtros_omnibox ids_comunas_seleccionadas_mapa".split()
FILTER_SET = {"analisis_s": "11", "filtros_omnibox": [{"categoria": "TEXTO", "valores": [""]}], "ids_comunas_seleccionadas_mapa": []}


def search_request(token: str, searcher: int, size: int, offset: int, **filters: str) -> dict[str, str]:
    """The form fields of one result page, as a crawl sends them; ``filters`` fills fields that are blank otherwise."""
    given = {f: filters.get(f, FILTER_SET.get(f, "")) for f in FILTER_FIELDS}
    return {"_token": token, "id_buscador": str(searcher), "filtros": json.dumps(given), "numero_filas_paginacion": str(size), "offset_paginacion": str(offset), "orden": "rel"}


def multipart(fields: dict[str, str], boundary: str) -> str:
    """Form fields as a multipart body with CRLF line ends."""
    lines = [x for name, value in fields.items() for x in (f"--{boundary}", f'Content-Disposition: form-data; name="{name}"', "", value)]
    return "\r\n".join([*lines, f"--{boundary}--"])
