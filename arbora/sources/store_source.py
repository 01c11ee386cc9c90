"""Taxonomy stores as a data source of Spark: `spark.read.format("taxonomy-store").load(path)` after `register(spark)`.

A store has a line for each name: the name and its parents, shell-quoted; `#` lines are comments, `#:meta name {json}` lines
describe a name.  Files are read by ranges of bytes, as Spark's own text source does: a range owns the lines that begin in
it.  Options:

* `kind`: `entries` (name, parents), `edges` (sub, sup; the default) or `meta` (name, gloss, wn30);
* `columns`: which of these are parsed and sent, by default all;
* `rangeBytes`: how many bytes a task reads, 64 MB by default.

Filters that compare a name (or a parent, in edges) with a value are applied while lines are read; the first field of a line
is compared before the rest is unquoted.

Paths are those that Arrow's file systems open: local ones, and S3, HDFS or GCS by their schemes.  A folder is read with all
of its files but those that begin with `_` or `.`, as writers leave them.
"""

from __future__ import annotations

import json
import re
import shlex
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringStartsWith

SCHEMAS = {"entries": "name string, parents array<string>", "edges": "sub string, sup string", "meta": "name string, gloss string, wn30 string"}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
META = b"#:meta "
CHUNK, TAIL = 1 << 20, 1 << 12
#: Without quotes shlex parts lines at these blanks, and does nothing else.
BLANKS, QUOTES = re.compile("[ \t\r\n]+"), re.compile("['\"\\\\]")


class Range(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


def fields(line: str) -> list[str]:
    """The fields of a line, shell-quoted or, where quotes don't close, parted by blanks."""
    if not QUOTES.search(line):
        return [f for f in BLANKS.split(line) if f]
    try:
        return shlex.split(line, comments=False)
    except ValueError:
        return line.split()


def as_text(value: object) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value)


def columns_of(kind: str, wanted: str | None) -> list[tuple[str, str]]:
    if kind not in SCHEMAS:
        raise ValueError(f"kind is one of {', '.join(SCHEMAS)}, not {kind}")
    known = dict(c.split(" ", 1) for c in SCHEMAS[kind].split(", "))
    names = [c.strip() for c in wanted.split(",")] if wanted else list(known)
    if missing := [c for c in names if c not in known]:
        raise ValueError(f"{kind} have no {', '.join(missing)}")
    return [(c, known[c]) for c in names]


class StoreReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.kind = options["path"], options.get("kind", "edges")
        self.columns = columns_of(self.kind, options.get("columns"))
        self.size = int(options.get("rangeBytes", 64 << 20))
        self.tests: list[tuple[str, str, object]] = []

    def partitions(self) -> list[InputPartition]:
        system, at = pafs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (pafs.LocalFileSystem(), self.path)
        found = system.get_file_info([at])[0]
        if found.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        files = [found] if found.is_file else [f for f in system.get_file_info(pafs.FileSelector(at, recursive=True)) if f.is_file and not any(p.startswith(("_", ".")) for p in f.path[len(at) :].split("/"))]
        return [Range(f.path, i, min(i + self.size, f.size)) for f in sorted(files, key=lambda f: f.path) for i in range(0, f.size, self.size)] or [Range("", 0, 0)]

    def _lines(self, part: Range) -> Iterator[bytes]:
        """Lines that begin in the range; the last one may end beyond it."""
        if not part.path:
            return
        system = pafs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else pafs.LocalFileSystem()
        # No more than the range and what its last line may need.
        chunk = min(CHUNK, part.end - part.start + TAIL)
        with system.open_input_file(part.path) as f:
            at, left = part.start, b""
            if at:
                # The line that is under way here belongs to the range before, unless one ended just there.
                f.seek(at - 1)
                at -= 1
                while True:
                    data = f.read(chunk)
                    if not data:
                        return
                    if (cut := data.find(b"\n")) >= 0:
                        at += cut + 1
                        left = data[cut + 1 :]
                        break
                    at += len(data)
            while at < part.end:
                while (cut := left.find(b"\n")) < 0:
                    data = f.read(chunk)
                    if not data:
                        if left:
                            yield left
                        return
                    left += data
                lines = left[: left.rfind(b"\n")].split(b"\n")
                left = left[left.rfind(b"\n") + 1 :]
                for line in lines:
                    if at >= part.end:
                        return
                    yield line
                    at += len(line) + 1

    def _passes(self, column: str, value: str | None) -> bool:
        for c, how, wanted in self.tests:
            if c == column and not (value is not None and (value in wanted if how == "in" else value.startswith(wanted))):
                return False
        return True

    def _rows(self, part: Range) -> Iterator[tuple]:
        names = [c for c, _ in self.columns]
        for raw in self._lines(part):
            raw = raw.rstrip(b"\r")
            if not raw.strip():
                continue
            if raw.startswith(b"#"):
                if self.kind != "meta" or not raw.startswith(META):
                    continue
                f = fields(raw[len(META) :].decode("utf-8", "replace"))
                if not f or not self._passes("name", f[0]):
                    continue
                try:
                    told = json.loads(f[1]) if len(f) > 1 and names != ["name"] else {}
                except ValueError:
                    told = {}
                row = {"name": f[0]} | ({c: as_text(told.get(c)) for c in ("gloss", "wn30")} if isinstance(told, dict) else {})
                if all(self._passes(c, row.get(c)) for c in ("gloss", "wn30")):
                    yield tuple(row.get(c) for c in names)
                continue
            if self.kind == "meta":
                continue
            line = raw.decode("utf-8", "replace")
            own = "name" if self.kind == "entries" else "sub"
            if self.tests and line[0] not in "'\"\\" and not any(q in line.split(None, 1)[0] for q in "'\"\\") and not self._passes(own, line.split(None, 1)[0]):
                continue
            f = fields(line)
            if not f or not self._passes(own, f[0]):
                continue
            if self.kind == "entries":
                yield tuple({"name": f[0], "parents": f[1:]}[c] for c in names)
            else:
                for sup in dict.fromkeys(f[1:]):
                    if self._passes("sup", sup):
                        yield tuple({"sub": f[0], "sup": sup}[c] for c in names)

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.list_(pa.string()) if t.startswith("array") else pa.string()) for c, t in self.columns])
        held: list[tuple] = []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)
            held.clear()
            return made

        for row in self._rows(partition):
            held.append(row)
            if len(held) >= 8192:
                yield batch()
        if held:
            yield batch()


class PushingReader(StoreReader):
    """Where the session lets Python sources take filters."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        texts = {c for c, t in self.columns if t == "string"}
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if column in texts and isinstance(f, EqualTo):
                self.tests.append((column, "in", {f.value}))
            elif column in texts and isinstance(f, In):
                self.tests.append((column, "in", set(f.value)))
            elif column in texts and isinstance(f, StringStartsWith):
                self.tests.append((column, "prefix", f.value))
            else:
                yield f


class StoreSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "taxonomy-store"

    def schema(self) -> str:
        return ", ".join(f"{c} {t}" for c, t in columns_of(self.options.get("kind", "edges"), self.options.get("columns")))

    def reader(self, schema: object) -> DataSourceReader:
        options = {k: self.options.get(k) for k in ("path", "kind", "columns", "rangeBytes") if self.options.get(k) is not None}
        return (PushingReader if self.options.get("pushed") == "true" else StoreReader)(options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StoreSource)


def read(spark: SparkSession, path: str, kind: str = "edges", columns: list[str] | None = None, range_bytes: int = 64 << 20) -> DataFrame:
    """A store's entries, edges or descriptions; filters reach the reader where the session's spark.sql.python.filterPushdown.enabled is
    set (Spark refuses a reader that takes them elsewhere, so it then applies them itself)."""
    register(spark)
    options = {"kind": kind, "rangeBytes": str(range_bytes), "pushed": spark.conf.get(PUSHDOWN, "false")}
    if columns:
        options["columns"] = ",".join(columns)
    return spark.read.format("taxonomy-store").options(**options).load(path)
