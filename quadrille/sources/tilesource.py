"""Tiles as a data source: `spark.read.format("tiles").load(folder)`, and catalogues written by `df.write.format("tiles")`.

Reading a tree: the planner lists folders level by level until there are enough of them for the wanted number of tasks, and each task walks on
below its own. A folder with a catalogue gives that catalogue's tiles and is not entered. Filters on `path` (equal, starts with) keep
other folders from being listed; filters on `format` and on the flat box columns are tested as soon as a tile's small metadata are read, so
that no volume outside is opened; files of a written catalogue whose bounds lie outside are not read.

Writing: every task writes files of a bounded number of tiles to a hidden folder; commit moves them and puts their names, counts, bounds and first and last paths into one index, which
replaces the folder's index by a rename. A job that fails leaves the folder's catalogue as it was.

Options: version, dims and dtype as in tiletree.scan; cache (auto or off); tasks (64). Rows that cannot be read say why in `error`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceWriter,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    StringStartsWith,
    WriterCommitMessage,
)

from . import folders, textproto, volumes, yamlcache
from .tables import spread

_FLAT = [f"{c}{d}" for c in "ose" for d in range(3)]
SCHEMA = (
    "path string, format string, ndim int, " + ", ".join(f"{c} bigint" for c in _FLAT)
    + ", ori array<bigint>, shape array<bigint>, dtype string, dims array<bigint>, crop array<bigint>, transform array<float>, volume string, error string"
)
#: Tiles of one file of a written catalogue at most.
PART = 20_000
#: Tiles of one batch of a task.
FRAME = 1_000
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
#: Columns that a written catalogue keeps.
SAVED = ["path", "ori", "shape", "dtype", "dims", "crop", "transform"]
_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "array<bigint>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32())}
ARROW = pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in SCHEMA.split(", ")])
_TESTS = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, EqualTo: lambda a, b: a == b, In: lambda a, b: a in b, StringStartsWith: lambda a, b: a.startswith(b)}


@dataclass
class Wanted:
    """Pushed filters: (column, test, value)."""

    tests: list[tuple[str, type, object]] = field(default_factory=list)

    def take(self, f: Filter) -> bool:
        """Whether a filter is answered here in full."""
        if isinstance(f, IsNotNull):
            return False
        kind, column = type(f), f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
        fits = column in _FLAT and kind in _TESTS and kind is not StringStartsWith or column in ("path", "format") and kind in (EqualTo, In, StringStartsWith)
        if fits:
            self.tests.append((column, kind, f.value))
        return fits

    def holds(self, row: dict) -> bool:
        """Whether the filters hold, as far as the row's columns are known; null does not."""
        return all(row[c] is not None and _TESTS[kind](row[c], value) for c, kind, value in self.tests if c in row)

    def below(self, folder: str) -> bool:
        """Whether a path that begins with this folder can be wanted."""
        inside = folder.rstrip("/") + "/"

        def may(kind: type, value) -> bool:
            if kind is StringStartsWith:
                return folder.startswith(value) or value.startswith(inside) or inside.startswith(value)
            return any(v == folder or v is not None and v.startswith(inside) for v in (value if kind is In else [value]))

        return all(may(kind, value) for c, kind, value in self.tests if c == "path")

    def meets(self, low: list[int], high: list[int], first: str, last: str) -> bool:
        """Whether a file with tiles of these bounds of o and e, and of paths from first to last, can hold wanted tiles."""
        for c, kind, value in self.tests:
            if c[0] in "oe" and c[1:] in "012":
                a, b = low[int(c[1])], high[int(c[1])]  # every o and e of the axis lies between these
                if kind in (GreaterThan, GreaterThanOrEqual) and not _TESTS[kind](b, value) or kind in (LessThan, LessThanOrEqual) and not _TESTS[kind](a, value):
                    return False
                if kind in (EqualTo, In) and not any(v is not None and a <= v <= b for v in (value if kind is In else [value])):
                    return False
            if c == "path" and kind is EqualTo and not first <= value <= last or c == "path" and kind is StringStartsWith and not (last >= value and (first <= value or first.startswith(value))):
                return False
        return True


def _row(path, kind, ori, shape, dtype, dims, crop, matrix, volume, error) -> dict:
    three = lambda xs: [*xs, *[None] * 3][:3] if xs else [None] * 3
    o, s = three(ori), three(shape)
    e = [None if a is None or n is None else a + n for a, n in zip(o, s)]
    return {"path": path, "format": kind, "ndim": len(ori) if ori else None, **dict(zip(_FLAT, [*o, *s, *e])), "ori": ori, "shape": shape, "dtype": dtype, "dims": dims, "crop": crop, "transform": matrix, "volume": volume, "error": error}


def tile_row(folder: str, files: list[str], options: dict, wanted: Wanted) -> dict | None:
    """The tile of a leaf folder, or None if it has no metadata or is not wanted. The volume's file is opened last, for its header alone."""
    ends = [min((f for f in files if f.endswith(e)), default=None) for e in (".microscope", ".acquisition")]
    if None in ends or not wanted.below(folder):
        return None
    meta = None
    try:
        meta = textproto.tile(*(folders.read_file(f"{folder}/{e}").decode() for e in ends), folder, options.get("version"))
        row = _row(folder, meta["format"], meta["ori"], meta["shape"], None, None, None, None, meta["volume"], None)
        if not wanted.holds(row):
            return None
        dims, dtype = options.get("dims"), options.get("dtype")
        if dims is None:
            first = next((f for f in files if f.endswith((".0.npy", ".0.tif", ".0.tiff"))), None)
            if first is None:
                raise FileNotFoundError("the volume has no file")
            dims, dtype = volumes.header_of(f"{folder}/{first}", first.rsplit(".", 1)[1])
        else:
            dims = [int(x) for x in (dims.split(",") if isinstance(dims, str) else dims)]
        return row | {"dtype": dtype, "dims": dims, "crop": dims, "transform": textproto.transform(meta, dims)}
    except Exception as e:  # noqa: BLE001  (whatever a file holds, its row says so)
        row = _row(folder, meta and meta["format"], meta and meta["ori"], meta and meta["shape"], None, None, None, None, meta and meta["volume"], f"{type(e).__name__}: {e}")
        return row if wanted.holds(row) else None


def cache_rows(path: str, wanted: Wanted) -> Iterator[dict]:
    """Tiles of one catalogue file."""
    for p, _n, ori, shape, dtype, dims, crop, matrix, error in yamlcache.parse(folders.read_file(path).decode()):
        row = _row(p if p is not None else path, None, ori, shape, dtype, dims, crop, matrix, None, error)
        if wanted.holds(row):
            yield row


def catalogue_files(folder: str, files: list[str], wanted: Wanted) -> list[str]:
    """Files of a folder's catalogue that can hold wanted tiles: those of the index, and single caches where there is none."""
    if folders.INDEX not in files:
        return [f"{folder}/{f}" for f in files if folders.fnmatch(f, folders.CACHES)]
    index = json.loads(folders.read_file(f"{folder}/{folders.INDEX}"))
    return [f"{folder}/{p['file']}" for p in index["parts"] if p["low"] is None or wanted.meets(p["low"], p["high"], p["first"], p["last"])]


@dataclass
class Part(InputPartition):
    """What one task reads: folders to walk from, and catalogue files."""

    dirs: list[str]
    files: list[str]


class TileReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.wanted = options, Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def _visit(self, folder: str) -> tuple[str, list[str], list[str]]:
        children, files = folders.listing(folder)
        return folders.kind_of(children, files, self.options.get("cache", "auto") == "auto"), [f"{folder.rstrip('/')}/{c}" for c in children], files

    def partitions(self) -> list[Part]:
        """Lists from the root on, a level at a time, until there are enough folders to deal out."""
        tasks, frontier, leaves, files = int(self.options.get("tasks", 64)), [folders.plain(self.options["path"])], [], []
        while frontier and len(frontier) + len(leaves) < tasks:
            level, frontier = frontier, []
            for folder in level:
                kind, children, names = self._visit(folder)
                if kind == "cache":
                    files += catalogue_files(folder, names, self.wanted)
                elif kind == "leaf":
                    leaves.append(folder)
                else:
                    frontier += [c for c in children if self.wanted.below(c)]
        dirs = leaves + frontier
        n = max(1, min(tasks, len(dirs) + len(files)))
        return [Part(dirs[k::n], files[(n - 1 - k) :: n]) for k in range(n)]

    def read(self, part: Part) -> Iterator[tuple]:
        for path in part.files:
            yield from (tuple(r[c] for c in COLUMNS) for r in cache_rows(path, self.wanted))
        todo = list(part.dirs)
        while todo:
            folder = todo.pop()
            kind, children, names = self._visit(folder)
            rows: list[dict] = []
            if kind == "cache":
                for path in catalogue_files(folder, names, self.wanted):
                    rows += cache_rows(path, self.wanted)
            elif kind == "leaf":
                row = tile_row(folder, names, self.options, self.wanted)
                rows = [row] if row else []
            else:
                todo += [c for c in children if self.wanted.below(c)]
            yield from (tuple(r[c] for c in COLUMNS) for r in rows)


@dataclass
class Written(WriterCommitMessage):
    parts: list[dict]


class CatalogueWriter(DataSourceWriter):
    """Parts are invisible until the index names them.

    Tasks write them to the job's own hidden folder, which the driver makes and commit empties: a task that is still running when the job is given up
    finds no folder to write to, and leaves nothing. A task holds PART tiles at a time, in the order in which they come.
    """

    def __init__(self, path: str, columns: list[str], overwrite: bool):
        self.path, self.columns, self.overwrite, self.job = folders.plain(path), columns, overwrite, uuid.uuid4().hex

    def write(self, rows: Iterator) -> Written:
        parts, held = [], []
        for r in rows:
            row = {c: r[c] if c in self.columns else None for c in SAVED}
            if row["ori"] is not None and row["dims"] is not None:
                held.append(row)
            if len(held) == PART:
                parts.append(self._part(held))
                held = []
        return Written(parts + ([self._part(held)] if held else []))

    def _part(self, held: list[dict]) -> dict:
        kept = sorted(held, key=lambda r: r["path"])
        root = kept[0]["path"].rsplit("/", 1)[0] + "/"
        name = f"part-{self.job}-{uuid.uuid4().hex}.tiles.yml"
        store, at = folders.store_of(f"{self.path}/.job-{self.job}/{name}")
        # each part has the longest root that all its paths share
        while root and not all(r["path"].startswith(root) for r in kept):
            root = root[:-1].rsplit("/", 1)[0] + "/" if "/" in root[:-1] else ""
        with store.open_output_stream(at) as f:
            f.write(yamlcache.dump(kept, root).encode())
        flat = all(len(r["ori"]) >= 3 for r in kept)
        low = [min(r["ori"][d] for r in kept) for d in range(3)] if flat else None
        high = [max(r["ori"][d] + r["shape"][d] for r in kept) for d in range(3)] if flat else None
        return {"file": name, "tiles": len(kept), "low": low, "high": high, "first": kept[0]["path"], "last": kept[-1]["path"]}

    def commit(self, messages: list[Written | None]) -> None:
        store, at = folders.store_of(self.path)
        store.create_dir(at, recursive=True)
        before = []
        try:
            before = json.loads(folders.read_file(f"{self.path}/{folders.INDEX}"))["parts"]
        except FileNotFoundError:
            pass
        parts = [p for m in messages if m for p in m.parts]
        for p in parts:  # no reader looks for them before the index names them
            store.move(f"{at}/.job-{self.job}/{p['file']}", f"{at}/{p['file']}")
        with store.open_output_stream(f"{at}/.index-{self.job}") as f:
            f.write(json.dumps({"parts": ([] if self.overwrite else before) + parts}).encode())
        store.move(f"{at}/.index-{self.job}", f"{at}/{folders.INDEX}")
        if self.overwrite:
            self._delete([p["file"] for p in before])
        self._close()  # with files of tasks that ran twice

    def abort(self, messages: list[Written | None]) -> None:
        self._close()

    def open(self) -> CatalogueWriter:
        """Makes the job's folder."""
        store, at = folders.store_of(self.path)
        store.create_dir(f"{at}/.job-{self.job}", recursive=True)
        return self

    def _close(self) -> None:
        store, at = folders.store_of(self.path)
        for _ in range(3):  # a task may open a file while the folder goes
            try:
                store.delete_dir(f"{at}/.job-{self.job}")
            except FileNotFoundError:
                return
            except OSError:
                continue

    def _delete(self, names: list[str]) -> None:
        store, at = folders.store_of(self.path)
        for n in names:
            store.delete_file(f"{at}/{n}")


class TileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TileReader:
        return TileReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> CatalogueWriter:
        return CatalogueWriter(self.options["path"], [f.name for f in schema.fields], overwrite).open()


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with filters pushed down to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TileSource)


def opened(spark: SparkSession, path: str, save: bool = False, progress: Callable[[int, int, int], None] | None = None, **options) -> DataFrame:
    """Tiles of a tree, walked level by level by tasks however uneven it is. save: the tiles without errors become the root's catalogue, from which the tree opens next time."""
    found = folders.walk(spark, path, options.get("cache", "auto") == "auto", progress).where("kind <> 'inner'")

    def run(batches):
        held: list[dict] = []
        for b in batches:
            for folder, kind, files in zip(*[b.column(c).to_pylist() for c in ("dir", "kind", "files")]):
                if kind == "leaf":
                    row = tile_row(folder, files, options, Wanted())
                    held += [row] if row else []
                else:
                    for f in catalogue_files(folder, files, Wanted()):
                        for row in cache_rows(f, Wanted()):
                            held.append(row)
                            if len(held) == FRAME:
                                yield pa.RecordBatch.from_pylist(held, schema=ARROW)
                                held = []
                if len(held) >= FRAME:
                    yield pa.RecordBatch.from_pylist(held, schema=ARROW)
                    held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=ARROW)

    out = spread(found, 1_000).mapInArrow(run, SCHEMA)
    if save:
        register(spark)
        out.where(F.col("error").isNull()).select(*SAVED).write.format("tiles").mode("overwrite").save(path)  # the writer gets its rows one by one, so columns cost
        out = spark.read.format("tiles").load(path)
    return out
