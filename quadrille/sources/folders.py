"""Folder trees on any file system that pyarrow reaches, walked by tasks; a folder with a catalogue is not entered."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import written

LISTED = "dir string, kind string, children array<string>, files array<string>"
CACHES, INDEX = "*.cache.yml", "tiles.index.json"
#: Folders that one task lists, and names that it holds at a time.
PER_TASK, NAMES = 2_048, 50_000


def store_of(path: str):
    """The file system of a path, and the path on it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def plain(path: str) -> str:
    """A path without the scheme of local files and without a slash at its end."""
    return ("/" + path[5:].lstrip("/") if path.startswith("file:") else path).rstrip("/") or "/"


def read_file(path: str) -> bytes:
    store, at = store_of(path)
    with store.open_input_stream(at) as f:
        return f.read()


def listing(folder: str) -> tuple[list[str], list[str]]:
    """Names of the folders and files in a folder. Hidden ones do not count."""
    from pyarrow import fs

    store, at = store_of(folder)
    found = [f for f in store.get_file_info(fs.FileSelector(at)) if not f.base_name.startswith(".")]
    names = lambda kind: sorted(f.base_name for f in found if f.type == kind)
    return names(fs.FileType.Directory), names(fs.FileType.File)


def kind_of(children: list[str], files: list[str], cached: bool = True) -> str:
    """cache: holds a catalogue, and what lies below is not walked; leaf: holds files and no folder; inner."""
    if cached and (INDEX in files or any(fnmatch(f, CACHES) for f in files)):
        return "cache"
    return "inner" if children or not files else "leaf"


def _listed(cached: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for b in batches:
            for folder in b.column("dir").to_pylist():
                children, files = listing(folder)
                kind = kind_of(children, files, cached)
                rows.append((folder, kind, children if kind == "inner" else [], files))
                held += 1 + len(children) + len(files)
                if held >= NAMES:
                    yield _rows(rows)
                    rows, held = [], 0
        if rows:
            yield _rows(rows)

    return task


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["dir", "kind", "children", "files"])


def walk(spark: SparkSession, root: str, cached: bool = True, progress: Callable[[int, int, int], None] | None = None) -> DataFrame:
    """dir, kind, children, files of every folder from the root on, without those below a catalogue.

    Each level is listed by tasks and is the next level's input; levels are as many as the tree is deep. After each level,
    progress is told the level, its folders and how many of them are leaves or catalogues.
    """
    frontier, level, out = spark.createDataFrame([(plain(root),)], "dir string"), 0, None
    size, cores = 1, spark.sparkContext.defaultParallelism
    while size:
        tasks = max(-(-size // PER_TASK), min(size, cores))  # few folders can have many names
        here = written(frontier.repartition(tasks, "dir").mapInArrow(_listed(cached), LISTED))
        out = here if out is None else out.unionByName(here)
        ends, size = here.agg(F.count_if(F.col("kind") != "inner"), F.coalesce(F.sum(F.size("children")), F.lit(0))).head()
        if progress:
            progress(level, here.count(), ends)
        frontier = here.select("dir", F.explode("children").alias("name")).select(F.concat(F.rtrim(F.col("dir"), F.lit("/")), F.lit("/"), F.col("name")).alias("dir"))
        level += 1
    return out
