"""The YAML catalogue: a root path and one record per tile."""

from __future__ import annotations

import re

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "path string, ndim int, ori array<bigint>, shape array<bigint>, dtype string, dims array<bigint>, crop array<bigint>, transform array<float>, error string"
KEYS = {"path", "aabb", "shape", "transform"}
NAME = "*.cache.yml"
#: YAML's parser in C, where it is built.
LOADER = getattr(yaml, "CBaseLoader", yaml.BaseLoader)


def parse(text: str, mode: str = "PERMISSIVE") -> list[tuple]:
    """Rows of the first document. PERMISSIVE keeps tiles with unknown keys or fields of another form and says so, and a file that is no YAML is one row
    that says so; FAILFAST raises."""
    plain = _plain(text)
    if plain is not None:
        return plain
    try:
        doc = next(yaml.load_all(text, Loader=LOADER), None) or {}  # scalars stay as they are written: a path 00012 is no number
        tiles = (doc.get("tiles") if isinstance(doc, dict) else None) or []
        if not isinstance(doc, dict) or not isinstance(tiles, list):
            raise ValueError("not a catalogue")
    except (yaml.YAMLError, ValueError) as e:
        if mode == "FAILFAST":
            raise
        return [(None, None, None, None, None, None, None, None, f"{type(e).__name__}: {' '.join(str(e).split())}")]
    root = str(doc.get("path") or "")
    return [_record(root, t, mode) for t in tiles]


_NUMBERS = r"\[(-?\d+(?:, -?\d+)*)?\]"
_PATH = r"([A-Za-z0-9_/][A-Za-z0-9_./-]*)"
_TILE = re.compile(
    rf"- path: {_PATH}\n  aabb:\n    ori: {_NUMBERS}\n    shape: {_NUMBERS}\n  shape:\n    type: ([A-Za-z0-9_]+)\n    dims: {_NUMBERS}\n(?:    crop: {_NUMBERS}\n)?"
    r"  transform: \[(-?\d+\.\d{6}(?:, -?\d+\.\d{6})*)?\]\n"
)
_HEAD = re.compile(rf"---\npath: {_PATH}\ntiles:\n")


def _plain(text: str) -> list[tuple] | None:
    """Rows of a text exactly as `dump` writes it; None if anything in it has another form, which is then left to YAML's own parser."""
    head = _HEAD.match(text)
    if not head:
        return None
    root, at, out = head.group(1), head.end(), []
    whole = lambda x: [int(n) for n in x.split(", ")] if x else None
    while m := _TILE.match(text, at):
        path, ori, shape, kind, dims, crop, matrix = m.groups()
        ori = whole(ori)
        out.append((root + path, len(ori or []), ori, whole(shape), kind, whole(dims), whole(crop), [float(n) for n in matrix.split(", ")] if matrix else None, None))
        at = m.end()
    return out if text[at:] in ("...\n", "...") and out else None


def _record(root: str, t, mode: str) -> tuple:
    """A tile's row. Fields that cannot be read are null, and the first of them is named."""
    errors: list[str] = []

    def read(what: str, get):
        try:
            return get()
        except (ValueError, TypeError, AttributeError) as e:
            if mode == "FAILFAST":
                raise
            errors.append(f"{what}: {e}")
            return None

    def known() -> None:
        unknown = set(t) - KEYS
        if unknown:
            raise ValueError(", ".join(sorted(map(str, unknown))))

    def part(name: str) -> dict:
        found = t.get(name) or {}
        if not isinstance(found, dict):
            raise ValueError("not a mapping")
        return found

    if not isinstance(t, dict):
        t = read("a tile", lambda: dict(t)) or {}
    read("unknown keys", known)
    box, shape = read("aabb", lambda: part("aabb")) or {}, read("shape", lambda: part("shape")) or {}
    whole = lambda name, xs: read(name, lambda: [int(x) for x in xs] if xs else None)
    ori, extent, dims, crop = whole("ori", box.get("ori")), whole("shape", box.get("shape")), whole("dims", shape.get("dims")), whole("crop", shape.get("crop"))
    matrix = read("transform", lambda: [float(x) for x in t["transform"]] if t.get("transform") else None)
    kind = shape.get("type")
    return (root + str(t.get("path") or ""), len(ori or []), ori, extent, None if kind is None else str(kind), dims, crop, matrix, errors[0] if errors else None)


def dump(rows: list[dict], root: str) -> str:
    """The text for records with path, ori, shape, dtype, dims, crop and transform; paths become relative to root."""
    out = ["---\n", f"path: {root}\n", "tiles:\n"]
    seq = lambda xs: "[" + ", ".join(map(str, xs)) + "]"
    for r in rows:
        if r["ori"] is None or r["dims"] is None:
            continue
        n = next((i for i, (a, b) in enumerate(zip(r["path"], root)) if a != b), min(len(r["path"]), len(root)))
        out.append(f"- path: {r['path'][n:]}\n  aabb:\n    ori: {seq(r['ori'])}\n    shape: {seq(r['shape'])}\n  shape:\n    type: {r['dtype']}\n    dims: {seq(r['dims'])}\n")
        if r.get("crop"):
            out.append(f"    crop: {seq(r['crop'])}\n")
        out.append(f"  transform: [{', '.join(f'{x:.6f}' for x in r['transform'] or [])}]\n")
    return "".join(out + ["...\n"])


def read(spark: SparkSession, path: str, mode: str = "PERMISSIVE") -> DataFrame:
    """One file, or all catalogues below a folder, parsed where they lie."""
    return parsed(spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.yml").load(path), mode)


def parsed(files: DataFrame, mode: str = "PERMISSIVE") -> DataFrame:
    """The rows of catalogue files (content)."""
    import pandas as pd

    def run(batches):
        for b in batches:
            for content in b["content"]:
                yield pd.DataFrame(parse(bytes(content).decode(), mode), columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"ndim": "Int32"})

    return files.select("content").mapInPandas(run, SCHEMA)


def write(tiles: DataFrame, folder: str, root: str) -> None:
    """One catalogue file for each partition, by Spark's text writer; each is a document of its own."""

    def run(batches):
        import pandas as pd

        rows = [r for b in batches for r in b.to_dict("records")]
        clean = lambda x: None if x is None or (isinstance(x, float) and x != x) else list(x) if hasattr(x, "__len__") and not isinstance(x, str) else x
        if rows:
            yield pd.DataFrame({"value": [dump([{k: clean(v) for k, v in r.items()} for r in rows], root).rstrip("\n")]})

    columns = ["path", "ori", "shape", "dtype", "dims", "crop", "transform"]
    tiles.select(*columns).mapInPandas(run, "value string").write.mode("errorifexists").text(folder)


def usable(tiles: DataFrame) -> DataFrame:
    return tiles.where(F.col("ori").isNotNull() & F.col("dims").isNotNull())
