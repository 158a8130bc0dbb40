"""Helpers that several text operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; where none is set, a temporary one in local mode (tests), else an error."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="quadrille-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def work_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one."""
    return f"{shared_dir(spark)}/quadrille-{spark.sparkContext.applicationId}"


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def sweep(spark: SparkSession) -> None:
    """Deletes all tables that the application's operators wrote on their way: results must have been written before."""
    remove(spark, work_dir(spark))


def stage(df: DataFrame, **options) -> DataFrame:
    """Cuts the lineage: writes df as a table in the shared folder and reads it again."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/stage-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")  # this plan runs once: its shuffle files can go when it ends
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def drop(staged: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more."""
    remove(staged.sparkSession, staged._stage_path)


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """One key per (id, text): rows that repeat share it, null ids have one too."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def row_key2(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Another 64 bits of a row's key. Where row_key alone decides which texts are read, both decide what is done to them."""
    return F.xxhash64(F.lit(0x51ED270B), F.col(text_col), F.col(id_col))


def whole_row(df: DataFrame) -> Column:
    """All columns in one, `_row`, so that their names meet no other."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


# --- words of whole texts, in numpy -------------------------------------------------------------

_WS = np.zeros(256, bool)
_WS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_R = np.uint64(0x9E3779B97F4A7C15)
_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r^i and r^-i mod 2^64 for i < n (n rounded up to a power of two, kept)."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _POW:
        _POW.clear()
        r, inv = int(_R), pow(int(_R), -1, 1 << 64)
        out = []
        for base in (r, inv):
            p = np.ones(size, np.uint64)
            step, k = base, 1
            while k < size:
                p[k : 2 * k] = p[:k] * np.uint64(step)
                step = step * step % (1 << 64)
                k *= 2
            out.append(p)
        _POW[size] = (out[0], out[1])
    return _POW[size]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = {s: mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95 + 2 * s)) for s in (0, 1)}


class Rolling:
    """Prefix sums from which the hash of any slice of a sequence follows in constant time."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """Of every k successive values."""
        n = len(self.sums) - k
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each starts; null counts as empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    n, buffers = len(column), column.buffers()
    off = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[off[0] : off[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def words_of(data: np.ndarray, off: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text number and hash of each word of texts laid end to end."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    inside = ~_WS[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[0] = True
    before[1:] = ~inside[:-1]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = True
    after[:-1] = ~inside[1:]
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return start, end, np.searchsorted(off, start, "right") - 1, Rolling(_BYTE[seed][data]).slices(start, end)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of batches with at most so many bytes of text each (a longer text stands alone)."""
    for b in batches:
        c = b.column(b.schema.get_field_index(column))
        size = np.zeros(len(c) + 1, np.int64)
        np.cumsum(pc.binary_length(c).fill_null(0).to_numpy(zero_copy_only=False), out=size[1:])
        at = 0
        while at < len(c):
            to = max(at + 1, int(np.searchsorted(size, size[at] + most, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


def sliding(values: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """The best of every `width` successive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    cur, have = values, 1
    while have * 2 <= width:
        cur = best(cur[:-have], cur[have:])
        have *= 2
    return best(cur[:n], cur[width - have : width - have + n])


# --- counts of many keys, as packed arrays -----------------------------------------------------------

MERGED = 2 << 20  # distinct keys that a task holds before it passes them on


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and the sums of their counts."""
    keys, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def pressed(keys: np.ndarray, n: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as differences, and counts, both compressed."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    small = n.astype(np.uint16 if not len(n) or n.max() < 1 << 16 else np.int64)
    return squeeze(np.diff(keys, prepend=np.uint64(0)).tobytes()), bytes([small.itemsize]) + squeeze(small.tobytes())


def opened(keys: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    loose = zstandard.ZstdDecompressor().decompress
    counts = np.frombuffer(loose(n[1:]), np.uint16 if n[0] == 2 else np.int64).astype(np.int64)
    return np.cumsum(np.frombuffer(loose(keys), np.uint64), dtype=np.uint64), counts


def counted_keys(df: DataFrame, keys_of: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], buckets: int) -> DataFrame:
    """How often each 64-bit key stands in df: a written table of keys (sorted) and n (counts) by bucket, packed (see `opened`).

    keys_of gives the keys of a task's batches, array by array. A task sums what it holds, deals it by a hash of the key and ships each bucket's part as one
    packed row; a task of the shuffle merges a bucket's parts. A frequent key has one entry in each part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0

        def passed_on() -> pa.RecordBatch:
            keys, n = summed(parts)
            bucket = (mix(keys) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")  # keys stay sorted within a bucket
            keys, n, bucket = keys[order], n[order], bucket[order]
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else bucket
            packs = [pressed(keys[a:z], n[a:z]) for a, z in zip(first.tolist(), np.append(first[1:], len(keys)).tolist())] if len(keys) else []
            return pa.RecordBatch.from_arrays([pa.array(bucket[first], pa.int64()), *[pa.array([p[k] for p in packs], pa.binary()) for k in (0, 1)]], names=["bucket", "keys", "n"])

        for keys in keys_of(batches):
            if len(keys):
                parts.append(np.unique(keys, return_counts=True))
                held += len(parts[-1][0])
            if held >= MERGED:
                parts = [summed(parts)]
                held = len(parts[0][0])
                if held >= MERGED // 2:
                    yield passed_on()
                    parts, held = [], 0
        if parts:
            yield passed_on()

    def merged(t: pa.Table) -> pa.Table:
        keys, n = pressed(*summed([opened(a.as_py(), b.as_py()) for a, b in zip(t.column("keys"), t.column("n"))]))
        return pa.table({"keys": pa.array([keys], pa.binary()), "n": pa.array([n], pa.binary())})

    return stage(df.mapInArrow(run, "bucket long, keys binary, n binary").groupBy("bucket").applyInArrow(merged, "keys binary, n binary"))
