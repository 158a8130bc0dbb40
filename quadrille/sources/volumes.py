"""Volume files: npy, raw with a shape, and uncompressed grey TIFF stacks."""

from __future__ import annotations

import io
import struct

import numpy as np

#: Type names, and what counts as no data for each.
DTYPES = {"u8": "<u1", "u16": "<u2", "u32": "<u4", "u64": "<u8", "i8": "<i1", "i16": "<i2", "i32": "<i4", "i64": "<i8", "f32": "<f4", "f64": "<f8"}


def no_data(dtype: str):
    """0 for unsigned and float types, the least value for signed ones."""
    t = np.dtype(DTYPES[dtype])
    return np.iinfo(t).min if t.kind == "i" else 0


def type_name(t: np.dtype) -> str:
    return next((k for k, v in DTYPES.items() if np.dtype(v) == np.dtype(t)), "unknown")


def decode(data: bytes, ext: str, dims: list[int] | None = None, dtype: str = "u16") -> np.ndarray:
    """The array with x fastest: axes (..., z, y, x)."""
    ext = ext.lower().lstrip(".")
    if ext == "npy":
        return np.load(io.BytesIO(data), allow_pickle=False)
    if ext in ("tif", "tiff"):
        return _tiff(data)
    if dims is None:
        raise ValueError(f"a raw volume (.{ext}) needs its dims")
    return np.frombuffer(data, DTYPES[dtype]).reshape(dims[::-1])


def read_box(path: str, ori: list[int], shape: list[int], dims: list[int] | None = None, dtype: str = "u16") -> np.ndarray:
    """The voxels of a pixel box (x first) of a volume file; only their pages are read. Axes past the given ones are whole."""
    cut = tuple(slice(o, o + n) for o, n in zip(ori, shape))[::-1]
    ext = path.rsplit(".", 1)[-1].lower()
    if ext in ("tif", "tiff"):
        with open(path, "rb") as f:
            pages = _pages(f)
            return np.stack([_page(f, *p) for p in pages[cut[0]]])[(slice(None), *cut[1:])]
    v = np.load(path, mmap_mode="r", allow_pickle=False) if ext == "npy" else np.memmap(path, DTYPES[dtype], "r", shape=tuple(dims[::-1]))
    return np.array(v[(..., *cut)])


def _tiff(data: bytes) -> np.ndarray:
    f = io.BytesIO(data)
    return np.stack([_page(f, *p) for p in _pages(f)])


def _page(f, kind: str, shape: tuple[int, int], strips: list[tuple[int, int]]) -> np.ndarray:
    raw = []
    for offset, size in strips:
        f.seek(offset)
        raw.append(f.read(size))
    return np.frombuffer(b"".join(raw), kind).reshape(shape)


def _pages(f) -> list[tuple]:
    """Type, shape and strips of each page of an open file, from its directories alone."""
    def data(a, b):
        f.seek(a)
        return f.read(b - a)

    order = {b"II": "<", b"MM": ">"}[data(0, 2)]
    at, pages = struct.unpack(order + "I", data(4, 8))[0], []
    while at:
        n = struct.unpack(order + "H", data(at, at + 2))[0]
        tag = {}
        for k in range(n):
            e = at + 2 + 12 * k
            code, kind, count = struct.unpack(order + "HHI", data(e, e + 8))
            size = {1: 1, 2: 1, 3: 2, 4: 4}.get(kind)
            if size is None:
                continue
            where = e + 8 if size * count <= 4 else struct.unpack(order + "I", data(e + 8, e + 12))[0]
            tag[code] = struct.unpack(order + {1: "B", 2: "B", 3: "H", 4: "I"}[kind] * count, data(where, where + size * count))
        if tag.get(259, (1,))[0] != 1:
            raise ValueError("compressed TIFF is not supported")
        kind = {1: "u", 2: "i", 3: "f"}[tag.get(339, (1,))[0]]
        pages.append((f"{order}{kind}{tag.get(258, (8,))[0] // 8}", (tag[257][0], tag[256][0]), list(zip(tag[273], tag[279]))))
        at = struct.unpack(order + "I", data(at + 2 + 12 * n, at + 6 + 12 * n))[0]
    return pages


def header_of(path: str, ext: str) -> tuple[list[int], str]:
    """header of a file, of which only those parts are read."""
    from pyarrow import fs

    store, at = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if path.startswith("file:") else fs.FileSystem.from_uri(path)
    with store.open_input_file(at) as f:
        return header(f, ext)


def header(f, ext: str) -> tuple[list[int], str]:
    """Dims (x first) and type name of an open volume, from what its first bytes or directories say."""
    if ext.lower() == "npy":
        version = np.lib.format.read_magic(f)
        shape, _, kind = {1: np.lib.format.read_array_header_1_0, 2: np.lib.format.read_array_header_2_0}[version[0]](f)
        return list(shape[::-1]), type_name(kind)
    pages = _pages(f)
    return [*pages[0][1][::-1], len(pages)], type_name(np.dtype(pages[0][0]))


def encode_tiff(v: np.ndarray) -> bytes:
    """A little-endian stack, a strip to a page."""
    v = np.ascontiguousarray(v.reshape(-1, *v.shape[-2:]))
    v = v.astype(v.dtype.newbyteorder("<"))
    kind = {"u": 1, "i": 2, "f": 3}[v.dtype.kind]
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for page in v:
        strip = len(out)
        out += page.tobytes()
        out += b"\0" * (len(out) % 2)
        struct.pack_into("<I", out, link, len(out))
        tags = [(256, page.shape[1]), (257, page.shape[0]), (258, 8 * v.itemsize), (259, 1), (262, 1), (273, strip), (277, 1), (278, page.shape[0]), (279, page.nbytes), (339, kind)]
        out += struct.pack("<H", len(tags))
        for code, value in tags:
            out += struct.pack("<HHII", code, 4, 1, value)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)
