"""Pixel-space transforms: row-major homogeneous matrices, as arrays, closed-form columns or numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Signs of the x, y and z flips, by metadata version.
FLIPS = {"v0": (1, -1, 1), "v1": (1, -1, 1)} | {f"v{n}": (-1, -1, 1) for n in range(2, 10)}


def tile_transform(ori, shape, dims, flip=(-1, -1, 1), rotation: float = 0.0) -> np.ndarray:
    """stage * scale * back * rotation * flip * centre * shear, of size len(dims) + 1."""
    n = len(dims) + 1
    eye = lambda: np.eye(n)
    centre, back, f, r, s, stage, shear = (eye() for _ in range(7))
    for d in (0, 1):
        centre[d, -1], back[d, -1] = -dims[d] / 2, dims[d] / 2
    f[range(3), range(3)] = flip
    c, z = np.cos(rotation), np.sin(rotation)
    r[:2, :2] = [[c, -z], [z, c]]
    s[range(3), range(3)] = [shape[d] / dims[d] for d in range(3)]
    stage[:3, -1] = ori[:3]
    shear[2, 1] = 1 / dims[1]
    return stage @ s @ back @ r @ f @ centre @ shear


def tile_transform_columns(ori: list[Column], shape: list[Column], dims: list[Column], flip=(-1, -1, 1)) -> dict[str, Column]:
    """The entries that are not fixed, for rotation 0: scales, shear and translations."""
    v = [s.cast("double") / d for s, d in zip(shape, dims)]
    move = lambda d: (ori[d] + (shape[d] if flip[d] < 0 else F.lit(0))).cast("double")
    return {"m00": v[0] * flip[0], "m11": v[1] * flip[1], "m21": v[2] * flip[2] / dims[1], "m22": v[2] * flip[2], "t0": move(0), "t1": move(1), "t2": ori[2].cast("double")}


def compose(src: np.ndarray, ori, size) -> np.ndarray:
    """From pixels of a target (voxel size `size`, origin `ori`) to pixels of the source with transform src; stacks give stacks."""
    dst = np.zeros(src.shape)
    dst[...] = np.eye(src.shape[-1])
    ori, size = np.asarray(ori, float), np.asarray(size, float)
    for d in range(3):
        dst[..., d, d], dst[..., d, -1] = size[..., d], ori[..., d]
    return np.linalg.inv(src) @ dst


def box_to_box(src_ori, src_shape, src_dims, dst_ori, dst_shape, dst_dims) -> np.ndarray:
    """From pixels of one box to pixels of another: scale and shift on each axis."""
    n = len(src_ori)
    m = np.eye(n + 1)
    for d in range(n):
        a, b = dst_shape[d] / dst_dims[d], src_shape[d] / src_dims[d]
        m[d, d], m[d, -1] = a / b, (dst_ori[d] - src_ori[d]) / b
    return m


def box_to_box_columns(src, dst) -> dict[str, Column]:
    """src and dst are (ori, shape, dims) triples of column lists."""
    out = {}
    for d in range(len(src[0])):
        a, b = dst[1][d].cast("double") / dst[2][d], src[1][d].cast("double") / src[2][d]
        out[f"m{d}{d}"], out[f"t{d}"] = a / b, (dst[0][d] - src[0][d]) / b
    return out


def apply(matrix: list[list[Column]], point: list[Column]) -> list[Column]:
    """The rows of an affine matrix (with translations last) applied to a point."""
    def row(r):
        out = r[-1]
        for m, p in zip(r, point):
            out = out + m * p
        return out

    return [row(r) for r in matrix]


def world_to_pixel(matrix: np.ndarray, ori, shape, dims) -> tuple[list[int], list[int]]:
    """The pixel box (origin, shape) of a world box, cut to the volume; axes past the third are whole."""
    n = 3
    inv = np.linalg.inv(matrix)
    corners = np.array([[ori[d] + (shape[d] if k >> d & 1 else 0) for d in range(n)] for k in range(1 << n)], float)
    full = np.zeros((len(corners), len(matrix)))
    full[:, :n], full[:, -1] = corners, 1
    px = full @ inv.T
    lo, hi = np.floor(px[:, :n].min(0) + 1e-9), np.ceil(px[:, :n].max(0) - 1e-9)
    lo, hi = np.maximum(lo, 0).astype(int), np.minimum(hi, dims[:n]).astype(int)
    rest = list(dims[n:])
    return [*lo.tolist(), *[0] * len(rest)], [*np.maximum(hi - lo, 0).tolist(), *rest]


def fix_fov(dims: list[Column], shape: list[Column], diag: list[Column], x_nm: float | None, y_nm: float | None):
    """Shapes and diagonal entries with the fields of view that are given and positive; signs stay."""
    new_shape, new_diag = list(shape), list(diag)
    for d, nm in ((0, x_nm), (1, y_nm)):
        if nm and nm > 0:
            new_shape[d] = F.lit(int(nm)).cast("long")
            new_diag[d] = F.when(diag[d] < 0, -1.0).otherwise(1.0) * F.lit(float(nm)) / dims[d]
    return new_shape, new_diag


def next_pow2(v: int) -> int:
    return 1 << max(0, (int(v) - 1).bit_length())


def square_window(shape, at, extent, voxel_um) -> tuple[list[float], list[float]]:
    """A fractional window of a box (nm) made square in x and y: both grow about their middle to a power of two of pixels, one number."""
    if voxel_um[0] != voxel_um[1]:
        raise ValueError("pixels must be square")
    at, extent = list(at), list(extent)
    pixels = [int(extent[d] * float(shape[d])) / 1000 / voxel_um[d] for d in (0, 1)]
    side = next_pow2(int(max(pixels)))
    for d in (0, 1):
        f = side / pixels[d]
        extent[d] *= f
        at[d] += 0.5 * (1 - f)
    return at, extent


def parse_size(text: str) -> int:
    """A plain integer or one with k, M, G, T, P or E (powers of 1000)."""
    text = text.strip()
    return int(float(text[:-1]) * 1000 ** ("kMGTPE".index(text[-1]) + 1)) if text[-1:] in "kMGTPE" and text else int(text)
