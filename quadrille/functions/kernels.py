"""Gaussian kernels, separable filters, difference of Gaussians and local maxima of dense volumes (z, y, x)."""

from __future__ import annotations

import math

import numpy as np


def radius(sigma: float) -> int:
    """Where the normal density falls to a hundredth; a density that starts below that has none."""
    inner = -2 * sigma * sigma * math.log(0.01 * sigma * math.sqrt(2 * math.pi))
    if inner < 0:
        raise ValueError(f"no radius for sigma {sigma}: the density starts below a hundredth")
    return math.ceil(math.sqrt(inner))


def gauss(sigma: float) -> list[float]:
    r = radius(sigma)
    w = [math.exp(-0.5 * (x / sigma) ** 2) for x in range(-r, r + 1)]
    return [x / math.fsum(w) for x in w]


def antialias(size: float, scale: float, threshold: float) -> list[float] | None:
    """A kernel of sigma scale * |size|, or none at or under the threshold."""
    sigma = scale * abs(size)
    return None if sigma <= threshold else gauss(sigma)


def point_kernel(r: float) -> list[float]:
    return gauss(abs(r) / 2)


def convolve(v: np.ndarray, kernel: list[float], axis: int) -> np.ndarray:
    """Filter along an axis; outside, the edge's value goes on."""
    r = len(kernel) // 2
    pad = [(0, 0)] * v.ndim
    pad[axis] = (r, r)
    p = np.pad(v, pad, mode="edge")
    n = v.shape[axis]
    out = np.zeros(v.shape, np.result_type(v.dtype, np.float32))
    for k, w in enumerate(kernel):
        out += w * np.take(p, range(k, k + n), axis)
    return out


def separable(v: np.ndarray, kernels: list[list[float] | None], compat: bool = False) -> np.ndarray:
    """kernels for x, y and z, the last three axes of v from behind; None leaves an axis alone.

    compat: enabled kernels are taken in order from the first axis on, as if none before them were disabled.
    """
    if compat:
        on = sum(k is not None for k in kernels)
        kernels = [kernels[i] if i < on else None for i in range(3)]
    for d, k in enumerate(kernels):
        if k is not None:
            v = convolve(v, k, v.ndim - 1 - d)
    return v


def dog(v: np.ndarray, r1: float = 2.0, r2: float = 3.0) -> np.ndarray:
    a, b = point_kernel(r1), point_kernel(r2)
    return separable(v, [a] * 3) - separable(v, [b] * 3)


def maxima(v: np.ndarray, threshold: float, compat: bool = False) -> np.ndarray:
    """x, y, z, value of voxels over the threshold that no neighbour of 26 exceeds.

    compat: neighbours are offsets in memory, so rows run on into each other.
    """
    keep = v > threshold
    nz, ny, nx = v.shape
    for dz in (-1, 0, 1):
        for dy in (-1, 0, 1):
            for dx in (-1, 0, 1):
                if not (dx or dy or dz):
                    continue
                other = np.full(v.shape, -np.inf)
                if compat:
                    shift, flat, to = dx + nx * (dy + ny * dz), v.ravel(), other.reshape(-1)
                    if shift > 0:
                        to[:-shift] = flat[shift:]
                    else:
                        to[-shift:] = flat[:shift]
                else:
                    cut = lambda d, n: (slice(max(0, -d), n - max(0, d)), slice(max(0, d), n - max(0, -d)))
                    (az, bz), (ay, by), (ax, bx) = cut(dz, nz), cut(dy, ny), cut(dx, nx)
                    other[az, ay, ax] = v[bz, by, bx]
                keep &= ~(other > v)
    z, y, x = np.nonzero(keep)
    return np.stack([x, y, z, v[keep]], 1) if len(x) else np.zeros((0, 4))


def affine(src: np.ndarray, matrix: np.ndarray, shape: tuple[int, int, int], fill: float) -> np.ndarray:
    """Trilinear samples of src (z, y, x) at matrix * (x, y, z, 1) for every voxel of a target; outside is fill."""
    z, y, x = np.meshgrid(*[np.arange(n, dtype=float) for n in shape], indexing="ij")
    p = matrix[:3, :3] @ np.stack([x.ravel(), y.ravel(), z.ravel()]) + matrix[:3, -1:]
    lim = np.array(src.shape[::-1])[:, None]
    p = np.where(np.abs(p - np.rint(p)) < 1e-6, np.rint(p), p)
    inside = ((p >= 0) & (p <= lim - 1)).all(0)
    q = np.clip(p, 0, lim - 1)
    lo = np.minimum(q.astype(int), np.maximum(lim - 2, 0))
    f = q - lo
    out = np.zeros(p.shape[1])
    for k in range(8):
        b = [(k >> d) & 1 for d in range(3)]
        at = [np.minimum(lo[d] + b[d], lim[d] - 1) for d in range(3)]
        w = np.prod([f[d] if b[d] else 1 - f[d] for d in range(3)], 0)
        out += w * src[at[2], at[1], at[0]]
    return np.where(inside, out, fill).reshape(shape)


def masked_ncc(a: np.ndarray, ma: np.ndarray, b: np.ndarray, mb: np.ndarray, min_overlap: int = 10) -> np.ndarray:
    """Masked normalised cross-correlation of two arrays over all shifts, by FFT (Padfield 2012)."""
    size = [x + y - 1 for x, y in zip(a.shape, b.shape)]
    axes, flip = tuple(range(a.ndim)), tuple(slice(None, None, -1) for _ in b.shape)
    fwd = lambda v: np.fft.rfftn(v, size, axes=axes)
    inv = lambda v: np.fft.irfftn(v, size, axes=axes)
    a, b = a * ma, (b * mb)[flip]
    mb = mb[flip].astype(float)
    fa, fb, fma, fmb = fwd(a), fwd(b), fwd(ma.astype(float)), fwd(mb)
    n = np.rint(inv(fma * fmb))
    safe = np.maximum(n, 1)
    sa, sb = inv(fa * fmb), inv(fma * fb)
    cov = inv(fa * fb) - sa * sb / safe
    va = np.maximum(inv(fwd(a * a) * fmb) - sa * sa / safe, 0)
    vb = np.maximum(inv(fma * fwd(b * b)) - sb * sb / safe, 0)
    den = np.sqrt(va * vb)
    return np.where((n >= min_overlap) & (den > 1e-9), cov / np.maximum(den, 1e-12), 0.0)
