"""What the two substring operators share: contexts of repeated anchors.

A sequence of symbols (words or bytes) is cut by window minima. Of every window of LENGTH symbols the least hash
of its GRAM-symbol grams is the anchor, so equal windows have equal anchors. A run of successive windows with
one anchor is a context. Only anchors that stand at two places or more can belong to a repeated window; their
contexts are small and are what is shuffled, keyed by the anchor, hashes of the first and the last window, a hash of all that
they hold and the number of windows. Two windows are taken as equal when both the anchor and the window's hash agree (2 x 64 bits).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, mix, sliding

NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
MOST_WINDOWS = 4096


@dataclass
class Windows:
    """Per window: its start among all symbols, text number, anchor and hash."""

    start: np.ndarray
    doc: np.ndarray
    anchor: np.ndarray
    grams: np.ndarray
    gram_ok: np.ndarray
    roll: Rolling
    length: int
    gram: int

    def hashes(self, which: np.ndarray) -> np.ndarray:
        s = self.start[which]
        return self.roll.slices(s, s + self.length)

    def first_symbol(self, n: int) -> np.ndarray:
        """Where the first window of each of n texts starts."""
        at = np.searchsorted(self.doc, np.arange(n))
        return np.append(self.start, 0)[np.minimum(at, len(self.start))]

    def anchor_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Anchors, and at how many places each is the least gram of some window."""
        if not len(self.start):
            return self.anchor, np.zeros(0, np.int64)
        span = self.length - self.gram + 1
        least = np.zeros(len(self.grams) + span - 1, np.uint64)  # of the window that starts at i, padded in front
        least[self.start + span - 1] = self.anchor
        top = sliding(least, span, np.maximum)
        chosen = self.gram_ok & (top == self.grams) & (top != 0)
        return np.unique(self.grams[chosen], return_counts=True)

    def runs(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last (inclusive) index of each run of kept windows with one anchor, of MOST_WINDOWS at most."""
        k = np.flatnonzero(keep)
        if not len(k):
            return k, k
        cut = np.ones(len(k), bool)
        cut[1:] = (self.start[k[1:]] != self.start[k[:-1]] + 1) | (self.anchor[k[1:]] != self.anchor[k[:-1]]) | (self.doc[k[1:]] != self.doc[k[:-1]])
        first = np.flatnonzero(cut)
        size = np.diff(np.append(first, len(k)))
        if size.max() > MOST_WINDOWS:
            cut[np.concatenate([np.arange(f, f + n, MOST_WINDOWS) for f, n in zip(first.tolist(), size.tolist())])] = True
            first = np.flatnonzero(cut)
        return k[first], k[np.append(first[1:], len(k)) - 1]


def windows(values: np.ndarray, doc: np.ndarray, length: int, gram: int) -> Windows:
    """All windows of texts laid end to end; doc has the text number of each symbol."""
    roll = Rolling(values)
    grams = roll.grams(gram)
    ok = doc[: len(grams)] == doc[gram - 1 :][: len(grams)] if len(grams) else np.zeros(0, bool)
    n = len(values) - length + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return Windows(z, z, z.astype(np.uint64), grams, ok, roll, length, gram)
    grams = np.maximum(grams, np.uint64(1))
    least = sliding(np.where(ok, grams, NONE), length - gram + 1)
    start = np.flatnonzero(doc[:n] == doc[length - 1 :])
    return Windows(start, doc[start], least[start], grams, ok, roll, length, gram)


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n symbols lie in one of the spans."""
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, ends, -1)
    return np.cumsum(mark[:-1]) > 0


def places_of(w: Windows, keys: pa.Array) -> pa.RecordBatch:
    """The distinct (anchor, rk) of the texts with these keys."""
    first, _ = w.runs(np.ones(len(w.start), bool))
    a, d = w.anchor[first], w.doc[first]
    order = np.lexsort((a, d))
    a, d = a[order], d[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
    return pa.RecordBatch.from_arrays([pa.array(a[new].view(np.int64)), pa.array(keys.to_numpy()[d[new].astype(np.int64)])], names=["anchor", "rk"])


def wanted_anchors(counted: DataFrame, placed: DataFrame) -> DataFrame:
    """rk and the anchors of its text that stand at two places or more."""
    repeated = counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor")
    return placed.join(repeated, "anchor").groupBy("rk").agg(F.collect_set("anchor").alias("anchors"))


def asked_windows(w: Windows, lists: pa.Array) -> np.ndarray:
    """Which windows have an anchor of their own text's list."""
    size = np.diff(lists.offsets.to_numpy())
    value = lists.flatten().to_numpy().view(np.uint64)
    of = lambda a, d: mix(a + mix(d.astype(np.uint64)))
    return np.isin(of(w.anchor, w.doc), of(value, np.repeat(np.arange(len(size)), size)))
