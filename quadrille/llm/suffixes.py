"""Suffix-array dedup by linear grouping construction.

Byte strings of WINDOW bytes that stand twice are found in contexts of repeated anchors (see `repeats`); equal
contexts are collapsed and counted first. In blocks, the remaining contexts are cut into phrases at content-defined
places, and the suffix array of the phrase numbers is built by grouping: suffixes start in groups by their first
symbol; groups are processed in descending order, where the pointer of each suffix to the previous smaller one
tells which suffix its Lyndon prefix extends, so that group is split; one ascending pass then emits each
group's order. No rank is recomputed in rounds. With the longest common prefixes of neighbours a window stays a candidate if the
phrases it holds are met elsewhere; candidates are confirmed by their hashes (2 x 64 bits with the anchor).

An anchor with many contexts is spread over several blocks by a salt. What such blocks cannot settle alone, the
hashes of their windows do, in one aggregation over all blocks of the anchor. Bytes that a repeated window
covers are removed.

Windows are told apart by 64-bit hashes within those that share an anchor, whole contexts by 192 bits, and rows by 128 bits.

Defined cases: null and empty texts have no byte; repeated rows are copies like any other, so all their windows
repeat; null ids are kept; texts shorter than a window lose nothing; ties do not arise: every place of a repeated window is
removed, the first as well; a very long text needs memory of about 100 times its size in its task; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _BYTE, Rolling, drop, mix, pieces, row_key, row_key2, stage, texts_of
from .repeats import asked_windows, covered, places_of, wanted_anchors, windows

WINDOW, GRAM = 200, 32
#: A phrase ends where the hash of 8 bytes is a multiple of this power of two.
PHRASE_BITS, PHRASE_GRAM = 5, 8
#: A block's bytes, and contexts of one anchor in one block: about as many bytes.
BLOCK_BYTES = 1 << 21
SALT = 8192


def suffix_array(s: list[int]) -> list[int]:
    """Starts of the suffixes of s in ascending order, in time linear but for sorting the symbols and group members."""
    n = len(s)
    arr = sorted(range(n), key=s.__getitem__)
    place = [0] * n
    for k, i in enumerate(arr):
        place[i] = k
    group, end = [0] * n, {}
    k = 0
    while k < n:
        e, v = k, s[arr[k]]
        while e < n and s[arr[e]] == v:
            group[arr[e]] = k
            e += 1
        end[k] = e
        k = e
    smaller = [-1] * n
    top = n
    while top:
        g = group[arr[top - 1]]
        members = sorted(arr[g:top])
        top = g
        count: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        if not count:
            continue
        levels: dict[int, list[int]] = {}
        for j, c in count.items():
            levels.setdefault(c, []).append(j)
        for c in sorted(levels, reverse=True):  # more copies of this group's prefix make a larger suffix
            moved: dict[int, int] = {}
            for j in levels[c]:
                h = group[j]
                e = end[h] if h not in moved else moved[h]
                last, at = arr[e - 1], place[j]
                arr[at], place[last] = last, at
                arr[e - 1], place[j] = j, e - 1
                moved[h] = e - 1
            was = {h: end[h] for h in moved}
            for j in levels[c]:
                group[j] = moved[group[j]]
            for h, new in moved.items():
                end[new] = was[h]
                if new != h:
                    end[h] = new
    front = list(range(n))
    out, done = [-1] * n, [False] * n
    # the empty suffix comes first; each suffix emitted places the chain of previous smaller ones before it
    for k in range(-1, n):
        j = (n if k < 0 else out[k]) - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            done[j] = True
            j = smaller[j]
    return out


def longest_shared(s: list[int], order: list[int]) -> list[int]:
    """For every start, how many symbols its suffix shares with a neighbour in the order (the best of both)."""
    n = len(s)
    rank = [0] * n
    for k, i in enumerate(order):
        rank[i] = k
    best = [0] * n
    h = 0
    for i in range(n):
        k = rank[i]
        if k:
            j = order[k - 1]
            while i + h < n and j + h < n and s[i + h] == s[j + h]:
                h += 1
            best[i] = max(best[i], h)
            best[j] = max(best[j], h)
            h = h - 1 if h else 0
        else:
            h = 0
    return best


def repeated_windows(bodies: list[bytes], weight: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the bodies: body number, place, hash, and whether it stands twice here."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    size = np.array([len(x) for x in bodies], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    of = np.repeat(np.arange(len(bodies)), size)
    # phrase ends: after PHRASE_GRAM bytes whose hash is a multiple
    marks = Rolling(_BYTE[1][data])
    g = marks.grams(PHRASE_GRAM)
    hit = np.flatnonzero(g & np.uint64((1 << PHRASE_BITS) - 1) == 0)
    hit = hit[of[hit] == of[hit + PHRASE_GRAM - 1]]
    cut = hit + PHRASE_GRAM  # a cut lies after the gram; a phrase and the gram before its cuts are its own
    # phrases between successive cuts of one body; the gram that makes the first cut must be in the window too
    body = of[hit]
    same = body[1:] == body[:-1]
    p = np.flatnonzero(same)
    value = marks.slices(cut[p], cut[p + 1]) if len(p) else np.zeros(0, np.uint64)
    _, number = np.unique(value, return_inverse=True)
    # one sequence: the phrases of each body, then a symbol of its own
    last = np.flatnonzero(np.append(~same, True)) if len(hit) else np.zeros(0, np.int64)
    symbol = np.full(len(hit), -1, np.int64)
    symbol[p] = number + len(last)
    symbol[last] = np.arange(len(last))
    s = symbol.tolist()
    shared = np.array(longest_shared(s, suffix_array(s)) if s else [], np.int64)
    room = size - WINDOW + 1
    start = np.concatenate([np.arange(n) for n in room.tolist()]) if len(room) else np.zeros(0, np.int64)
    who = np.repeat(np.arange(len(bodies)), room)
    at = off[who] + start
    # cuts whose gram lies in the window: from the first, how many phrases the window holds
    lo = np.searchsorted(hit, at)
    hi = np.searchsorted(cut, at + WINDOW, "right")
    held = hi - lo - 1
    maybe = held <= 0
    some = np.flatnonzero(held > 0)
    maybe[some] = shared[lo[some]] >= held[some]
    hashes = Rolling(_BYTE[0][data]).slices(at, at + WINDOW)
    twice = weight[who] > 1
    cand = np.flatnonzero(maybe | twice)
    key = mix(hashes[cand] + mix(anchor[who[cand]].view(np.uint64)))
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    twice[cand] |= n[back] > 1
    return who, start, hashes, twice


def _cut(column: pa.Array):
    data, off = texts_of(column)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    return data, off, windows(_BYTE[0][data], doc, WINDOW, GRAM)


def anchors(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchor, number of places), summed within slices; and the distinct (anchor, rk) of each text."""

    def counts(batches):
        for b in pieces(batches, most=1 << 21):
            a, n = _cut(b.column(1))[-1].anchor_counts()
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    def places(batches):
        for b in pieces(batches, most=1 << 21):
            yield places_of(_cut(b.column(1))[-1], b.column(0))

    docs = docs.select("rk", "text")
    return docs.mapInArrow(counts, "anchor long, n long"), docs.mapInArrow(places, "anchor long, rk long")


def contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The runs of windows of each text whose anchor is wanted; of equal ones in a slice the first has the bytes."""

    def run(batches):
        for b in pieces(batches, most=1 << 21):
            data, off, w = _cut(b.column(2))
            first, last = w.runs(asked_windows(w, b.column(3)))
            m = last - first + 1
            s, e = w.start[first], w.start[last] + WINDOW
            # the end windows say nothing of what lies between two places of one anchor: the whole body is hashed too
            ends, whole = mix(w.hashes(first) + mix(w.hashes(last))), w.roll.slices(s, e)
            key = mix(ends + mix(whole + mix(m.astype(np.uint64) + w.anchor[first])))
            lead = np.zeros(len(first), bool)
            lead[np.unique(key, return_index=True)[1]] = True
            raw = data.tobytes()
            body = [raw[x:y] if k else None for x, y, k in zip(s.tolist(), e.tolist(), lead.tolist())]
            d = w.doc[first]
            yield pa.RecordBatch.from_arrays([*[pa.array(b.column(k).to_numpy()[d]) for k in (0, 1)], pa.array(w.anchor[first].view(np.int64)), pa.array(s - off[d]), pa.array(m), pa.array(ends.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(body, pa.binary())], names=["rk", "rk2", "anchor", "at", "m", "ends", "whole", "body"])

    asked = docs.select("rk", "rk2", "text").join(wanted, "rk").select("rk", "rk2", "text", "anchors")
    return asked.mapInArrow(run, "rk long, rk2 long, anchor long, at long, m long, ends long, whole long, body binary")


def sorted_blocks(sources: DataFrame) -> DataFrame:
    """anchor, ends, whole, m, s, e, edge: islands of windows that stand twice in a block (edge null); of salted anchors
    the hash of every other window, and each hash of those that do stand twice (settled) once."""

    def solve(rows: pa.Table):
        bodies = [x.as_buffer().to_pybytes() for x in rows.column("body").combine_chunks()]
        col = {c: rows.column(c).to_numpy() for c in ("anchor", "ends", "whole", "m", "n", "salts")}
        who, start, hashes, twice = repeated_windows(bodies, col["n"], col["anchor"])
        k = np.flatnonzero(twice)
        cut = np.ones(len(k), bool)
        cut[1:] = (who[k[1:]] != who[k[:-1]]) | (start[k[1:]] != start[k[:-1]] + 1)
        first = np.flatnonzero(cut)
        a, z = k[first], k[np.append(first[1:], len(k)) - 1] if len(first) else k
        # of a salted anchor: windows that are not settled, and of the settled ones one for each hash
        salted = np.flatnonzero(col["salts"][who] > 1)
        settled = salted[twice[salted]]
        settled = settled[np.unique(mix(hashes[settled] + mix(col["anchor"][who[settled]].view(np.uint64))), return_index=True)[1]]
        open_ = np.concatenate([salted[~twice[salted]], settled])
        i = np.concatenate([who[a], who[open_]])
        edge = pa.array(np.concatenate([np.zeros(len(a), np.int64), hashes[open_].view(np.int64)]), mask=np.arange(len(i)) < len(a))
        return pa.RecordBatch.from_arrays([*[pa.array(col[c][i]) for c in ("anchor", "ends", "whole", "m")], pa.array(np.concatenate([start[a], start[open_]])), pa.array(np.concatenate([start[z], start[open_]]) + 1), edge, pa.array(np.concatenate([np.ones(len(a), bool), twice[open_]]))], names=["anchor", "ends", "whole", "m", "s", "e", "edge", "settled"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            # blocks end between (anchor, salt) groups, once they are large enough
            key = np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()], 1)
            ends = np.append(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, b.num_rows)
            if held and b.num_rows and (held[-1].column(0)[-1].as_py(), held[-1].column(1)[-1].as_py()) != tuple(key[0].tolist()) and size >= BLOCK_BYTES:
                yield solve(pa.Table.from_batches(held))
                held, size = [], 0
            at = 0
            for e in ends.tolist()[:-1]:
                part = b.slice(at, e - at)
                held.append(part)
                size += int(np.sum(part.column(4).to_numpy())) + WINDOW * part.num_rows
                at = e
                if size >= BLOCK_BYTES:
                    yield solve(pa.Table.from_batches(held))
                    held, size = [], 0
            if at < b.num_rows:
                part = b.slice(at)
                held.append(part)
                size += int(np.sum(part.column(4).to_numpy())) + WINDOW * part.num_rows
        if held:
            yield solve(pa.Table.from_batches(held))

    columns = ["anchor", "salt", "ends", "whole", "m", "n", "salts", "body"]
    return sources.select(*columns).repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").mapInArrow(run, "anchor long, ends long, whole long, m long, s long, e long, edge long, settled boolean")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Row keys, s, e: the bytes that repeated windows cover; docs has the row keys and text."""
    found = stage(contexts(docs, wanted_anchors(*anchors(docs))))
    ctx = ["anchor", "ends", "whole", "m"]
    kinds = found.groupBy(*ctx).agg(F.count(F.lit(1)).alias("n"), F.max("body").alias("body"))
    per = found.select(*ctx).distinct().groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).select("anchor", F.ceil(F.col("c") / SALT).cast("long").alias("salts"))
    sources = kinds.join(per, "anchor").withColumn("salt", F.pmod(F.xxhash64("ends", "whole", "m"), F.col("salts")))
    solved = stage(sorted_blocks(sources))
    opened = solved.where("edge is not null")
    twice = opened.groupBy("anchor", "edge").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor", "edge")
    more = opened.where("not settled").join(twice, ["anchor", "edge"]).select(*ctx, "s", "e")
    islands = solved.where("edge is null").select(*ctx, "s", "e").unionByName(more)
    spans = found.select("rk", "rk2", "at", *ctx).join(islands, ctx).select("rk", "rk2", (F.col("at") + F.col("s")).alias("s"), (F.col("at") + F.col("e") + (WINDOW - 1)).alias("e"))
    spans = stage(spans)
    drop(found)
    drop(solved)
    return spans


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every row of docs."""
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("rk"), row_key2().alias("rk2"))
    spans = repeated_spans(docs).groupBy("rk", "rk2").agg(F.collect_list(F.struct("s", "e")).alias("spans"))

    def run(batches):
        for b in pieces(batches):
            n, gone, runs, kept = [], [], [], []
            for t, spans_ in zip(b.column(1).to_pylist(), b.column(2)):
                raw = (t or "").encode()
                removed = pieces_ = 0
                if spans_.is_valid:
                    s, e = (spans_.values.field(k).to_numpy() for k in (0, 1))
                    mask = covered(s, e, len(raw))
                    removed, pieces_ = int(mask.sum()), int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum())
                    kept.append(np.frombuffer(raw, np.uint8)[~mask].tobytes())
                else:
                    kept.append(raw)
                n.append(len(raw))
                gone.append(removed)
                runs.append(pieces_)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(x, pa.int64()) for x in (n, gone, runs)], pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.join(spans, ["rk", "rk2"], "left").select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
