"""MinHash near-dedup by a multi-index Hamming join.

A document's set holds its distinct 5-word shingles (64-bit hashes of the words, A-Z in lower case). Equal sets
are one class from the start. A class has POSITIONS minima of BITS bits. Two signatures that differ in at most
MOST positions agree, by pigeonhole, in one of CHUNKS chunks up to one position (MOST // CHUNKS = 1), so each
class is entered once for every chunk and every position of it left out: no pair under the distance is missed.
`dedup` has the similarity, MOST and CHUNKS as parameters. At a similarity of 0.85 a position differs with probability 0.15; of 48 more than 20 do so in fewer than two
of a million pairs. For 0.80 (AT_80) the bound is 25 positions in 13 chunks: more differ in fewer than one of a million pairs.

Buckets are not expanded into pairs. First every member meets the least member of its bucket; verified links give
components. Only buckets that still hold several components are searched for links between those, on the full sets; a bucket
gives the links that connect its components, fewer than it has members. A bucket of more than BUCKET members is dealt into
blocks, and every two blocks meet in a task of their own.

Defined cases: null or empty texts have an empty set and no link; rows that share an id are one node with several
texts, so they and all that is linked with any of them have one component; a null id is no node: such a row gets the component of
its equal texts, null if they have none; ties do not arise, since a component is named by its least id; the set of a very long
text (8 bytes for each of its words) must fit in a task; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, mix, pieces, stage, texts_of, words_of
from .components import components

SHINGLE = 5
POSITIONS, BITS, MOST, CHUNKS = 48, 16, 20, 11
SIMILAR = 85
LONGS = POSITIONS * BITS // 64
BLOCK, BUCKET = 512, 2048
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TIMES = mix(np.arange(1, POSITIONS + 1, dtype=np.uint64)) | np.uint64(1)
_PLUS = mix(np.arange(1001, POSITIONS + 1001, dtype=np.uint64))
#: Similarity and number of chunks of signatures that differ in at most 2 * chunks - 1 positions.
AT_80 = {"similar": 80, "chunks": 13}


def chunked(chunks: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Positions of each chunk; and every chunk with each of its positions."""
    parts = [p.tolist() for p in np.array_split(np.arange(POSITIONS), chunks)]
    return parts, [(c, j) for c, part in enumerate(parts) for j in part]


PARTS, KEYS = chunked(CHUNKS)


def sets_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, sorted, end to end, and where each text's begin."""
    data, off = texts_of(column)
    _, _, doc, word = words_of(_LOWER[data], off)
    n = len(column)
    count = np.bincount(doc, minlength=n)
    roll = Rolling(word)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    start = np.arange(len(word) - SHINGLE + 1) if len(word) >= SHINGLE else np.zeros(0, np.int64)
    start = start[doc[start] == doc[start + SHINGLE - 1]] if len(start) else start
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    h = np.concatenate([roll.slices(start, start + SHINGLE), mix(roll.slices(first[short], first[short] + count[short]) + count[short].astype(np.uint64))])
    d = np.concatenate([doc[start], short]) if len(word) else np.zeros(0, np.int64)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[keep], d[keep]
    return h, np.searchsorted(d, np.arange(n + 1))


def signatures(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of POSITIONS 16-bit values for each text that has a shingle."""
    full = off[:-1][off[1:] > off[:-1]]
    out = np.empty((len(full), POSITIONS), np.uint16)
    for i in range(POSITIONS if len(full) else 0):
        out[:, i] = mix(np.minimum.reduceat((h ^ _PLUS[i]) * _TIMES[i], full)) >> np.uint64(48)
    return out


def _sums(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for salt in (1, 2):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(h + np.uint64(salt)))])
        out.append((total[off[1:]] - total[off[:-1]]).view(np.int64))
    return out[0], out[1]


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, size of the set, two hashes of the whole set, the signature as longs (0 for empty sets)."""
    names = [f"g{i}" for i in range(LONGS)]

    def run(batches):
        for b in pieces(batches, most=1 << 20):
            h, off = sets_of(b.column(1))
            sig = np.zeros((b.num_rows, POSITIONS), np.uint16)
            sig[off[1:] > off[:-1]] = signatures(h, off)
            longs = sig.view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), *map(pa.array, _sums(h, off)), *[pa.array(np.ascontiguousarray(longs[:, i])) for i in range(LONGS)]], names=["doc_id", "n", "s1", "s2", *names])

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, " + ", ".join(f"{x} long" for x in names))


def _matrix(b: pa.RecordBatch, at: int) -> np.ndarray:
    return np.ascontiguousarray(np.stack([b.column(at + i).to_numpy() for i in range(LONGS)], 1)).view(np.uint16)


def keys(classes: DataFrame, chunks: int = CHUNKS) -> DataFrame:
    """key, cid: a class under every chunk with one of its positions left out."""
    parts, places = chunked(chunks)

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 5000):
                part = b.slice(at, 5000)
                sig = _matrix(part, 1).astype(np.uint64)
                found = []
                for k, (c, j) in enumerate(places):
                    x = np.full(len(sig), k + 1, np.uint64)
                    for i in parts[c]:
                        if i != j:
                            x = mix(x * np.uint64(0x9E3779B97F4A7C15) + sig[:, i])
                    found.append(x.view(np.int64))
                cid = np.tile(part.column(0).to_numpy(), len(places))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(cid)], names=["key", "cid"])

    return classes.select("cid", *[f"g{i}" for i in range(LONGS)]).mapInArrow(run, "key long, cid long")


def across(members: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """a, b: links between components of a bucket (key, and two of its blocks i and j), enough to connect all that are linked there.

    A bucket's sets are numbered once; each set then meets those of other components by one gather and one sum. A pair whose
    components are joined already, by an earlier link, is passed over, so m members give fewer than m links.
    """

    def links(cid: np.ndarray, comp: np.ndarray, slot: np.ndarray, crossed: bool, sets: list[np.ndarray]):
        names, own = np.unique(comp, return_inverse=True)
        if len(names) < 2:
            return
        # sorted by component: what stands before the first member of one's own component is of another
        order = np.argsort(own, kind="stable")
        cid, own, slot, sets = cid[order], own[order], slot[order], [sets[k] for k in order.tolist()]
        begin, group = np.searchsorted(own, own), own.copy()
        size = np.array([len(x) for x in sets])
        off = np.concatenate([[0], np.cumsum(size)])
        _, number = np.unique(np.concatenate(sets), return_inverse=True)
        flag = np.zeros(number.max() + 1, np.int32)
        for x in range(1, len(cid)):
            if (group == group[0]).all():
                return
            mine = number[off[x] : off[x + 1]]
            flag[mine] = 1
            for at in range(0, int(begin[x]), BLOCK):
                to = min(int(begin[x]), at + BLOCK)
                common = np.add.reduceat(flag[number[off[at] : off[to]]], off[at:to] - off[at])
                near = (100 * common >= similar * (size[x] + size[at:to] - common)) & (group[at:to] != group[x])
                if crossed:
                    near &= slot[at:to] != slot[x]
                for y in (np.flatnonzero(near) + at).tolist():
                    if group[y] != group[x]:
                        group[group == group[y]] = group[x]
                        yield int(cid[x]), int(cid[y])
            flag[mine] = 0

    def run(batches):
        held = None

        def solve(b, last):
            """Whole buckets of b; what may go on in the next batch is given back."""
            key = np.stack([b.column(k).to_numpy() for k in range(3)])
            cut = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, [b.num_rows]])
            done = cut if last else cut[:-1]
            cid, comp, slot = (b.column(k).to_numpy() for k in (3, 4, 5))
            out = []
            for s, e in zip(done[:-1].tolist(), done[1:].tolist()):
                out += links(cid[s:e], comp[s:e], slot[s:e], key[1, s] != key[2, s], [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(6).slice(s, e - s)])
            pairs = pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
            return pairs, (None if last else b.slice(cut[-2]))

        for b in batches:
            if not b.num_rows:
                continue
            b = b if held is None else pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            out, held = solve(b, False)
            yield out
        if held is not None:
            yield solve(held, True)[0]

    pair = ["key", "i", "j"]
    return members.select(*pair, "cid", "comp", "slot", "set").repartition(*pair).sortWithinPartitions(*pair, "cid").mapInArrow(run, "a long, b long")


def dealt(members: DataFrame) -> DataFrame:
    """members (key, c, cid, comp) with their block of the bucket's, once for every two blocks i <= j that hold it."""
    blocks = F.ceil(F.col("c") / BUCKET).cast("int")
    df = members.withColumn("slot", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    df = df.select("key", "cid", "comp", "slot", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return df.select("key", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "cid", "comp", "slot")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """cid and the whole set, as bytes, of the documents with these ids."""

    def run(batches):
        for b in pieces(batches, most=1 << 20):
            h, off = sets_of(b.column(1))
            raw = h.view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([raw[s:e].tobytes() for s, e in zip(off[:-1], off[1:])], pa.binary())], names=["cid", "set"])

    docs = docs.select(F.col("doc_id").cast("long").alias("cid"), F.col("text").cast("string").alias("text"))
    return docs.join(ids, "cid", "left_semi").mapInArrow(run, "cid long, set binary")


def verified(pairs: DataFrame, sets: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def run(batches):
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if 100 * min(len(x), len(y)) >= similar * max(len(x), len(y)):
                    both = np.concatenate([x, y])
                    both.sort()
                    common = int((both[1:] == both[:-1]).sum())
                    keep[i] = 100 * common >= similar * (len(x) + len(y) - common)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep))], names=["a", "b"])

    one = sets.select(F.col("cid").alias("a"), F.col("set").alias("x"))
    two = sets.select(F.col("cid").alias("b"), F.col("set").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def dedup(docs: DataFrame, similar: int = SIMILAR, chunks: int = CHUNKS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs; links have a similarity of `similar` in a hundred or more."""
    every = stage(describe(docs))
    sig = [f"g{i}" for i in range(LONGS)]
    classes = stage(every.where("n > 0").groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("cid"), *[F.first(g).alias(g) for g in sig]))
    nodes = classes.where("cid is not null")
    entered = keys(nodes, chunks)
    shared = entered.groupBy("key").agg(F.min("cid").alias("least"), F.max("cid").alias("most")).where("least < most").drop("most")
    members = stage(entered.join(shared, "key"))
    sets = stage(full_sets(docs, members.select("cid").distinct()))
    sizes = nodes.select("cid", "n")
    star = members.where("cid > least").select(F.col("cid").alias("a"), F.col("least").alias("b")).distinct()
    star = star.join(sizes.select(F.col("cid").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("cid").alias("b"), F.col("n").alias("nb")), "b")
    star = star.where(f"100 * least(na, nb) >= {similar} * greatest(na, nb)").select("a", "b").distinct()
    links = stage(verified(star, sets, similar).distinct())
    comps = components(links)
    labelled = members.join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn("comp", F.coalesce("component", "cid")).select("key", "cid", "comp")
    # buckets of several components; of those with the same members one is enough
    buckets = labelled.groupBy("key").agg(F.min("comp").alias("l"), F.max("comp").alias("m"), F.count(F.lit(1)).alias("c"), F.sum(F.xxhash64("cid").cast("decimal(20,0)")).alias("s")).where("l < m")
    open_ = buckets.groupBy("c", "s").agg(F.min("key").alias("key")).select("key", "c")
    rest = dealt(labelled.join(open_, "key")).join(sets, "cid")
    every_link = comps.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(across(rest, similar).distinct())
    comps = components(every_link.unionByName(_shared_ids(every, classes)))
    named = classes.select("s1", "s2", "n", "cid").join(comps.withColumnRenamed("node", "cid"), "cid", "left").select("s1", "s2", "n", F.coalesce("component", "cid").alias("component"))
    out = every.select("doc_id", "n", "s1", "s2").where("n > 0").join(named, ["s1", "s2", "n"], "left").select("doc_id", "n", "component")
    # an empty text has the component of its id's other texts, if there are any
    bare = every.where("n = 0").select("doc_id", "n")
    theirs = comps.join(bare.select(F.col("doc_id").alias("node")).distinct(), "node", "left_semi").withColumnRenamed("node", "doc_id")
    out = out.unionByName(bare.join(theirs, "doc_id", "left").select("doc_id", "n", F.coalesce("component", "doc_id").alias("component")))
    component = F.col("component")
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _shared_ids(every: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b: ids that name rows of several classes (or that are in a class under another's name and have an empty text), and their classes."""
    key = ("s1", "s2", "n")
    ends = every.where("doc_id is not null").groupBy("doc_id").agg(*[f(c).alias(f"{c}_{k}") for c in key for k, f in (("x", F.min), ("y", F.max))])
    several = ends.where(" or ".join(f"{c}_x <> {c}_y" for c in key)).select("doc_id")
    rows = every.where("n > 0").select("doc_id", "s1", "s2", "n").join(several, "doc_id", "left_semi").distinct()
    return rows.join(classes.select("s1", "s2", "n", "cid"), ["s1", "s2", "n"]).select(F.col("doc_id").alias("a"), F.col("cid").alias("b")).where("a <> b")
