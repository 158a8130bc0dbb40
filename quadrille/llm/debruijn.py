"""Substring dedup by De Bruijn compaction.

Token k-mers (WINDOW successive words) are edges from the node of their first WINDOW - 1 words to the node of their
last. Edges that stand at two places or more are kept. Within a context (see `repeats`) successive repeated edges
form a unit; contexts are equal if all their edges are. Units that meet at a node which no other unit enters or leaves are joined, and the chains of joins
compact to paths (Spark joins on the node, connected components over the joints). Paths keep the coordinates of
their units in the sources: row, first word, last word. A span of a path is verified there: it must consist of whole
windows of that text, and its first and last edge must stand where it says. The words that verified spans cover are removed.

Edges are told apart by 64-bit hashes of their words within the edges that share an anchor, and rows by 128 bits.

Defined cases: null and empty texts have no word; repeated rows are copies like any other, so all their windows
repeat; null ids are kept; texts shorter than a window lose nothing; ties do not arise: every place of a repeated window is
removed, the first as well; a very long text needs memory of about 100 bytes for each of its words in its task; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, mix, pieces, row_key, row_key2, stage, texts_of, words_of
from .components import components
from .repeats import MOST_WINDOWS, asked_windows, covered, places_of, wanted_anchors, windows

WINDOW, GRAM = 35, 8
TOTAL_BITS = MOST_WINDOWS.bit_length() - 1


def _cut(column: pa.Array):
    data, off = texts_of(column)
    start, end, doc, word = words_of(data, off)
    return data, start, end, doc, windows(mix(word), doc, WINDOW, GRAM)


def anchors(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchor, number of places), summed within slices; and the distinct (anchor, rk) of each text."""

    def counts(batches):
        for b in pieces(batches):
            a, n = _cut(b.column(1))[-1].anchor_counts()
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    def places(batches):
        for b in pieces(batches):
            yield places_of(_cut(b.column(1))[-1], b.column(0))

    docs = docs.select("rk", "text")
    return docs.mapInArrow(counts, "anchor long, n long"), docs.mapInArrow(places, "anchor long, rk long")


def _total(edges: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each context, the sum of its edges without their lowest TOTAL_BITS bits (no overflow over MOST_WINDOWS edges)."""
    return np.add.reduceat(edges >> TOTAL_BITS, bounds[:-1]) if len(edges) else edges


def contexts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The runs of windows of each text whose anchor is wanted: row keys, place of the first word, edges, their sum and nodes."""

    def run(batches):
        for b in pieces(batches):
            *_, w = _cut(b.column(2))
            first, last = w.runs(asked_windows(w, b.column(3)))
            where = [np.arange(f, l + 1) for f, l in zip(first.tolist(), last.tolist())]
            flat = np.concatenate(where) if where else first
            edges = w.hashes(flat).view(np.int64)
            begins, end = w.start[first], w.start[last]
            in_node = w.roll.slices(begins, begins + WINDOW - 1).view(np.int64)
            out_node = w.roll.slices(end + 1, end + WINDOW).view(np.int64)
            m = last - first + 1
            bounds = np.concatenate([[0], np.cumsum(m)])
            begin = w.first_symbol(b.num_rows)[w.doc[first]]
            yield pa.RecordBatch.from_arrays([
                *[pa.array(b.column(k).to_numpy()[w.doc[first]]) for k in (0, 1)], pa.array(w.anchor[first].view(np.int64)), pa.array(w.start[first] - begin), pa.array(m), pa.array(_total(edges, bounds)), pa.array(in_node), pa.array(out_node),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(edges))],
                names=["rk", "rk2", "anchor", "at", "m", "total", "enters", "leaves", "edges"])

    asked = docs.select("rk", "rk2", "text").join(wanted, "rk").select("rk", "rk2", "text", "anchors")
    return asked.mapInArrow(run, "rk long, rk2 long, anchor long, at long, m long, total long, enters long, leaves long, edges array<long>")


def repeated_units(docs: DataFrame) -> DataFrame:
    """Successive repeated edges of one context: row keys, s, e (first edge and end), first and last edge, and their nodes."""
    counted, placed = anchors(docs)
    kept = stage(contexts(docs, wanted_anchors(counted, placed)))
    found = kept.withColumns({"f": F.element_at("edges", 1), "l": F.element_at("edges", -1)})
    # the end windows say nothing of what lies between two places of one anchor: the sum of all edges is part of the key
    ctx = ["anchor", "f", "l", "m", "total"]
    kinds = stage(found.groupBy(*ctx).agg(F.count(F.lit(1)).alias("n"), F.first("rk").alias("rk"), F.first("at").alias("at"), F.first("enters").alias("enters"), F.first("leaves").alias("leaves")))
    # the edges of a context that stands once must be met in another context of the anchor, or again in itself
    single = kinds.where("n = 1").select("anchor").distinct()
    place = ["rk", "at"]
    sources = kinds.join(single, "anchor").join(found.select(*ctx, *place, "edges"), [*ctx, *place])
    edges = sources.select("anchor", "n", F.explode("edges").alias("edge"))
    twice = edges.groupBy("anchor", "edge").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "edge")
    alone = sources.where("n = 1").select(*ctx, "enters", "leaves", F.posexplode("edges").alias("i", "edge")).join(twice, ["anchor", "edge"])
    island = F.col("i") - F.row_number().over(Window.partitionBy(*ctx).orderBy("i"))
    ends = [F.min("i").alias("s"), (F.max("i") + 1).alias("e"), F.min_by("edge", "i").alias("first"), F.max_by("edge", "i").alias("last"), F.sum(F.shiftright("edge", TOTAL_BITS)).alias("sum"), F.first("enters").alias("enters"), F.first("leaves").alias("leaves")]
    islands = alone.withColumn("k", island).groupBy(*ctx, "k").agg(*ends).drop("k")
    # an island that ends inside its context meets no repeated edge there, so that end has a node of its own
    islands = islands.withColumns({"enters": F.when(F.col("s") == 0, F.col("enters")).otherwise(F.xxhash64("first", F.lit(0))), "leaves": F.when(F.col("e") == F.col("m"), F.col("leaves")).otherwise(F.xxhash64("last", F.lit(1)))})
    whole = kinds.where("n > 1").select(*ctx, F.lit(0).alias("s"), F.col("m").cast("int").alias("e"), F.col("f").alias("first"), F.col("l").alias("last"), F.col("total").alias("sum"), "enters", "leaves")
    some = islands.unionByName(whole).withColumn("unit", F.xxhash64("anchor", "first", "last", "sum", F.col("e") - F.col("s")))
    placed = found.select("rk", "rk2", "at", *ctx).join(some, ctx)
    units = stage(placed.select("rk", "rk2", (F.col("at") + F.col("s")).alias("s"), (F.col("at") + F.col("e")).alias("e"), "first", "last", "enters", "leaves", "unit"))
    drop(kept)
    drop(kinds)
    return units


def compacted(units: DataFrame) -> DataFrame:
    """unit, path: units joined at nodes that one unit enters and one leaves."""
    distinct = units.select("unit", "enters", "leaves").distinct()
    into = distinct.groupBy("leaves").agg(F.count(F.lit(1)).alias("n"), F.min("unit").alias("a")).where("n = 1").select(F.col("leaves").alias("node"), "a")
    out = distinct.groupBy("enters").agg(F.count(F.lit(1)).alias("n"), F.min("unit").alias("b")).where("n = 1").select(F.col("enters").alias("node"), "b")
    return components(into.join(out, "node").select("a", "b")).select(F.col("node").alias("unit"), F.col("component").alias("path"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Row keys, path, s, e, first, last: the spans of every path in the sources, e the end of its last edge's start."""
    row = ["rk", "rk2"]
    units = repeated_units(docs)
    named = units.join(compacted(units), "unit", "left").withColumn("path", F.coalesce("path", "unit"))
    w = Window.partitionBy(*row).orderBy("s", "e")
    joint = F.coalesce((F.lag("e").over(w) == F.col("s")) & (F.lag("path").over(w) == F.col("path")), F.lit(False))
    runs = named.distinct().withColumn("new", (~joint).cast("int")).withColumn("run", F.sum("new").over(w))
    spans = runs.groupBy(*row, "path", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.min_by("first", "s").alias("first"), F.max_by("last", "e").alias("last"))
    spans = stage(spans.drop("run"))
    drop(units)
    return spans


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words of every row of docs."""
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("rk"), row_key2().alias("rk2"))
    spans = repeated_spans(docs).groupBy("rk", "rk2").agg(F.collect_list(F.struct("s", "e", "first", "last")).alias("spans"))

    def run(batches):
        for b in pieces(batches):
            texts, spans_ = b.column(1), b.column(2)
            n, gone, kept = [], [], []
            some = np.flatnonzero(~np.asarray(spans_.is_null()))
            place = dict(zip(some.tolist(), range(len(some))))
            if len(some):
                start, _, doc, w = _cut(texts.take(pa.array(some)))[1:]
                begin = np.searchsorted(doc, np.arange(len(some)))
            for i, t in enumerate(texts.to_pylist()):
                words = (t or "").encode().split()
                n.append(len(words))
                removed = 0
                if i in place:
                    s, e, first, last = (np.array([x[k] for x in spans_[i].as_py()], np.int64) for k in ("s", "e", "first", "last"))
                    at = begin[place[i]]
                    inside = e + WINDOW - 1 <= len(words)
                    s, e, first, last = s[inside], e[inside], first[inside], last[inside]
                    stands = (w.roll.slices(at + s, at + s + WINDOW).view(np.int64) == first) & (w.roll.slices(at + e - 1, at + e - 1 + WINDOW).view(np.int64) == last)
                    s, e = s[stands], e[stands]
                    mask = covered(s, e + WINDOW - 1, len(words))
                    removed = int(mask.sum())
                    words = [words[k] for k in np.flatnonzero(~mask).tolist()]
                gone.append(removed)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.join(spans, ["rk", "rk2"], "left").select("doc_id", "text", "spans").mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")


def digest(docs: DataFrame) -> DataFrame:
    return dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
