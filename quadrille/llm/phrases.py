"""Phrases whose words stand together more often than by chance.

Four passes over whole texts, each counted over all documents:

1. Words per language. Only words that are frequent enough can stand in a frequent phrase.
2. Pairs of successive frequent words.
3. Triples of words that make two frequent pairs.
4. What is left of a shard's texts are runs of frequent pairs, and substrings of which all pairs and triples are frequent; they hold every occurrence of every
   frequent phrase. Each shard builds their generalised suffix automaton, bounded to the longest phrase: a state is a set of substrings
   that end at the same places, and its suffix link leads to their longest suffix that ends at more. The shard's substrings go out with their
   numbers of ends, and the numbers are summed over all shards.

What the first three passes find goes back to the tasks as bits of filters of fixed size, by a hash. A word, pair or triple that passes
by chance only makes substrings longer or more: counts stay exact, as words and phrases are themselves the keys of the final counts.

Subsumption comes from the automata too. If a substring w p is in the state of p, every occurrence of p follows w; if it has as many ends as
its stem, every occurrence of the stem goes on with its last word. Each shard says so for its substrings, and a phrase is part of a longer one with equally
many occurrences if all its shards name the same word on one side. Intermediate phrases have counts between the two, so
looking one word further is enough.

Null texts and texts without words give nothing, a null language is `und`. A very long text is a shard of its own (about 100 bytes of memory for each of
its bytes). Ties go by count, then by the phrase's bytes. Rows that repeat count each. Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import _BYTE, Rolling, counted_keys, drop, mix, opened, pieces, stage, texts_of

LONGEST, LEAST = 5, 100  # words of a phrase at most, occurrences at least
FILTER_BITS = 26  # 2^26 bits, 8 MB, whatever the input
SLICE = 2 << 20  # bytes of text at a time
HELD = 1 << 19  # phrases that a task holds before it passes them on
BUCKET_WORDS = 4_000_000  # words of all texts for each bucket of keys and phrases

_KIND = np.zeros(256, np.uint8)  # 0: part of a word
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PAIR = np.uint64(0x9E6C63D0876A9A35)
_BLOCK = 15  # bits of a position within a block of the filter


@dataclass
class Words:
    """The words of a slice in order: bounds in `data`, language, two hashes (language included), and whether the next word follows in one piece."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    lang: np.ndarray
    key: np.ndarray
    key2: np.ndarray
    joined: np.ndarray
    langs: list[str]

    def texts(self, which: np.ndarray) -> pa.Array:
        """These words as strings."""
        size = self.end[which] - self.start[which]
        off = np.zeros(len(which) + 1, np.int64)
        np.cumsum(size, out=off[1:])
        at = np.repeat(self.start[which] - off[:-1], size) + np.arange(off[-1])
        return pa.Array.from_buffers(pa.large_string(), len(which), [None, pa.py_buffer(off), pa.py_buffer(self.data[at])]).cast(pa.string())

    def named(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the words `which`: the first of each kind, and the number of each one's kind. Kinds differ in either hash."""
        _, first, name = np.unique(self.key[which], return_index=True, return_inverse=True)
        if (self.key2[which][first][name] != self.key2[which]).any():
            both = np.stack([self.key[which], self.key2[which]], axis=1)
            _, first, name = np.unique(both, axis=0, return_index=True, return_inverse=True)
        return which[first], name.ravel()


def _hashes(strings: pa.Array, seed: int) -> np.ndarray:
    data, off = texts_of(strings)
    return Rolling(_BYTE[seed][data]).slices(off[:-1], off[1:]) if len(data) else np.zeros(len(strings), np.uint64)


def word_keys(words: pa.Array, langs: pa.Array) -> np.ndarray:
    """The first hash of words given as strings."""
    return mix(_hashes(words, 0) + np.uint64(3) * _hashes(langs, 1))


def split(batch: pa.RecordBatch) -> Words:
    """Words of the texts of a batch (text, lang)."""
    data, off = texts_of(batch.column("text"))
    langs = batch.column("lang").dictionary_encode()
    data, n = _LOWER[data], len(data)
    kind = _KIND[data]
    inside = kind == 0
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.ones(n, bool)
    before[1:] = ~inside[:-1]
    after = np.ones(n, bool)
    after[:-1] = ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    cut = np.cumsum(kind == 2, dtype=np.int32)[start] if n else start
    text = np.searchsorted(off, start, "right") - 1
    joined = (cut[1:] == cut[:-1]) & (text[1:] == text[:-1])
    lang = langs.indices.to_numpy()[text] if n else start
    salt = [np.uint64(3) * _hashes(langs.dictionary, s) if len(langs.dictionary) else np.zeros(0, np.uint64) for s in (1, 0)]
    key, key2 = (mix(Rolling(_BYTE[s][data]).slices(start, end) + salt[s][lang]) if n else np.zeros(0, np.uint64) for s in (0, 1))
    return Words(data, start, end, lang, key, key2, joined, langs.dictionary.to_pylist())


def _passes(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys a filter lets pass."""
    at = (key >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _pairs(w: Words, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of pairs of frequent words, and the pairs' keys."""
    ok = _passes(frequent, w.key)
    at = np.flatnonzero(w.joined & ok[:-1] & ok[1:]) if len(ok) else np.zeros(0, np.int64)
    return at, mix(w.key[at] * _PAIR + w.key[at + 1]) if len(at) else np.zeros(0, np.uint64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, word, n; the row without a word has the number of all words of its language."""
    for b in pieces(batches, most=SLICE):
        w = split(b)
        first, name = w.named(np.arange(len(w.start)))
        n, total = np.bincount(name, minlength=len(first)), np.bincount(w.lang, minlength=len(w.langs))
        langs = pa.array(w.langs, pa.string())
        yield pa.RecordBatch.from_arrays([langs.take(pa.array(w.lang[first])), w.texts(first), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])
        yield pa.RecordBatch.from_arrays([langs, pa.nulls(len(langs), pa.string()), pa.array(total.astype(np.int64))], names=["lang", "word", "n"])


class Automaton:
    """A generalised suffix automaton of sequences laid end to end, bounded to substrings of `longest` symbols.

    reach: how long the longest substring from each place on may be (1 at least; never less than the one before less 1). Substrings of each length
    are named by the name of their stem and their last symbol; the name of a substring's suffix gives its state (the suffix's, if it has as
    many ends) or, where a state begins, its suffix link.
    """

    def __init__(self, symbols: np.ndarray, reach: np.ndarray, longest: int):
        self.first, self.count, self.state, self.stem, self.suffix = [], [], [], [], []  # by length, then by name
        link, length = [np.full(1, -1, np.int64)], 1  # state 0 is the empty one
        base = name = None
        for d in range(1, longest + 1):
            at = np.flatnonzero(reach >= d)
            key = symbols[at] if d == 1 else name[at] * many + base[at + d - 1]
            _, first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            first = at[first]
            if d == 1:
                many, stem, suffix, up, same = len(first), np.zeros(len(first), np.int64), np.zeros(len(first), np.int64), np.zeros(len(first), np.int64), np.zeros(len(first), bool)
            else:
                stem, suffix = name[first], name[first + 1]
                up, same = self.state[-1][suffix], count == self.count[-1][suffix]
            state = up.copy()
            state[~same] = length + np.arange(np.count_nonzero(~same))
            link.append(up[~same])
            length += np.count_nonzero(~same)
            new = np.full(len(symbols), -1, np.int64)
            new[at] = inverse.ravel()
            base, name = (new if d == 1 else base), new
            for held, v in zip((self.first, self.count, self.state, self.stem, self.suffix), (first, count, state, stem, suffix)):
                held.append(v)
        self.link = np.concatenate(link)

    def substrings(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each substring of a length: a place where it stands, its number of ends, and the places of the symbols that always precede and follow it (-1: none)."""
        first, count, state = (v[size - 1] for v in (self.first, self.count, self.state))
        before, after = np.full(len(first), -1, np.int64), np.full(len(first), -1, np.int64)
        if size < len(self.first):
            suffix, stem, longer = self.suffix[size], self.stem[size], self.first[size]
            on = self.state[size] == state[suffix]
            before[suffix[on]] = longer[on]
            on = self.count[size] == count[stem]
            after[stem[on]] = longer[on] + size
        return first, count, before, after


def _pair_keys(frequent) -> Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        bits = np.frombuffer(frequent.value, np.uint8)
        for b in pieces(batches, most=SLICE):
            yield _pairs(split(b), bits)[1]

    return keys


def _triples(w: Words, frequent: np.ndarray, paired: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word whether it begins a frequent pair; first words of triples of two such pairs, and the triples' keys."""
    at, key = _pairs(w, frequent)
    at = at[_passes(paired, key)]
    pair = np.zeros(len(w.start) + 1, bool)
    pair[at] = True
    at = at[pair[at + 1]]
    return pair[:-1], at, mix((w.key[at] * _PAIR + w.key[at + 1]) * _PAIR + w.key[at + 2]) if len(at) else np.zeros(0, np.uint64)


def _triple_keys(frequent, paired) -> Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        bits = [np.frombuffer(x.value, np.uint8) for x in (frequent, paired)]
        for b in pieces(batches, most=SLICE):
            yield _triples(split(b), *bits)[2]

    return keys


def _reach(pair: np.ndarray, triple: np.ndarray, longest: int) -> np.ndarray:
    """How many words from each one on make a substring of frequent pairs and triples."""
    reach = 1 + pair.astype(np.int64)
    on = triple.copy()
    for d in range(3, longest + 1):
        reach[on] = d
        on = on & np.append(on[1:], False) if d > 3 else triple & np.append(triple[1:], False)
    return np.minimum(reach, longest)


_FOUND = [("n", "sum"), ("k", "sum"), ("bk", "sum"), ("b0", "min"), ("b1", "max"), ("ak", "sum"), ("a0", "min"), ("a1", "max")]
_TYPES = {"lang": "string", "phrase": "string", "n": "bigint", "k": "bigint", "bk": "bigint", "b0": "string", "b1": "string", "ak": "bigint", "a0": "string", "a1": "string"}


def _merged(t: pa.Table) -> pa.Table:
    """Rows of one phrase as one: ends, shards, and in how many shards which words always precede and follow."""
    out = t.group_by(["lang", "phrase"]).aggregate(_FOUND)
    return out.rename_columns({f"{c}_{how}": c for c, how in _FOUND}).select(list(_TYPES))


def _shard_phrases(w: Words, bits: list[np.ndarray], longest: int) -> pa.Table | None:
    """The substrings of a shard's automaton, two words and longer."""
    pair, at, key = _triples(w, *bits[:2])
    triple = np.zeros(len(pair), bool)
    triple[at[_passes(bits[2], key)]] = True
    member = pair.copy()
    member[1:] |= pair[:-1]
    which = np.flatnonzero(member)
    if not len(which):
        return None
    kinds, name = w.named(which)
    machine = Automaton(name, _reach(pair, triple, longest)[which], longest)
    words = w.texts(kinds).take(pa.array(name))
    langs = pa.array(w.langs, pa.string()).take(pa.array(w.lang[which]))
    out = []
    maybe = lambda at: words.take(pa.array(at, mask=at < 0))
    for size in range(2, longest + 1):
        first, n, before, after = machine.substrings(size)
        if len(first):
            text = pc.binary_join_element_wise(*[words.take(pa.array(first + k)) for k in range(size)], " ")
            b, a, one = maybe(before), maybe(after), pa.array(np.ones(len(first), np.int64))
            columns = [langs.take(pa.array(first)), text, pa.array(n.astype(np.int64)), one, pa.array((before >= 0).astype(np.int64)), b, b, pa.array((after >= 0).astype(np.int64)), a, a]
            out.append(pa.table(columns, names=list(_TYPES)))
    return pa.concat_tables(out) if out else None


def _shard_rows(filters: list, longest: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's phrases, those of its shards summed, as one row of lists for each bucket of phrases."""

    def dealt(t: pa.Table) -> pa.RecordBatch:
        bucket = (_hashes(t["phrase"].combine_chunks(), 0) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        t, bucket = t.take(pa.array(order)).combine_chunks(), bucket[order]
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        off = pa.array(np.append(first, len(bucket)).astype(np.int32))
        columns = [t[c].chunk(0) for c in _TYPES]
        return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *[pa.ListArray.from_arrays(off, c) for c in columns]], names=["bucket", *_TYPES])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [np.frombuffer(x.value, np.uint8) for x in filters]
        held: list[pa.Table] = []
        size = 0
        for b in pieces(batches, most=SLICE):
            found = _shard_phrases(split(b), bits, longest)
            if found is None:
                continue
            held.append(found)
            size += len(found)
            if size >= HELD:
                held = [_merged(pa.concat_tables(held))]
                size = len(held[0])
                if size >= HELD // 2:
                    yield dealt(held[0])
                    held, size = [], 0
        if held:
            yield dealt(_merged(pa.concat_tables(held)))

    return task


def _frequent_phrases(least: int, longest: int) -> Callable[[pa.Table], pa.Table]:
    """Sums a bucket's phrases over all tasks; keeps the frequent ones, with whether a longer one holds each as often."""

    def task(t: pa.Table) -> pa.Table:
        flat = pa.table({c: t[c].combine_chunks().flatten() for c in _TYPES})
        flat = _merged(flat)
        flat = flat.filter(pc.greater_equal(flat["n"], least))
        always = lambda c: pc.fill_null(pc.and_(pc.equal(flat[f"{c}k"], flat["k"]), pc.equal(flat[f"{c}0"], flat[f"{c}1"])), False)
        full = pc.greater_equal(pc.count_substring(flat["phrase"], " "), longest - 1)  # nothing longer is a candidate
        part = pc.and_(pc.invert(full), pc.or_(always("b"), always("a")))
        return pa.table({"lang": flat["lang"], "phrase": flat["phrase"], "n": flat["n"], "part": part})

    return task


def _filter(spark: SparkSession, positions: DataFrame):
    """A broadcast filter with the bits at these positions set. It has 2^FILTER_BITS bits, however many positions there are."""

    def pack(t: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _BLOCK, np.uint8)
        bits[t["at"].to_numpy() & ((1 << _BLOCK) - 1)] = 1
        return pa.table({"block": t["block"][:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    blocks = positions.distinct().withColumn("block", F.shiftright("at", _BLOCK)).groupBy("block").applyInArrow(pack, "block int, bits binary")
    whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for r in blocks.collect():  # 8 MB at most
        part = np.frombuffer(r["bits"], np.uint8)
        whole[r["block"] * len(part) :][: len(part)] = part
    return spark.sparkContext.broadcast(whole.tobytes())


def _frequent_positions(least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for keys, n in zip(b.column("keys"), b.column("n")):
                k, c = opened(keys.as_py(), n.as_py())
                yield pa.RecordBatch.from_arrays([pa.array((k[c >= least] >> np.uint64(64 - FILTER_BITS)).astype(np.int32))], names=["at"])

    return task


def _positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        key = word_keys(b.column("word"), b.column("lang"))
        yield pa.RecordBatch.from_arrays([pa.array((key >> np.uint64(64 - FILTER_BITS)).astype(np.int32))], names=["at"])


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Frequent words (lang, word, n; all words of a language where word is null), and frequent phrases (lang, phrase, n, part: whether a longer one holds it as often)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").alias("text")).where("text is not null")
    words = texts.mapInArrow(_count_words, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = stage(words.where(F.col("word").isNull() | (F.col("n") >= least)))
    frequent = _filter(spark, words.where("word is not null").mapInArrow(_positions, "at int"))
    total = words.where("word is null").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    buckets = max(16, total // BUCKET_WORDS)

    def passing(keys) -> object:
        """The filter of keys that are frequent enough."""
        counted = counted_keys(texts, keys, buckets)
        bits = _filter(spark, counted.mapInArrow(_frequent_positions(least), "at int"))
        drop(counted)
        return bits

    filters = [frequent]
    filters.append(passing(_pair_keys(*filters)))
    filters.append(passing(_triple_keys(*filters)))
    shards = texts.mapInArrow(_shard_rows(filters, longest, buckets), "bucket bigint, " + ", ".join(f"{c} array<{t}>" for c, t in _TYPES.items()))
    found = stage(shards.groupBy("bucket").applyInArrow(_frequent_phrases(least, longest), "lang string, phrase string, n bigint, part boolean"))
    for bits in filters:
        bits.unpersist()
    return words, found


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: per language the phrases with the highest scores.

    a, l, r count the phrase and the two parts of its lowest-scoring cut, n all words of the language; score is floor(1000 * a * n / (l * r)).
    """
    words, found = counted(docs, least, longest)
    parts = found.select("lang", "phrase", "n").unionByName(words.where("word is not null").select("lang", F.col("word").alias("phrase"), "n"))
    w = F.split("phrase", " ", -1)
    cuts = found.where("not part").select("lang", "phrase", F.col("n").alias("a"), w.alias("w"), F.explode(F.sequence(F.lit(1), F.size(w) - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("first"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(words.where("word is null").select("lang", "n"), "lang")
    whole = lambda c: f"cast({c} as decimal(38,0))"
    score = F.expr(f"({whole(1000)} * {whole('a')} * {whole('n')}) div ({whole('l')} * {whole('r')})")
    cuts = cuts.withColumn("score", score)
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "n", "c.l", "c.r", "c.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    out = stage(ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
    drop(words)
    drop(found)
    return out
