"""Hard negatives, nearest neighbours and phrases against brute force."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.llm import hardneg, multiindex, phrases, queries
from quadrille.llm.common import table

SF = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def vectors(spark, seed=5, n=420, dims=10):
    """A hot label and a hot vector, ties, repeated rows, nulls, odd components, short and empty vectors, clashing columns."""
    rnd = random.Random(seed)
    rows = [(k, [round(rnd.gauss(0, 0.3), 2) for _ in range(dims)], 1 if rnd.random() < 0.4 else rnd.randrange(6)) for k in range(n)]
    rows += [(1000 + k, rows[3][1], 1) for k in range(60)] + [(7, rows[7][1], rows[7][2]), (100, rows[100][1], rows[100][2])]
    rows += [(2000, None, 1), (2100, [0.5] * dims, None), (None, [0.5] * dims, 1), (2001, [NAN] + [0.1] * (dims - 1), 1), (2002, [INF] + [0.1] * (dims - 1), 2), (2003, [None] + [0.1] * (dims - 1), 2)]
    rows += [(2200, [0.4] * (dims - 4), 2), (2300, [], 3), (2301, [0.0] * dims, 3), (2007, [-0.2] * dims, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    return df.withColumns({c: F.lit("other") for c in ("id", "uid", "h", "i", "j", "k", "q", "v", "score", "rank", "kind")})


def sound(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def negatives(rows):
    """By the contract's words; each row stands for itself."""
    rows = [(i, None if i is None or lab is None else (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * float(x)) for x in v]) for i, v, lab in rows if sound(v)]
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    out = []
    for n, (i, lab, v) in enumerate(rows):
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for m, (j, _, w) in enumerate(rows) if m != n)
        for p, j, _ in [s for s in scored if rows[s[2]][1] == lab][:5]:
            found = [(s, x) for s, x, m in scored if rows[m][1] != lab and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(i, j, r + 1, x, -p, -s) for r, (s, x) in enumerate(found)]
    return out


def test_hard_negatives(spark, monkeypatch):
    df = vectors(spark)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    given = df.where(hardneg.finite("embedding")).select("vec_id", label, hardneg.quantised("embedding").alias("q"))
    want = negatives([(r.vec_id, r.embedding, r.label) for r in df.select("vec_id", "embedding", "label").collect()])
    assert len(want) > 50 and {r[0] for r in want} >= {0, 100, 200}
    for block, anchors, chunk, chunks in ((1024, 256, 32, 16), (37, 2, 3, 16), (64, 3, 1, 2)):
        monkeypatch.setattr(hardneg, "BLOCK", block)
        monkeypatch.setattr(hardneg, "ANCHORS", anchors)
        monkeypatch.setattr(hardneg, "CHUNK", chunk)
        monkeypatch.setattr(hardneg, "CHUNKS", chunks)
        got = hardneg.mine(given, F.col("vec_id") % 100 == 0).collect()
        assert sorted(map(tuple, got)) == sorted(want), (block, anchors, chunk)


def test_hard_negatives_on_the_table(spark):
    got = queries.op11_summa_negatives(spark, SF)
    assert dict(got.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    assert sorted(map(tuple, got.collect())) == sorted(negatives([(r.vec_id, r.embedding, r.label) for r in table(spark, SF, "embeddings").select("vec_id", "embedding", "label").collect()]))


def test_products_are_exact():
    rnd = np.random.default_rng(1)
    for top in (1 << 8, 1 << 24, 1 << 29):
        a, b = rnd.integers(-top, top, (5, 7)), rnd.integers(-top, top, (6, 7))
        assert hardneg.product(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]


def test_scores_beyond_64_bits_are_an_error(spark):
    df = spark.createDataFrame([(0, 1, [1 << 40]), (1, 1, [1 << 40]), (2, 2, [1])], "vec_id long, label int, q array<long>")
    with pytest.raises(Exception, match="too large"):
        hardneg.mine(df, F.col("vec_id") % 100 == 0)


# --- neighbours ---------------------------------------------------------------------------------------


def nearest(rows, top=10):
    """(query id, its uid) -> the nearest, exactly."""
    rows = [(i, np.pad(np.array(v, np.float64), (0, 10 - len(v)) if len(v) < 10 else (0, 0))) for i, v in rows if i is not None and sound(v) and any(v)]
    x = np.array([v for _, v in rows])
    for n, (i, v) in enumerate(rows):
        if i % 100 == 0:
            d = np.sqrt(((x - v) ** 2).sum(axis=1))
            yield i, [(d[m], rows[m][0]) for m in sorted((m for m in range(len(rows)) if m != n), key=lambda m: (d[m], rows[m][0]))[:top]]


def test_within_retrieves_every_code():
    """Probing equals a scan for each radius."""
    x = np.random.default_rng(2).standard_normal((700, 12))
    coder = multiindex.fit(x, 10)
    s = multiindex.Segment(coder, np.arange(700), np.arange(700), x)
    for radius in (0, 1, 5, 8, 13, 16, 23, 31, 40, 57, 64):
        for q in range(0, 700, 70):
            far = np.bitwise_count(s.codes ^ s.codes[q])
            assert s.within(coder.codes(x[q : q + 1])[0], radius).tolist() == np.flatnonzero(far <= radius).tolist()


@pytest.mark.parametrize("segment", [4096, 50])
def test_neighbours_of_odd_rows(spark, monkeypatch, segment):
    monkeypatch.setattr(multiindex, "SEGMENT", segment)
    df = vectors(spark)
    got = multiindex.search(df, F.col("vec_id") % 100 == 0).collect()
    want = list(nearest([(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]))
    by = collections.defaultdict(list)
    for r in got:
        by[r.query_id].append(r)
    assert set(by) == {i for i, _ in want} and len(got) == 10 * len(want)
    have = sum(len({(round(r.score, 9), r.vec_id) for r in by[i]} & {(round(float(d), 9), j) for d, j in found}) / len(found) for i, found in want) / len(want)
    assert have >= 0.9
    assert len(by[100]) == 20 and min((r.score, r.vec_id) for r in by[100]) == (0.0, 100)  # a repeated row is a neighbour of its copy
    exact = {(i, j): d for i, found in want for d, j in found}
    assert all(abs(exact[r.query_id, r.vec_id] - r.score) < 1e-12 for r in got if (r.query_id, r.vec_id) in exact)
    assert all([r.rank for r in sorted(v, key=lambda r: (r.score, r.vec_id))] == sorted(r.rank for r in v) for k, v in by.items() if k != 100)


def test_recall(spark):
    sf = "/root/testdata/sf0.1"
    t = table(spark, sf, "embeddings").select("vec_id", "embedding").toPandas()
    x, ids = np.array(t.embedding.tolist(), np.float64), t.vec_id.to_numpy()
    got = collections.defaultdict(set)
    for r in queries.op12_multi_index_hashing(spark, sf).collect():
        got[r.query_id].add(r.vec_id)
    hits = []
    for n in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((x - x[n]) ** 2).sum(axis=1))
        d[n] = np.inf
        hits.append(len(got[ids[n]] & set(ids[np.lexsort((ids, d))[:10]].tolist())) / 10)
    assert len(hits) == len(got) and np.mean(hits) >= 0.9


def test_few_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in multiindex.search(df, F.col("vec_id") % 100 == 0).orderBy("rank").collect()] == [(0, 1, 2, 0.0), (0, 2, 1, math.sqrt(2))]
    assert multiindex.search(df.limit(1), F.col("vec_id") % 100 == 0).count() == 0


# --- phrases --------------------------------------------------------------------------------------------


def grams(rows, longest=5):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = [x for x in re.split(r"[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    return f, n


def collocations(rows, least, longest=5, top=2000):
    f, n = grams(rows, longest)
    c = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    inside = lambda s, t: any(t[i : i + len(s)] == s for i in range(len(t) - len(s) + 1))
    out = collections.defaultdict(list)
    for (lang, p), a in c.items():
        if any(m == lang and len(q) > len(p) and b >= a and inside(p, q) for (m, q), b in c.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items() for r, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def prose(seed, n=70):
    """Texts of few words, so that phrases repeat; a passage that many share, odd whitespace, nulls, copies, a long text without stops."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["Red", "red", "fox", "é", "ñu", "日本", "a", "THE", "of", "x-y", "q\xa0z", "w" + str(rnd.randrange(6))])
    text = lambda k: "".join(word() + rnd.choice([" "] * 8 + ["  ", "\t", ". ", ",", "\n", "\x0b", "! "]) for _ in range(k))
    fixed = "alpha Beta gamma delta epsilon zeta eta"
    rows = [(rnd.choice(["en", "en", "de", None]), text(rnd.randrange(60)) + (fixed if rnd.random() < 0.5 else "")) for _ in range(n)]
    rows += [("en", None), (None, ""), ("und", "fox of the fox of the"), ("fr", " \t\n"), ("", "red fox. red fox. red fox")] + [("de", fixed + " end")] * 9
    return rows + [("en", " ".join(word() for _ in range(900)))]


@pytest.mark.parametrize("seed,least,longest", [(1, 3, 5), (2, 6, 5), (3, 4, 3)])
def test_collocations(spark, monkeypatch, seed, least, longest):
    rows = prose(seed)
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("other") for c in ("phrase", "word", "n", "key", "at", "rank", "score", "k", "w")})
    got = phrases.mine(df.repartition(5), least, longest).collect()
    want = collocations(rows, least, longest)
    assert len(want) > 20 and sorted(map(tuple, got)) == want
    short = phrases.mine(df, least, longest, top=3).collect()
    assert sorted(map(tuple, short)) == collocations(rows, least, longest, 3)


@pytest.mark.parametrize("longest", [5, 3, 1])
def test_automaton(longest):
    """States are substrings with the same ends; links lead to the longest suffix with other ends; what always precedes or follows."""
    rnd = random.Random(longest)
    made = [[rnd.randrange(2 + k % 4) for _ in range(rnd.randrange(1, 30))] for k in range(40)] + [[9, 8, 7, 6, 5, 4]] * 3
    flat = np.array([c for s in made for c in s])
    reach = np.concatenate([np.minimum(longest, np.arange(len(s), 0, -1)) for s in made])
    m = phrases.Automaton(flat, reach, longest)
    ends, state, at = collections.defaultdict(set), {}, 0
    for s in made:
        for i, j in itertools.combinations(range(len(s) + 1), 2):
            if j - i <= longest:
                ends[tuple(s[i:j])].add(at + j)
        at += len(s)
    for size in range(1, longest + 1):
        first, n, before, after = m.substrings(size)
        own = [tuple(flat[f : f + size].tolist()) for f in first]
        assert len(set(own)) == len(own) and {t: int(c) for t, c in zip(own, n)} == {t: len(e) for t, e in ends.items() if len(t) == size}
        state |= dict(zip(own, m.state[size - 1].tolist()))
        if size < longest:
            for t, b, a in zip(own, before, after):
                one = lambda found: found[0] if found else None
                assert (int(flat[b]) if b >= 0 else None) == one([x for x in range(10) if len(ends.get((x, *t), ())) == len(ends[t])])
                assert (int(flat[a]) if a >= 0 else None) == one([x for x in range(10) if len(ends.get((*t, x), ())) == len(ends[t])])
    for t in ends:
        assert all((state[t] == state[u]) == (ends[t] == ends[u]) for u in list(ends)[:60])
        suffixes = [t[k:] for k in range(1, len(t)) if ends[t[k:]] != ends[t]]
        assert m.link[state[t]] == (state[suffixes[0]] if suffixes else 0)


def test_counted_keys(spark, monkeypatch):
    """Sums over tasks and over what a task passes on before its end."""
    from quadrille.llm import common

    monkeypatch.setattr(common, "MERGED", 50)
    values = [k * k % 997 for k in range(6000)] + [2**64 - 1] * 70_000 + [0]
    df = spark.createDataFrame([(i, v - 2**63) for i, v in enumerate(values)], "i long, v long").repartition(3)
    keys = lambda batches: (b.column(1).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for b in batches)
    got = collections.Counter()
    for r in common.counted_keys(df, keys, 5).collect():
        k, n = common.opened(bytes(r.keys), bytes(r.n))
        assert (np.diff(k.astype(object)) > 0).all()
        got.update(dict(zip(k.tolist(), n.tolist())))
    assert got == collections.Counter(values)


def test_exact_scores(spark, monkeypatch):
    """Products beyond 64 bits: counts as a corpus of many terabytes would have."""
    words = spark.createDataFrame([("en", None, 9 * 10**14), ("en", "a", 7 * 10**12 + 1), ("en", "b", 5 * 10**12 + 3)], "lang string, word string, n long")
    found = spark.createDataFrame([("en", "a b", 4 * 10**12 + 7, False)], "lang string, phrase string, n long, part boolean")
    monkeypatch.setattr(phrases, "counted", lambda *a: (words, found))
    monkeypatch.setattr(phrases, "drop", lambda df: None)
    got = phrases.mine(spark.createDataFrame([], "lang string, text string")).head()
    assert got.score == 1000 * (4 * 10**12 + 7) * 9 * 10**14 // ((7 * 10**12 + 1) * (5 * 10**12 + 3))
