"""The text operators against brute force on small fixtures."""

import collections
import hashlib
import itertools
import math
import random
import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from quadrille.llm import attention, bpe, components, debruijn, neardup, pii, quality, queries, suffixes, templates
from quadrille.llm.common import stage, table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = ["", None, "a b c", "A  B c", "one", "w " * 400, "q" * 450, "é" * 150, "x" + "é" * 150, "日本語 🙂 ñ\x0b\x0c\r\nz", "x" * 30_000 + " y"]
CLASH = ["rk", "words", "n", "spans", "cands", "base", "h", "s", "p", "key", "kept", "anchor", "block", "_t", "lines", "grams"]


@pytest.fixture(scope="module")
def docs(spark):
    """Half the small table, odd texts, a null id, repeated rows and columns whose names clash."""
    d = table(spark, SF, "documents").select("doc_id", "text").where("doc_id % 2 = 0")
    odd = [(10**9 + i, t) for i, t in enumerate(ODD)] + [(None, "n " * 140), (None, None)]
    d = d.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    d = d.unionByName(d.where("doc_id in (0, 2, 1000000005)"))
    return stage(d.withColumns({c: F.lit("other") for c in CLASH}))


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def test_empty_tables(spark, docs, tmp_path):
    docs.limit(0).withColumn("lang", F.lit("en")).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark", "pages", "embeddings"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name, q in queries.QUERIES.items():
        assert q(spark, str(tmp_path)).count() == 0, name


# --- 1 ------------------------------------------------------------------------------------------------

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((2 * int(c) - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def personal(text):
    out = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text):
            g, d = m.group(), re.sub("[^0-9]", "", m.group())
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in g.split(".")) or kind == "card" and 16 <= len(d) <= 19 and luhn(d) or kind == "phone" and 8 <= len(d) <= 15:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_personal_data(spark, docs):
    more = ["a@b.c_x@y.z +1-2-3 tel (212) 555-1234 and x", "1.2.3.4.5 999.1.1.1 00001.2.3.4", "4111 1111 1111 1111 x 4111-1111-1111-1112 41111111111111112222334", "🙂 a.b+c@d-e.co.uk, +49 (0) 30.12-345 67 ip 10.0.0.1. +1 ++12345678", "john (at) example (dot) com", "1 " * 9000, "a" * 9000 + "@b" + ".c" * 900]
    d = docs.unionByName(spark.createDataFrame([(2 * 10**9 + i, t) for i, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    cands = stage(pii.candidates(d.select("doc_id", "text")).drop("text"))
    got = pii.digest(pii.spans(cands, pii.fit(cands))).collect()
    key = lambda n, h: (*n, h)
    want = collections.Counter()
    for r in d.select("doc_id", "text").collect():
        s = personal(r.text or "")
        want[r.doc_id, *(sum(x.startswith(k) for x in s) for k in KINDS), hashlib.sha256(",".join(s).encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    by = {r.doc_id: r.spans for r in got}
    assert "phone:23:37" in by[2 * 10**9] and by[2 * 10**9 + 4] == "email:0:27" and by[10**9 + 2] == ""
    assert all(set(personal(t)) <= set(by[i].split(",")) for i, t in ((2 * 10**9 + k, t) for k, t in enumerate(more)) if personal(t))
    red = pii.redact(pii.spans(pii.candidates(d.where("doc_id = 2000000000").select("doc_id", "text")), pii.fit(cands))).head().text
    assert red == "<EMAIL><EMAIL> +1-2-3 tel <PHONE> and x"


def test_places_of_weak_numbers(spark):
    """A number without a plus is found wherever it stands, but not within another number."""
    places = ["555-123-4567 is my phone", "Call me. 555-123-4567", "tel:555-123-4567", "phone\t(555) 123-4567", "phone [555-123-4567]", "call\n555 123 4567", "phone  555-123-4567"]
    not_ = ["phone 7555-123-4567", "phone 1.555-123-4567", "phone 555-123-45678", "phone +1 555-123-4567"]
    found = {r.doc_id: [(c.start, c.end) for c in r.cands if c.kind == "phone" and not c.base] for r in pii.candidates(spark.createDataFrame(list(enumerate(places + not_)), "doc_id long, text string")).collect()}
    for i, t in enumerate(places):
        m = re.search(r"\(?555\)?[ -]123[ -]4567", t)
        assert found[i] == [m.span()], t
    assert [found[len(places) + k] for k in range(3)] == [[], [], []]
    cands = pii.candidates(spark.createDataFrame([(0, not_[3])], "doc_id long, text string"))
    yes = {("phone", False, a, b, c, *f): 0.9 for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) for f in itertools.product(range(4), range(3), range(3))}
    assert pii.digest(pii.spans(cands, yes)).head().spans == "phone:6:21"


def test_what_the_method_adds(spark):
    """Candidates of every kind that only the method finds; the model keeps the likely ones, and words alike but empty of data stay."""
    rnd = random.Random(21)
    hexes = lambda n: "".join(rnd.choice("0123456789abcdef") for _ in range(n))
    rows, want = [], {}
    for k in range(60):
        n = lambda d: "".join(rnd.choice("23456789") for _ in range(d))
        card = n(15)
        card += next(c for c in "0123456789" if luhn(card + c))
        parts = [
            f"mail me: joe{k}@mail.example.com or call +1 (2{n(2)}) {n(3)}-{n(4)}, host 10.{k}.7.9, card 4{n(3)}",
            ("email", f"write to ann{k} (at) example (dot) com now"), ("phone", f"phone: (2{n(2)}) {n(3)}-{n(4)} today"), ("ip", f"the host 10[.]{k}[.]7[.]{k} answers"), ("card", f"visa card {card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]} ok"),
            ("secret", f'token = "{hexes(40)}" in a file'), "an ordinary sentence of words, at noon.dot and 2020-10-10 or 12345, with anticonstitutionnellement",
        ]
        for x in parts:
            rows.append((len(rows), x if isinstance(x, str) else x[1]))
            want[len(rows) - 1] = None if isinstance(x, str) else x[0]
    cands = stage(pii.candidates(spark.createDataFrame(rows, "doc_id long, text string")))
    found = pii.spans(cands, pii.fit(cands.select("cands")))
    red = {r.doc_id: r.text for r in pii.redact(found).collect()}
    for r in pii.digest(found).collect():
        kind = want[r.doc_id]
        if kind:
            assert [x.split(":")[0] for x in r.spans.split(",")] == [kind] and r.n_spans == 1 and f"<{kind.upper()}>" in red[r.doc_id], rows[r.doc_id]
        elif r.doc_id % 7 == 6:
            assert r.spans == "" and red[r.doc_id] == rows[r.doc_id][1]
    assert all(x in red[5] for x in ('token = "<SECRET>" in a file',))


def test_long_texts_of_personal_data(spark):
    """A megabyte without breaks, or full of spans, takes seconds: nothing is quadratic."""
    n = 1_000_000
    spansful = "a@b.co 555-123-4567 +4930123456 é" * (n // 33)
    texts = ["x" * n + " @ y", "1" * n, "x@" * (n // 2), "+" + "(" * n, "1." * (n // 2), "é" * n + "a@b.co", spansful]
    began = time.time()
    cands = stage(pii.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    found = stage(pii.redact(pii.spans(cands, {("phone", False, a, b, c, *f): 0.9 for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) for f in itertools.product(range(4), range(3), range(3))})))
    got = {r.doc_id: (r.n, r.text) for r in found.select("doc_id", F.size("spans").alias("n"), "text").collect()}
    assert time.time() - began < 90
    assert [got[i][0] for i in range(7)] == [0, 0, 0, 0, n // 8, 1, 3 * (n // 33)] and got[6][1] == "<EMAIL> <PHONE> <PHONE> é" * (n // 33)
    assert got[5][1] == "é" * n + "<EMAIL>" and got[0][1] == texts[0]


# --- 2 and 7 ------------------------------------------------------------------------------------------


def covered(seqs, n):
    """For each sequence which items a window of n that starts at two places covers."""
    seen = collections.Counter(s[i : i + n] for s in seqs for i in range(len(s) - n + 1))
    for s in seqs:
        m, end = bytearray(len(s)), 0
        for i in range(len(s) - n + 1):
            if seen[s[i : i + n]] > 1:
                at = max(i, end)
                m[at : i + n] = b"\1" * (i + n - at)
                end = i + n
        yield m


def test_repeated_words(spark, docs, rows):
    more = [(3 * 10**9 + i, t) for i, t in enumerate([" ".join(f"x{i}" for i in range(35)), " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i % 7}" for i in range(5000)), "q " * 35, "z " * 34])]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    every = rows + more
    words = [tuple(WORD.findall(t)) for _, t in every]
    want = collections.Counter((i, len(w), sum(m), hashlib.sha256(" ".join(x for x, y in zip(w, m) if not y).encode()).hexdigest()) for (i, _), w, m in zip(every, words, covered(words, debruijn.WINDOW)))
    assert collections.Counter(tuple(r) for r in debruijn.digest(d).collect()) == want


@pytest.mark.parametrize("salt", [1000, 2])
def test_repeated_bytes(spark, docs, rows, salt, monkeypatch):
    monkeypatch.setattr(suffixes, "SALT", salt)
    rnd = random.Random(5)
    base = "".join(rnd.choice("abcdefgh ij") for _ in range(2000))
    more = [(3 * 10**9 + i, t) for i, t in enumerate([base[i : i + rnd.randrange(150, 900)] for i in range(0, 1500, 61)] + [base[:500] + str(i) + base[600:900] for i in range(12)])]
    d = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    every = [(i, t.encode()) for i, t in rows + more]
    want = collections.Counter()
    for (i, b), m in zip(every, covered([b for _, b in every], suffixes.WINDOW)):
        starts = sum(m[k] and not (k and m[k - 1]) for k in range(len(m)))
        want[i, len(b), sum(m), starts, hashlib.sha256(bytes(x for x, y in zip(b, m) if not y)).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in suffixes.digest(d).collect()) == want


def repeated_line(words, module):
    """Of a text of these words, the gram with the least hash: it is the anchor of every window that holds it."""
    import pyarrow as pa

    text = " ".join(words)
    grams = module._cut(pa.array([text]))[-1].grams
    at = int(grams.argmin())
    return words[at : at + module.GRAM] if module is debruijn else text[at : at + module.GRAM]


def test_changed_word_within_a_repeated_line(spark):
    """A context that holds its anchor twice: its end windows agree in both copies, what lies between does not."""
    rnd = random.Random(12)
    w = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    q = repeated_line(w(6000), debruijn)
    d = []
    for k in range(6):
        a, b, m = w(40), w(40), w(15)
        for x in ("one", "two", "two")[: 2 + k % 2]:
            d.append((len(d), " ".join(a + q + m[:7] + [x] + m[8:] + q + b)))
    words = [tuple(t.split()) for _, t in d]
    want = [(i, len(w), sum(m), hashlib.sha256(" ".join(x for x, y in zip(w, m) if not y).encode()).hexdigest()) for (i, _), w, m in zip(d, words, covered(words, debruijn.WINDOW))]
    assert any(0 < n - gone for _, n, gone, _ in want)
    assert sorted(tuple(r) for r in debruijn.digest(spark.createDataFrame(d, "doc_id long, text string")).collect()) == want


def test_changed_byte_within_a_repeated_line(spark):
    rnd = random.Random(13)
    s = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    q = repeated_line([s(30000)], suffixes)
    d = []
    for k in range(6):
        a, b, m = s(300), s(300), s(60)
        for x in "122"[: 2 + k % 2]:
            d.append((len(d), a + q + m[:30] + x + m[31:] + q + b))
    raw = [t.encode() for _, t in d]
    want = [(i, len(t), sum(m), hashlib.sha256(bytes(x for x, y in zip(t, m) if not y)).hexdigest()) for (i, _), t, m in zip(d, raw, covered(raw, suffixes.WINDOW))]
    assert any(0 < n - gone for _, n, gone, _ in want)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in suffixes.digest(spark.createDataFrame(d, "doc_id long, text string")).collect()) == want


def test_suffix_array():
    rnd = random.Random(6)
    for _ in range(400):
        s = [rnd.randrange(rnd.randrange(1, 5)) for _ in range(rnd.randrange(1, 40))]
        order = suffixes.suffix_array(s)
        assert order == sorted(range(len(s)), key=lambda i: s[i:])
        shared = lambda i, j: next((k for k in range(len(s)) if max(i, j) + k >= len(s) or s[i + k] != s[j + k]), 0)
        assert suffixes.longest_shared(s, order) == [max([shared(i, j) for j in range(len(s)) if j != i], default=0) for i in range(len(s))]


def test_compaction(spark):
    """A chain of units that only follow each other is one path; a node that two units enter is not passed."""
    u = spark.createDataFrame([(1, 10, 11), (2, 11, 12), (3, 12, 13), (4, 20, 13), (5, 13, 14)], "unit long, enters long, leaves long")
    assert {(r.unit, r.path) for r in debruijn.compacted(u).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_a_passage_is_one_path(spark, monkeypatch):
    """A long passage is many units; compaction makes one path of it, with one span in each source. Without compaction it falls apart."""
    rnd = random.Random(12)
    w = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage = w(400)
    d = spark.createDataFrame([(k, " ".join([*w(60 + k), *passage, *w(50)])) for k in range(3)], "doc_id long, text string")
    rows = d.select("doc_id", "text", debruijn.row_key().alias("rk"), debruijn.row_key2().alias("rk2"))
    spans = debruijn.repeated_spans(rows).collect()
    assert len({s.path for s in spans}) == 1 and sorted((s.s, s.e) for s in spans) == [(60 + k, 60 + k + 400 - 34) for k in range(3)]
    units = debruijn.repeated_units(rows)
    assert units.select("unit").distinct().count() > 5
    monkeypatch.setattr(debruijn, "compacted", lambda units: units.select("unit", F.col("unit").alias("path")).distinct())
    assert len(debruijn.repeated_spans(rows).collect()) > 15


# --- 4 ------------------------------------------------------------------------------------------------


UNITS = "kg g mg lb oz km m cm mm mi ft l ml s ms min h hours hour minutes minute seconds second days day weeks years usd eur dollars euros percent degrees meters metres miles pounds grams".split()


def slotted(text):
    """Tokens of a plain text as (type or None, lower-case value); for words parted by single spaces and , ; ? . behind them."""
    out, before = [], "."
    for w in (text or "").split():
        bare = w.rstrip(",;?.:!")
        if not bare:
            before = w
            continue
        kind = None
        if re.fullmatch(r"[0-9]+(?:[.,:/-][0-9]+)*", bare):
            kind = "num"
        elif bare in UNITS and out and out[-1][0] == "num" and before[-1] not in ",;?.:!":
            kind = "unit"
        elif bare[0].isupper() and before[-1] not in ".!?:;" and (bare[-1].islower() or len(bare) == 1):
            kind = "name"
        out.append((kind, bare.lower()))
        before = w
    return out


def leaked(text, item):
    """Brute force over all alignments of an item with a text."""
    d, a = slotted(text), slotted(item)
    n = min(len(a), templates.WINDOW)
    if not n or n < templates.SHORT and len(d) != n:
        return False
    of, seen = len(a) - n + 1, set()
    for shift in range(-len(a), len(d)):
        ats, slots = [], set()
        for at in range(of):
            x, y = a[at : at + n], d[at + shift : at + shift + n] if at + shift >= 0 else []
            words = sum(k is None for k, _ in x)
            if len(y) == n and (all(p[1] == q[1] for p, q in zip(x, y)) or (words >= min(templates.LITERALS, max(1, n - 1)) and all(p[0] == q[0] and (p[0] or p[1] == q[1]) for p, q in zip(x, y)))):
                ats.append(at)
                slots |= {(p[0], p[1], q[1]) for p, q in zip(x, y) if p[0] and q[0]}
        if all(len({s[:2] for s in slots if s[0] == k}) == len({(s[0], s[2]) for s in slots if s[0] == k}) == len({s for s in slots if s[0] == k}) for k in ("num", "unit", "name")):
            seen |= set(ats)
    return len(seen) >= templates.SHARE * of


@pytest.mark.parametrize("most", [10_000, 2])
def test_templates(spark, docs, most, monkeypatch):
    monkeypatch.setattr(templates, "MOST_KEYS", most)
    item = "A train leaves Berlin at 10:30 and travels 120 km to Hamburg with 12 cars; how long does Anna wait in Berlin for 12 more minutes of rest?"
    good = item.replace("Berlin", "Madrid").replace("12 ", "7 ").replace("10:30", "9:15").replace("120", "80").replace("Anna", "Maria")
    bench = [(9001, item), (9002, "too short"), (9003, None), (9001, item), (9004, "What is the capital of France?"), (9005, "yes"), (9006, ""), (9007, "If Anna has 12 and Bert has 15 apples, who has more apples then?"), (9008, "1 2 3 4 5 6 7 8 9 10 11 12"), (9009, "Is it 5 km from here?")]
    texts = [
        "so. " + good + " end", "so. " + good.replace("in Madrid", "in Lisbon").replace("for 7", "for 9"), item.upper(), "Well. What is the capital of France? Paris.", "WHAT IS THE CAPITAL OF FRANCE", "What is the capital of Spain then",
        "yes", "yes it is", "too short", "it is too short for this", "if Max has 7 and Max has 7 apples, who has more apples then?", "if Max has 7 and Moritz has 9 apples, who has more apples then?", "if Max has 12 and Anna has 15 apples, who has more apples then?",
        "9 8 7 6 5 4 3 2 1 0 11 12", "x 1 2 3 4 5 6 7 8 9 10 11 12 y", "Oh, is it 9 miles from here?", "is it 5 g from here", None, "", "7 " * 3000 + item, "is it far from here",
    ]
    rows = [(5 * 10**9 + i, t) for i, t in enumerate(texts)] + [(5 * 10**9, texts[0]), (None, item), (5 * 10**9 + 4, "another text of that id")]
    clash = {c: F.lit("other") for c in ("tokens", "t", "p", "s", "rk", "key", "size", "window")}
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns(clash)
    b = spark.createDataFrame(bench, "item_id long, text string").withColumns(clash)
    want = {(i, k) for i, t in rows for k, x in bench if leaked(t, x)}
    assert (5 * 10**9, 9001) in want and (5 * 10**9 + 1, 9001) not in want and (5 * 10**9 + 3, 9004) in want and (5 * 10**9 + 10, 9007) not in want and (5 * 10**9 + 11, 9007) in want and (5 * 10**9 + 13, 9008) not in want
    got = {(r.doc_id, r.item_id) for r in templates.report(d, b).collect()}
    assert got == want
    kept = templates.clean(d, b)
    bad = {(i, t) for i, t in rows if any(leaked(t, x) for _, x in bench)}
    assert collections.Counter((r.doc_id, r.text, r.window) for r in kept.collect()) == collections.Counter((i, t, "other") for i, t in rows if (i, t) not in bad)


def test_templates_of_the_table(spark, docs, rows):
    """Every document that holds half of an item's windows word for word is found."""
    bench = table(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in templates.report(docs, bench).collect()}
    windows, size = collections.defaultdict(set), {}
    for r in bench.collect():
        w = r.text.split()
        size[r.item_id] = len(w) - 7
        for k in range(len(w) - 7):
            windows[" ".join(w[k : k + 8])].add((r.item_id, k))
    want = set()
    for i, t in rows:
        w, hit = t.split(), collections.defaultdict(set)
        for k in range(len(w) - 7):
            for item_, at in windows.get(" ".join(w[k : k + 8]), ()):
                hit[item_].add(at)
        want |= {(i, x) for x, ats in hit.items() if len(ats) >= templates.SHARE * size[x]}
    assert want <= got and want
    # of what is found beyond, every pair shares its alignment by the brute-force rule
    text, items = dict(rows), {r.item_id: r.text for r in bench.collect()}
    assert all(leaked(text[i], items[k]) for i, k in got - want)


# --- 6 ------------------------------------------------------------------------------------------------


def test_quality(spark, docs, rows):
    import xxhash

    labels = table(spark, SF, "labels")
    got = quality.judge(docs.select("doc_id", "text", *CLASH), labels).collect()
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    one = lambda *ws: signed_chain(ws) % quality.BUCKETS

    def signed_chain(ws):
        h = 42
        for w in ws:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        return signed(h)

    raw, good_n, grams = collections.Counter(), collections.Counter(), []
    for i, t in rows:
        w = WORD.findall(t)
        g = [one(x) for x in w] + [one(a, b) for a, b in zip(w, w[1:])]
        grams.append(g)
        raw.update(g)
        if i in good:
            good_n.update(g)
    a, b = sum(raw.values()) + quality.BUCKETS, sum(good_n.values()) + quality.BUCKETS
    weight = lambda x: round(math.log(good_n[x] + 1) - math.log(b) - math.log(raw[x] + 1) + math.log(a), 6)
    want = []
    for (i, t), g in zip(rows, grams):
        w = WORD.findall(t)
        three = collections.Counter(zip(w, w[1:], w[2:]))
        m = [False] * len(w)
        for k in range(len(w) - 2):
            if three[tuple(w[k : k + 3])] > 1:
                m[k : k + 3] = [True] * 3
        lines = [x for x in t.split("\n") if WORD.search(x)]
        failed = len(w) < 50 or 100 * sum(m) > 50 * len(w)
        llr = sum(map(weight, g)) / len(g) if g else 0.0
        want.append((i, len(w), sum(map(len, w)), sum(t.count(c) for c in quality.SYMBOLS), len(lines) - len(set(lines)), sum(m), failed, not failed and llr >= quality.THRESHOLD, round(llr, 5)))
    short = lambda r: (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept, round(r.llr, 5))
    assert collections.Counter(map(repr, map(short, got))) == collections.Counter(map(repr, want))


# --- 8 ------------------------------------------------------------------------------------------------


def word_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components_of(rows, similar=85):
    """The least id that each id reaches; rows with a null id take no part."""
    up = {i: i for i, _ in rows if i is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    sets = [(i, word_set(t)) for i, t in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= similar * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in up}


@pytest.mark.parametrize("bucket", [2048, 3])
def test_near_duplicates(spark, docs, rows, bucket, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET", bucket)
    rnd = random.Random(8)
    base = [f"b{rnd.randrange(10**6)}" for _ in range(150)]
    more = []
    for k in range(40):
        w = list(base)
        for _ in range(rnd.randrange(1, 6)):
            w[rnd.randrange(len(w))] = f"e{k}x{rnd.randrange(99)}"
        more.append((7 * 10**9 + k, " ".join(w)))
    other = [" ".join(f"{c}{k}" for k in range(40)) for c in "pqrs"]
    at = 8 * 10**9
    # ids that share texts, ids with several texts, an id with a text and an empty one, a null id with copies and without
    more += [(at + 1, other[0]), (at + 5, other[0]), (at + 3, other[1]), (at + 5, other[1]), (at + 7, ""), (at + 7, other[0]), (at + 8, None), (at + 8, other[2]), (None, other[1]), (None, other[3]), (at + 9, "x"), (at + 9, "y"), (at + 10, "y")]
    clash = {c: F.lit("other") for c in CLASH}
    d = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string").withColumns(clash))
    got, want = neardup.dedup(d).collect(), components_of(rows + more)
    assert want[at + 3] == want[at + 5] == want[at + 7] == at + 1 and want[at + 10] == at + 9
    texts = collections.defaultdict(set)
    for i, t in rows + more:
        texts[i].add(word_set(t))
    for r in got:
        if r.doc_id is not None:
            assert (r.component_id, r.kept) == (want[r.doc_id], want[r.doc_id] == r.doc_id)
    by_set = {word_set(t): i for i, t in sorted((r for r in rows + more if r[0] is not None), reverse=True, key=lambda r: r[0]) if word_set(t)}
    nulls = collections.Counter((len(word_set(t)), want.get(by_set.get(word_set(t)))) for i, t in rows + more if i is None)
    assert collections.Counter((r.n_shingles, r.component_id) for r in got if r.doc_id is None) == nulls
    assert collections.Counter((r.doc_id, r.n_shingles) for r in got) == collections.Counter((i, len(word_set(t))) for i, t in rows + more)


def test_open_buckets(spark):
    """Blocks of a bucket link what one block would: all that is linked, in fewer links than members."""
    import numpy as np

    rnd, sets = random.Random(4), []
    for k in range(60):
        sets.append(sorted({*range(1000 * (k % 7), 1000 * (k % 7) + 100)} - set(rnd.sample(range(1000 * (k % 7), 1000 * (k % 7) + 100), 4))))
    m = spark.createDataFrame([(1, 60, k, k, bytearray(np.array(x, np.uint64).tobytes())) for k, x in enumerate(sets)], "key long, c long, cid long, comp long, set binary")
    want = [(a, b) for a in range(60) for b in range(a) if 100 * len({*sets[a]} & {*sets[b]}) >= 85 * len({*sets[a]} | {*sets[b]})]
    for bucket in (2048, 5):
        neardup.BUCKET, was = bucket, neardup.BUCKET
        try:
            links = [tuple(r) for r in neardup.across(neardup.dealt(m.drop("set")).join(m.select("cid", "set"), "cid")).collect()]
        finally:
            neardup.BUCKET = was
        assert {(max(x), min(x)) for x in links} <= set(want)
        groups = lambda e: {r.node: r.component for r in components.components(spark.createDataFrame(e, "a long, b long")).collect()}
        assert groups(links) == groups(want)


def test_pigeonhole():
    """Whatever MOST positions differ, some chunk agrees with one of its positions left out."""
    rnd = random.Random(9)
    for _ in range(2000):
        off = set(rnd.sample(range(neardup.POSITIONS), neardup.MOST))
        assert any(all(i == j or i not in off for i in neardup.PARTS[c]) for c, j in neardup.KEYS)


def test_components(spark):
    rnd = random.Random(10)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5000, k) for k in range(5001, 5100)]
    up = {x: x for e in edges for x in e}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# --- 9 ------------------------------------------------------------------------------------------------


def test_scores(spark, docs, rows):
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    toks = [(i, [*WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t)), None]) for i, t in rows]
    c = collections.Counter(w for i, ws in toks if not out(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = collections.Counter()
    for i, ws in toks:
        want[i, out(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4)] += 1
    got = attention.scored(docs, *queries.tokenizer()).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
    assert all(r.score < 0 for r in got)


def test_every_training_text_counts(spark, monkeypatch):
    """Which word follows which is learned from all training texts, whichever block they fall in, and from no held-out one."""
    monkeypatch.setattr(attention, "BLOCK_BYTES", 4000)
    out = [i for i in range(20000, 21000) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [(i, ("red house blue river ", "green stone white cloud ")[i % 2] * 5) for i in range(400)]
    rows += [(out[0], "red house blue river " * 5), (out[1], "red river blue house " * 5)]
    score = lambda r: {x.doc_id: x for x in attention.scored(spark.createDataFrame(r, "doc_id long, text string"), *queries.tokenizer()).collect()}
    got = score(rows)
    good, bad = got[out[0]], got[out[1]]
    assert good.held_out and bad.held_out and abs(good.base_score - bad.base_score) < 1e-9
    assert good.score > bad.score + 15
    last = next(i for i in range(9000, 9100) if zlib.crc32(str(i).encode()) % 10)
    more = score([*rows, (last, "red river blue house " * 40)])  # one more training text moves the score
    assert more[out[1]].score > bad.score + 1
    same = score([*rows, (out[2], "red river blue house " * 40)])
    assert abs(same[out[1]].score - bad.score) < 0.5


def small_tables(r, n=60, size=4000):
    """Ids of texts of 100 (the last id their end) in which the next id depends on the one before, and their tables."""
    import numpy as np

    size = np.full(size // 100, 100)
    ids = (np.cumsum(r.integers(1, 4, size.sum())) * 7 % (n - 20)).astype(np.int64)
    ids[np.cumsum(size) - 1] = n - 1
    counts = np.bincount(ids, minlength=n).astype(float)
    kind, _ = attention.classes_of(counts)
    x = attention.before(ids, size, n - 1)
    flat = lambda a, b: np.bincount(a * attention.CLASSES + kind[b], minlength=n * attention.CLASSES).reshape(n, -1).astype(float)
    return ids, size, attention.tables_of(counts, flat(x, ids), flat(ids, x))


def test_probabilities_of_ids():
    """Given what stands before, the ids' probabilities sum to one; training beats the counts of single ids."""
    import numpy as np

    ids, size, tables = small_tables(np.random.default_rng(2))
    head = attention.Head(tables)
    loss = [np.mean(attention.fit(head, ids, size, state, 0.01)) for state in [{}] for _ in range(20)]
    assert loss[-1] < loss[0]
    start = ids[:45]
    last = np.array([attention.score(head, np.append(start, k), np.array([46]))[-1] for k in range(60)])
    assert abs((10.0**last).sum() - 1) < 1e-4
    counts = np.bincount(ids, minlength=60)
    assert attention.score(head, ids, size).mean() > np.log10(counts[ids] / len(ids)).mean() + 0.5
    assert len(np.unique(tables.near[:40], axis=0)) == 40


def test_pairs_share_their_class():
    """Whatever is kept, the shares of a class's ids sum to one for each id before; a frequent pair comes nearer to its share in the text."""
    import numpy as np

    ids, size, tables = small_tables(np.random.default_rng(6))
    n, kind = 60, tables.kind
    x = attention.before(ids, size, n - 1)
    after = np.bincount(x * attention.CLASSES + kind[ids], minlength=n * attention.CLASSES).reshape(n, -1).astype(float)
    keys, count = np.unique(x * n + ids, return_counts=True)
    every = np.arange(n)
    for most in (0, 10, 300, len(keys)):
        kept = np.sort(np.argsort(-count, kind="stable")[:most])
        t = attention.with_pairs(tables, after, keys[kept], count[kept])
        for before in range(n):
            p = np.exp(t.log_inside(np.full(n, before), every))
            assert np.allclose(np.bincount(kind, p, attention.CLASSES)[np.unique(kind)], 1, atol=1e-4)
        if most == 300:
            a, b = divmod(int(keys[np.argmax(count)]), n)
            share = count.max() / after[a, kind[b]]
            both = [float(np.exp(m.log_inside(np.array([a]), np.array([b]))[0])) for m in (tables, t)]
            assert abs(both[1] - share) <= abs(both[0] - share)


def test_frequent_pairs(spark, docs):
    import numpy as np

    path, pattern = queries.tokenizer()
    blocks = stage(attention.spelled_blocks(docs.select("doc_id", "text").repartition(3), path, pattern)).where("ids is not null")
    n = attention.coder(path, pattern).n_vocab + 1
    want = collections.Counter()
    for r in blocks.collect():
        ids, size = attention.unpacked(bytes(r.ids), np.uint16).astype(np.int64), np.array(r.sizes)
        trains = np.repeat(~np.array(r.held), size)
        want.update((attention.before(ids, size, n - 1) * n + ids)[trains].tolist())
    keys, count = attention.frequent_pairs(blocks, n)
    assert dict(zip(keys.tolist(), count.tolist())) == dict(want) and (np.diff(keys) > 0).all()
    keys, count = attention.frequent_pairs(blocks, n, 500)
    assert 0 < len(keys) <= 500 and all(want[k] == c for k, c in zip(keys.tolist(), count.tolist()))
    assert min(count) > sorted(want.values(), reverse=True)[500] * 0.9  # whole size classes


def test_scores_of_a_table(spark, docs):
    """What scored() gives each text is the sum over its ids by the model, made again step by step."""
    import numpy as np

    path, pattern = queries.tokenizer()
    d = stage(docs.select("doc_id", "text").where("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1))
    got = {r.doc_id: r.score for r in attention.scored(d, path, pattern).collect()}
    blocks = stage(attention.spelled_blocks(d, path, pattern)).where("ids is not null")
    n = attention.coder(path, pattern).n_vocab + 1
    counts, parts = np.zeros(n), []
    for r in blocks.collect():
        ids, size = attention.unpacked(bytes(r.ids), np.uint16).astype(np.int64), np.array(r.sizes)
        counts += np.bincount(ids[np.repeat(~np.array(r.held), size)], minlength=n)
        parts.append((r.docs, ids, size))
    head = attention.trained(blocks, attention.tables(blocks, counts))
    want = {}
    for names, ids, size in parts:
        each = attention.score(head, ids, size).astype(float)
        want |= dict(zip(names, np.add.reduceat(each, np.cumsum(size) - size)))
    assert set(got) == set(want) and all(abs(got[i] - want[i]) <= 1e-3 * abs(want[i]) for i in want)


def test_gradient():
    """The step's gradient is the slope of the loss."""
    import numpy as np

    r = np.random.default_rng(3)
    ids, size, tables = small_tables(r)
    head = attention.Head(tables)
    head.w = {k: (v + r.normal(size=v.shape) * 0.2).astype(np.float64) for k, v in head.w.items()}
    x, y = attention.before(ids, size, 59)[:160].reshape(10, 16), tables.kind[ids][:160].reshape(10, 16)[:, 8:].copy()
    y[3, 5:] = -1
    loss = lambda w: -attention.Head(tables, w).log_class(x, np.maximum(y, 0), 8)[y >= 0].mean()
    was = {k: v.copy() for k, v in head.w.items()}
    state = {}
    head.step(x, y, 8, state, 0.0)
    for name, w in was.items():
        for _ in range(6):
            at = tuple(int(r.integers(0, 16 if name == "p" and d == 0 else n)) for d, n in enumerate(w.shape))
            up, down = ({k: v.copy() for k, v in was.items()} for _ in range(2))
            up[name][at] += 1e-3
            down[name][at] -= 1e-3
            assert abs((loss(up) - loss(down)) / 2e-3 - state[name][0][at] * 10) < 2e-3, name


def test_attention_windows():
    """Overlapping windows give each id the score of its own window, computed alone and one place after the other."""
    import numpy as np

    r = np.random.default_rng(1)
    ids, size, tables = small_tables(r)
    head = attention.Head(tables)
    attention.fit(head, ids, size, {}, 0.01)
    size = np.array([1, 7, 32, 33, 56, 57, 200])
    ids = ids[: size.sum()]
    got = attention.score(head, ids, size, batch=3)
    at, w, t = 0, head.w, tables
    for n in size.tolist():
        c = ids[at : at + n]
        x = np.concatenate([[59], c[:-1]])
        for k in range(n):
            step = attention.CONTEXT - attention.LEAD
            start = 0 if k < attention.CONTEXT else (k - attention.LEAD) // step * step
            assert k - start < attention.CONTEXT and (k - start >= attention.LEAD or not start)
            h = t.near[x[start : k + 1]] + w["p"][: k + 1 - start]
            q, keys, v = h[-1] @ w["w"][:, :16], h @ w["w"][:, 16:32], h @ w["w"][:, 32:]
            a = np.exp(keys @ q)
            z = (h[-1] + a @ v / a.sum()) @ w["o"] + w["b"] + t.prior[x[k]]
            want = z[t.kind[c[k]]] - np.log(np.exp(z).sum()) + t.inside[c[k], t.kind[x[k]]]
            assert abs(want / np.log(10) - got[at + k]) < 1e-3
        at += n


# --- 10 -----------------------------------------------------------------------------------------------


def test_long_pieces():
    """Long runs without breaks: equal to the library where it can answer, and in time about proportional to the length."""
    import tiktoken

    path, pattern = queries.tokenizer()
    codec = bpe.Codec(path, pattern)
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.table.ranks, special_tokens={})
    rnd = random.Random(5)
    many = [x * 1500 for x in ("a", "ab", "the", "é", "abcab", "-", "日", "zq")] + ["".join(rnd.choice("ab") for _ in range(3000)), "".join(rnd.choice("aeinrst") for _ in range(3000)), "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3000))]
    many += [x[: rnd.randrange(bpe.LONG - 9, bpe.LONG + 9)] for x in many]
    assert codec.encode(many) == [enc.encode_ordinary(t) for t in many]
    took = []
    for n in (100_000, 1_000_000):
        texts = ["a" * n, "".join(rnd.choice("aeinrst") for _ in range(n))]
        began = time.time()
        ids = codec.encode(texts)
        took.append(time.time() - began)
        assert [codec.decode(x) for x in ids] == [t.encode() for t in texts]
    assert took[1] < 60 and took[1] < 25 * took[0] + 5


def test_bpe(spark, docs, rows):
    import tiktoken

    path, pattern = queries.tokenizer()
    codec = bpe.Codec(path, pattern)
    enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=codec.table.ranks, special_tokens={})
    rnd = random.Random(3)
    texts = [t for _, t in rows] + ["a" * 3000, "<|endoftext|>"] + ["".join(chr(rnd.choice([97, 98, 32, 10, 233, 0x4E2D, 0x1F600, rnd.randrange(32, 0x2FFF)])) for _ in range(rnd.randrange(60))) for _ in range(500)] + ["".join(rnd.choice("abcdeinorst") for _ in range(40)) for _ in range(500)]
    assert codec.encode(texts) == [enc.encode_ordinary(t) for t in texts]
    want = collections.Counter()
    for i, t in rows:
        ids = enc.encode_ordinary(t)
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += 1
    assert collections.Counter(tuple(r) for r in bpe.digest(docs, path, pattern).collect()) == want
    back = bpe.decode(bpe.encode(docs, path, pattern), path)
    assert collections.Counter((r.doc_id, r.text) for r in back.collect()) == collections.Counter(rows)


def _digested(texts, size=1 << 30):
    """What a task makes of texts, in batches of so many."""
    import pyarrow as pa

    ids = list(range(len(texts)))
    batches = [pa.record_batch({"text": pa.array(texts[k : k + size], pa.string()), "doc_id": pa.array(ids[k : k + size])}) for k in range(0, len(texts), size)]
    return [tuple(r.values()) for b in bpe.digests(iter(batches), *queries.tokenizer()) for r in b.to_pylist()]


def test_digests_do_not_depend_on_what_a_task_keeps(monkeypatch, rows):
    """Small blocks and replays, pieces forgotten after a few: the same ids."""
    texts = [t for _, t in rows] + ["x" * 5000 + " y", None]
    codec = bpe.Codec(*queries.tokenizer())
    want = [(k, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for k, (t, x) in enumerate(zip(texts, codec.encode(texts)))]
    assert _digested(texts) == want
    for name, value in {"BLOCK_BYTES": 3000, "REPLAYED": 50, "KEPT": 100, "KEPT_CHARS": 1000}.items():
        monkeypatch.setattr(bpe, name, value)
    assert _digested(texts, 7) == want


def test_digests_in_bounded_memory(monkeypatch):
    """What a task holds follows its bounds, not the number of distinct pieces that it gets (before: those of 24 MB at once)."""
    import tracemalloc

    rnd = random.Random(11)
    texts = [" ".join("".join(rnd.choices("aeinrstlo", k=8)) for _ in range(100)) for _ in range(2000)]
    bpe.Codec(*queries.tokenizer())
    for name, value in {"BLOCK_BYTES": 1 << 16, "REPLAYED": 1 << 15, "KEPT": 1 << 13}.items():
        monkeypatch.setattr(bpe, name, value, raising=False)
    peaks = []
    for many in (texts[:500], texts):
        tracemalloc.start()
        _digested(many)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0], peaks


def test_fit_looks_at_every_place(monkeypatch):
    """Each id of each text is predicted once."""
    import numpy as np

    ids, size, tables = small_tables(np.random.default_rng(3))
    head, seen = attention.Head(tables), []
    real = head.step
    monkeypatch.setattr(head, "step", lambda x, y, low, state, rate: seen.append((y >= 0).sum()) or real(x, y, low, state, rate))
    attention.fit(head, ids, size, {}, 0.01)
    assert sum(seen) == len(ids)


def test_pairs_are_found_in_runs(monkeypatch):
    """Pairs are sorted in runs before they are looked up, and no array is as long as the text in 64 bits; the result is that of a search for each."""
    import tracemalloc

    import numpy as np

    r = np.random.default_rng(8)
    n, many = 60, 1 << 20
    counts = r.integers(1, 50, n).astype(float)
    after = r.integers(0, 9, (n, attention.CLASSES)).astype(float)
    keys = np.sort(r.choice(n * n, 900, replace=False))
    t = attention.with_pairs(attention.tables_of(counts, after, after), after, keys, r.integers(1, 9, 900))
    x, y = r.integers(0, n, many), r.integers(0, n, many)
    monkeypatch.setattr(attention, "SORTED", 1 << 14, raising=False)
    tracemalloc.start()
    got = t.log_inside(x, y)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    kept = {int(k): v for k, v in zip(*t.pairs)}
    for i in range(0, many, 501):
        want = kept.get(int(x[i] * n + y[i]), t.inside[y[i], t.kind[x[i]]] + t.rest[x[i], t.kind[y[i]]])
        assert got[i] == want
    assert peak < 8 * many


def test_words_meet_their_counts_packed(spark, docs, rows):
    """No word is a row: a block's list comes packed and meets the counts of the training texts by ranges of hashes."""
    import numpy as np

    path, pattern = queries.tokenizer()
    every = stage(attention.spelled_blocks(docs.select("doc_id", "text").repartition(5), path, pattern))
    blocks = every.where("ids is not null").collect()
    assert len(blocks) > 3 and every.count() == len(blocks) + every.where("block is null").count()
    met = attention.counted_words(every.where("ids is not null"), most=500).collect()
    out = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0
    words = lambda t: WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), t))
    c = collections.Counter(w for i, t in rows if not out(i) for w in words(t))
    assert sum(r.n for r in met if r.of_block is None) == sum(c.values()) and sum(r.v for r in met if r.of_block is None) == len(c)
    assert len({r.bucket for r in met}) == 64
    got = collections.Counter()
    for r in blocks:
        parts = sorted((x.bucket, bytes(x.c)) for x in met if x.of_block == r.block)
        n = np.concatenate([attention.unpacked(p, np.int64) for _, p in parts])[attention.unpacked(bytes(r.order), np.uint32)]
        got.update(n[attention.unpacked(bytes(r.of), np.uint32)].tolist())
    assert got == collections.Counter(c[w] for _, t in rows for w in words(t))


def test_tables_come_from_pairs(spark, docs, monkeypatch):
    """The texts are gone through once for pairs and tables; the tables are those counted from the ids."""
    import numpy as np

    path, pattern = queries.tokenizer()
    blocks = stage(attention.spelled_blocks(docs.select("doc_id", "text").repartition(3), path, pattern)).where("ids is not null")
    n = attention.coder(path, pattern).n_vocab + 1
    parts = []
    for r in blocks.collect():
        ids, size = attention.unpacked(bytes(r.ids), np.uint16).astype(np.int64), np.array(r.sizes)
        trains = ~np.array(r.held)
        parts.append((ids[np.repeat(trains, size)], size[trains]))
    ids, size = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    counts = np.bincount(ids, minlength=n).astype(float)
    kind, x = attention.classes_of(counts)[0], attention.before(ids, size, n - 1)
    flat = lambda a, b: np.bincount(a * attention.CLASSES + kind[b], minlength=n * attention.CLASSES).reshape(n, -1).astype(float)
    want = attention.tables_of(counts, flat(x, ids), flat(ids, x))
    seen = []
    monkeypatch.setattr(attention, "counted_pairs", lambda b, many, f=attention.counted_pairs: seen.append(many) or f(b, many))
    got = attention.tables(blocks, counts)
    assert seen == [n]
    assert np.array_equal(got.prior, want.prior) and np.array_equal(got.inside, want.inside) and np.array_equal(got.kind, want.kind)


def test_steps_move_one_array():
    """A step moves all weights in place; what stands beside them stays; scoring by what is known of each id gives the same."""
    import numpy as np

    ids, size, tables = small_tables(np.random.default_rng(4))
    head = attention.Head(tables)
    flat, was = head.flat, head.flat.copy()
    attention.fit(head, ids, size, {}, 0.01)
    still = np.ones(len(flat), bool)
    for v in attention._named(still).values():
        v[...] = False
    assert head.flat is flat and (flat[still] == was[still]).all() and (flat[~still] != was[~still]).mean() > 0.9
    x, y = attention.before(ids, size, 59)[:960].reshape(30, 32), tables.kind[ids][:960].reshape(30, 32)
    for low in (0, 8):
        assert np.allclose(head.log_class(x, y[:, low:], low), head.log_class(x, y[:, low:], low, head.known()), atol=1e-5)
    head.w = {k: v * 40 for k, v in head.w.items()}  # logits that are clipped
    out = attention._parts(head.flat)[2]
    m = head.attend(x)[-1]
    want = np.exp(np.clip(m @ out.T, -20, 20) + tables.prior[x.ravel()])
    assert np.abs(m @ out.T).max() > 20 and np.allclose(head.mass(m, x.ravel()), want, rtol=1e-4)
