"""URL verdicts, WARC archives and the pipeline."""

import gzip
import io
import os
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from quadrille.llm import queries, urls, warc

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    got = [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]
    cur = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(repr([r[c] for c in columns]) for r in got) == sorted(repr(list(r)) for r in cur.fetchall())


def test_aliases(spark):
    rows = [
        (1, "http://a.example.com/fr/1", "<link rel='canonical' href='/de/9'>"), (2, "http://b.org/x", '<meta http-equiv="refresh" content="0; url=http://a.example.com/de/9">'),
        (3, "http://c.org/fr/a", '<link href="http://b.org/x" rel=canonical>'), (4, "https://Q.NET", None), (5, None, "x"), (6, "http://z.com/q#f", '<link rel="canonical" href="//x.net/p">'),
        (7, "http://k.org/d/e?x", '<link rel="canonical" href="f">'), (7, "http://k.org/d/f", ""), (8, "http://www.EXAMPLE.net/en/a?b", ""), (9, "http://www.example.net/de/", ""), (10, "http://notnet/", ""), (11, "://net/x", ""),
    ]
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {
        (1, "a.example.com", "/fr/1", None, "allow"), (2, "b.org", "/x", None, "allow"), (3, "c.org", "/fr/a", "org/fr/", "allow"), (4, "q.net", "", None, "allow"), (5, "", "", None, "allow"),
        (6, "z.com", "/q", None, "block"), (7, "k.org", "/d/e", None, "allow"), (7, "k.org", "/d/f", None, "allow"), (8, "www.example.net", "/en/a", "example.net/en/", "allow"),
        (9, "www.example.net", "/de/", "net/", "block"), (10, "notnet", "/", None, "allow"), (11, "net", "/x", "net/", "block"),
    }


def linked_pages(seed):
    """Pages whose links make classes of several sizes, some under rules, with extra columns of clashing names."""
    import random

    rnd, rows = random.Random(seed), []
    url = lambda k: f"http://{('a.Example.com', 'b.org', 'x.net', 'www.example.net', 'c.de')[k % 5]}{('/de/', '/fr/', '/en/', '/q/')[k // 5 % 4]}{k}"
    for k in range(160):
        ways = [lambda t: f"<link rel='canonical' href='{t}'>", lambda t: f'<META http-equiv="Refresh" content="0; URL={t}">', lambda t: f'<link href="{t}#top" rel=canonical>', lambda t: f"<link rel=stylesheet href='{t}'>", lambda t: "<p>canonical</p>"]
        html = "".join(rnd.choice(ways)(url(rnd.randrange(160))) for _ in range(rnd.choice((0, 0, 1, 1, 2))))
        rows.append((k, url(k), html))
    more = [(160, None, "<link rel=canonical href=http://x.net/a>"), (161, url(3), None), (161, url(3), None), (162, url(4), "<link rel='canonical' href='/de/7?a=1&amp;b=2'>"), (163, "http://A.example.com/de/7?a=1&b=2", ""), (164, "no address", "<link rel=canonical href='x'>"), (None, url(5), ""), (165, "", "")]
    return rows + more


@pytest.mark.parametrize("seed", [1, 2])
def test_linked_pages(spark, tmp_path, seed):
    """Verdicts by links against a search over the graph, and against the SQL."""
    import re

    rows = linked_pages(seed)
    clash = {c: F.lit("other") for c in ("host", "path", "rule", "verdict", "_address", "component", "node", "a", "b")}
    spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(clash).write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted(map(repr, (tuple(r) for r in queries.QUERIES["op3_url_equivalence"](spark, str(tmp_path)).select("page_id", "host", "path", "rule", "verdict").collect())))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(map(repr, con.execute(queries.ORACLE_SQL["op3_url_equivalence"]).fetchall()))

    def parts(u):
        m = re.search("://([^/?#]*)([^?#]*)", u or "")
        return (m.group(1).lower(), m.group(2)) if m else ("", "")

    def rule(u):
        h, p = parts(u)
        return max(((len(x + y), x + y, v) for v, x, y in urls.RULES if (h == x or h.endswith("." + x)) and p.startswith(y)), default=(0, None, None))[1:]

    def address(u):
        u = u.split("#")[0]
        m = re.match("(.*?://)([^/?]*)(.*)$", u)
        return m.group(1) + m.group(2).lower() + m.group(3) if m else u

    near = {}
    for _, u, html in rows:
        for tag in re.findall("(?i)<(?:link|meta)[^>]*>", html or "") if u is not None else []:
            m = re.search("(?i)href=['\"]?([^'\"\\s>]+)", tag) if re.search("(?i)rel=['\"]?canonical", tag) else re.search("(?i)url=([^'\"\\s>]+)", tag) if "efresh" in tag else None
            if m:
                t = m.group(1).replace("&amp;", "&")
                t = address(t if "://" in t else re.match("(.*?://[^/]*)", u).group(1) + t if t.startswith("/") else "/x")
                near.setdefault(address(u), set()).add(t)
                near.setdefault(t, set()).add(address(u))

    def verdict(u):
        if rule(u)[1] or u is None:
            return rule(u)[1] or "allow"
        seen, todo = {address(u)}, [address(u)]
        while todo:
            for x in near.get(todo.pop(), ()):
                if x not in seen:
                    seen.add(x)
                    todo.append(x)
        found = {rule(x)[1] for x in seen}
        return "allow" if "allow" in found else "block" if "block" in found else "allow"

    want = [(i, *parts(u), rule(u)[0], verdict(u)) for i, u, _ in rows]
    assert got == sorted(map(repr, want))
    assert any(w[3] is None and w[4] == "block" for w in want) and any(w[3] == "net/" and w[4] == "block" for w in want)


def test_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 5000)
    p = "é" * 80
    rows = [(3, "u", p), (2, "u\n2", p), (None, None, p), (4, "", None), (5, "x y", "short"), (6, "x", "short"), (2, "again", p), (9, "w", "y" * 3_000_000)]
    clash = {c: F.lit("other") for c in ("digest", "first", "n", "archive", "path", "payload")}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns(clash)
    raw = warc.write(warc.decide(pages), f"file://{tmp_path}/raw")
    n = warc.normalise(raw, str(tmp_path / "new"))
    got = sorted((r.page_id or -1, r.url, r.payload_bytes, r.record_type, r.refers_to, bytes(r.payload).decode()) for r in warc.read(n).collect())
    assert got == sorted([
        (3, "u", 160, "revisit", 2, ""), (2, "u%0A2", 160, "response", None, p), (-1, "", 160, "revisit", 2, ""), (4, "", 0, "response", None, ""), (5, "x y", 5, "response", None, "short"),
        (6, "x", 5, "response", None, "short"), (2, "again", 160, "response", None, p), (9, "w", 3_000_000, "response", None, "y" * 3_000_000),
    ])
    heads = 0
    for r in n.collect():
        data = open(r.path, "rb").read()
        for offset, length, kind, _, _ in warc.indexed(r.sidecar):
            (head, raw_), = warc.records(warc.inflate(io.BytesIO(data[int(offset) : int(offset) + int(length)])))
            assert head["warc-type"] == kind and raw_.startswith(b"WARC/1.1\r\n")
            heads += 1
    assert heads == len(rows)
    # what was written first is one stream: its records have no members of their own
    one = max(raw.collect(), key=lambda r: os.path.getsize(r.path[7:])).path[7:]
    unpack = zlib.decompressobj(31)
    unpack.decompress(open(one, "rb").read())
    assert unpack.eof and not unpack.unused_data


def test_inflation_in_steps():
    """A stream that grows a thousandfold is given out in bounded parts; members that follow each other are one stream."""
    text = b"0" * 50_000_000
    parts = list(warc.inflate(io.BytesIO(gzip.compress(text) + gzip.compress(b"end")), 1 << 16))
    assert max(map(len, parts)) <= 1 << 16 and b"".join(parts) == text + b"end"


def test_near_duplicates_of_the_pipeline(spark):
    """Copies at 0.80 to 0.85 go, those below 0.80 stay: the stage's rows against all pairs of sets."""
    import random

    import corpus_pipeline as pipeline

    rnd, rows = random.Random(14), []
    for k in range(30):
        w = [f"b{rnd.randrange(10**6)}" for _ in range(154)]
        copy = list(w)
        for i in range(1 + k % 6):
            copy[10 + 20 * i] = f"e{k}"
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(copy))]
    sets = [{tuple(t.split()[i : i + 5]) for i in range(150)} for _, t in rows]
    share = [len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(0, 60, 2)]
    assert any(0.8 <= x < 0.85 for x in share) and any(0.7 < x < 0.8 for x in share)
    assert all(not sets[i] & sets[j] for i in range(60) for j in range(i) if i // 2 != j // 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in pipeline.near_duplicates(spark, docs, SF).collect()} == {2 * k for k in range(30)} | {2 * k + 1 for k in range(30) if share[k] < 0.8}


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as pipeline

    out = {r.doc_id: r for r in pipeline.run(spark, SF).collect()}
    docs, every = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, function in pipeline.STAGES[:-1]:
        kept = function(spark, docs, SF)
        kept.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        assert sorted(docs.columns) == sorted(before.columns)
        every[name] = {r.doc_id for r in docs.collect()}
        assert every[name] <= {r.doc_id for r in before.collect()}
    verdict = {r.doc_id: r.kept for r in queries.QUERIES["op6_quality_llr"](spark, SF).collect()}
    assert every["quality"] == {i for i, k in verdict.items() if k}
    assert set(out) == every["pii"] and 0 < len(out) < len(verdict)
    assert all(r.n_tokens > 0 and len(r.ids_sha256) == 64 for r in out.values())
