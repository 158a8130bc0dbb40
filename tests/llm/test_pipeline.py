"""The pipeline's stages within run(), each against brute force on what the stage before wrote."""

import collections
import glob
import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from quadrille.llm import pii, queries
from quadrille.llm.common import table, work_dir
from test_text import components_of, leaked, personal, word_set

SF = "/root/testdata/sf0.001"
CLASH = ["window", "_t", "spans", "cands", "rk", "words", "n_tokens", "_n", "_c", "kept", "score"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables, with odd rows, near copies, personal data and benchmark items, and columns whose names clash."""
    at = tmp_path_factory.mktemp("tables")
    docs, bench, labels = (table(spark, SF, n) for n in ("documents", "benchmark", "labels"))
    rnd = random.Random(3)
    long = [r.text for r in docs.orderBy("doc_id").collect() if r.text and len(r.text.split()) > 120]
    items = [r.text for r in bench.orderBy("item_id").limit(6).collect()]
    more, k = [], 10**6
    for t in long[:12]:
        w = t.split()
        changed = list(w)
        changed[rnd.randrange(len(w))] = "changed"
        more += [(k, " ".join(changed), len(t)), (k + 1, f"{t} write to joe{k}@mail.example.com or call +49 30 {rnd.randrange(10**5, 10**6)}, host 10.1.2.{k % 256}", len(t))]
        k += 2
    for t, item in zip(long[12:18], items):
        more += [(k, f"{t} {item}", len(t)), (k + 1, f"{item}", None)]
        k += 2
    more += [(None, long[20] + " null id", 7), (None, None, None), (k, None, None), (k + 1, "", 0), (k + 2, " \n\t", 3), (k + 3, "x" * 50_000, 50_000), (k + 4, (long[21] + " ") * 40, None)]
    every = docs.select("doc_id", "text", "n_chars", "lang", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, n_chars long").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("own")}))
    every = every.unionByName(every.where("doc_id in (3, 8, 1000001)")).withColumns({c: F.lit(f"other {c}") for c in CLASH})
    every.write.parquet(str(at / "documents.parquet"))
    bench.write.parquet(str(at / "benchmark.parquet"))
    labels.write.parquet(str(at / "labels.parquet"))
    return str(at)


@pytest.fixture(scope="module")
def written(spark, folder):
    """The result of run() and what each stage wrote within it."""
    was = set(glob.glob(f"{work_dir(spark)}/pipeline-*"))
    out = pipeline.run(spark, folder).collect()
    (here,) = set(glob.glob(f"{work_dir(spark)}/pipeline-*")) - was
    return out, [spark.read.parquet(f"{here}/{k}-{name}") for k, (name, _) in enumerate(pipeline.STAGES)]


def bag(rows):
    return collections.Counter(map(repr, rows))


def test_columns_go_through(spark, folder, written):
    out, stages = written
    columns = table(spark, folder, "documents").columns
    assert all(s.columns == columns for s in stages[:-1])
    assert {"n_tokens", "ids_sha256", "decoded_sha256", *columns} - {"text"} == set(stages[-1].columns)
    assert out and all(r[c] == f"other {c}" for r in out for c in CLASH if c != "n_tokens") and all(r.n_tokens > 0 for r in out)


def test_quality_within(spark, folder, written):
    """Base rules in full: what they reject is gone; null and empty texts among it."""
    def failed(t):
        w = word_list(t)
        three = collections.Counter(zip(w, w[1:], w[2:]))
        m = [False] * len(w)
        for k in range(len(w) - 2):
            if three[tuple(w[k : k + 3])] > 1:
                m[k : k + 3] = [True] * 3
        return len(w) < 50 or 100 * sum(m) > 50 * len(w)

    import re

    word_list = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    kept = written[1][0].collect()
    assert kept and not any(failed(r.text) for r in kept)
    verdict = {(r.doc_id, r.n_words): r.kept for r in queries.op6_quality_llr(spark, folder).collect()}
    rows = table(spark, folder, "documents").collect()
    assert bag(kept) == bag(r for r in rows if verdict[r.doc_id, len(word_list(r.text))])


def test_near_duplicates_within(written):
    before, after = (written[1][k].collect() for k in (0, 1))
    at = {n: r for n, r in enumerate(sorted(before, key=lambda r: (r.doc_id is None, r.doc_id or 0)))}
    groups = components_of([(n, r.text) for n, r in at.items()], 80)
    want = [at[n].text for n in at if groups[n] == n]
    ids = [at[n].doc_id for n in at if groups[n] == n]
    assert collections.Counter(r.doc_id for r in after) == collections.Counter(ids) and len(after) < len(before)
    assert {word_set(r.text) for r in after} == {word_set(t) for t in want}


def test_decontamination_within(spark, folder, written):
    before, after = (written[1][k].collect() for k in (1, 2))
    items = [r.text for r in table(spark, folder, "benchmark").collect()]
    want = [r for r in before if not any(leaked(r.text, x) for x in items)]
    assert bag(after) == bag(want) and len(after) < len(before)
    assert not any(x in r.text for r in after for x in items if len(x.split()) >= 8)


def test_personal_data_within(spark, written):
    before, after = written[1][2], {(r.doc_id, r.lang, r.source): r for r in written[1][3].collect()}
    cands = pii.candidates(before.select("doc_id", "lang", "source", "text"))
    spans = {(r.doc_id, r.lang, r.source): r for r in pii.spans(cands, pii.fit(cands)).select("doc_id", "lang", "source", "spans").collect()}
    rows = before.collect()
    assert len(rows) == len(after) == len(spans)
    hit = 0
    for r in rows:
        key = (r.doc_id, r.lang, r.source)
        found = sorted((s.start, -s.end, s.kind) for s in spans[key].spans)
        base = {(k, int(a), int(b)) for k, a, b in (x.split(":") for x in personal(r.text))}
        assert base <= {(k, a, -b) for a, b, k in found}
        out, at = [], 0
        for a, b, kind in found:
            if a >= at:
                out += [r.text[at:a], f"<{kind.upper()}>"]
                at = -b
            else:
                at = max(at, -b)
        text = "".join(out) + r.text[at:]
        assert after[key].text == text
        assert after[key].n_chars == (len(text) if found else r.n_chars)
        hit += bool(base)
    assert hit >= 5


def test_encoding_within(spark, written):
    import base64

    import tiktoken

    path, pattern = queries.tokenizer()
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    coder = tiktoken.Encoding("test", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for r in written[1][3].collect():
        ids = coder.encode_ordinary(r.text)
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids)).encode()), sha(r.text.encode())))
    assert bag((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in written[0]) == bag(want)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        table(spark, folder, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0
