"""Quality rules [native]: a hashed n-gram log-likelihood ratio and plain counts.

Every document gets the mean, over its hashed word n-grams, of log p(gram | trusted) - log p(gram | raw).
Both multinomials live on BUCKETS hash buckets. The raw one counts all documents; the trusted one counts the
documents of at most TRUSTED labelled rows (good and not toxic, those with the smallest hash of the id).
A document stays if the base rules hold and that mean is at least THRESHOLD.

Defined cases: a null text has no word and fails the base rule, as has an empty one; a null id is kept as it
is; a repeated row is judged again, equally; an empty table gives an empty result; without labels both
multinomials are equal, every ratio is 0 and only the base rules decide; columns other than the id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, WORD, whole_row

BUCKETS = 1 << 14
TRUSTED = 20_000
ALPHA = 1.0
THRESHOLD = -0.2
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"


def with_words(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).withColumn("words", F.filter(F.split("text", WHITE), lambda w: w != ""))


def grams(words) -> F.Column:
    """Buckets of the words and of the pairs of neighbours."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    two = F.transform(words, lambda w, i: F.pmod(F.xxhash64(w, F.get(words, i + 1)), F.lit(BUCKETS)).cast("int"))
    return F.concat(one, F.slice(two, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def weights(worded: DataFrame, labels: DataFrame | None) -> list[float]:
    """log p(bucket | trusted) - log p(bucket | raw) for each bucket; the result's size is BUCKETS whatever the input."""
    raw = worded.select("doc_id", F.explode(grams(F.col("words"))).alias("bucket"))
    if labels is not None:
        good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
        good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED).withColumn("trusted", F.lit(1))
        # at most TRUSTED rows of 12 bytes
        marked = worded.join(F.broadcast(good), "doc_id", "left")
        raw = marked.select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(grams(F.col("words"))).alias("bucket"))
    else:
        raw = raw.select(F.lit(0).alias("trusted"), "bucket")
    found = raw.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("trusted").alias("t")).collect()
    n, t = [0] * BUCKETS, [0] * BUCKETS
    for r in found:
        n[r["bucket"]], t[r["bucket"]] = r["n"], r["t"]
    if not sum(t):
        return [0.0] * BUCKETS
    ln, lt = math.log(sum(n) + ALPHA * BUCKETS), math.log(sum(t) + ALPHA * BUCKETS)
    return [math.log(b + ALPHA) - lt - math.log(a + ALPHA) + ln for a, b in zip(n, t)]


def repeat_words(df: DataFrame) -> DataFrame:
    """n_repeat_words: words in 3-word windows found twice or more in the text."""
    w = F.col("words")
    three = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    df = df.withColumn("h", F.slice(three, 1, F.greatest(F.size(w) - 2, F.lit(0))))
    df = df.withColumn("s", F.when(F.size(F.array_distinct("h")) == F.size("h"), F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    s = F.col("s")
    same = lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | ((i > 0) & (x["h"] == F.get(s, F.greatest(i - 1, F.lit(0)))["h"]))
    df = df.withColumn("p", F.array_sort(F.transform(F.filter(s, lambda x, i: F.coalesce(same(x, i), F.lit(False))), lambda x: x["i"])))
    p = F.col("p")
    n = F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", n.cast("long")).drop("h", "s", "p")


def judged(worded: DataFrame, table: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """worded (text and words) with the counts, the ratio and the verdict."""
    text = F.col("text")
    # the folded literal has BUCKETS doubles
    per = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    out = worded.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "lines": lines,
        "grams": grams(F.col("words")),
    }).withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    out = repeat_words(out)
    total = F.aggregate("grams", F.lit(0.0), lambda a, g: a + F.get(per, g))
    out = out.withColumn("llr", F.when(F.size("grams") > 0, total / F.size("grams")).otherwise(F.lit(0.0)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("llr") >= threshold))


def judge(docs: DataFrame, labels: DataFrame | None, threshold: float = THRESHOLD) -> DataFrame:
    worded = with_words(docs)
    out = judged(worded, weights(worded, labels), threshold)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")


def kept(docs: DataFrame, table: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, whole, that stay; no join is needed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    worded = docs.select(whole_row(docs), text).withColumn("words", F.filter(F.split("text", WHITE), lambda w: w != ""))
    # without the row number the filter would be pushed down, and with it a copy of every expression that it needs
    return judged(worded, table, threshold).select("_row", "kept", F.monotonically_increasing_id().alias("_n")).where("kept and _n >= 0").select("_row.*")
