"""Benchmark decontamination [native] by template canonicalisation.

Numbers, names (capitalised words inside a sentence, not those in capitals throughout) and units become typed placeholders,
punctuation goes, the rest is lower-cased. Every WINDOW successive tokens of a document are hash-joined with those of the
benchmark items; an item of fewer tokens is one window of its own length. A window has two keys: its template, if at least
LITERALS of its tokens are no slots, and its plain words, so that a copy in other letter case or one made of numbers alone is
found as well (windows of slots alone meet by their values only, so tables of numbers do not meet each other).

Matches are compared as tokens, not only by hash. Along one alignment of a document with an item the slots must be consistent
both ways: within a type, equal values in the item stand for equal values in the document and different ones for different ones.
A pair counts as a leak if its consistent windows make up SHARE of the item's windows, so an item whose numbers or names were
changed is found too. Items of fewer than SHORT tokens leak into documents that consist of them, since in a longer text they are
no evidence.

Defined cases: null and empty texts have no window; null ids are kept (as null); repeated rows of an item or a document give one
pair; ties do not arise; a very long text costs time in proportion to its length; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_key, row_key2, stage, whole_row

WINDOW, LITERALS, SHORT = 8, 3, 3
SHARE = 0.5
#: More keys of a benchmark than these are not tested within the scan, more bytes of them are not broadcast.
MOST_KEYS = 10_000
BROADCAST_BYTES = 32 << 20
#: Units that follow a number.
UNITS = "kg|g|mg|lb|oz|km|m|cm|mm|mi|ft|l|ml|s|ms|min|h|hours|hour|minutes|minute|seconds|second|days|day|weeks|years|usd|eur|dollars|euros|percent|degrees|meters|metres|miles|pounds|grams"
ROW = ["rk", "rk2", "doc_id"]
LINE = [*ROW, "item_id", "shift"]


def marked(text: Column) -> Column:
    """Tokens joined by single spaces; a slot is its placeholder, an equals sign and its value."""
    t = F.translate(F.coalesce(text, F.lit("")), "<>=", "   ")
    t = F.regexp_replace(t, r"(?<=[^.!?:;\s]\s)(\p{Lu}[\p{L}'’-]*+)(?<=\p{Ll}|\P{L}\p{Lu})", "<name>=$1")
    t = F.lower(t)
    digits = F.regexp_replace(t, rf"([0-9])\s?({UNITS})(?![\p{{L}}\p{{N}}])", "$1 <unit>=$2")
    digits = F.regexp_replace(digits, r"(?<![\p{L}\p{N}=.,:/-])([0-9]++(?:[.,:/-][0-9]++)*+)(?![\p{L}\p{N}])", "<num>=$1")
    t = F.when(t.rlike("[0-9]"), digits).otherwise(t)
    return F.trim(F.regexp_replace(t, r"(?:[^\p{L}\p{N}<>=.,:/-]|[.,:/-](?![0-9])|(?<![0-9])[.,:/-])++", " "))


def tokenised(rows: DataFrame) -> DataFrame:
    """rows with `tokens`, as marked, and of each token two hashes: of its type or word (t), and of its value or word (p)."""
    df = rows.withColumn("tokens", F.filter(F.split(marked(F.col("text").cast("string")), " "), lambda w: w != "")).drop("text")
    is_slot = lambda w: w.startswith("<") & F.contains(w, F.lit("="))
    df = df.withColumn("t", F.transform("tokens", lambda w: F.xxhash64(F.when(is_slot(w), F.substring_index(w, "=", 1)).otherwise(w))))
    df = df.withColumn("p", F.transform("tokens", lambda w: F.xxhash64(F.when(is_slot(w), F.substring_index(w, "=", -1)).otherwise(w))))
    df = df.withColumn("s", F.transform("tokens", lambda w: F.when(is_slot(w), 1).otherwise(0)))
    return df.withColumn("n_slots", F.aggregate("s", F.lit(0), lambda a, x: a + x))


def keys_of(sizes: list[int], asked: list[int] | None = None) -> Column:
    """For every window of so many tokens: size, place, tokens and keys, the hash of its words and that of its template (if it
    has enough words; the two are one where it has no slot). With asked, only windows of which a key is asked for."""

    def chain(column: str, i: Column, size: int) -> Column:
        return F.xxhash64(F.lit(size), *[F.get(F.col(column), i + k) for k in range(size)])

    def every(size: int) -> Column:
        last, none = F.size("tokens") - size, F.array().cast("array<int>")
        places = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(none)
        if size < SHORT:
            places = F.when(last == 0, F.array(F.lit(0))).otherwise(none)
        slots = lambda i: sum((F.get(F.col("s"), i + k) for k in range(1, size)), F.get(F.col("s"), i))
        typed = lambda i: (F.col("n_slots") > 0) & slots(i).between(1, size - min(LITERALS, max(1, size - 1)))
        if asked is not None:
            places = F.filter(places, lambda i: chain("p", i, size).isin(asked) | (typed(i) & chain("t", i, size).isin(asked)))
        keys = lambda i: F.when(typed(i), F.array(chain("t", i, size), chain("p", i, size))).otherwise(F.array(chain("p", i, size)))
        return F.transform(places, lambda i: F.struct(F.lit(size).alias("size"), i.cast("int").alias("pos"), F.slice("tokens", i + 1, size).alias("window"), keys(i).alias("keys")))

    return F.concat(*[every(s) for s in sizes]) if len(sizes) > 1 else every(sizes[0])


def windows(tokened: DataFrame, ids: list[str], sizes: list[int], asked: list[int] | None = None) -> DataFrame:
    """ids, size, pos, window and key: a row for each key of each window."""
    # the outer forms spare a filter on the arrays' sizes, which would be pushed down with all that makes the arrays
    part = tokened.select(*ids, F.explode_outer(keys_of(sizes, asked)).alias("w"))
    return part.select(*ids, "w.size", "w.pos", "w.window", F.explode_outer("w.keys").alias("key")).where("key is not null")


def _of_items(benchmark: DataFrame) -> DataFrame:
    """item_id, size of the windows, n tokens, the tokens; one row for each different text of an item."""
    rows = tokenised(benchmark.select("item_id", "text").distinct()).where("size(tokens) > 0")
    return rows.withColumn("size", F.least(F.size("tokens"), F.lit(WINDOW))).withColumn("of", F.size("tokens") - F.col("size") + 1)


def leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """rk, rk2, doc_id, item_id, matched windows, slots compared, share of the item's windows.

    First the documents' keys meet the different keys of all items: as a set within the scan while the benchmark has at most
    MOST_KEYS keys, by a join beyond. What they meet is small, and only that meets the items, tokens by tokens.
    """
    items = stage(_of_items(benchmark))
    sizes = sorted(r[0] for r in items.select("size").distinct().collect()) or [WINDOW]  # WINDOW values at most
    parts = [windows(items.where(F.col("size") == size).select("item_id", "tokens", "t", "p", "s", "n_slots"), ["item_id"], [size]) for size in sizes]
    own = parts[0]
    for part in parts[1:]:
        own = own.unionByName(part)
    own = stage(own.select("item_id", "size", F.col("pos").alias("at"), F.col("window").alias("asked"), "key").distinct())
    keys = own.select("key").distinct()
    few = [r[0] for r in keys.limit(MOST_KEYS + 1).collect()]
    rows = tokenised(docs.select("doc_id", "text", row_key().alias("rk"), row_key2().alias("rk2")))
    if len(few) <= MOST_KEYS:
        held = windows(rows, ROW, sizes, few)
    else:
        found = windows(rows, ROW, sizes)
        small = 16 * keys.count() <= BROADCAST_BYTES
        held = found.join(F.broadcast(keys) if small else keys, "key", "left_semi")
    met = stage(held.distinct()).join(own, ["key", "size"])
    pairs = F.arrays_zip(F.col("asked").alias("a"), F.col("window").alias("d"))
    kind = lambda w: F.when(F.contains(w, F.lit("=")), F.substring_index(w, "=", 1)).otherwise(w)
    value = lambda w: F.substring_index(w, "=", -1)
    same = F.forall(pairs, lambda x: kind(x["a"]) == kind(x["d"])) | F.forall(pairs, lambda x: value(x["a"]) == value(x["d"]))
    met = met.where(same).withColumn("shift", F.col("pos") - F.col("at")).select(*LINE, "at", "asked", "window").distinct()
    met = stage(met)
    slot = F.filter(pairs, lambda x: F.contains(x["a"], F.lit("=")) & F.contains(x["d"], F.lit("=")))
    slots = met.select(*LINE, F.explode(slot).alias("x")).select(*LINE, kind(F.col("x.a")).alias("k"), value(F.col("x.a")).alias("a"), value(F.col("x.d")).alias("d"))
    per = slots.groupBy(*LINE, "k").agg(F.countDistinct("a").alias("a"), F.countDistinct("d").alias("d"), F.countDistinct("a", "d").alias("both"))
    checked = per.groupBy(*LINE).agg(F.max((F.greatest("a", "d", "both") > F.least("a", "d", "both")).cast("int")).alias("mixed"), F.sum("a").alias("slots"))
    on = [F.col(f"m.{c}").eqNullSafe(F.col(f"c.{c}")) for c in LINE]
    good = met.select(*LINE, "at").distinct().alias("m").join(checked.alias("c"), on, "left").where("coalesce(c.mixed, 0) = 0")
    covers = good.select(*[f"m.{c}" for c in (*ROW, "item_id", "at")], F.coalesce("c.slots", F.lit(0)).alias("slots"))
    covers = covers.groupBy(*ROW, "item_id").agg(F.countDistinct("at").alias("n_windows"), F.max("slots").alias("n_slots"))
    # an item with several texts counts with the shortest of them
    of = items.groupBy("item_id").agg(F.min("of").alias("of"))
    out = covers.alias("m").join(of.alias("s"), F.col("m.item_id").eqNullSafe(F.col("s.item_id"))).select("m.*", F.least(F.col("n_windows") / F.col("of"), F.lit(1.0)).alias("share"))
    return out.where(F.col("share") >= share)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("n_slots").alias("n_slots"), F.max("share").alias("share"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without those that hold a leak; other columns go through, whatever their names."""
    bad = leaks(docs, benchmark).select("rk", "rk2").distinct()
    rows = docs.select(whole_row(docs), row_key().alias("rk"), row_key2().alias("rk2"))
    return rows.join(bad, ["rk", "rk2"], "left_anti").select("_row.*")
