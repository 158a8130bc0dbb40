"""Personal data [native]: labelers vote on candidate spans, EM weighs them, a trained classifier decides.

Candidates of each kind come from its patterns: the base pattern (its valid matches always stay) and weak ones (mail addresses
with the signs spelled out, addresses of hosts with the dots spelled out or of version 6, card numbers with other separators,
telephone numbers without a plus, secrets behind a word that names them or mixed of letters and digits). Three labelers vote 1, 0 or
-1 (no opinion) on each candidate: its form (regex), a word list or number plan that fits its kind (gazetteer), and the words
just before it (context). A two-class model with one table of vote probabilities for each labeler is fitted by
expectation-maximisation on the counts of candidates; a logistic classifier over votes, kind, form and features that no labeler
sees (length, share of digits, what stands before) is then trained on the posteriors. Candidates are counted by kind, form, votes and
features, of which there are at most 5 * 2 * 27 * 4 * 3 * 3 combinations whatever the input. Weak candidates whose
probability exceeds CUT are added, unless they overlap a base span.

All steps take time in proportion to a text's length (running sums in blocks of STEP, searches by halving).

Defined cases: a null text is an empty one (no span); null ids stay; repeated rows are judged alike, each by
itself; ties do not arise; an empty table gives an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: The base patterns. Repeats are possessive where the next character cannot be one of theirs, and a match begins where
#: its first run of characters does (or where the match before ended), since no later place of that run could begin one earlier.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_NAMES = "password|passwd|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth"
#: The weak patterns.
WEAK = {
    "email": r"[A-Za-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}+){1,4}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]|\(dot\))[0-9]{1,3}+){3}(?![0-9])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9./_])(?:[0-9]{4}[./_]){3}[0-9]{4}(?![0-9./_])",
    "phone": r"(?<![0-9+])(?<![0-9][.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9.-]?[0-9])",
    "secret": rf"(?i)(?<=(?:{_NAMES})[\"']?\x20?[:=]\x20?[\"']?)(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{8,}}+={{0,2}}|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+_]*+[0-9])(?=[0-9+_]*+[A-Za-z])[A-Za-z0-9+_]{{20,}}+(?![/-])",
}
#: Words of the gazetteer and context labelers.
ENDINGS = "com|org|net|edu|gov|io|de|fr|es|uk|info|eu"
CONTEXT = {
    "email": "mail|contact|write|reach|address",
    "ip": r"\bip\b|host|server|address|client|peer",
    "card": "card|visa|master|amex|credit|payment|account",
    "phone": r"phone|call|tel\b|fax|mobile|cell|number",
    "secret": "password|passwd|passphrase|secret|token|key|auth|credential|bearer",
}
REACH = 40
CUT = 0.5
ROUNDS = 50
STEP = 256


def _matches(text: Column, pattern: str, gate: Column) -> Column:
    """The leftmost non-overlapping matches and what lies between them."""
    none = F.array().cast("array<string>")
    hit = F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    gap = F.when(gate, F.split(text, pattern, -1)).otherwise(none)
    return F.struct(hit.alias("hit"), gap.alias("gap"))


def _blocks(values: Column, best, least) -> Column:
    """Running results of an array before each block of STEP elements. It must be a column of its own, read at two places or more,
    or the optimiser would put it where it is computed anew for each element."""
    one = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STEP).cast("int")), lambda b: F.aggregate(F.slice(values, b * STEP + 1, STEP), F.lit(least), best))
    upto = F.aggregate(one, F.array(F.lit(least)), lambda a, x: F.concat(a, F.array(best(F.element_at(a, -1), x))))
    return F.when(F.size(values) > 0, upto).otherwise(F.array(F.lit(least)))


def _before(values: Column, blocks: Column, i: Column, best) -> Column:
    """The running result before element i."""
    return F.aggregate(F.slice(values, i - i % STEP + 1, i % STEP), F.get(blocks, F.floor(i / STEP).cast("int")), best)


def _plus(a: Column, x: Column) -> Column:
    return a + x


def _larger(a: Column, x: Column) -> Column:
    return F.greatest(a, x)


def _placed(df: DataFrame, names: list[str]) -> DataFrame:
    """Each column of matches as structs of start, end (code points), match and what stands before it (REACH characters at most)."""
    sizes = lambda c: F.transform(F.col(c)["hit"], lambda m, i: F.length(m) + F.length(F.get(F.col(c)["gap"], i)))
    df = df.withColumns({f"{c}w": sizes(c) for c in names})
    df = df.withColumns({f"{c}u": _blocks(F.col(f"{c}w"), _plus, 0) for c in names})

    def one(c: str) -> Column:
        w, upto, gap = F.col(f"{c}w"), F.col(f"{c}u"), F.col(c)["gap"]
        start = lambda i: _before(w, upto, i, _plus) + F.length(F.get(gap, i))
        rows = F.transform(F.col(c)["hit"], lambda m, i: F.struct(start(i).alias("start"), (start(i) + F.length(m)).alias("end"), m.alias("match"), F.right(F.get(gap, i), F.lit(REACH)).alias("before")))
        return F.when(F.size(upto) > 0, rows)  # upto is read twice

    return df.withColumns({c: one(c) for c in names}).drop(*[f"{c}{x}" for c in names for x in "wu"])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether the digits of m, doubled at every other place from the right, sum to a multiple of ten."""
    d = F.split(F.reverse(_digits(m)), "")
    worth = lambda c, i: F.when(i % 2 == 0, c.cast("int")).when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))
    return F.aggregate(F.transform(F.filter(d, lambda c: c != ""), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("double") <= 255, F.lit(False)))
    if kind == "card":
        return n.between(16, 19) & luhn(m)
    if kind == "phone":
        return n.between(8, 15)
    return F.lit(True)


def _votes(kind: str, base: bool, m: Column, before: Column) -> list[Column]:
    """Votes of the regex, gazetteer and context labelers."""
    form = F.lit(1) if base else F.lit(-1)
    if kind == "email":
        form = F.when(m.rlike(r"^[A-Za-z0-9].*[A-Za-z]$"), 1).otherwise(0) if base else F.lit(-1)
        known = F.when(F.lower(m).rlike(rf"(?:\.|dot[\])]) ?(?:{ENDINGS})$"), 1).otherwise(0)
    elif kind == "ip":
        known = F.when(m.rlike(r"^(?:0|127|255)\."), 0).when(m.rlike(r"^(?:[0-9]\.){3}[0-9]$"), 0).otherwise(1)
    elif kind == "card":
        form = F.lit(1) if base else F.when(luhn(m), 1).otherwise(0)
        known = F.when(m.rlike("^[3-6]"), 1).otherwise(0)
    elif kind == "phone":
        area = F.substring(F.regexp_replace(_digits(m), "^1(?=[0-9]{10}$)", ""), 1, 3)
        known = F.when(F.length(_digits(m)).between(10, 11), F.when(area.rlike("^[2-9][0-9][0-9]$"), 1).otherwise(0)).otherwise(-1)
    else:
        form = F.when(m.rlike("[0-9]") & m.rlike("[A-Za-z]"), 1).otherwise(0)
        known = F.when(m.rlike("^(?:AKIA|ASIA|gh[pousr]_|sk_|pk_|xox|AIza)") | m.rlike("^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"), 1).otherwise(-1)
    near = F.when(F.lower(before).rlike(CONTEXT[kind]), 1).otherwise(-1 if base else 0)
    return [form, known, near]


def _features(m: Column, before: Column) -> list[Column]:
    """Length, share of digits and what stands before, in a few steps each."""
    n, d = F.length(m), F.length(_digits(m))
    return [F.when(n < 8, 0).when(n < 16, 1).when(n < 32, 2).otherwise(3), F.when(d == 0, 0).when(2 * d < n, 1).otherwise(2), F.when(before.rlike(r"(?:^|\s)$"), 0).when(before.rlike(r"[\p{L}\p{N}]$"), 1).otherwise(2)]


def candidates(docs: DataFrame) -> DataFrame:
    """docs with `cands`: for each kind, in order, structs of kind, base, start, end, the three votes and the features."""
    df = docs.withColumn("_t", F.coalesce(F.col("text").cast("string"), F.lit("")))
    t = F.col("_t")
    gates = {"email": F.contains(t, F.lit("@")), "ip": t.rlike(r"[0-9]\.[0-9]"), "card": t.rlike(r"(?:[0-9][\x20-]?){16}"), "phone": F.contains(t, F.lit("+"))}
    weak_gates = {
        "email": F.contains(t, F.lit("at)")) | F.contains(t, F.lit("at]")), "ip": t.rlike(r"[0-9][\[(](?:\.|dot)[\])][0-9]|(?:[0-9A-Fa-f]{1,4}:){7}"), "card": t.rlike("[0-9]{4}[./_][0-9]{4}[./_]"),
        "phone": t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}"), "secret": t.rlike(rf"(?i)(?:{_NAMES})[\"']?\x20?[:=]|(?<![A-Za-z0-9+/_-])(?=[A-Za-z+_]*+[0-9])(?=[0-9+_]*+[A-Za-z])[A-Za-z0-9+_]{{20}}"),
    }
    names = {f"_b{k}": (k, True) for k in BASE_KINDS} | {f"_w{k}": (k, False) for k in KINDS}
    df = df.withColumns({c: _matches(t, (BASE if base else WEAK)[k], (gates if base else weak_gates)[k]) for c, (k, base) in names.items()})
    df = _placed(df, list(names))

    def built(kind: str, base: bool) -> Column:
        def one(x):
            v, f = _votes(kind, base, x["match"], x["before"]), _features(x["match"], x["before"])
            return F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), x["start"].alias("start"), x["end"].alias("end"), *[c.cast("int").alias(f"v{i}") for i, c in enumerate(v)], *[c.cast("int").alias(f"f{i}") for i, c in enumerate(f)])

        col = F.col(f"_{'b' if base else 'w'}{kind}")
        return F.transform(F.filter(col, lambda x: valid(kind, x["match"])) if base else col, one)

    return df.withColumn("cands", F.concat(*[built(k, base) for k, base in names.values()])).drop("_t", *names)


KEY = ("kind", "base", "v0", "v1", "v2", "f0", "f1", "f2")


def fit(cands: DataFrame) -> dict[tuple, float]:
    """The probability that the classifier gives each combination of kind, form, votes and features."""
    seen = cands.select(F.explode("cands").alias("c")).groupBy(*[f"c.{x}" for x in KEY]).count().collect()  # at most 9,720 rows
    rows = sorted(((r[0], r[1], tuple(r[2:5]), tuple(r[5:8])), r["count"]) for r in seen)
    if not rows:
        return {}
    # expectation-maximisation; the start says that labelers are right more often than not
    prior, table = 0.5, {(j, v, y): (0.7 if v == y else 0.2 if v == -1 else 0.1) for j in range(3) for v in (-1, 0, 1) for y in (0, 1)}
    post: list[float] = []
    for _ in range(ROUNDS):
        post = []
        for (_k, _b, votes, _f), _n in rows:
            p = [(prior if y else 1 - prior) * math.prod(table[j, v, y] for j, v in enumerate(votes)) for y in (0, 1)]
            post.append(p[1] / (p[0] + p[1]))
        total = sum(n for _, n in rows)
        prior = min(0.99, max(0.01, sum(q * n for q, (_, n) in zip(post, rows)) / total))
        for j in range(3):
            for y in (0, 1):
                mass = {v: 1.0 + 9 * (v == y) for v in (-1, 0, 1)}  # pseudo-counts hold the meaning of the classes
                for q, ((_k, _b, votes, _f), n) in zip(post, rows):
                    mass[votes[j]] += n * (q if y else 1 - q)
                for v in mass:
                    table[j, v, y] = mass[v] / sum(mass.values())
    features = [[1.0, float(b), *[float(k == x) for x in KINDS], *[float(v == x) for v in votes for x in (0, 1)], *[float(x == v) for v, n in zip(f, (4, 3, 3)) for x in range(1, n)]] for (k, b, votes, f), _ in rows]
    w = [0.0] * len(features[0])
    score = lambda x: 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
    for _ in range(400):
        grad = [0.002 * a for a in w]
        for x, q, (_, n) in zip(features, post, rows):
            d = (score(x) - q) * n / total
            for i, a in enumerate(x):
                grad[i] += d * a
        w = [a - 1.0 * g for a, g in zip(w, grad)]
    return {(k, b, *v, *f): score(x) for x, ((k, b, v, f), _) in zip(features, rows)}


def _overlaps(spans_: Column, x: Column) -> Column:
    """Whether x overlaps one of the spans, which are in order and apart: the last that starts before x ends, found by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(30, -1, -1)])
    at = lambda i: F.get(spans_, i)
    last = F.aggregate(steps, F.lit(-1), lambda p, k: F.when((F.size(spans_) - p > k) & F.coalesce(at(p + k)["start"] < x["end"], F.lit(False)), p + k).otherwise(p))
    return (F.size(spans_) > 0) & F.coalesce(at(last)["end"] > x["start"], F.lit(False))


def spans(cands: DataFrame, model: dict[tuple, float]) -> DataFrame:
    """cands with `base` and `spans`: arrays of kind, start and end, by kind as listed and start."""
    good = [":".join(map(str, (k, *rest))) for (k, base, *rest), p in sorted(model.items()) if not base and p > CUT]
    c = F.col("cands")
    name = lambda x: F.concat_ws(":", x["kind"], *[x[v] for v in KEY[2:]])
    rank = lambda k: F.array_position(F.array(*[F.lit(x) for x in KINDS]), k)
    slim = lambda x: F.struct(rank(x["kind"]).alias("rank"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
    df = cands.withColumn("base", F.transform(F.filter(c, lambda x: x["base"]), slim))
    if not good:
        return df.withColumn("spans", F.col("base"))
    df = df.withColumn("_add", F.filter(c, lambda x: ~x["base"] & name(x).isin(good)))
    of = lambda k: F.when(F.size("_add") > 0, F.filter("base", lambda y: y["kind"] == k))
    df = df.withColumns({f"_of_{k}": of(k) for k in BASE_KINDS})
    free = F.filter("_add", lambda x: ~(_overlaps(F.col("_of_email"), x) | _overlaps(F.col("_of_ip"), x) | _overlaps(F.col("_of_card"), x) | _overlaps(F.col("_of_phone"), x)))
    every = F.when(F.size("_add") > 0, F.array_sort(F.concat("base", F.transform(free, slim)))).otherwise(F.col("base"))
    return df.withColumn("spans", every).drop("_add", *[f"_of_{k}" for k in BASE_KINDS])


def listed(column: Column) -> Column:
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    count = {f"n_{k}": number(k) for k in BASE_KINDS}
    return found.select("doc_id", *[v.alias(n) for n, v in count.items()], F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def redact(found: DataFrame) -> DataFrame:
    """Replaces what spans cover in `text` by a kind in angle brackets; spans that overlap give one, of the kind of the first."""
    df = found.withColumn("_s", F.array_sort(F.transform("spans", lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("minus"), x["end"].alias("end"), x["kind"].alias("kind")))))
    df = df.withColumn("_e", F.transform("_s", lambda x: x["end"].cast("int")))
    df = df.withColumn("_u", _blocks(F.col("_e"), _larger, 0)).withColumn("_c", F.when(F.size("_s") > 0, F.split(F.coalesce("text", F.lit("")), "")))
    e, u = F.col("_e"), F.col("_u")
    runs = F.transform("_s", lambda x, i: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), _before(e, u, i, _larger).alias("after")))
    df = df.withColumn("_r", F.when(F.size(u) > 0, F.filter(runs, lambda x: x["after"] <= x["start"])))
    part = lambda a, n: F.array_join(F.slice("_c", a + 1, n), "")
    new = F.concat(F.array_join(F.transform("_r", lambda x: F.concat(part(x["after"], x["start"] - x["after"]), F.lit("<"), F.upper(x["kind"]), F.lit(">"))), ""), part(F.array_max(e), F.size("_c")))
    return df.withColumn("text", F.when(F.size("_s") > 0, new).otherwise(F.col("text"))).drop("_s", "_e", "_u", "_c", "_r")
