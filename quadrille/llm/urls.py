"""URL filters by redirect equivalence.

A page's meta refresh and its canonical link are edges between addresses (without fragment, host in lower case).
Distributed connected components over them are the alias classes. A page under a rule gets the rule's verdict.
Any other page takes its class's: allow if an address of the class has an explicit allow rule, else block if one
has a block rule, else allow.

Defined cases: a null url has empty host and path, no rule and is allowed; null html has no edge; repeated rows
and ids are judged each by itself; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components

#: Verdict, host and path of each rule.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = "://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(h: Column, p: Column, rules=RULES) -> Column:
    """The longest fitting rule as a struct of rule and verdict, or null; the list of rules is a constant of the plan."""
    out = None
    for verdict, rh, rp in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        value = F.struct(F.lit(rh + rp).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out


def address(url: Column) -> Column:
    """The url without fragment, host in lower case."""
    bare = F.regexp_replace(url, "#.*$", "")
    lead = F.regexp_extract(bare, "^(.*?://)", 1)
    return F.when(lead != "", F.concat(lead, host(bare), F.regexp_replace(bare, "^.*?://[^/?]*", ""))).otherwise(bare)


def _absolute(base: Column, ref: Column) -> Column:
    ref = F.trim(F.replace(ref, F.lit("&amp;"), F.lit("&")))
    scheme, origin = F.regexp_extract(base, "^([^:]*:)", 1), F.regexp_extract(base, "^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(base, r"[?#].*$", ""), "^(.*?://.*/)", 1)
    return (F.when(ref.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), ref).when(ref.startswith("//"), F.concat(scheme, ref)).when(ref.startswith("/"), F.concat(origin, ref))
            .when((ref == "") | ref.startswith("#"), base).otherwise(F.concat(F.when(folder == "", F.concat(origin, F.lit("/"))).otherwise(folder), ref)))


def edges(pages: DataFrame) -> DataFrame:
    """a, b: addresses that a redirect or a canonical link ties."""
    html, quote = F.coalesce("html", F.lit("")), "[\"']?"
    link = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<link\b[^>]*>)")), lambda t: t.rlike(rf"(?i)\brel\s*=\s*{quote}canonical\b"))
    href = F.transform(link, lambda t: F.regexp_extract(t, rf"(?i)\bhref\s*=\s*{quote}([^\"'\s>]+)", 1))
    meta = F.filter(F.regexp_extract_all(html, F.lit(r"(?is)(<meta\b[^>]*>)")), lambda t: t.rlike(rf"(?i)\bhttp-equiv\s*=\s*{quote}refresh\b"))
    goes = F.transform(meta, lambda t: F.regexp_extract(t, r"(?i)\burl\s*=\s*['\"]?([^\"'>\s]+)", 1))
    found = pages.where(F.col("url").isNotNull() & html.rlike("(?i)canonical|refresh"))
    found = found.select("url", F.explode(F.filter(F.concat(href, goes), lambda x: x != "")).alias("to"))
    return found.select(address(F.col("url")).alias("a"), address(_absolute(F.col("url"), F.col("to"))).alias("b")).where("a <> b").distinct()


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    pages = pages.select("page_id", "url", "html")
    known = components(edges(pages))
    n = F.col("node")
    ruled = known.withColumn("r", rule_of(host(n), path(n), rules)["verdict"])
    verdicts = ruled.groupBy("component").agg(F.max((F.col("r") == "allow").cast("int")).alias("ok"), F.max((F.col("r") == "block").cast("int")).alias("bad"))
    blocked = verdicts.where("coalesce(ok, 0) = 0 and bad = 1").select("component")
    aliases = known.join(blocked, "component").select(F.col("node").alias("_address"), F.lit(True).alias("_blocked"))
    url = F.col("url")
    out = pages.select("page_id", host(url).alias("host"), path(url).alias("path"), address(url).alias("_address"))
    out = out.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).join(aliases, "_address", "left")
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_blocked"), "block"), F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
