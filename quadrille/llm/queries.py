"""The queries of this subpackage, by name, and the SQL that states the same where SQL can."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attention, bpe, debruijn, hardneg, multiindex, neardup, phrases, pii, quality, suffixes, templates, urls, warc
from .common import remove, stage, table, work_dir


def op6_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op1_pii_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    cands = stage(pii.candidates(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text"))
    return pii.digest(pii.spans(cands, pii.fit(cands)))


def tokenizer() -> tuple[str, str]:
    """Path of the ranks and the pattern of the pieces."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op10_bpe_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), *tokenizer())


def op3_url_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op5_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{work_dir(spark)}/warc-{uuid.uuid4().hex}"
    archives = warc.normalise(warc.write(warc.decide(table(spark, sf_dir, "pages")), f"{folder}/raw"), folder)
    remove(spark, f"{folder}/raw")
    return warc.read(archives, payloads=False).drop("url", "payload")


def op8_minhash_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_debruijn_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return debruijn.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_suffix_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_attention_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention.scored(table(spark, sf_dir, "documents").select("doc_id", "text"), *tokenizer())


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_summa_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    vectors = table(spark, sf_dir, "embeddings").where(hardneg.finite("embedding")).select("vec_id", label, hardneg.quantised("embedding").alias("q"))
    return hardneg.mine(vectors, F.col("vec_id") % 100 == 0)


def op12_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_suffix_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii_weak_supervision": op1_pii_weak_supervision,
    "op2_debruijn_substring": op2_debruijn_substring,
    "op3_url_equivalence": op3_url_equivalence,
    "op4_template_decontamination": op4_template_decontamination,
    "op5_warc_normaliser": op5_warc_normaliser,
    "op6_quality_llr": op6_quality_llr,
    "op7_suffix_grouping": op7_suffix_grouping,
    "op8_minhash_hamming": op8_minhash_hamming,
    "op9_attention_scoring": op9_attention_scoring,
    "op10_bpe_merge_replay": op10_bpe_merge_replay,
    "op11_summa_negatives": op11_summa_negatives,
    "op12_multi_index_hashing": op12_multi_index_hashing,
    "op13_suffix_automata": op13_suffix_automata,
}

def _address(url: str) -> str:
    """urls.address as SQL."""
    bare = f"regexp_replace({url}, '#.*$', '')"
    host = f"translate(regexp_extract({bare}, '://([^/?#]*)', 1), '{urls._UPPER}', '{urls._LOWER}')"
    return f"case when {bare} like '%://%' then regexp_extract({bare}, '^(.*?://)', 1) || {host} || regexp_replace({bare}, '^.*?://[^/?]*', '') else {bare} end"


_QUOTE = """["'']?"""
_RULES = "rules(verdict, h, p) as (values " + ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES) + ")"

#: The closure over redirects and canonical links is stated by a recursive union.
ORACLE_SQL: dict[str, str] = {
    "op3_url_equivalence": f"""
        with recursive {_RULES},
        parts as (
            select page_id, url, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), '{urls._UPPER}', '{urls._LOWER}') as host,
                   regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) as path
            from pages),
        tags as (
            select url, unnest(list_concat(
                list_transform(list_filter(regexp_extract_all(html, '(?is)<link\\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\\brel\\s*=\\s*{_QUOTE}canonical\\b')),
                    lambda t: regexp_extract(t, '(?i)\\bhref\\s*=\\s*{_QUOTE}([^"''\\s>]+)', 1)),
                list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\\bhttp-equiv\\s*=\\s*{_QUOTE}refresh\\b')),
                    lambda t: regexp_extract(t, '(?i)\\burl\\s*=\\s*{_QUOTE}([^"''>\\s]+)', 1)))) as found
            from pages where url is not null and html is not null),
        refs as (
            select url, trim(replace(found, '&amp;', '&'), ' ') as ref, regexp_extract(url, '^([^:]*:)', 1) as scheme, regexp_extract(url, '^(.*?://[^/?#]*)', 1) as origin,
                   regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(.*?://.*/)', 1) as folder
            from tags where found <> ''),
        goes as (
            select url, case when regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*://') then ref when starts_with(ref, '//') then scheme || ref when starts_with(ref, '/') then origin || ref
                   when ref = '' or starts_with(ref, '#') then url else (case when folder = '' then origin || '/' else folder end) || ref end as goal
            from refs),
        edges as (select distinct {_address("url")} as a, {_address("goal")} as b from goes),
        both_ways as (select a, b from edges where a <> b union select b, a from edges where a <> b),
        reach(a, b) as (select a, a from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
        known as (
            select b, translate(regexp_extract(b, '://([^/?#]*)([^?#]*)', 1), '{urls._UPPER}', '{urls._LOWER}') as host, regexp_extract(b, '://([^/?#]*)([^?#]*)', 2) as path
            from (select distinct b from reach)),
        ruled as (select b, arg_max(verdict, length(h || p)) as verdict from known join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by b),
        classes as (
            select r.a as address, case when bool_or(coalesce(verdict = 'allow', false)) then 'allow' when bool_or(coalesce(verdict = 'block', false)) then 'block' end as verdict
            from reach r left join ruled x on x.b = r.b group by r.a),
        fits as (
            select page_id, url, arg_max(h || p, length(h || p)) as rule, arg_max(verdict, length(h || p)) as verdict
            from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by page_id, url)
        select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, c.verdict, 'allow') as verdict
        from parts p left join fits f on p.page_id is not distinct from f.page_id and p.url is not distinct from f.url left join classes c on c.address = {_address("p.url")}""",
    "op5_warc_normaliser": """
        with p as (
            select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
        f as (select *, min(page_id) over (partition by payload_digest) as first from p)
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 100 and first <> page_id then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 100 and first <> page_id then first end as refers_to
        from f""",
    "op11_summa_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
            from embeddings
            where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
        s as (
            select a.vec_id as anchor, b.vec_id as id, a.label = b.label as same,
                   cast(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) as bigint) as score
            from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
        p as (select anchor, id, score from s where same qualify row_number() over (partition by anchor order by score desc, id) <= 5)
        select p.anchor as anchor_id, p.id as positive_id, cast(row_number() over (partition by p.anchor, p.id order by s.score desc, s.id) as int) as rank,
               s.id as negative_id, p.score as positive_score, s.score as negative_score
        from p join s on s.anchor = p.anchor and not s.same and 80 * p.score <= 100 * s.score and 100 * s.score <= 100 * p.score
        qualify row_number() over (partition by p.anchor, p.id order by s.score desc, s.id) <= 5""",
    "op13_suffix_automata": f"""
        with d as (select coalesce(lang, 'und') as lang, translate(text, '{urls._UPPER}', '{urls._LOWER}') as t from documents where text is not null),
        pieces as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) as piece from d),
        w as (select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') as ws from pieces),
        g as (
            select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) as phrase
            from w, (values (1), (2), (3), (4), (5)) sizes(k) where len(ws) >= k),
        f as (select lang, k, phrase, count(*) as f from g group by lang, k, phrase),
        totals as (select lang, sum(f) as n from f where k = 1 group by lang),
        c as (select *, string_split(phrase, ' ') as ws from f where k >= 2 and f >= 100),
        whole as (
            select * from c where not exists (
                select 1 from c y where y.lang = c.lang and y.k > c.k and y.f >= c.f and contains(' ' || y.phrase || ' ', ' ' || c.phrase || ' '))),
        parts as (select lang, phrase, f as a, unnest(range(1, k)) as cut, ws from whole),
        scored as (
            select p.lang, p.phrase, p.a, p.cut, x.f as l, y.f as r, t.n, cast((cast(1000 as hugeint) * p.a * t.n) // (cast(x.f as hugeint) * y.f) as bigint) as score
            from parts p join f x on x.lang = p.lang and x.phrase = array_to_string(p.ws[1 : p.cut], ' ')
            join f y on y.lang = p.lang and y.phrase = array_to_string(p.ws[p.cut + 1 :], ' ') join totals t on t.lang = p.lang),
        best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1)
        select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, cast(n as bigint) as n, score
        from best qualify row_number() over (partition by lang order by score desc, a desc, phrase) <= 2000""",
}
