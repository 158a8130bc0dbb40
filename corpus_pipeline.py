"""The corpus pipeline: each stage reads what the one before kept, as documents, and writes what it keeps.

The last stage returns the encoded documents: their columns, the number of ids and the digests of ids and of
the decoded bytes. A null or extra column goes through unchanged, but for `n_chars`, which follows
a redacted text, and for a column named like one that the last stage makes, which gives way to it.

Defined cases: a null text is an empty one, and both fail the quality rules (under 50 words), so neither is in the result; a null id stays, after all others
in the choice among near copies; of rows that repeat one stays; ties among copies go to the least id, then to any one row; texts are whole in every
stage, however long; an empty table gives an empty result. Tables that stages write on their way lie in the application's folder below
spark.checkpoint.dir; `quadrille.llm.common.sweep` deletes it once the result has been written elsewhere.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm import bpe, neardup, pii, quality, queries, templates
from quadrille.llm.common import stage, table, whole_row, work_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    model = quality.weights(quality.with_words(docs), table(spark, sf_dir, "labels"))
    return quality.kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (similarity 0.8 or more) the row with the least id stays (null last); texts without words all stay.

    Every row is a node of its own, whatever its id; rows that repeat are copies like any other.
    """
    rows = stage(docs.select(whole_row(docs), F.monotonically_increasing_id().alias("_n")))
    nodes = neardup.dedup(rows.select(F.col("_n").alias("doc_id"), F.col("_row.text").alias("text")), **neardup.AT_80)
    first = F.struct(F.col("_row.doc_id").isNull().alias("last"), F.col("_row.doc_id").alias("id"), F.col("_n").alias("n"))
    named = nodes.select(F.col("doc_id").alias("_n"), F.col("component_id").alias("_c"))
    kept = rows.select("_n", first.alias("_f")).join(named, "_n").groupBy("_c").agg(F.min("_f").alias("_f")).select(F.col("_f.n").alias("_n"))
    return rows.join(kept, "_n", "left_semi").select("_row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in angle brackets."""
    cands = stage(pii.candidates(docs.select(whole_row(docs.drop("text")), "text")))  # found once: the model is fitted on them, then judges them
    found = pii.redact(pii.spans(cands, pii.fit(cands)))
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return found.select(*[columns[c].alias(c) for c in docs.columns])


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, as digests."""
    own = {"doc_id", "text", "n_tokens", "ids_sha256", "decoded_sha256"}
    return bpe.digest(docs, *queries.tokenizer(), extra=tuple(c for c in docs.columns if c not in own))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", personal_data),
    ("bpe", encoding),
]

#: Hashing, EM, MinHash and BPE have no SQL form; tests/llm compares the near-duplicate stage with brute force, run() with its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{work_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, function) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
