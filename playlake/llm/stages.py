"""The stages of the corpus pipeline. Each takes (spark, docs, sf_dir) and returns documents.

In all of them null texts count as empty, rows with null or repeated ids are documents of their own, an empty table stays empty, and further
columns of ``docs`` are carried along whatever their names.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake.llm import bpe, latent_decon, rule_ensemble, secrets, simhash
from playlake.llm.common import quoted, table, unused
from playlake.llm.queries import KEEP_FROM, quality_features, quality_rules
from playlake.storage import materialize


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents whose quality score is at least ``KEEP_FROM``. The rules are learned from labelled documents of ``docs``. All are measured twice:
    looking for the labelled ones first would shuffle whole texts, afterwards numbers only."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled")).distinct()
    labelled = quality_features(docs).join(labels, F.col("doc_id") == F.col("labelled"), "left_semi")
    rules = quality_rules(spark, materialize(labelled, "labelled"), sf_dir)
    names = {name: unused(docs, f"_{name}") for name in rule_ensemble.NAMES}
    statistics = rule_ensemble.statistics(F.col("text"))
    measured = docs.select("*", *[statistics[name].alias(column) for name, column in names.items()])
    return measured.filter(rules.score({name: F.col(column) for name, column in names.items()}) >= KEEP_FROM).select(*map(quoted, docs.columns))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.one_of_each(docs, "doc_id", "text", words=4, radius=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no item of the benchmark."""
    finder = latent_decon.Decontaminator(docs, F.col("text"), table(spark, sf_dir, "benchmark"))
    return docs.filter(F.size(finder.leaks(F.col("text"))) == 0).select(*map(quoted, docs.columns))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in every text are replaced by a mark; ``n_chars`` follows. No document goes. Null texts stay null."""
    found = unused(docs, "found")
    cut = secrets.with_redacted(docs, F.col("text"), found)
    spans, text = F.col(quoted(found))["spans"], F.col(quoted(found))["text"]
    n_chars = F.when(F.size(spans) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumns({"text": text, "n_chars": n_chars}).select(*map(quoted, docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its ids, packed, and their number. Ids that do not decode to the text stop the run."""
    pairs = bpe.BytePairs(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    ids, n, coded = (unused(docs, name) for name in ("ids", "n_tokens", "coded"))
    both = pairs.round_trip(docs, F.col("text"), coded)
    found, decoded = F.col(quoted(coded))["ids"], F.col(quoted(coded))["decoded"]
    same = decoded == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    checked = both.withColumn(ids, F.when(same, found).otherwise(F.raise_error(F.lit("ids do not decode to the text"))))
    return checked.withColumn(n, bpe.n_ids(F.col(quoted(ids)))).drop(coded)


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_each),
    ("benchmark", decontaminated),
    ("secrets", hide_secrets),
    ("byte_bpe", encode),
]
