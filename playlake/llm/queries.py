"""The dealt operators on their whole tables, with production parameters."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from playlake.llm import (
    bbit_minhash,
    bpe,
    graph_ann,
    latent_decon,
    oracles,
    page_diff,
    rule_ensemble,
    secrets,
    shuffle_shards,
    simhash,
    suffix_dedup,
    turn_repair,
    url_filter,
    zone_clusters,
)
from playlake.llm.common import table
from playlake.storage import materialize
from playlake.workload.registry import Query

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def register(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@register
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text decoded from them, as digests."""
    pairs = bpe.BytePairs(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = pairs.round_trip(docs, F.col("text"), "coded")
    return coded.select(
        "doc_id",
        bpe.n_ids(F.col("coded.ids")).alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )


@register
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every text: the base kinds and values that are hard to guess."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.with_spans(docs, F.col("text"), "found")
    base = F.filter("found", lambda s: s["kind"] != "guess")

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("found")).alias("spans"),
        F.transform(F.filter("found", lambda s: s["kind"] == "guess"), lambda s: s["cost"]).alias("guess_costs"),
    )


@register
def op10_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards whose row counts differ by one at most, in shuffled order."""
    docs = table(spark, sf_dir, "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    placed = shuffle_shards.shards(docs, 16, size=size)
    doc_id, text = F.col(f"row.c{docs.columns.index('doc_id')}"), F.col(f"row.c{docs.columns.index('text')}")
    return placed.select(
        doc_id.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@register
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every text and the component of its near copies."""
    return simhash.near_copies(table(spark, sf_dir, "documents"), "doc_id", "text", words=4, radius=4)


@register
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without byte strings of 400 that start anywhere else too, and if over 50 words in a row stand in another one."""
    kept = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), "doc_id", "text", 400, from_scan=True, n_words=51)
    has_repeats = (F.col("n_removed") > 0).alias("has_repeats")
    shares_passage = F.col("shares_words").cast("int").alias("shares_passage")
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), has_repeats, shares_passage)


@register
def op9_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th vector."""
    return graph_ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, from_scan=True)


#: Documents scored at least this much are predicted to have label 1.
KEEP_FROM = 0.3


def held_out(doc_id: str):
    """Rows that no label is learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def quality_rules(spark: SparkSession, features: DataFrame, sf_dir: str) -> rule_ensemble.Ensemble:
    """Rules for ``labels.quality``, learned from all labelled rows of ``features`` that are not held out."""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled"), "quality").filter("quality is not null")
    rows = features.filter(~held_out("doc_id")).join(labels, F.col("doc_id") == F.col("labelled"))
    return rule_ensemble.fit(rows, "quality")


def quality_features(docs: DataFrame) -> DataFrame:
    statistics = rule_ensemble.statistics(F.col("text"))
    return materialize(docs.select("doc_id", *[c.alias(name) for name, c in statistics.items()]), "statistics")


@register
def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every text."""
    features = quality_features(table(spark, sf_dir, "documents"))
    rules = quality_rules(spark, features, sf_dir)
    scored = features.select("doc_id", rules.score({name: F.col(name) for name in rule_ensemble.NAMES}).alias("score"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


@register
def op6_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and how much of it; documents without one have no row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    finder = latent_decon.Decontaminator(docs, F.col("text"), table(spark, sf_dir, "benchmark"))
    found = docs.select("doc_id", F.explode(finder.leaks(F.col("text"))).alias("leak"))
    return found.select("doc_id", "leak.item_id", "leak.cosine", "leak.share", "leak.answer_share")


# The rules of the URL filter.
URL_RULES = [
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


@register
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: by the longest rule that fits, else by the character models."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), "url", URL_RULES)
    return judged.select(F.col("row.c0").alias("page_id"), "host", "path", "rule", "verdict", "score")


@register
def op3_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    texts = page_diff.main_texts(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "url", "html", from_scan=True)
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@register
def op12_zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after three rounds of 16 centroids."""
    return zone_clusters.clusters(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", dims=64, k=16, rounds=3, scale=64, seed=1)


@register
def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation and its cheapest repair."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = turn_repair.damaged(turns, "conv_id", "turn", "role", "text")
    _, found = turn_repair.repaired(rows, "conv", "turn", "role", "text")
    every = turns.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].eqNullSafe(found["conv"]), "left")

    def number(name: str):
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    return joined.select(
        "conv_id",
        *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@register
def op13_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles of every text and the component of its near copies."""
    return bbit_minhash.near_copies(table(spark, sf_dir, "documents"), "doc_id", "text", words=4, percent=80, from_scan=True)
