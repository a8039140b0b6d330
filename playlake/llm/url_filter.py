"""URL filters: host and path rules, and where none fits a ratio of two character models.

Two variable-order Markov models give the chance of each character after the ones before it, one learned from URLs that the rules accept
and one from URLs they reject. Each order is smoothed towards the next shorter one by the number of different characters that
follow (Witten and Bell), down to a uniform chance. A URL's score is the difference of its log-likelihoods for each character.
The least score that is allowed is calibrated on a fifth of the hosts, whose URLs the models do not see: of all thresholds the one
with the best mean of both classes' hit rates, midway between the scores next to it.

A null URL, or one without ``://``, has an empty host and path. URLs that are alike are scored once. Rows with repeated or null ids are rows of their own. If the rules accept
or reject no URL, there is nothing to tell apart, and everything without a rule is allowed.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from playlake.operators.joins import skew_join
from playlake.storage import materialize

#: Characters of context at most, and the share of hosts that calibrate: one in so many.
ORDER, CALIBRATE = 4, 5
#: Characters that any context may be followed by, for the uniform chance.
ALPHABET = 256
#: Scores are counted in steps of this width, so that a bounded number of them reaches the driver.
STEP, WIDEST = 0.005, 6.0
_START, _END = "\u0002", "\u0003"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    rest = F.coalesce(F.when(F.contains(url, F.lit("://")), F.regexp_replace(url, r"(?s)^.*?://", "")), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does. Of equally long ones the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, F.lit(r.text)).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _positions(urls: DataFrame) -> DataFrame:
    """Every character of ``urls.s``, the end included, after its context of ``ORDER`` characters: (s, gram), the character last."""
    padded = F.concat(F.lit(_START * ORDER), "s", F.lit(_END))
    grams = F.transform(F.sequence(F.lit(1), F.length("s") + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))
    return urls.select("*", F.explode(grams).alias("gram"))


def _ratios(grams: DataFrame, learned: DataFrame) -> DataFrame:
    """(gram, ratio) for every gram of ``grams``: log chance of its last character if accepted, less that if rejected.

    ``learned`` has (gram, good, bad): how often the gram stands in accepted and rejected URLs.
    """
    keys = grams.select("gram").distinct()
    chance = {side: F.lit(1.0 / ALPHABET) for side in ("good", "bad")}
    chances = keys.select("gram", *[c.alias(f"p_{side}") for side, c in chance.items()])
    for order in range(ORDER + 1):
        # Grams of this order are the ends of the longest ones: their counts, and those of their contexts.
        tail = F.expr(f"right(gram, {order + 1})")
        counts = learned.groupBy(tail.alias("tail")).agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
        context = F.expr("left(tail, length(tail) - 1)")
        contexts = counts.groupBy(context.alias("of")).agg(
            *[F.sum(s).alias(f"n_{s}") for s in chance], *[F.count_if(F.col(s) > 0).alias(f"t_{s}") for s in chance]
        )
        with_tail = skew_join(chances.withColumn("k", tail), counts, {"k": "tail"}, "left").drop("k", "tail")
        ahead = F.expr(f"left(right(gram, {order + 1}), {order})")
        with_context = skew_join(with_tail.withColumn("k", ahead), contexts, {"k": "of"}, "left").drop("k", "of")

        def smoothed(side: str) -> Column:
            n, t, seen = (F.coalesce(F.col(c), F.lit(0)) for c in (f"n_{side}", f"t_{side}", side))
            return F.when(n + t > 0, (seen + t * F.col(f"p_{side}")) / (n + t)).otherwise(F.col(f"p_{side}"))

        chances = with_context.select("gram", *[smoothed(side).alias(f"p_{side}") for side in chance])
    return chances.select("gram", (F.log("p_good") - F.log("p_bad")).alias("ratio"))


def scores(urls: DataFrame) -> DataFrame:
    """(s, host, verdict, score) for distinct strings ``s`` with ``times``, ``host`` and the rules' ``verdict``; score is for each character."""
    places = _positions(urls)
    calibrating = F.pmod(F.xxhash64("host"), F.lit(CALIBRATE)) == 0
    learn = places.filter(F.col("verdict").isNotNull() & ~calibrating)
    learned = learn.groupBy("gram").agg(
        F.sum(F.when(F.col("verdict") == "allow", F.col("times")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("verdict") == "block", F.col("times")).otherwise(0)).alias("bad"),
    )
    learned = materialize(learned, "url-grams")
    ratios = materialize(_ratios(places, learned), "url-ratios").withColumnRenamed("gram", "g")
    summed = skew_join(places, ratios, {"gram": "g"}, "inner").groupBy("s").agg(
        F.avg("ratio").alias("score"), F.first("host").alias("host"), F.first("verdict").alias("verdict"), F.first("times").alias("times")
    )
    return summed


def calibrated(scored: DataFrame) -> float | None:
    """The least score that is allowed; null if either class is missing. The scores are counted in bounded steps."""
    for only_held in (True, False):
        held = F.pmod(F.xxhash64("host"), F.lit(CALIBRATE)) == 0 if only_held else F.lit(True)
        step = F.round(F.greatest(F.least("score", F.lit(WIDEST)), F.lit(-WIDEST)) / STEP).cast("int")
        rows = scored.filter(F.col("verdict").isNotNull() & held).groupBy(step.alias("step")).agg(
            F.sum(F.when(F.col("verdict") == "allow", F.col("times")).otherwise(0)).alias("good"),
            F.sum(F.when(F.col("verdict") == "block", F.col("times")).otherwise(0)).alias("bad"),
        )
        counts = sorted(tuple(r) for r in rows.collect())
        good, bad = sum(c[1] for c in counts), sum(c[2] for c in counts)
        if good and bad:
            break
    else:
        return None
    best, at, lost, caught = -1.0, 0.0, 0, 0
    for k, (value, g, b) in enumerate(counts):
        rate = (good - lost) / good + caught / bad
        if rate > best:
            best, at = rate, (value + (counts[k - 1][0] if k else value - 2)) / 2 * STEP
        lost, caught = lost + g, caught + b
    return at if caught / bad <= best else (counts[-1][0] + 1) * STEP


def judge(df: DataFrame, url: str, rules: list[Rule]) -> DataFrame:
    """``df`` as (row, host, path, rule, verdict, score): ``row`` is a struct of its columns c0, c1, ... in order."""
    row = F.struct(*[F.col("`" + c.replace("`", "``") + "`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    host, path = host_and_path(F.col("`" + url.replace("`", "``") + "`"))
    rows = df.select(row.alias("row"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("row", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    text = F.concat("host", "path")
    urls = rows.select(text.alias("s"), "host", F.col("by_rule").alias("verdict")).groupBy("s").agg(
        F.first("host").alias("host"), F.max("verdict").alias("verdict"), F.count(F.lit(1)).alias("times")
    )
    scored = materialize(scores(materialize(urls, "urls")), "url-scores")
    least = calibrated(scored)
    by_score = F.lit("allow") if least is None else F.when(F.col("score") >= least, F.lit("allow")).otherwise(F.lit("block"))
    joined = skew_join(rows.withColumn("k", text), scored.select(F.col("s").alias("of"), "score"), {"k": "of"}, "inner")
    return joined.select("row", "host", "path", "rule", F.coalesce("by_rule", by_score).alias("verdict"), "score")
