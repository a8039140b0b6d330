"""Quality classifier: a sparse ensemble of rules over statistics of a text.

Shallow trees propose rules: each path from the root to a node is a conjunction of comparisons. A logistic regression with a
lasso penalty weighs them, most with zero. What is left is compiled into one column expression, so scoring is a projection.

The trees and weights are fitted by Spark on all labelled rows given. Null texts count as empty, whose statistics are all zero. Rows
without a label, or with a null one, are not learned from; with no labelled rows every score is 0.5, and with a single class it
is the share of the class, one row of either class added.
"""

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

TREES, DEPTH, BINS, PENALTY, SEED = 20, 3, 64, 0.0005, 42


def statistics(text: Column) -> dict[str, Column]:
    """The statistics that rules compare, by name."""
    t = F.coalesce(text, F.lit(""))
    n = F.greatest(F.length(t), F.lit(1))
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    n_words = F.greatest(F.size(words), F.lit(1))
    lines = F.split(t, "\n")

    def share(pattern: str, of: Column) -> Column:
        return F.regexp_count(t, F.lit(pattern)) / of

    return {
        "chars_log": F.log1p(F.length(t)),
        "words_log": F.log1p(F.size(words)),
        "word_length": F.length(F.array_join(words, "")) / n_words,
        "upper": share(r"\p{Lu}", n),
        "digits": share(r"\p{N}", n),
        "signs": share(r"[^\p{L}\p{N}\s]", n),
        "stops": share(r"[.,;:]", n_words),
        "marks": share(r"[#$%&*]", n_words),
        "shouts": share(r"!", n_words),
        "bars": share(r"[|<>{}\\]", n_words),
        "distinct_words": F.size(F.array_distinct(words)) / n_words,
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "line_words": F.size(words) / F.greatest(F.size(lines), F.lit(1)),
        "short_words": F.size(F.filter(words, lambda w: F.length(w) <= 2)) / n_words,
        "long_words": F.size(F.filter(words, lambda w: F.length(w) >= 15)) / n_words,
    }


#: Names of the statistics, in the order of the trees' features.
NAMES = (
    "chars_log", "words_log", "word_length", "upper", "digits", "signs", "stops", "marks", "shouts", "bars",
    "distinct_words", "distinct_lines", "line_words", "short_words", "long_words",
)


@dataclass(frozen=True)
class Rule:
    """Comparisons (statistic, whether at most, bound) that must all hold, and what the rule adds to the logit."""

    comparisons: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def holds(self, values: dict[str, Column]) -> Column:
        parts = [values[name] <= F.lit(bound) if at_most else values[name] > F.lit(bound) for name, at_most, bound in self.comparisons]
        out = parts[0]
        for part in parts[1:]:
            out = out & part
        return out


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    intercept: float

    def score(self, values: dict[str, Column]) -> Column:
        """Probability of label 1 as an expression over the statistics."""
        logit = F.lit(float(self.intercept))
        for rule in self.rules:
            logit = logit + F.when(rule.holds(values), F.lit(rule.weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-logit))


def paths(tree_text: str, names: tuple[str, ...]) -> list[Rule]:
    """Every path of the trees that Spark prints, as a rule; simplified, without repeats, in a fixed order."""
    found, path = {}, []
    for line in tree_text.splitlines():
        if "Tree" in line and "(weight" in line:
            path = []
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not m:
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, names[int(m[2])], m[3] == "<=", float(m[4]))]
        tightest: dict[tuple[str, bool], float] = {}
        for _, name, at_most, bound in path:
            have = tightest.get((name, at_most))
            tightest[name, at_most] = bound if have is None else min(have, bound) if at_most else max(have, bound)
        found[tuple(sorted((name, at_most, bound) for (name, at_most), bound in tightest.items()))] = None
    return [Rule(c) for c in sorted(found)]


def _constant(counts: dict[float, int]) -> Ensemble:
    share = (counts.get(1.0, 0) + 1) / (sum(counts.values()) + 2)
    return Ensemble((), math.log(share / (1 - share)))


def fit(rows: DataFrame, label: str) -> Ensemble:
    """Fit on ``rows``, which have the statistics under their names and ``label`` (0 or 1)."""
    rows = rows.select(*NAMES, F.col(label).cast("double").alias("label")).filter("label in (0, 1)")
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(counts) < 2:
        return _constant(counts)
    vectors = VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, maxBins=BINS, bootstrap=False, featureSubsetStrategy="sqrt", seed=SEED, minInstancesPerNode=5
    ).fit(vectors)
    rules = paths(forest.toDebugString, NAMES)
    if not rules:
        return _constant(counts)
    values = {name: F.col(name) for name in NAMES}
    held = F.array(*[rule.holds(values).cast("double") for rule in rules])
    model = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=60, standardization=False).fit(
        rows.select(array_to_vector(held).alias("features"), "label")
    )
    weighed = [Rule(rule.comparisons, float(w)) for rule, w in zip(rules, model.coefficients.toArray()) if w]
    return Ensemble(tuple(weighed), float(model.intercept))
