"""Near copies by b-bit MinHash, against all pairs of sets in plain Python."""

import random

import duckdb
import numpy as np

from playlake.llm import bbit_minhash as bm
from playlake.llm.queries import QUERIES
from tests.conftest import SMALL

SCHEMA = "doc_id long, text string"


def shingles(text):
    tokens = (text or "").encode().lower().split()
    return {tuple(tokens[i : i + 4]) for i in range(max(1, len(tokens) - 3))} if tokens else set()


def expected(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        ids = [x for x in (least.get(r), doc) if x is not None]
        least[r] = min(ids) if ids else None
    out = []
    for i, (doc, _) in enumerate(rows):
        component = least[find(i)] if sets[i] else doc
        out.append((doc, len(sets[i]), component, doc is not None and doc == component))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_documents(spark):
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    df = QUERIES["op13_bbit_minhash"](spark, SMALL)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert got(df) == expected(rows)


def changed(dice, words, share):
    return [dice.choice(VOCABULARY) if dice.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(500)]


def groups(seed):
    """Groups of near copies around the least similarity, a passage many share, short texts, nulls and repeated rows."""
    dice = random.Random(seed)
    texts = []
    passage = [dice.choice(VOCABULARY) for _ in range(120)]
    for _ in range(6):
        base = [dice.choice(VOCABULARY) for _ in range(dice.randint(5, 200))]
        texts += [" ".join(changed(dice, base, dice.choice([0.005, 0.02, 0.03, 0.04, 0.06]))) for _ in range(25)]
    texts += [" ".join(passage + [dice.choice(VOCABULARY) for _ in range(dice.randint(5, 90))]) for _ in range(40)]
    texts += ["one two", "ONE\ttwo", "one", "", None, " \n", "É é", "é é", "one two three four", "one two three four five"]
    texts += texts[:20]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(None, texts[0]), (None, "alone and without an id"), (3, texts[40]), (3, texts[40])]
    dice.shuffle(rows)
    return rows


def test_groups_in_blocks(spark):
    rows = groups(3)
    df = spark.createDataFrame(rows, SCHEMA)
    want = expected(rows)
    assert got(bm.near_copies(df, "doc_id", "text")) == want
    assert got(bm.near_copies(df, "doc_id", "text", block=7, stars=1)) == want
    assert got(bm.near_copies(df, "doc_id", "text", block=16, stars=0)) == want


def test_estimates_are_corrected_for_chance(spark):
    dice = np.random.default_rng(2)
    rows = []
    for share in (0.0, 0.3, 0.6, 0.8, 0.95):
        for _ in range(40):
            common = dice.integers(1 << 62, size=int(800 * share), dtype=np.uint64)
            sides = [np.unique(np.append(common, dice.integers(1 << 62, size=(800 - len(common)) // 2, dtype=np.uint64))) for _ in range(2)]
            planes = [bm.signature(bm._mixed(s))[1].tolist() for s in sides]
            rows.append((share, *planes))
    df = spark.createDataFrame(rows, "share double, a array<long>, b array<long>")
    means = df.select("share", bm.similarity(bm._agreeing("a", "b")).alias("estimate")).groupBy("share").avg("estimate")
    for share, mean in means.collect():
        assert abs(mean - share) < 0.03
    assert bm.least_agreement(80) < 256 * 0.8125 - 5 * 6  # far below what a linked pair has on average


def test_empty_table_and_clashing_names(spark):
    assert bm.near_copies(spark.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0
    clash = spark.createDataFrame([("a", "x y z", 1, 2, 3), ("b", "x  y z", 1, 2, 3)], "c string, root string, size int, bucket int, h1 int")
    assert got(bm.near_copies(clash, "c", "root")) == [("a", 1, "a", True), ("b", 1, "a", False)]
    long = " ".join(f"w{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, long), (2, long + " end")], SCHEMA)
    assert {r["component_id"] for r in bm.near_copies(df, "doc_id", "text").collect()} == {1}
