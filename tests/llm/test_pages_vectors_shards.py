"""Pages, URLs, vectors, shards and the pipeline, against plain Python."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from playlake.llm import graph_ann, page_diff, shuffle_shards, url_filter
from playlake.llm.queries import QUERIES, URL_RULES
from tests.conftest import SMALL


def small(name):
    return duckdb.execute(f"SELECT * FROM '{SMALL}/{name}.parquet'").fetchall()


def host_path(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[n:]
    return "".join(c.lower() if c.isascii() else c for c in rest[:n]), path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]


def longest_rule(host, path):
    fit = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def test_urls(spark):
    urls = [r[1] for r in small("pages")] + [None, "", "no scheme", "http://", "ftp://A.COM", "http://X.Com/?q", "x://a.net/fr/é\nb#c", "http://example.com/en/", "http://example.com/en/"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    rows = {r["row"][0]: r for r in url_filter.judge(df, "url", URL_RULES).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        host, path = host_path(url)
        rule = longest_rule(host, path)
        assert (rows[i]["host"], rows[i]["path"]) == (host, path)
        assert rows[i]["rule"] == (rule.text if rule else None)
        assert rows[i]["verdict"] == rule.verdict if rule else rows[i]["verdict"] in ("allow", "block")
    assert url_filter.judge(df.limit(0), "url", URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filter.judge(df, "url", []).collect()} == {"allow"}


def test_character_models_against_a_loop(spark):
    """Chances of both models, smoothed in a plain loop, give the same scores."""
    urls = [(f"{h}{p}", h, v, t) for h, p, v, t in [("a.x", "/ab", "allow", 3), ("b.x", "/ba", "block", 1), ("c.x", "/abab", None, 2), ("d.x", "", "allow", 1), ("e.x", "/bb", "block", 2)]]
    df = spark.createDataFrame(urls, "s string, host string, verdict string, times long")
    held = {r["host"] for r in df.filter(F.pmod(F.xxhash64("host"), F.lit(url_filter.CALIBRATE)) == 0).collect()}
    got = {r["s"]: r["score"] for r in url_filter.scores(df).collect()}
    counts = {"allow": Counter(), "block": Counter()}
    for s, host, verdict, times in urls:
        padded = "\2" * url_filter.ORDER + s + "\3"
        for i in range(len(s) + 1):
            if verdict and host not in held:
                for k in range(url_filter.ORDER + 1):
                    counts[verdict][padded[i + url_filter.ORDER - k : i + url_filter.ORDER + 1]] += times

    def chance(side, gram):
        p = 1 / url_filter.ALPHABET
        for k in range(url_filter.ORDER + 1):
            tail = gram[len(gram) - k - 1 :]
            follow = {g: c for g, c in counts[side].items() if len(g) == k + 1 and g[:-1] == tail[:-1]}
            n, t = sum(follow.values()), len(follow)
            p = (follow.get(tail, 0) + t * p) / (n + t) if n + t else p
        return p

    for s, *_ in urls:
        padded = "\2" * url_filter.ORDER + s + "\3"
        grams = [padded[i : i + url_filter.ORDER + 1] for i in range(len(s) + 1)]
        want = sum(math.log(chance("allow", g)) - math.log(chance("block", g)) for g in grams) / len(grams)
        assert abs(got[s] - want) < 1e-9


ARTICLE = "<html><nav>menu</nav><div class='ad'>buy</div><article><h1>T &amp; t</h1><p>One<b> two</b>\n three<br>x<p>Four</article><aside>s</aside><footer>f</footer>"


def test_pages(spark):
    plain = "<body><div>Same head</div><p>Own {0} &lt;a&gt;</p><div>Same foot</div><form>f</form><!-- c --><script>var a='<p>';</script></body>"
    pages = [(1, "http://h/a", ARTICLE), (2, "http://h/b", ARTICLE), (3, "http://g/a/1", plain.format("one")), (4, "http://g/a/2", plain.format("two"))]
    pages += [(5, None, None), (6, "x", ""), (6, "x", "text <b>only"), (None, "http://k/", "<p>a &am")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = page_diff.main_texts(df, "page_id", "url", "html").collect()
    got = sorted((str(r["page_id"]), r["text"]) for r in rows)
    article = "T & t\n\nOne two three x\n\nFour"
    assert got == sorted(
        [("1", article), ("2", article), ("3", "Own one <a>"), ("4", "Own two <a>"), ("5", ""), ("6", ""), ("6", "text only"), ("None", "a &am")]
    )
    assert page_diff.main_texts(df.limit(0), "page_id", "url", "html").count() == 0


def test_copied_pages_keep_their_text(spark):
    plain = "<body><div>Same head</div><p>Own {0}</p><div>Same foot</div></body>"
    inside = "<body><article><div>Site line</div><div>Own {0}</div>bare {0}<br>more</article></body>"
    pages = [(i, f"http://a/{i}", plain.format("one")) for i in range(3)] + [(3, "http://a/3", plain.format("two"))]
    pages += [(10, "http://b/x", plain.format("one")), (11, "http://b/x", plain.format("one")), (12, "http://b/x", plain.format("new"))]
    pages += [(20, "http://c/1", inside.format("one")), (21, "http://c/2", inside.format("one")), (22, "http://c/3", inside.format("two"))]
    pages += [(30, "http://d/1", plain.format("one")), (31, "http://d/2", ""), (32, "http://d/3", plain.format("two"))]
    pages += [(40, None, plain.format("one")), (41, None, plain.format("two"))]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"].split("\n\n") for r in page_diff.main_texts(df, "page_id", "url", "html").collect()}
    whole = ["Same head", "Own one", "Same foot"]
    assert [got[i] for i in range(4)] == [["Own one"]] * 3 + [["Own two"]]
    assert got[10] == got[11] == whole and got[12] == ["Same head", "Own new", "Same foot"]
    assert got[20] == got[21] == ["Own one", "bare one more"] and got[22] == ["Own two", "bare two more"]
    assert got[30] == ["Own one"] and got[31] == [""] and got[32] == ["Own two"]
    assert got[40] == ["Own one"] and got[41] == ["Own two"]


def test_layout_classes_do_not_blank_a_page():
    prose = "A sentence of the page that is long enough to be more than a menu or a button."

    def text(page):
        return [t for t, kind, _ in page_diff.lines(page) if kind != page_diff._NOISE]

    side = "<div class='sidebar'><p>Side</p></div><div class='site-footer'>Foot</div><div id='cookie-banner-2'>Cookies</div><ul class='top-nav'><li>Menu</ul>"
    for mark in ("class='content-sidebar-wrap'", "class='layout with-sidebar'", "class='has-banner x'", "id='social-policy'", "class='sidebar'", "class='menu-page-container'"):
        for inner in ("<article><p>{}</p></article>", "<main><p>{}</p></main>", "<div itemprop='articleBody'>{}</div>", "<p>{}</p>"):
            assert text(f"<body><div {mark}>{inner.format(prose)}{side}</div></body>") == [prose], (mark, inner)
    # what is noise stays noise, articles in it too
    comments = f"<section class='comments'><article><p>{prose}</p></article></section><div class='related'><article>R</article></div>"
    assert text(f"<body><article><h1>T</h1><p>Own</p></article>{comments}</body>") == ["T", "Own"]
    assert text(f"<body><main><p>{prose}</p><p>{prose}</p>{comments}</main></body>") == [prose, prose]
    assert text(f"<body><article><p>Own</p><div class='share'>S</div><article class='comment'>{prose}</article></article></body>") == ["Own"]
    assert text(f"<body><p>{prose}</p><p>{prose}</p><div class='cookie-notice-box'><p>{prose}</p></div><nav><article>n</article></nav></body>") == [prose, prose]


def test_common_lines():
    dice = random.Random(1)
    for most in (1 << 28, 20):
        for _ in range(150):
            a, b = ([dice.randint(0, 4) for _ in range(dice.randint(0, 30))] for _ in range(2))
            table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
            found = page_diff.common_lines(a, b) if most > 20 else page_diff._aligned(a, b, most) if a and b else []
            assert found == sorted(set(found)) and len(found) == table[-1][-1]
            rest = iter(b)
            assert all(a[i] in rest for i in found)


def test_page_query_has_every_page(spark):
    rows = QUERIES["op3_page_difference"](spark, SMALL).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(r[0] for r in small("pages"))
    assert all(r["text"] and r["n_chars"] == len(r["text"]) for r in rows)


def test_neighbours_against_all_vectors(spark):
    rows = small("embeddings")
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    found, hits, total = {}, 0, 0
    for r in QUERIES["op9_graph_ann"](spark, SMALL).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    for query, near in found.items():
        near.sort()
        scores = vectors @ vectors[ids == query][0]
        best = [i for i in ids[np.lexsort((ids, -scores))] if i != query][:20]
        assert [r for r, _, _ in near] == list(range(1, 21))
        assert all(abs(s - scores[ids == v][0]) < 1e-12 for _, v, s in near)
        hits, total = hits + len({v for _, v, _ in near} & set(best)), total + 20
    assert hits >= 0.9 * total


def test_neighbours_in_small_shards_with_copies_and_odd_rows(spark):
    dice = np.random.default_rng(2)
    rows = [(i, dice.standard_normal(8).tolist()) for i in range(300)] + [(i, [0.5] * 8) for i in range(300, 420)]
    rows += [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [None] * 8), (None, [1.0] * 8), (504, [1.0]), (505, [float("inf")] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in graph_ann.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    good = {i: np.array(v) for i, v in rows[:420]}
    for query, near in got.items():
        best = sorted((-float((good[query] * v).sum()), i) for i, v in good.items() if i != query)[:20]
        assert [v for _, v in sorted(near)] == [i for _, i in best]
    assert set(got) == {i for i in good if i % 20 == 0}
    assert graph_ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    few = graph_ann.nearest(df.filter("vec_id < 3"), F.col("vec_id") % 20 == 0).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] and len(few) == 2


def test_neighbours_of_two_lengths_and_of_repeated_ids(spark):
    dice = np.random.default_rng(4)
    rows = [(i, dice.standard_normal(6).tolist()) for i in range(150)] + [(i, dice.standard_normal(3).tolist()) for i in range(150, 180)]
    rows += [(i, dice.standard_normal(6).tolist()) for i in (0, 20, 20, 33)] + [(40, rows[40][1]), (7, [2.0]), (60, [3.0, 4.0])]
    df = spark.createDataFrame([(v, "x", i) for i, v in rows], "embedding array<double>, `row` string, vec_id long").repartition(3)
    got = Counter(tuple(r) for r in graph_ann.nearest(df, F.col("vec_id") % 20 == 0, k=5).collect())
    want = Counter()
    for a, (i, v) in enumerate(rows):
        if i % 20 == 0:
            others = [(-math.fsum(x * y for x, y in zip(v, w)), j) for b, (j, w) in enumerate(rows) if b != a and len(w) == len(v)]
            want.update((i, rank, j, round(-s, 9)) for rank, (s, j) in enumerate(sorted(others)[:5], 1))
    assert Counter((i, rank, j, round(s, 9)) for i, rank, j, s in got.elements()) == want


def test_shards(spark):
    rows = QUERIES["op10_shuffle_shards"](spark, SMALL).collect()
    docs = {r[0]: r[1] or "" for r in small("documents")}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = {}
    for r in rows:
        text = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(text) + 1, zlib.crc32(text), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    assert order != sorted(order)


def test_shards_of_few_repeated_and_null_rows(spark, out):
    df = spark.createDataFrame([(1, "a", 1)] * 40 + [(None, None, None)] * 3, "id long, `row` string, shard long")
    placed = shuffle_shards.shards(df, 4, size=F.lit(10), bucket_bytes=50)
    rows = placed.collect()
    assert Counter(r["shard"] for r in rows) == {0: 11, 1: 11, 2: 11, 3: 10}
    assert Counter(tuple(r["row"]) for r in rows) == {(1, "a", 1): 40, (None, None, None): 3}
    shuffle_shards.write_shards(placed, df.columns, out + "/shards")
    assert spark.read.parquet(out + "/shards").select("record.id", "record.row", "record.shard").count() == 43
    assert shuffle_shards.shards(df.limit(0), 4).count() == 0


def test_pipeline_stages(spark, out):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = docs.withColumn("fp", F.lit("x")).withColumn("found", F.lit("y")).withColumn("_signs", F.lit(1)).withColumn("ids", F.lit(2))
    odd = spark.createDataFrame([(None, None, None, None, None), (90001, "", "en", "s", 0), (90001, "", "en", "s", 0)], docs.schema)
    docs = extra.unionByName(odd, allowMissingColumns=True)
    before = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs.write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
        result = stage(spark, docs, SMALL)
        assert result.columns[: len(docs.columns)] == docs.columns
        if name != "byte_bpe":
            assert result.columns == docs.columns
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        docs = result
    assert 0.5 * before < docs.count() < before
