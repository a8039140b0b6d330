"""Benchmark decontamination by latent semantic retrieval.

Passages of the benchmark and windows of the documents become TF-IDF vectors, with document frequencies counted over all
documents. A randomised singular value decomposition of the benchmark's passages, computed by Spark, gives a latent space in
which the cosine of every window and every passage is taken. Candidates come from two sources, of which neither drops what the
other finds:

* Latent cosine, for paraphrases: the item of every passage that is at least ``NEAR`` to a window. It leaks if at least ``REWORDED``
  of its words, by number and by weight, stand around the window, piece by piece (the items' halves, or more pieces of at most ``HALF`` words), each by its
  longest common subsequence, so that pieces may change places; and, where its answer is looked for, as much of the answer too.
* An inverted list of rare words, so that nothing verbatim depends on a cosine: all items that can reach the shares below by the
  words that stand around a window. Such an item leaks if its words stand there in order: by their longest common subsequence,
  either most of the item, or a good part of it and its answer too. An item of more than a passage's words leaks as well if most
  of one passage stands there, however little of the item that is.

``share`` is of the whole item in order, around the first such window; a paraphrase's may be low.

The vocabulary is the benchmark's. A benchmark is collected in blocks of at most ``BLOCK_BYTES``; a larger one takes more passes.

Null and empty texts hold no leaks. Items of fewer than ``LEAST_WORDS`` words leak where all their words stand in one piece, a
single word too: such an item says little, so leave it out of the benchmark if texts with that word are to stay. Scripts without
spaces are cut into letters, of which three count as a word. Items that are null or have no words are left out. Without an answer column, an item's last sentence is its answer; an answer of fewer than three words is not looked
for. Repeated items are reported under each of their ids, rows with repeated ids are rows of their own.
"""

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

#: Words of half a window (or passage); windows overlap by half.
HALF = 16
#: Dimensions of the latent space, and of the random sketch it is found in; rounds of power iteration.
DIMENSIONS, SKETCH, ROUNDS, SEED = 192, 208, 2, 42
#: Least share of an item's words that leaks, alone and together with the answer's.
LEAK, PART, ANSWER = 0.8, 0.65, 0.8
#: Least cosine of a window and a passage, and least share of an item's words in its pieces, of a paraphrase.
NEAR, REWORDED = 0.7, 0.5
#: Rare words of an item that must stand near one another before anything is compared.
HITS = 4
LEAST_WORDS = 8
#: Bytes of benchmark text whose vocabulary and passages are held at once.
BLOCK_BYTES = 16 << 20
#: Words of documents that are searched at once, and entries of the inverted list.
_WORDS, _POSTINGS = 1 << 17, 1 << 21
#: Half windows whose vectors are held at once, and passages they are compared with at once.
_HALVES, _PASSAGES = 1 << 10, 1 << 13

#: Signs beyond ASCII that part words, and all of ASCII but letters and digits.
_SIGNS = re.compile("[\u0080-\u00a9\u00ab-\u00b4\u00b6-\u00b9\u00bb-\u00bf\u2000-\u206f\u3000-\u303f\uff00-\uff0f\uff1a-\uff20\uff3b-\uff40\uff5b-\uff65]+")
#: Letters of scripts without spaces (Thai, Lao, Tibetan, Burmese, Khmer, kana, Han); each is a word. So many count as one in an item.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
_LETTERS_A_WORD = 3
_PARTED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-case words in UTF-8, without signs and white space; single letters where a script has no spaces."""
    low = (text or "").lower()
    if not low.isascii():
        low = _UNSPACED.sub(r" \g<0> ", _SIGNS.sub(" ", low))
    return low.encode().translate(_PARTED).split()


def answer_of(text: str) -> str:
    """The last sentence."""
    parts = [p for p in re.split(r"[.!?\u3002\uff01\uff1f]+\s*", text) if p.strip()]
    return parts[-1] if len(parts) > 1 else ""


def common(item: list[int], region: list[int]) -> int:
    """Length of the longest common subsequence, 64 comparisons and more at a time."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << i
    every = state = (1 << len(item)) - 1
    for word in region:
        mask = masks.get(word)
        if mask is not None:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & every
    return len(item) - state.bit_count()


class Benchmark:
    """Items of one block as word ids from 1, their passages, and (later) weights and latent vectors."""

    def __init__(self, items: list[tuple[int, str, str]], near: float = NEAR):
        self.near = near
        self.vocabulary: dict[bytes, int] = {}
        self.items = []  # (item id, word ids, answer's word ids)
        self.short: list[int] = []  # those that are looked for word by word
        for item_id, text, answer in items:
            parts = words(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in parts]
            if ids:
                letters = sum(_UNSPACED.match(w.decode()) is not None for w in parts)
                if len(ids) - letters + letters / _LETTERS_A_WORD < LEAST_WORDS:
                    self.short.append(len(self.items))
                self.items.append((item_id, ids, [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(answer)]))
        self.passages = [
            (k, ids[at : at + 2 * HALF])
            for k, (_, ids, _) in enumerate(self.items)
            for at in range(0, max(len(ids) - HALF, 1), HALF)
        ]
        self.passages_of: dict[int, list[int]] = {}
        for p, (k, _) in enumerate(self.passages):
            self.passages_of.setdefault(k, []).append(p)
        self.longest = max((len(ids) for _, ids, _ in self.items), default=0)
        self.weights = np.zeros(len(self.vocabulary) + 1, dtype=np.float32)
        self.embedding = self.targets = np.zeros((0, 0), dtype=np.float32)

    def ids(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, tokens, repeat(0)), dtype=np.int32, count=len(tokens))

    def index(self, seen: np.ndarray) -> None:
        """The inverted list. Of a unit of n words of which ``need`` must stand in order, any n - need + HITS words hold HITS that
        match; the rarest ones are listed, so a place without HITS of them within the unit's span cannot hold it."""
        short = self.in_one_piece = set(self.short)
        long = [(k, ids) for k, (_, ids, _) in enumerate(self.items) if k not in short]
        self.units = [(k, np.array(ids), math.ceil(PART * len(ids)), False) for k, ids in long]
        for k, ids in long:  # longer items also by each passage, the last one up to the item's end
            starts = {*range(0, len(ids) - 2 * HALF, HALF), len(ids) - 2 * HALF} if len(ids) > 2 * HALF else ()
            self.units += [(k, np.array(ids[at : at + 2 * HALF]), math.ceil(LEAK * 2 * HALF), True) for at in sorted(starts)]
        self.spans = np.array([2 * len(wanted) + 2 * HALF for _, wanted, _, _ in self.units], dtype=np.int64)
        rare = [np.unique(wanted[np.argsort(seen[wanted], kind="stable")[: len(wanted) - need + HITS]]) for _, wanted, need, _ in self.units]
        self.begins, self.units_of = self._lists(rare)
        self.present = np.zeros(len(self.weights), dtype=bool)
        # Short items stand in order and in one piece around their rarest word.
        pieces = [np.array(self.items[k][1]) for k in self.short]
        self.short_at = np.array([int(np.argmin(seen[piece])) for piece in pieces], dtype=np.int64)
        self.short_begins, self.shorts_of = self._lists([piece[at : at + 1] for piece, at in zip(pieces, self.short_at)])
        self.short_sizes = np.array([len(piece) for piece in pieces], dtype=np.int64)
        self.short_words = np.zeros((len(pieces), max(map(len, pieces), default=0)), dtype=np.int32)
        for row, piece in zip(self.short_words, pieces):
            row[: len(piece)] = piece

    def _lists(self, listed: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each word, where its part begins in the second array, which holds the places in ``listed`` that have the word."""
        every = np.concatenate([np.zeros(0, dtype=np.int64), *listed])
        places = np.repeat(np.arange(len(listed), dtype=np.int32), [len(x) for x in listed])
        return np.concatenate(([0], np.cumsum(np.bincount(every, minlength=len(self.weights))))), places[np.argsort(every, kind="stable")]

    def nearness(self, ids: np.ndarray, h: int, item: int, n: int) -> float:
        """Greatest latent cosine of an item's passages and the windows in the surroundings of window ``h``."""
        starts = range(max(0, h - n // HALF - 1), min((len(ids) - 1) // HALF, h + n // HALF + 1) + 1)
        sums = np.stack([self.embedding[ids[at * HALF : (at + 2) * HALF]].sum(axis=0) for at in starts])
        sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        return float((sums @ self.targets[self.passages_of[item]].T).max())


def document_frequencies(df: DataFrame, text: Column, sent, size: int) -> tuple[np.ndarray, int]:
    """Documents that hold each word of the vocabulary, and all documents. ``size`` numbers at most reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        benchmark = sent.value
        seen, known = np.zeros(size, dtype=np.int64), benchmark.vocabulary
        for batch in batches:
            for value in batch["text"]:
                seen[[known[word] for word in known.keys() & set(words(value))]] += 1
                seen[0] += 1
        held = np.flatnonzero(seen)
        yield pd.DataFrame({"word": held, "n": seen[held]})

    counts = df.select(text.alias("text")).mapInPandas(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(size, dtype=np.int64)
    for row in counts.collect():
        out[row["word"]] = row["n"]
    return out, int(out[0])


def latent_space(spark: SparkSession, benchmark: Benchmark) -> np.ndarray:
    """Right singular vectors (words x dimensions) of the passages' TF-IDF rows, by a randomised range finder.

    Tasks multiply their passages with the sketch; sums of size words x sketch reach the driver, which makes them orthonormal.
    """
    size = len(benchmark.weights)
    weights = benchmark.weights
    rows = spark.createDataFrame([(ids,) for _, ids in benchmark.passages], "words array<int>")
    width = max(1, min(SKETCH, len(benchmark.passages), size - 1))

    def times(basis: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast((weights, basis))

        def multiply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            idf, factor = sent.value
            total = np.zeros(factor.shape)
            for batch in batches:
                for ids in batch["words"]:
                    present, times = np.unique(np.asarray(ids), return_counts=True)
                    row = times * idf[present]
                    row = row / max(float(np.sqrt((row**2).sum())), 1e-12)
                    total[present] += np.outer(row, row @ factor[present])
            held = np.flatnonzero(total.any(axis=1))
            yield pd.DataFrame({"word": held, "row": pd.Series(list(total[held]), dtype=object)})

        parts = rows.mapInPandas(multiply, "word long, row array<double>")
        summed = parts.groupBy("word").agg(*[F.sum(F.get("row", F.lit(k))).alias(f"s{k}") for k in range(basis.shape[1])])
        out = np.zeros(basis.shape)
        for row in summed.collect():
            out[row[0]] = row[1:]
        sent.unpersist()
        return out

    basis = np.random.default_rng(SEED).standard_normal((size, width))
    basis[0] = 0
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(times(basis))
    small = basis.T @ times(basis)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:DIMENSIONS]
    return basis @ vectors[:, best[values[best] > 1e-9]]


def learn(df: DataFrame, text: Column, items: list[tuple[int, str, str]], near: float = NEAR) -> Benchmark:
    spark = df.sparkSession
    benchmark = Benchmark(items, near)
    if not benchmark.items:
        return benchmark
    size = len(benchmark.weights)
    sent = spark.sparkContext.broadcast(benchmark)
    seen, n = document_frequencies(df, text, sent, size)
    benchmark.weights = np.log((n + 1) / (seen + 1)).astype(np.float32) + np.float32(0.05)
    space = latent_space(spark, benchmark)
    benchmark.embedding = (benchmark.weights[:, None] * space).astype(np.float32)
    benchmark.embedding[0] = 0
    benchmark.index(seen)
    targets = np.stack([benchmark.embedding[ids].sum(axis=0) for _, ids in benchmark.passages])
    benchmark.targets = targets / np.maximum(np.linalg.norm(targets, axis=1, keepdims=True), 1e-9)
    return benchmark


LEAKS = ArrayType(
    StructType(
        [
            StructField("item_id", LongType()),
            StructField("cosine", DoubleType()),
            StructField("share", DoubleType()),
            StructField("answer_share", DoubleType()),
        ]
    )
)


def _leaks(texts, benchmark: Benchmark) -> list[list[dict]]:
    out: list[dict[int, tuple]] = [{} for _ in range(len(texts))]
    if not benchmark.items:
        return [[] for _ in out]
    waiting: list[tuple[int, np.ndarray]] = []
    held = 0
    for k, text in enumerate(texts):
        ids = benchmark.ids(words(text))
        if len(ids):
            waiting.append((k, ids))
            held += len(ids)
        if waiting and (held >= _WORDS or k == len(texts) - 1):
            _search(waiting, benchmark, out)
            waiting, held = [], 0
    return [
        [dict(item_id=benchmark.items[i][0], cosine=c, share=s, answer_share=a) for i, (c, s, a) in sorted(found.items())]
        for found in out
    ]


def _search(documents: list[tuple[int, np.ndarray]], benchmark: Benchmark, out: list[dict]) -> None:
    """Add to ``out`` the leaking items of some documents, given as word ids."""
    flat = np.concatenate([ids for _, ids in documents])
    lengths = np.array([len(ids) for _, ids in documents])
    first = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(documents)), lengths)
    _search_short(documents, flat, first, owner, benchmark, out)
    _search_near(documents, benchmark, out)
    reach = 2 * benchmark.longest + 2 * HALF
    postings = benchmark.begins[flat + 1] - benchmark.begins[flat]
    upto = np.cumsum(postings, dtype=np.int64)
    looked: dict[tuple[int, int], int] = {}
    at = 0
    while at < len(flat):  # stretches of so many postings, each as far into the next one as a match may reach
        end = int(np.searchsorted(upto, upto[at] + _POSTINGS))
        end = max(end, at + 2 * reach)
        token = np.flatnonzero(postings[at:end]) + at
        token, unit = _listed(token, flat, benchmark.begins, benchmark.units_of)
        order = np.argsort(unit, kind="stable")
        unit, token = unit[order], token[order]
        spread = token + owner[token] * reach  # no match goes over the end of a document
        run = (unit[HITS - 1 :] == unit[: 1 - HITS]) & (spread[HITS - 1 :] - spread[: 1 - HITS] < benchmark.spans[unit[: 1 - HITS]])
        for u, place in zip(unit[: 1 - HITS][run].tolist(), token[: 1 - HITS][run].tolist()):
            o = int(owner[place])
            if looked.get((o, u), -1) >= place:
                continue
            looked[o, u] = place + int(benchmark.spans[u])
            _compare(documents[o], place - int(first[o]), u, benchmark, out)
        if end >= len(flat):
            break
        at = end - reach


def _listed(token: np.ndarray, flat: np.ndarray, begins: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every token as often as its word has entries in an inverted list, and the entries."""
    times = begins[flat[token] + 1] - begins[flat[token]]
    places = np.arange(times.sum()) + np.repeat(begins[flat[token]] - (np.cumsum(times) - times), times)
    return np.repeat(token, times), entries[places]


def _search_short(documents, flat: np.ndarray, first: np.ndarray, owner: np.ndarray, benchmark: Benchmark, out: list[dict]) -> None:
    """Short items: all words in one piece."""
    upto = np.cumsum(benchmark.short_begins[flat + 1] - benchmark.short_begins[flat], dtype=np.int64)
    tokens = np.flatnonzero(np.diff(upto, prepend=0))
    ends = first + np.array([len(ids) for _, ids in documents])
    at = 0
    while at < len(tokens):
        end = max(at + 1, int(np.searchsorted(upto[tokens], upto[tokens[at]] + _POSTINGS)))
        token, s = _listed(tokens[at:end], flat, benchmark.short_begins, benchmark.shorts_of)
        o, begin = owner[token], token - benchmark.short_at[s]
        fits = (begin >= first[o]) & (begin + benchmark.short_sizes[s] <= ends[o])
        o, begin, s = o[fits], begin[fits], s[fits]
        for j in range(benchmark.short_words.shape[1]):
            same = (j >= benchmark.short_sizes[s]) | (flat[np.minimum(begin + j, len(flat) - 1)] == benchmark.short_words[s, j])
            o, begin, s = o[same], begin[same], s[same]
        _, once = np.unique(o * len(benchmark.short) + s, return_index=True)
        for i in once.tolist():
            (k, ids), item, place = documents[o[i]], benchmark.short[s[i]], int(begin[i] - first[o[i]])
            if item not in out[k]:
                _add(k, ids, place // HALF, item, 1.0, ids[place : place + int(benchmark.short_sizes[s[i]])], True, benchmark, out)
        at = end


def _sums(rows: np.ndarray) -> np.ndarray:
    """Sums of every ``HALF`` rows, and of those left over, in the order of the rows."""
    whole = len(rows) // HALF * HALF
    sums = rows[:whole].reshape(-1, HALF, rows.shape[1]).sum(axis=1)
    return np.concatenate((sums, rows[whole:].sum(axis=0, keepdims=True))) if whole < len(rows) else sums


def _search_near(documents: list[tuple[int, np.ndarray]], benchmark: Benchmark, out: list[dict]) -> None:
    """Add the items whose passages are near to a window and whose pieces stand around it."""
    for k, ids in documents:
        for at in range(0, max(1, (len(ids) - 1) // HALF), _HALVES):
            # One half more than windows begin here, as a window takes the half behind it too.
            part = ids[at * HALF : (at + _HALVES + 1) * HALF]
            halves = _sums(benchmark.embedding[part])
            windows = halves[:-1] + halves[1:] if len(halves) > 1 else halves
            windows /= np.maximum(np.linalg.norm(windows, axis=1, keepdims=True), 1e-9)
            for p in range(0, len(benchmark.targets), _PASSAGES):
                window, passage = np.nonzero(windows @ benchmark.targets[p : p + _PASSAGES].T >= benchmark.near)
                for h, q in zip(window.tolist(), passage.tolist()):
                    item = benchmark.passages[p + q][0]
                    if item not in out[k] and item not in benchmark.in_one_piece:
                        _reworded(k, ids, at + h, item, benchmark, out)


def _reworded(k: int, ids: np.ndarray, h: int, item: int, benchmark: Benchmark, out: list[dict]) -> None:
    """Whether the pieces of an item stand around a window, in any order of the pieces."""
    _, wanted, answer = benchmark.items[item]
    n = len(wanted)
    region = ids[max(0, h * HALF - n) : h * HALF + 2 * HALF + n]
    benchmark.present[region] = True
    weights = benchmark.weights[wanted]
    weight = weights[benchmark.present[wanted]].sum()
    benchmark.present[region] = False
    if weight < REWORDED * weights.sum():
        return
    held = region.tolist()
    pieces = max(2, math.ceil(n / HALF))
    bounds = [n * i // pieces for i in range(pieces + 1)]
    if sum(common(wanted[a:b], held) for a, b in zip(bounds, bounds[1:])) < REWORDED * n:
        return
    if len(answer) >= 3 and common(answer, held) < REWORDED * len(answer):
        return
    _add(k, ids, h, item, common(wanted, held) / n, region, True, benchmark, out)


def _bound(wanted: np.ndarray, stretch: np.ndarray, present: np.ndarray) -> int:
    """Words of ``wanted`` that ``stretch`` holds in any order."""
    present[stretch] = True
    held = int(np.count_nonzero(present[wanted]))
    present[stretch] = False
    return held


def _compare(document: tuple[int, np.ndarray], place: int, u: int, benchmark: Benchmark, out: list[dict]) -> None:
    """Look for unit ``u`` in the surroundings of all windows that hold a match from ``place`` to a span behind it."""
    k, ids = document
    item, wanted, need, passage = benchmark.units[u]
    if passage and item in out[k]:
        return  # reported already, by the whole item or another passage
    n, span = len(wanted), int(benchmark.spans[u])
    stretch = ids[max(0, place - span) : place + 2 * span]
    if _bound(wanted, stretch, benchmark.present) < need or (most := common(wanted.tolist(), stretch.tolist())) < need:
        return
    begin = max(0, (place - 2 * HALF - n) // HALF)
    for h in range(begin, min(place + span + n, len(ids) - 1) // HALF + 1):
        region = ids[max(0, h * HALF - n) : h * HALF + 2 * HALF + n]
        if _bound(wanted, region, benchmark.present) < need or (found := common(wanted.tolist(), region.tolist())) < need:
            continue
        if passage:  # it leaks by itself; what is reported is the share of the item around it
            whole = benchmark.items[item][1]
            region = ids[max(0, h * HALF - len(whole)) : h * HALF + 2 * HALF + len(whole)]
            _add(k, ids, h, item, common(whole, region.tolist()) / len(whole), region, True, benchmark, out)
        else:
            _add(k, ids, h, item, found / n, region, False, benchmark, out)
        if found == most:
            break


def _add(k: int, ids: np.ndarray, h: int, item: int, share: float, region: np.ndarray, leaks: bool, benchmark: Benchmark, out: list[dict]) -> None:
    _, wanted, answer = benchmark.items[item]
    of_answer = common(answer, region.tolist()) / len(answer) if len(answer) >= 3 else 0.0
    if not leaks and share < LEAK and of_answer < ANSWER:
        return
    new = (benchmark.nearness(ids, h, item, len(wanted)), share, of_answer)
    have = out[k].get(item)
    out[k][item] = new if have is None else max(have, new, key=lambda x: (x[1], x[0]))


class Decontaminator:
    """Leaks of a benchmark in the texts of ``df``, whose document frequencies it takes. ``near`` is the least cosine of a paraphrase."""

    def __init__(
        self,
        df: DataFrame,
        text: Column,
        benchmark: DataFrame,
        item_id: str = "item_id",
        item: str = "text",
        answer: str | None = None,
        near: float = NEAR,
    ):
        spark = df.sparkSession
        known = benchmark.filter(F.col(item).isNotNull() & F.col(item_id).isNotNull())
        total = known.agg(F.sum(F.octet_length(item))).first()[0] or 0
        blocks = max(1, math.ceil(total / BLOCK_BYTES))
        self.sent = []
        for b in range(blocks):
            block = known.filter(F.pmod(F.xxhash64(item_id), F.lit(blocks)) == b)
            rows = block.select(F.col(item_id).cast("long"), item, F.col(answer) if answer else F.lit(None)).distinct().collect()
            items = sorted((i, t, a if a is not None else answer_of(t)) for i, t, a in rows)
            self.sent.append(spark.sparkContext.broadcast(learn(df, text, items, near)))

    def leaks(self, text: Column) -> Column:
        """(item_id, cosine, share, answer_share) of every item that leaks into ``text``."""
        found = [_leaks_of(sent)(F.coalesce(text, F.lit(""))) for sent in self.sent]
        return found[0] if len(found) == 1 else F.concat(*found)


def _leaks_of(sent):
    @F.pandas_udf(LEAKS)
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(_leaks(texts.tolist(), sent.value), dtype=object)

    return of
