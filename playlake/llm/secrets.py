"""Secret scans: fixed patterns, and values in the context of a credential that would be hard to guess.

The cost of guessing a value is the least, over all ways to cut it into spans, of the sum of the logarithms (base 10) of the
guesses that each span needs: a word by its rank among the words of the corpus, a date by the number of dates, a repeat by its
sign and length, a keyboard walk by its start, turns and length, anything else by brute force over the signs of its class. A value that needs
``HARD`` or more is reported as kind ``guess``.

Null and empty texts hold no spans. A very long value takes time in proportion to its length. Spans are half-open and in code points; all kinds may overlap.
"""

import math
import re
from functools import partial
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from playlake.operators.ids import serial_ids
from playlake.storage import materialize

# The patterns and least lengths of the base kinds, in the order in which kinds are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

#: Names that announce a credential, beyond those of ``ASSIGN``.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"""
    r"""|client[_-]?secret|credentials?|auth|bearer|login|pin)["']?(?:\x20*[:=]\x20*|\x20+is\x20+)["'`]?([^\s"'`,;<>(){}]+)""",
    re.ASCII | re.IGNORECASE,
)
#: Least characters of a value, and the logarithm of the guesses from which it counts as a secret.
LEAST_VALUE = 6
HARD = 10.0
#: Words that passwords are made of often and a corpus may not hold; they rank before the corpus.
COMMON = (
    "password passwd pass admin administrator root user guest login welcome letmein master secret qwerty monkey dragon "
    "football baseball iloveyou princess sunshine shadow superman batman trustno changeme default test testing example "
    "sample demo dummy placeholder your my the and not none null true false xxx abc key token value string hello world"
).split()
#: Words of the corpus that are taken as guessable; those that most of its distinct texts hold.
WORDS_KEPT = 50_000
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
_DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d"
)
_LEET = str.maketrans("@4310$57", "aaeiosst")


def _neighbours() -> dict[str, str]:
    """Keys that touch on a keyboard, by rows that are shifted half a key each."""
    where = {key: (y, x) for y, row in enumerate(_ROWS) for x, key in enumerate(row)}
    steps = {(0, 1), (0, -1), (1, 0), (1, -1), (-1, 0), (-1, 1)}
    return {a: "".join(b for b, q in where.items() if (q[0] - p[0], q[1] - p[1]) in steps) for a, p in where.items()}


_TOUCHING = _neighbours()


def _brute(sign: str) -> float:
    """Logarithm of the signs in the class of ``sign``."""
    if sign.isdigit():
        return 1.0
    return math.log10(26) if sign.isascii() and sign.isalpha() else math.log10(33) if sign.isascii() else 2.0


def _runs(value: str, follows) -> list[int]:
    """For each place, the end of the longest run from there in which each sign follows the one before."""
    ends = list(range(1, len(value) + 1))
    for i in range(len(value) - 2, -1, -1):
        if follows(value[i], value[i + 1]):
            ends[i] = ends[i + 1]
    return ends


def guess_cost(value: str, ranks: dict[str, int], longest: int) -> float:
    """Logarithm of the guesses for ``value``; ``longest`` is the length of the longest word in ``ranks``."""
    n = len(value)
    low = value.lower()
    plain = low.translate(_LEET) if len(low) == n else value.translate(_LEET)
    low = low if len(low) == n else value
    repeats = _runs(value, lambda a, b: a == b)
    walks = _runs(low, lambda a, b: b in _TOUCHING.get(a, ""))
    climbs = [_runs(low, lambda a, b, d=d: a.isalnum() and ord(b) - ord(a) == d) for d in (1, -1)]
    dates: dict[int, list[int]] = {}
    for i in range(n - 3):
        if value[i].isdigit() and (found := _DATE.match(value, i)):
            dates.setdefault(i, []).append(found.end())
    turned = [0, *accumulate(a != b for a, b in zip(value, value[1:]))]  # changes of sign up to each place
    best = [0.0] + [math.inf] * n
    for i in range(n):
        here = best[i]

        def reach(end: int, cost: float, here=here) -> None:
            best[end] = min(best[end], here + cost)

        reach(i + 1, _brute(value[i]))
        for end in range(i + 3, min(n, i + longest) + 1):
            rank = ranks.get(low[i:end])
            if rank:
                # upper case, or signs in place of letters, double the guesses
                reach(end, math.log10(rank + 1) + 0.3 + (0 if value[i:end] == low[i:end] else 0.3))
            elif plain is not low and (rank := ranks.get(plain[i:end])):
                reach(end, math.log10(rank + 1) + 0.9)
        for end in dates.get(i, ()):
            reach(end, math.log10(365 * 120) if end - i > 4 else math.log10(120))
        for ends, cost in ((repeats, _brute(value[i]) + 0.3), (walks, math.log10(len(_TOUCHING)) + 0.6), (climbs[0], 1.7), (climbs[1], 1.9)):
            for end in {i + 3, ends[i]} if ends[i] - i >= 3 else ():
                turns = turned[end - 1] - turned[i] if ends is walks else 0
                reach(end, cost + math.log10(end - i) + 0.15 * turns)
    return best[n]


def find(text: str, ranks: dict[str, int], longest: int, hard: float) -> list[tuple[str, int, int, float | None]]:
    """Spans of ``text`` as (kind, start, end, cost), by start and then kind."""
    spans: list[tuple[str, int, int, float | None]] = []
    if ":" in text or "=" in text:
        spans += [("assign", m.start(), m.end(), None) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end(), None) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    spans += [("hex", m.start(), m.end(), None) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?")
        if len(value) >= LEAST_VALUE and (cost := guess_cost(value, ranks, longest)) >= hard:
            spans.append(("guess", m.start(1), m.start(1) + len(value), round(cost, 6)))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", IntegerType()),
            StructField("end", IntegerType()),
            StructField("cost", DoubleType()),
        ]
    )
)


def word_ranks(df: DataFrame, text: Column, kept: int = WORDS_KEPT) -> dict[str, int]:
    """Ranks of guessable words: the fixed ones, then the ``kept`` that most of the distinct texts hold, ties in order of the word.

    Values in the context of a credential are no words of a text. The words of each text are shuffled once, by a hash of the text, so
    that copies count once. Exactly ``kept`` words reach the driver (all, if there are fewer): the steps of frequency (an eighth of a
    power of two each) that fit whole, and the first words of the next step, which is range-partitioned for that.
    """
    bare = text
    for pattern in (CONTEXT, ASSIGN):  # what precedes the last group stays
        at = pattern.pattern.rindex("([")
        bare = F.regexp_replace(bare, f"(?i)(?<kept>{pattern.pattern[:at]}){pattern.pattern[at:]}", "${kept} ")
    bag = F.array_join(F.array_distinct(F.split(F.lower(bare), r"[^\p{L}]+")), " ")
    bags = df.filter(text.isNotNull()).select(F.unhex(F.md5(text)).alias("key"), bag.alias("bag"))
    bags = bags.groupBy("key").agg(F.first("bag").alias("bag"))
    words = bags.select(F.explode(F.split("bag", " ")).alias("word"))
    counts = words.filter(F.length("word").between(3, 24)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts.withColumn("step", F.floor(F.log2("n") * 8).cast("int")), "words")
    left, least, cut = kept, None, None
    for row in sorted(counts.groupBy("step").count().collect(), reverse=True):  # some hundred steps at most
        if row["count"] > left:
            cut = row["step"]
            break
        left, least = left - row["count"], row["step"]
    top = counts.filter(F.col("step") >= least).select("n", "word").collect() if least is not None else []
    if cut is not None and left:
        step = counts.filter(F.col("step") == cut).select((-F.col("n")).alias("less"), "word")
        placed = serial_ids(step, ["less", "word"], name="place", unique=True)
        top += placed.filter(F.col("place") <= left).select((-F.col("less")).alias("n"), "word").collect()
    ranks = {word: i + 1 for i, word in enumerate(COMMON)}
    for row in sorted(top, key=lambda r: (-r["n"], r["word"])):
        ranks.setdefault(row["word"], len(ranks) + 1)
    return ranks


def with_spans(df: DataFrame, text: Column, name: str, hard: float = HARD, words_kept: int = WORDS_KEPT) -> DataFrame:
    """``df`` with a column ``name``: all spans of ``text`` as an array of (kind, start, end, cost), in order."""
    sent = _sent_ranks(df, text, words_kept)

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        known, longest = sent.value
        return texts.map(partial(_rows, ranks=known, longest=longest, hard=hard))

    return df.withColumn(name, spans(F.coalesce(text, F.lit(""))))


def with_redacted(
    df: DataFrame, text: Column, name: str, mark: str = "[SECRET]", hard: float = HARD, words_kept: int = WORDS_KEPT
) -> DataFrame:
    """``df`` with a column ``name``: a struct of ``spans``, as of ``with_spans``, and ``text``, as of ``redacted``. One process does both, so a task holds the
    words and a batch of texts once."""
    sent = _sent_ranks(df, text, words_kept)

    @F.pandas_udf(StructType([StructField("spans", SPANS), StructField("cut", StringType())]))
    def both(texts: pd.Series) -> pd.DataFrame:
        known, longest = sent.value
        spans = texts.map(partial(_rows, ranks=known, longest=longest, hard=hard))
        cut = [_cut(t, s, mark) if s else None for t, s in zip(texts, spans)]
        return pd.DataFrame({"spans": spans, "cut": pd.Series(cut, index=texts.index, dtype=object)})

    found = both(F.coalesce(text, F.lit("")))
    left = F.when(F.size(found["spans"]) > 0, found["cut"]).otherwise(text)
    return df.withColumn(name, F.struct(found["spans"].alias("spans"), left.alias("text")))


def _sent_ranks(df: DataFrame, text: Column, words_kept: int):
    ranks = word_ranks(df, text, words_kept)
    return df.sparkSession.sparkContext.broadcast((ranks, max(map(len, ranks))))


def _rows(text: str, **how) -> list[dict]:
    return [dict(zip(("kind", "start", "end", "cost"), span)) for span in find(text, **how)]


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span, or run of overlapping spans, replaced by ``mark``. Null stays null."""

    @F.pandas_udf(StringType())
    def cut(texts: pd.Series, found: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, s, mark) for t, s in zip(texts, found)], dtype=object)

    return F.when(F.size(spans) > 0, cut(text, spans)).otherwise(text)


def _cut(text: str | None, spans, mark: str) -> str | None:
    if text is None or spans is None:
        return text
    out, at, until = [], 0, -1
    for span in spans:
        if span["start"] >= until:
            out += [text[max(at, until, 0) : span["start"]], mark]
        until = max(until, span["end"])
    return "".join(out) + text[max(until, 0) :]
