"""Cheapest repair of the turn structure of conversations, by prefix-doubling path ranking.

A conversation is a path through states: nothing yet, after a system turn, after a user turn, after an assistant turn. Each row is kept,
given the role that fits, or deleted; turns without text can be inserted anywhere. What is left reads ``(s?(ua)+)?`` in initials of roles.

* Cost: every row is a min-plus matrix over the states. Products of 2, 4, 8 ... rows give the cost from each row to the end.
* Ranks: the nodes (row, state) on cheapest paths are ranked by the first letters of their audits, then by 2, 4, 8 ... letters: the rank of
  twice as many is the rank of the pair of a node's rank and that of the node its pointer leads to. The edits of a node differ
  in their letters, so the least edit is known from its letter and the rank of what follows, and the audit is read along the doubled pointers.

Rows of all conversations are numbered in one order and cut into blocks of ``BLOCK`` rows, whatever conversation they belong to. A
conversation that runs over many blocks gives one matrix for each block, and the products and pointers over blocks are doubled in the
same way by joins in Spark, so no task holds a conversation. Only the digest of a repaired conversation has to be taken in order:
one task reads its rows as a stream, a batch at a time, and keeps the digest's state and the audit.

Null roles and texts count as one space. Null turns come first; rows of one turn go by the role's first 16 characters, then by a digest of role and
text, so rows that are still tied are equal. A null conversation id is a conversation of its own. An empty table has no
conversations. Texts are never cut. Further columns of the input, whatever their names, are not looked at.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from playlake.llm.common import quoted
from playlake.operators.ids import serial_ids
from playlake.operators.joins import skew_join
from playlake.storage import materialize

#: Rows of one block.
BLOCK = 1 << 16
# White space, roles, costs of the edits, and pairs of role initials that may follow one another.
BLANKS = " \t\n\x0b\x0c\r"
ROLES = {"s": 0, "u": 1, "a": 2}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(4)
_FREE, _CUT, _GONE = range(3)  # a row without a fault, a truncated one, one that must go
_FAR = np.int64(1) << 40
#: The state that a turn of the other speaker leads to.
_NEXT = np.array([_USER, _USER, _ASSISTANT, _USER])
_LETTERS = "DIKR"  # in ASCII order


def _inserts() -> np.ndarray:
    """Costs of inserts alone, from state to state."""
    costs = np.full((4, 4), _FAR)
    for state in range(4):
        at = state
        for n in range(3):
            costs[state, at] = min(costs[state, at], n * INSERT)
            at = _NEXT[at]
    return costs


def _edits() -> tuple[np.ndarray, np.ndarray]:
    """Cost and next state by symbol (fault * 4 + class of the role), state and letter; an insert's row stays where it is."""
    cost, to = np.full((12, 4, 4), _FAR), np.zeros((12, 4, 4), np.int64)
    for symbol in range(12):
        fault, role = divmod(symbol, 4)
        for state in range(4):
            cost[symbol, state, 0], to[symbol, state, 0] = DELETE, state
            cost[symbol, state, 1], to[symbol, state, 1] = INSERT, _NEXT[state]
            if fault == _GONE:
                continue
            extra = TRUNCATED if fault == _CUT else 0
            turn = {_SYSTEM: 0, _USER: 1, _ASSISTANT: 2}
            for after in (_SYSTEM, _USER, _ASSISTANT):
                if role == turn[after] and (after == _SYSTEM and state == _EMPTY or after == _NEXT[state]):
                    cost[symbol, state, 2], to[symbol, state, 2] = KEEP + extra, after
            cost[symbol, state, 3], to[symbol, state, 3] = REROLE + extra, _NEXT[state]
    return cost, to


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of matrices."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), _FAR)


INSERTS = _inserts()
EDIT_COST, EDIT_TO = _edits()
#: What is left to pay at the end of a conversation, by state.
FINAL = _times(INSERTS[None], np.array([0, _FAR, _FAR, 0])[None, :, None])[0, :, 0]


def _row_matrices(symbols: np.ndarray) -> np.ndarray:
    """Inserts, then one edit of the row, from state to state."""
    table = np.full((12, 4, 4), _FAR)
    for letter in (0, 2, 3):
        for symbol in range(12):
            for state in range(4):
                to = EDIT_TO[symbol, state, letter]
                table[symbol, state, to] = min(table[symbol, state, to], EDIT_COST[symbol, state, letter])
    return _times(np.broadcast_to(INSERTS, (12, 4, 4)), table)[symbols]


def _suffixes(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The product of the matrices from each row to the end of its segment, by doubling; ``ends`` is the row after the segment."""
    out, at = _row_matrices(symbols), np.arange(len(symbols))
    step, longest = 1, int((ends - at).max(initial=0))
    while step < longest:
        more = np.flatnonzero(at + step < ends)
        out[more] = _times(out[more], out[more + step])
        step *= 2
    return out


class Segments:
    """Stretches of rows in one block, each of one conversation, with what is left to pay after them."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, exits: np.ndarray, closed: np.ndarray):
        """``closed``: the segment ends its conversation."""
        self.symbols, self.starts = symbols, starts
        sizes = np.diff(np.append(starts, len(symbols)))
        of_row = np.repeat(np.arange(len(starts)), sizes)
        suffix = _suffixes(symbols, (starts + sizes)[of_row])
        # One place per row and one after each segment; a node is a place and a state.
        self.row_place = np.arange(len(symbols)) + of_row
        self.end_place = starts + sizes + np.arange(len(starts))
        costs = np.zeros((len(symbols) + len(starts), 4), np.int64)
        costs[self.row_place] = (suffix + exits[of_row][:, None, :]).min(axis=2)
        costs[self.end_place] = exits
        self.costs = np.minimum(costs, _FAR)
        self._rank(closed)

    def _rank(self, closed: np.ndarray) -> None:
        places = len(self.costs)
        symbol = np.full(places, _GONE * 4)
        symbol[self.row_place] = self.symbols
        weight = EDIT_COST[symbol].copy()  # place, state, letter
        weight[self.end_place] = _FAR  # no row to edit there
        weight[self.end_place[closed], :, 1] = INSERT
        to_place = np.arange(places)[:, None, None] + (np.arange(4) != 1).astype(np.int64)[None, None, :]
        target = np.minimum(to_place, places - 1) * 4 + EDIT_TO[symbol]
        reach = self.costs.reshape(-1)
        best = (weight < _FAR) & (weight + reach[target] == self.costs[:, :, None]) & (self.costs < _FAR)[:, :, None]
        target, best = target.reshape(-1, 4), best.reshape(-1, 4)
        nodes = np.arange(places * 4)
        # Ranks by the first letter; 0 where the path ends.
        self.letter = np.where(best.any(axis=1), best.argmax(axis=1), -1)
        rank, pointer = self.letter + 1, np.where(self.letter < 0, nodes, target[nodes, self.letter])
        length = (self.letter >= 0).astype(np.int64)
        self.pointers = [pointer]
        while (self.letter[pointer] >= 0).any():
            pairs = rank.astype(np.int64) * (rank.max() + 1) + rank[pointer]
            rank = np.unique(pairs, return_inverse=True)[1]
            length = length + length[pointer]
            pointer = pointer[pointer]
            self.pointers.append(pointer)
        # The least edit, by its letter and the rank of all that follows.
        order = np.where(best, np.arange(4) * (rank.max() + 1) + rank[target], np.iinfo(np.int64).max)
        self.letter = np.where(self.letter < 0, -1, order.argmin(axis=1))
        self.rank, self.length, self.last, self.target = rank, length, pointer, target

    def first_nodes(self, states: np.ndarray) -> np.ndarray:
        return self.row_place[self.starts] * 4 + states

    def paths(self, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes on the least paths from the segments' entry states, in order, and the letters of the edits chosen there."""
        first = self.first_nodes(states)
        lengths = self.length[first]
        total = np.cumsum(lengths)
        step = np.arange(total[-1] if len(total) else 0) - np.repeat(total - lengths, lengths)
        node = np.repeat(first, lengths)
        for k in reversed(range(len(self.pointers))):
            node = np.where(step >> k & 1, self.pointers[k][node], node)
        return node, self.letter[node]


def _cut(rows: pd.DataFrame) -> np.ndarray:
    """First rows of the segments of a block in order."""
    key = rows["key"].to_numpy()
    return np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))


def _edges(rows: pd.DataFrame) -> pd.DataFrame:
    """Matrices of the segments that reach the first or last row of their block: their conversations may go on beyond it."""
    rows = rows.sort_values("p")
    starts, symbols = _cut(rows), rows["symbol"].to_numpy()
    ends = np.append(starts[1:], len(rows))
    picked = sorted({0, len(starts) - 1})
    out = []
    for s in picked:
        own = symbols[starts[s] : ends[s]]
        product = _suffixes(own, np.full(len(own), len(own)))[0]
        out.append((int(rows["block"].iloc[0]), rows["key"].iloc[starts[s]], product.reshape(-1).tolist(), int(own[0] % 4)))
    return pd.DataFrame(out, columns=["block", "key", "product", "first_role"])


_FORM = "block long, key string, product array<long>, first_role int"


def _known(rows: pd.DataFrame, about: pd.DataFrame) -> tuple[Segments, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a block, their entry states, whether they end their conversation, and the role that follows."""
    starts = _cut(rows)
    exits = np.tile(FINAL, (len(starts), 1))
    closed, entry, follows = np.ones(len(starts), bool), np.zeros(len(starts), np.int64), np.full(len(starts), -1)
    place = {key: i for i, key in enumerate(rows["key"].to_numpy()[starts])}
    for row in about.itertuples(index=False):
        at = place[row.key]
        if row.exits is not None:
            exits[at], closed[at], follows[at] = row.exits, False, row.next_role
        entry[at] = row.entry
    return Segments(rows["symbol"].to_numpy(), starts, exits, closed), entry, closed, follows


def _maps(rows: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
    """For each segment of ``about`` the state it ends in, by the state it begins in."""
    rows = rows.sort_values("p")
    segments, _, _, _ = _known(rows, about)
    keys = rows["key"].to_numpy()[segments.starts].tolist()
    ends = [segments.last[segments.first_nodes(np.full(len(keys), state))] % 4 for state in range(4)]
    wanted = set(about["key"])
    out = [(int(rows["block"].iloc[0]), key, [int(e[i]) for e in ends]) for i, key in enumerate(keys) if key in wanted]
    return pd.DataFrame(out, columns=["block", "key", "to"])


def _decided(rows: pd.DataFrame, about: pd.DataFrame) -> pd.DataFrame:
    """For each row its edit, the role it gets, the roles inserted before it and, at the end of a conversation, after it."""
    rows = rows.sort_values("p")
    segments, entry, _, follows = _known(rows, about)
    node, letter = segments.paths(entry)
    n = len(rows)
    row_of = np.full(len(segments.costs), -1)
    row_of[segments.row_place] = np.arange(n)
    row = row_of[node // 4]
    role = np.where(segments.target[node, letter] % 4 == _USER, "u", "a")
    before, after = [""] * n, [""] * n
    ends = dict(zip(segments.end_place.tolist(), np.append(segments.starts[1:], n) - 1))
    for i in np.flatnonzero(letter == 1).tolist():
        if row[i] >= 0:
            before[row[i]] += role[i]
        else:
            after[ends[int(node[i] // 4)]] += role[i]
    edited = letter != 1
    edit, given, cost = np.empty(n, dtype=object), np.empty(n, dtype=object), np.zeros(n, np.int64)
    cost[row[edited]] = EDIT_COST[rows["symbol"].to_numpy()[row[edited]], node[edited] % 4, letter[edited]]
    cost += [INSERT * (len(b) + len(a)) for b, a in zip(before, after)]
    edit[row[edited]] = np.array(list(_LETTERS), dtype=object)[letter[edited]]
    given[row[edited]] = role[edited]
    roles = rows["symbol"].to_numpy() % 4
    following = np.append(roles[1:], -1)
    following[np.append(segments.starts[1:], n) - 1] = follows
    allowed = {(ROLES[a], ROLES[b]) for a, b in LEGAL}
    bad = [b >= 0 and (a, b) not in allowed for a, b in zip(roles.tolist(), following.tolist())]
    return pd.DataFrame(
        {
            "place": rows["place"],
            "p": rows["p"],
            "key": rows["key"],
            "edit": edit,
            "given": given,
            "before": before,
            "after": after,
            "cost": cost,
            "illegal": np.array(bad, np.int64),
        }
    )


_DECISION = "place long, p long, key string, edit string, given string, before string, after string, cost long, illegal long"


def _product(a: str, b: str) -> Column:
    """Min-plus product of two 4 x 4 matrices in arrays."""
    cells = [F.least(*[F.col(a)[i * 4 + m] + F.col(b)[m * 4 + j] for m in range(4)], F.lit(int(_FAR))) for i in range(4) for j in range(4)]
    return F.array(*cells)


def _chains(edges: DataFrame, blocks: DataFrame) -> DataFrame | None:
    """For the segments of conversations that run over several blocks: costs after them, the role that follows, and the entry state."""
    runs = edges.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    longest = runs.agg(F.max("n")).first()[0]
    if longest is None:
        return None
    edges = materialize(skew_join(edges, runs.withColumnRenamed("key", "of"), {"key": "of"}, "inner").select("block", "key", "product", "first_role"), "chains")

    def ahead(chain: DataFrame, step: int, *columns: str) -> DataFrame:
        """``chain`` beside itself, ``step`` blocks further on."""
        other = chain.select(F.col("key").alias("_key"), (F.col("block") - step).alias("_block"), *[F.col(c).alias(f"_{c}") for c in columns])
        return skew_join(chain, other, {"key": "_key", "block": "_block"}, "left")

    whole, step = edges, 1
    while step < longest:
        both = ahead(whole, step, "product")
        product = F.when(F.col("_product").isNull(), F.col("product")).otherwise(_product("product", "_product"))
        whole = materialize(both.select("block", "key", product.alias("product"), "first_role"), "chains")
        step *= 2
    costs = F.array(*[F.least(*[F.col("_product")[i * 4 + j] + int(FINAL[j]) for j in range(4)]) for i in range(4)])
    exits = ahead(whole, 1, "product", "first_role").select(
        "block", "key", F.when(F.col("_product").isNotNull(), costs).alias("exits"), F.coalesce("_first_role", F.lit(-1)).alias("next_role"), F.lit(0).alias("entry")
    )
    exits = materialize(exits, "exits")
    maps = materialize(blocks.groupBy("block").cogroup(exits.groupBy("block")).applyInPandas(_maps, "block long, key string, to array<int>"), "maps")
    # ``to`` of a block leads from the state its doubled span of blocks begins in to the state after it; spans end before the block.
    spans = skew_join(maps, maps.select(F.col("key").alias("_key"), (F.col("block") + 1).alias("_block"), F.col("to").alias("_to")), {"key": "_key", "block": "_block"}, "left")
    same = F.array(*map(F.lit, range(4)))
    spans = materialize(spans.select("block", "key", F.coalesce("_to", same).alias("to")), "spans")
    step = 1
    while step < longest:
        earlier = spans.select(F.col("key").alias("_key"), (F.col("block") + step).alias("_block"), F.col("to").alias("_to"))
        both = skew_join(spans, earlier, {"key": "_key", "block": "_block"}, "left")
        through = F.transform(F.coalesce("_to", same), lambda state: F.get("to", state))
        spans = materialize(both.select("block", "key", through.alias("to")), "spans")
        step *= 2
    entry = spans.select(F.col("key").alias("_key"), F.col("block").alias("_block"), F.get("to", F.lit(0)).alias("state"))
    return skew_join(exits, entry, {"key": "_key", "block": "_block"}, "inner").select("block", "key", "exits", "next_role", F.col("state").alias("entry"))


def _decisions(narrow: DataFrame, block: int) -> DataFrame:
    """``narrow`` (p, key, symbol, place) with the edit of each row."""
    blocks = narrow.select(F.expr(f"p div {block}").alias("block"), "p", "key", "symbol", "place")
    edges = materialize(blocks.groupBy("block").applyInPandas(_edges, _FORM), "edges")
    about = _chains(edges, blocks)
    if about is None:
        nothing = pd.DataFrame({"key": [], "exits": [], "next_role": [], "entry": []})
        return blocks.groupBy("block").applyInPandas(lambda rows: _decided(rows, nothing), _DECISION)
    return blocks.groupBy("block").cogroup(about.groupBy("block")).applyInPandas(_decided, _DECISION)


def _ended(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Audit, cost and digest of each conversation, from its rows in order."""
    key, digest, audit, cost, illegal, any_line = None, None, [], 0, 0, False

    def result() -> pd.DataFrame:
        return pd.DataFrame({"key": [key], "audit": ["".join(audit)], "cost": [cost], "illegal": [illegal], "sha": [digest.hexdigest()]})

    for batch in batches:
        columns = (batch[c].tolist() for c in ("key", "letters", "cost", "illegal", "n_lines", "lines"))
        for row_key, letters, row_cost, bad, n_lines, lines in zip(*columns):
            if row_key != key:
                if key is not None:
                    yield result()
                key, digest, audit, cost, illegal, any_line = row_key, hashlib.sha256(), [], 0, 0, False
            audit.append(letters)
            cost += row_cost
            illegal += bad
            if n_lines:
                digest.update((("\n" if any_line else "") + lines).encode())
                any_line = True
    if key is not None:
        yield result()


def _key(conv: Column) -> Column:
    """A conversation id as text that is never null."""
    return F.when(conv.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), conv.cast("string")))


def faults(rows: DataFrame) -> DataFrame:
    """``rows`` (key, turn, role, text, place) numbered in order, without texts: p, key, turn, fault, symbol, place."""
    role, text = F.col("role"), F.col("text")
    bare = F.rtrim(text, F.lit(BLANKS))
    first = F.substring(role, 1, 1)
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    narrow = rows.select(
        "key",
        "turn",
        F.substring(role, 1, 16).alias("start"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        "place",
        kind.alias("kind"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    numbered = serial_ids(narrow, ["key", "turn", "start", "digest", "place"], "p", start=0, unique=True)
    numbered = materialize(numbered, "turns")
    firsts = numbered.groupBy("key", "digest").agg(F.min("p").alias("first_p")).select("first_p")
    known = numbered.join(firsts, numbered["p"] == firsts["first_p"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("first_p").isNull(), "duplicate").when(F.col("cut"), "truncated")
    symbol = F.when(fault == "truncated", _CUT).when(fault.isNotNull(), _GONE).otherwise(_FREE) * 4 + F.col("kind")
    return materialize(known.select("p", "key", "turn", fault.alias("fault"), symbol.cast("int").alias("symbol"), "place"), "faults")


def repaired(df: DataFrame, conv: str, turn: str, role: str, text: str, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair: its rows, and one row for each conversation.

    Rows: key, p (place in all), edit, ``lines`` (``role:text`` of what the row leaves with the turns inserted around it, null if nothing).
    Conversations: ``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    space = F.lit(" ")
    rows = df.select(
        F.col(quoted(conv)).alias("conv"),
        F.col(quoted(turn)).cast("long").alias("turn"),
        F.coalesce(F.col(quoted(role)), space).alias("role"),
        F.coalesce(F.col(quoted(text)), space).alias("text"),
    )
    keyed = rows.withColumn("key", _key(F.col("conv"))).withColumn("place", F.monotonically_increasing_id())
    stored = materialize(keyed, "conversations")
    found = faults(stored)
    decided = materialize(_decisions(found.select("p", "key", "symbol", "place"), block), "edits")

    def inserted(roles: str) -> Column:
        names = F.create_map(F.lit("u"), F.lit("user:"), F.lit("a"), F.lit("assistant:"))
        return F.transform(F.filter(F.split(roles, ""), lambda c: c != ""), lambda c: names[c])

    stripped = stored.select(F.col("place").alias("at"), "role", "text")
    joined = decided.join(stripped, decided["place"] == stripped["at"])
    name = F.when(F.col("edit") == "R", F.when(F.col("given") == "u", "user").otherwise("assistant")).otherwise(F.col("role"))
    own = F.when(F.col("edit") == "D", F.array().cast("array<string>")).otherwise(F.array(F.concat(name, F.lit(":"), F.col("text"))))
    lines = F.concat(inserted("before"), own, inserted("after"))
    shown = joined.select("key", "p", "place", "edit", "before", "after", "cost", "illegal", F.size(lines).alias("n_lines"), F.array_join(lines, "\n").alias("lines"))
    letters = F.concat(F.repeat(F.lit("I"), F.length("before")), F.col("edit"), F.repeat(F.lit("I"), F.length("after")))
    parts = shown.select("key", "p", letters.alias("letters"), "cost", "illegal", "n_lines", "lines")
    ordered = parts.repartition("key").sortWithinPartitions("key", "p")
    ends = ordered.mapInPandas(_ended, "key string, audit string, cost long, illegal long, sha string")

    def count(fault: str) -> Column:
        return F.count(F.when(F.col("fault") == fault, 1)).alias(fault)

    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    per = found.groupBy(F.col("key").alias("of")).agg(gaps, count("blank"), count("duplicate"), count("truncated"))
    ids = stored.groupBy(F.col("key").alias("named")).agg(F.first("conv").alias("conv"))  # one id has one key
    result = ends.join(per, F.col("key") == F.col("of")).join(ids, F.col("key") == F.col("named"))
    result = result.select(F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))
    return shown.select("key", "p", "edit", F.when(F.col("n_lines") > 0, F.col("lines")).alias("lines")), result


def damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows with faults put in by the checksum of ``conv:turn``; nulls become one space. For trials of the repair."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn))) % 20
    content = F.when(lot == 1, F.lit("")).when(lot == 2, F.regexp_replace(shown(text), "[.!?]", "")).otherwise(shown(text))
    speaker = F.when(lot == 4, F.lit("user")).otherwise(shown(role))
    copies = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = df.select(F.col(quoted(conv)).alias("conv"), F.col(quoted(turn)).alias("turn"), speaker.alias("role"), content.alias("text"), lot.alias("lot"), copies.alias("copies"))
    return rows.filter("lot <> 0").select("conv", "turn", "role", "text", F.explode("copies").alias("copy"))
