"""HTML extraction: marked-up noise goes, and then lines that a page shares with its neighbour by URL.

A page becomes lines, one for each block of text. Lines in menus, headers, footers, sidebars, adverts, forms, comments and the
like, told by element, role, class or id, are noise. A class or id counts as a whole: all its words must be those of noise or of
layout, so ``has-banner`` or ``content-sidebar-wrap`` do not count. An element that is noise by its class alone is none after all
if it holds the article (or main part) of a page that has no better one outside such elements, or, where no article or main part is
marked, most of the page's long lines. If the page marks its article (else its main part), only what is inside counts. The pages of a host are
put in order of path, and each is aligned with the next one (the last with the one before) by a longest common
subsequence of their lines: a shared line is what the site repeats, and is deleted. Copies tell nothing of the site: pages of a host
whose lines beside the noise are all equal count as one page, at the first one's place, and pages of one URL or without such lines are
passed over. A page that has no other page to compare with keeps its lines. Paragraphs, headings, list items and the like inside a marked article are
its text even if another page has them too; they stay.

Character references are decoded; white space within a block is one space; blocks are joined by two line breaks. Null or empty
pages have an empty text. A tag that the end of the page cuts off is dropped. Rows with repeated or null ids are rows of their own; pages with a null URL share the empty host.
"""

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, StringType

from playlake.llm.url_filter import host_and_path
from playlake.operators.ids import serial_ids
from playlake.operators.joins import skew_join
from playlake.storage import materialize, with_place

TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))*+)(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Elements of HTML by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOISE = frozenset("nav header footer aside form script style noscript template iframe svg button select textarea menu dialog head title object canvas".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote td th dt dd figcaption caption".split())
BLOCKS = PROSE | NOISE | frozenset(
    "html body article main section div ul ol dl table thead tbody tfoot tr figure hr address fieldset details summary center".split()
)
CLOSES_P = BLOCKS - {"html", "body", "head", "title", "script", "style", "template", "noscript", "button", "svg", "td", "th", "object", "canvas", "iframe", "select", "textarea"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
MARKS = frozenset(
    "ad ads adbox adslot advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices newsletter "
    "subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead share sharing social related recommended "
    "comment comments commentlist disqus reply replies respond popup modal overlay widget login signup pagination pager toolbar hidden".split()
)

#: Those of an article that is not the page's own.
ARTICLE_MARKS = frozenset("comment comments reply related ad advert advertisement promo sponsored".split())
#: Words that a class or id of noise may have beside those.
LAYOUT = frozenset(
    "site page main top bottom left right primary secondary global area box bar block container wrap wrapper inner outer list lists link links button "
    "buttons icon icons post posts article articles story stories section form slot unit widget item items row column col group panel js "
    "app desktop mobile sticky fixed".split()
)

_NOISE, _LINE, _TEXT = 0, 1, 2
#: Characters from which a line is long, as menus and buttons are not.
_LONG = 40
#: Pages that a Python task works on at once.
HANDED_ON = 250


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)}


def _hidden(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is noise by its role or because it is not shown."""
    if name in ("html", "body", "main"):
        return False
    return attributes.get("role", "").lower() in ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true"


def _marked(name: str, attributes: dict[str, str]) -> bool:
    """Whether an element is noise by its class or id."""
    if name in ("html", "body", "main"):
        return False
    marks = ARTICLE_MARKS if name == "article" else MARKS
    for whole in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        tokens = {t for t in re.split(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])", whole) if t and not t.isdigit()}
        if tokens & marks and tokens <= marks | MARKS | LAYOUT:
            return True
    return False


def lines(page: str) -> list[tuple[str, int, int]]:
    """(text, kind, place) of every block: kind is noise, a line, or prose; place is 2 in an article, 1 in a main part, else 0."""
    out: list[tuple[str, int, int]] = []
    # name, noise, place, prose, elements around that are noise by class: outside of the article or main part, and from there on
    open_: list[tuple[str, bool, int, bool, tuple[int, ...], tuple[int, ...]]] = []
    doubtful: dict[int, tuple[int, tuple[int, ...], tuple[int, ...]]] = {}  # by line: kind, and those elements
    n_marked = 0
    buffer: list[str] = []
    state = (False, 0, False, (), ())

    def flush() -> None:
        text = " ".join(html.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            noise, place, prose, around, within = state
            kind = _NOISE if noise else _TEXT if prose else _LINE
            if not noise and (around or within):
                doubtful[len(out)] = (kind, around, within)
                kind = _NOISE
            out.append((text, kind, place))

    def top() -> tuple[bool, int, bool, tuple[int, ...], tuple[int, ...]]:
        return open_[-1][1:] if open_ else (False, 0, False, (), ())

    at, raw_until = 0, re.compile("")
    while at < len(page):
        m = TAG.search(page, at)
        if m is None:
            buffer.append(page[at:])
            break
        buffer.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if name in BLOCKS:
            flush()
        elif name == "br":
            buffer.append(" ")
        if m[1]:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == name:
                    del open_[depth:]
                    break
            state = top()
            continue
        if name in VOID:
            continue
        if name in CLOSES_P:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] == "p":
                    del open_[depth:]
                    break
                if open_[depth][0] in BLOCKS:
                    break
        if name in SIBLINGS:
            for depth in range(len(open_) - 1, -1, -1):
                if open_[depth][0] in SIBLINGS[name]:
                    del open_[depth:]
                    break
                if open_[depth][0] in ("ul", "ol", "dl", "table", "tr", "select"):
                    break
        attributes = _attributes(m[3]) if m[3].strip() else {}
        noise, place, prose, around, within = top()
        noise = noise or (name in NOISE and not (name == "header" and place == 2)) or bool(attributes and _hidden(name, attributes))
        before = place
        if name == "article" or "articlebody" in attributes.get("itemprop", "").lower():
            place, prose = 2, False
        elif (name == "main" or attributes.get("role", "").lower() == "main") and place < 2:
            place, prose = 1, False
        if place > before:
            around, within = around + within, ()
        if attributes and _marked(name, attributes):
            n_marked += 1
            within = (*within, n_marked)
        if name in RAW:
            raw_until = re.compile(rf"</{name}(?![a-z0-9])", re.IGNORECASE)
            end = raw_until.search(page, at)
            at = end.start() if end else len(page)
            continue
        open_.append((name, noise, place, prose or name in PROSE, around, within))
        state = top()
    flush()
    for i, kind in _cleared(out, doubtful).items():
        out[i] = (out[i][0], kind, out[i][2])
    return out


def _cleared(found: list[tuple[str, int, int]], doubtful: dict[int, tuple[int, tuple[int, ...], tuple[int, ...]]]) -> dict[int, int]:
    """Kinds of the lines that are no noise after all, though an element around them looks like it by its class."""
    if not doubtful:
        return {}
    sizes: dict[int, int] = {}  # characters that are no noise, by place
    for text, kind, place in found:
        if kind != _NOISE:
            sizes[place] = sizes.get(place, 0) + len(text)
    held = {i: kind for i, (kind, _, within) in doubtful.items() if found[i][2] and not within}
    best = max((found[i][2] for i in held), default=0)
    if best and max(sizes, default=0) < best and sum(len(found[i][0]) for i in held if found[i][2] == best) >= sum(sizes.values()):
        return held
    if any(sizes.get(place) for place in (1, 2)):
        return {}
    every, parts = 0, {}
    for i, (text, kind, _) in enumerate(found):
        if len(text) >= _LONG and (kind != _NOISE or i in doubtful):
            every += len(text)
            for element in sum(doubtful[i][1:], ()) if i in doubtful else ():
                parts[element] = parts.get(element, 0) + len(text)
    spared = {element for element, size in parts.items() if 2 * size > every}
    return {i: kind for i, (kind, around, within) in doubtful.items() if spared.issuperset(around + within)}


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` that a longest common subsequence with ``b`` takes."""
    start = 0
    while start < len(a) and start < len(b) and a[start] == b[start]:
        start += 1
    end = 0
    while end < len(a) - start and end < len(b) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    middle_a, middle_b = a[start : len(a) - end], b[start : len(b) - end]
    inner = _aligned(middle_a, middle_b) if middle_a and middle_b else []
    return [*range(start), *(start + i for i in inner), *range(len(a) - end, len(a))]


def _states(a: list[int], b: list[int]) -> list[int]:
    """A bit vector for each line of ``a``: bit j is zero where one more line of ``b`` lengthens the common subsequence."""
    masks: dict[int, int] = {}
    for j, line in enumerate(b):
        masks[line] = masks.get(line, 0) | 1 << j
    every = state = (1 << len(b)) - 1
    states = []
    for line in a:
        hit = state & masks.get(line, 0)
        state = ((state + hit) | (state - hit)) & every
        states.append(state)
    return states


def _aligned(a: list[int], b: list[int], most: int = 1 << 28) -> list[int]:
    if len(a) * len(b) > most and len(a) > 1:  # in halves, so that the vectors of one half at a time are held
        half = len(a) // 2

        def reached(x: list[int], y: list[int]) -> np.ndarray:
            bits = np.unpackbits(np.frombuffer(_states(x, y)[-1].to_bytes(len(y) // 8 + 1, "little"), np.uint8), bitorder="little")
            return np.concatenate(([0], np.cumsum(1 - bits[: len(y)].astype(np.int64))))

        cut = int(np.argmax(reached(a[:half], b) + reached(a[half:][::-1], b[::-1])[::-1]))
        return common_lines(a[:half], b[:cut]) + [half + i for i in common_lines(a[half:], b[cut:])]
    states, out = _states(a, b), []
    i, j = len(a), len(b)
    while i and j:
        if states[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or states[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append(i)
    return out[::-1]


def _keys(found: list[tuple[str, int, int]]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(text) - (1 << 63) for text, _, _ in found]


def _content(found: list[tuple[str, int, int]], keys: np.ndarray) -> int | None:
    """One hash of all lines that are not noise; none if there are none."""
    own = [kind != _NOISE for _, kind, _ in found]
    return xxhash.xxh3_64_intdigest(keys[own].tobytes()) - (1 << 63) if any(own) else None


def _text(found: list[tuple[str, int, int]], shared: set[int]) -> str:
    """The lines that stay: all text of an article, and what the neighbour does not share."""
    inside = max((place for _, kind, place in found if kind != _NOISE), default=0)
    kept = (
        text
        for i, (text, kind, place) in enumerate(found)
        if kind != _NOISE and place >= inside and ((inside and kind == _TEXT) or i not in shared)
    )
    return "\n\n".join(kept)


def _find_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), HANDED_ON):
            part = batch.iloc[at : at + HANDED_ON]
            found = [lines(page or "") for page in part["page"]]
            keys = [np.array(_keys(f), dtype=np.int64) for f in found]
            contents = pd.Series([_content(f, k) for f, k in zip(found, keys)], index=part.index, dtype="Int64")
            yield part[["row", "host", "path", "name"]].assign(lines=keys, content=contents)


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Places of the lines that a page shares with its neighbour."""
    for batch in batches:
        for at in range(0, len(batch), HANDED_ON):
            part = batch.iloc[at : at + HANDED_ON]
            shared = [np.array(common_lines(list(a), list(b)), dtype=np.int32) for a, b in zip(part["lines"], part["other_lines"])]
            yield pd.DataFrame({"of": part["row"].to_numpy(), "shared": shared})


def _compressed(pages: pd.Series) -> pd.Series:
    return pages.map(lambda page: zstandard.compress((page or "").encode(), 1))


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), HANDED_ON):
            part = batch.iloc[at : at + HANDED_ON]
            texts = [
                _text(lines(zstandard.decompress(page).decode()), set() if shared is None else set(np.asarray(shared).tolist()))
                for page, shared in zip(part["page"], part["shared"])
            ]
            yield part[["id", "url"]].assign(text=texts)


def main_texts(df: DataFrame, page_id: str, url: str, page: str, from_scan: bool = False) -> DataFrame:
    """(``page_id``, ``url``, text) for every row of ``df``.

    Only hashes of lines are aligned; a page itself is shuffled once, compressed. ``from_scan`` says that ``df`` is a scan of files;
    otherwise it is written first, so that rows keep their places.
    """
    host, path = host_and_path(F.col(url))
    pages = df.select(F.col(page_id).alias("id"), F.col(url).alias("url"), host.alias("host"), path.alias("path"), F.col(page).alias("page"))
    pages = with_place(pages, "row", from_scan)
    name = F.coalesce("url", F.format_string("%020d", "row")).alias("name")  # pages without a URL are no copies by it
    keys = pages.select("row", "host", "path", name, "page").mapInPandas(
        _find_lines, "row long, host string, path string, name string, lines array<long>, content long"
    )
    stored = materialize(keys, "page-lines")
    firsts = stored.filter("content is not null").groupBy("host", "content").agg(F.min(F.struct("path", "name", "row")).alias("first"))
    firsts = materialize(firsts.select("host", "content", "first.*"), "page-contents")
    places = firsts.groupBy("host", "path", "name").agg(F.min("row").alias("row"))
    order = materialize(serial_ids(places, ["host", "path", "name"], name="pos", unique=True), "page-order")
    after = order.select(F.col("pos").alias("p1"), F.col("host").alias("h1"), F.col("name").alias("after_name"), F.col("row").alias("after"))
    before = order.select(F.col("pos").alias("p2"), F.col("host").alias("h2"), F.col("name").alias("before_name"), F.col("row").alias("before"))
    beside = (
        order.join(after, (order["pos"] + 1 == after["p1"]) & (order["host"] == after["h1"]), "left")
        .join(before, (order["pos"] - 1 == before["p2"]) & (order["host"] == before["h2"]), "left")
        .select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("name").alias("n"), "after_name", "after", "before_name", "before")
    )
    same_place = (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")) & (F.col("name") == F.col("n"))
    partners = firsts.join(beside, same_place).select("h", F.col("content").alias("c"), "after_name", "after", "before_name", "before")
    partners = materialize(partners, "page-partners")
    other = F.when(F.col("after_name") != F.col("name"), F.col("after")).when(F.col("before_name") != F.col("name"), F.col("before"))
    pairs = skew_join(stored.select("row", "host", "name", "content"), partners, {"host": "h", "content": "c"}, "inner")
    pairs = pairs.select(F.col("row").alias("of"), other.alias("other")).filter("other is not null")
    own = stored.select("row", "lines")
    theirs = stored.select(F.col("row").alias("r"), F.col("lines").alias("other_lines"))
    with_own = pairs.join(own, F.col("of") == F.col("row"))
    both = skew_join(with_own, theirs, {"other": "r"}, "inner").select("row", "lines", "other_lines")
    shared = materialize(both.mapInPandas(_align, "of long, shared array<int>"), "shared-lines")
    packed = pages.select("id", "url", "row", F.pandas_udf(_compressed, BinaryType())(F.coalesce("page", F.lit(""))).alias("page"))
    joined = packed.join(shared, packed["row"] == shared["of"], "left").select("id", "url", "page", "shared")
    kind = df.select(F.col(page_id).alias("id"), F.col(url).alias("url")).schema
    texts = joined.mapInPandas(_extract, kind.add("text", StringType()))
    return texts.select(F.col("id").alias(page_id), F.col("url").alias(url), "text")
