"""Main text of web pages: what a site repeats goes, what its article has stays.

A page becomes blocks of text in page order, and the token streams of a host's pages are
concatenated. Their suffix array, with the longest common prefix of each two neighbours, gives for
every position the longest run from there that enough distinct pages have. Runs of a few tokens on a
share of the pages, and long ones on a few pages, are boilerplate; covered tokens go, unique runs
stay. Equal pages of a host are one.

A host of many pages is dealt out by a hash of the page into shards of a few hundred, with a suffix
array each. Its runs are counted over all of its shards: a run on a share of the host's pages is on
that share of some shard's, so the shards' own runs are all that can be, and every shard counts them.
Long runs are known by anchors, the least of the hashes of the shorter runs in them, which are the
same wherever the long run is; those whose anchor has enough pages in all shards are counted. So the
shards change no result, but for runs that are told apart by hashes of 64 bits.

What a page says of its elements corrects that. An article that the page marks (``article``, or
``main`` if no article has text) is restored whole, also passages that other pages have, and unique
runs around it go. Inside an article, elements go whose class or id has a word for an advert or
reader comments, alone or as a part (``comments-area``), and those with one for shares, related
pages and the like unless they hold most of it; a part that says header or footer leaves it to the
runs. Chrome (menus, headers, footers, sidebars, forms, and what a role names as such) goes on every
page. On pages without a marked article, other elements are decided by the runs; where a host has
too few pages for any, names and blocks of links decide.

Defined cases: null or empty html gives an empty text and 0 characters; repeated rows are
extracted each; a null url is a host of its own; malformed markup is read as far as it goes, an
open comment or script hides the rest; of a very long page the tokens are one row; an empty table
gives no rows; other columns are ignored, whatever their names. ``br`` is white space inside a block.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from hashlib import blake2b
from html import unescape
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import parts_for, written

#: Pages of a shard, about.
SHARD_PAGES = 256
#: Tokens of a run and the share of a shard's pages that it recurs on, at least.
MIN_RUN = 6
MIN_SHARE = 0.2
#: A run of so many tokens needs but so many pages; and so many pages does a shorter one at least.
LONG_RUN = 50
MIN_PAGES = 3

#: ``NAMED`` is chrome by a class or id alone, and ``INNER`` an article inside of it.
ARTICLE, INNER, MAIN, OPEN, NAMED, CHROME = range(6)
#: What a part of a name says of an element inside an article: it may be an edge or an aside of it.
EDGE, ASIDE = 1, 2

_RAW = "script|style|noscript|template|iframe|noembed|noframes|textarea|title|svg|math|object"
_TOKENS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<close>/?)(?P<tag>[a-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol option optgroup p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
_CHROME_TAGS = frozenset(
    "head nav aside footer form button select fieldset dialog menu search audio video canvas".split()
)
_CHROME_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
_CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside "
    "cookie cookies consent notice notices gdpr popup modal overlay newsletter subscribe signup "
    "login share sharing social related recommended comment comments respond disqus reply replies "
    "pagination pager skip toolbar widget".split()
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_COMMENTS = frozenset("comment comments respond disqus reply replies".split())
# Parts of names inside an article: what is never its own, what may be, and what is at its edges.
_FOREIGN_PARTS = _COMMENTS | set("commentlist ad ads advert adverts advertisement sponsored".split())
_ASIDE_PARTS = frozenset(
    "advertising sponsor promo promotion related recommended share sharing social newsletter "
    "subscribe signup cookie cookies consent gdpr popup login pagination breadcrumb "
    "breadcrumbs".split()
)
_EDGE_PARTS = frozenset("header footer banner nav menu notice notices toolbar widget sidebar".split())
_DENIALS = frozenset("no not has with without hide".split())
_PARTS = re.compile(r"[-_:]+")


class Block(NamedTuple):
    kind: int
    text: str
    links: bool  #: all of it is link text
    mark: int = 0  #: ``EDGE`` or ``ASIDE`` of an article, or nothing


def _chrome(tag: str, rest: str, in_article: bool) -> tuple[int, int]:
    """``CHROME``, ``NAMED`` or ``OPEN``, and a mark: what an element says of itself."""
    if tag in _CHROME_TAGS or (tag == "header" and not in_article):
        return CHROME, 0
    if not rest or tag in ("html", "body", "main"):
        return OPEN, 0
    found, mark = CHROME if _HIDDEN.search(rest) else OPEN, 0
    for name, *values in _NAMES.findall(rest):
        words = set("".join(values).lower().split())
        if words & (_CHROME_ROLES if name.lower() == "role" else _COMMENTS):
            return CHROME, 0
        if name.lower() == "role" or tag == "article":
            continue
        if words & _CHROME_NAMES:
            found = max(found, NAMED)
        if in_article:
            split = (set(_PARTS.split(word)) for word in words)
            parts = {part for of_word in split if not of_word & _DENIALS for part in of_word}
            if parts & _FOREIGN_PARTS:
                found = max(found, NAMED)
            elif parts & _ASIDE_PARTS:
                mark = ASIDE
            elif parts & _EDGE_PARTS:
                mark = mark or EDGE
    return found, mark


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page that have text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, int, int]] = []
    runs: list[str] = []
    kind, mark, linked, plain, in_link = OPEN, 0, False, False, 0

    def close_block() -> None:
        nonlocal linked, plain
        if runs:
            text = " ".join("".join(runs).split())
            if text:
                out.append(Block(kind, text, linked and not plain, mark))
            runs.clear()
        linked = plain = False

    def take(raw: str) -> None:
        nonlocal linked, plain
        if raw:
            text = unescape(raw)
            runs.append(text)
            if text.strip():
                linked, plain = (True, plain) if in_link else (linked, True)

    at = 0
    for token in _TOKENS.finditer(html):
        take(html[at : token.start()])
        at = token.end()
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            runs.append(" ")
        if tag == "a":
            in_link = 0 if token["close"] else 1
        if tag in _BLOCK or tag in _CHROME_TAGS:
            close_block()
        if tag in _VOID:
            continue
        if token["close"]:
            open_tags = [t for t, *_ in stack]
            if tag in open_tags:
                close_block() if tag in _BLOCK else None
                del stack[len(open_tags) - 1 - open_tags[::-1].index(tag) :]
        elif not token["rest"].endswith("/"):
            if tag in _BLOCK and stack and stack[-1][0] == "p":
                stack.pop()  # a paragraph ends where another block begins
            inner, inner_mark = stack[-1][1:] if stack else (OPEN, 0)
            told, told_mark = _chrome(tag, token["rest"], inner in (ARTICLE, INNER, MAIN))
            if CHROME in (inner, told):
                inner = CHROME
            elif tag == "article":
                inner = INNER if inner in (NAMED, INNER) else ARTICLE
            elif tag == "main" and inner in (OPEN, NAMED):
                inner = MAIN
            elif told == NAMED:
                inner = NAMED
            stack.append((tag, inner, max(inner_mark, told_mark)))
        now = stack[-1][1:] if stack else (OPEN, 0)
        if now != (kind, mark):
            close_block()
            kind, mark = now
    take(html[at:])
    close_block()
    return out


def article_of(blocks: list[Block]) -> list[int]:
    """Which blocks are the marked article's; none if the page marks no article with text."""
    for kind in (ARTICLE, INNER, MAIN):
        inside = [i for i, b in enumerate(blocks) if b.kind == kind]
        own = [i for i in inside if blocks[i].mark != ASIDE]
        aside = sum(len(blocks[i].text) for i in inside) - sum(len(blocks[i].text) for i in own)
        if inside:
            # An aside of more than the rest is a name around the article itself.
            return own if own and aside <= sum(len(blocks[i].text) for i in own) else inside
    return []


def text_of(blocks: list[Block], covered: list[np.ndarray] | None = None, told: bool = False) -> str:
    """The main text of a page, from its blocks and which of their tokens lie in repeated runs.

    ``told`` says that the site has enough pages for runs to tell something.
    """
    article = article_of(blocks)
    if article:
        gone = {i for i in article if covered and blocks[i].mark == EDGE and covered[i].all()}
        left = [i for i in article if i not in gone] or article
        return "\n".join(blocks[i].text for i in left)
    texts, doubtful = [], []
    for i, block in enumerate(blocks):
        if block.kind == CHROME:
            continue
        words = block.text.split(" ")
        rest = [w for w, c in zip(words, covered[i], strict=True) if not c] if covered else words
        if rest:
            texts.append(" ".join(rest))
            doubtful.append(not told and (block.kind == NAMED or block.links))
    sure = [text for text, doubt in zip(texts, doubtful, strict=True) if not doubt]
    return "\n".join(sure or texts)


class SuffixArray:
    """All suffixes of some pages' token streams in order, and what each shares with the next.

    The order comes from doubling: ranks by the first one, two, four tokens and so on, which then
    also give the longest common prefixes, without looking at tokens again. Each page's stream ends
    with a token of its own, so no common prefix goes beyond a page.
    """

    def __init__(self, tokens: np.ndarray, page: np.ndarray):
        size = len(tokens)
        self.page = page
        # The rank of a suffix is the place of the first that begins alike; ties alone are sorted again.
        order = np.argsort(tokens, kind="stable")
        at, starts = _groups(np.arange(size), tokens[order])
        ranks = [np.full(size + 1, -1, np.int64)]
        ranks[0][order] = starts
        step = 1
        while len(at):
            rank, tied = ranks[-1], order[at]
            keys = rank[tied] * (size + 1) + rank[np.minimum(tied + step, size)] + 1
            by_key = np.argsort(keys, kind="stable")
            tied = order[at] = tied[by_key]
            at, starts = _groups(at, keys[by_key])
            ranks.append(rank.copy())
            ranks[-1][tied] = starts
            step *= 2
        self.suffixes = order
        # Common prefix of each suffix with the one before it, by ever shorter strides.
        left, right = order[:-1].copy(), order[1:].copy()
        common = np.zeros(max(size - 1, 0), np.int64)
        for k in reversed(range(len(ranks))):
            same = np.flatnonzero(ranks[k][left] == ranks[k][right])
            for x in (common, left, right):
                x[same] += 1 << k
        self.common = np.concatenate([[0], common])

    def pages_with(self, length: int, counted: np.ndarray) -> np.ndarray:
        """For each position, how many of the ``counted`` pages have the run of ``length`` from there."""
        new = self.common < length
        page = self.page[self.suffixes]
        found = counted[page].astype(np.int64)
        # Suffixes that begin like their neighbours, and which of these begin alike.
        at = np.flatnonzero(~(new & np.append(new[1:], True)))
        same = np.cumsum(new[at]) - 1
        taken = counted[page[at]]
        pairs = np.unique(same[taken] * len(counted) + page[at][taken])
        found[at] = np.bincount(pairs // max(len(counted), 1), minlength=len(at))[same]
        out = np.empty_like(found)
        out[self.suffixes] = found
        return out

    def longest_runs(self, pages: int) -> np.ndarray:
        """For each position, the longest run from there that so many distinct pages have, two at least.

        That is the largest common prefix of a window of suffixes with so many pages around the
        position's own. Of these windows those matter that end or begin with it, or are the shortest
        from their first suffix on.
        """
        size = len(self.suffixes)
        best = np.zeros(size, np.int64)
        forward, backward = _windows(self.page[self.suffixes], max(pages, 2))
        at = np.arange(size)
        starts = np.concatenate([at[forward >= 0], backward[backward >= 0]])
        ends = np.concatenate([forward[forward >= 0], at[backward >= 0]])
        if len(starts):
            shared = _least_between(self.common, starts + 1, ends)
            best[self.suffixes] = _largest_over(starts, ends, shared, size)
        return best


def _groups(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key a neighbour has, and for each place the first one of its key."""
    new = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    starts = places[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
    return places[~(new & np.append(new[1:], True)[: len(keys)])], starts


def _windows(page: np.ndarray, pages: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the last and the first place of the shortest window with so many distinct pages
    that begins and ends there; -1 without one."""
    size = len(page)
    forward, backward = np.full(size, -1), np.full(size, -1)
    numbers = page.tolist()
    inside: dict[int, int] = {}
    end = 0
    for start, number in enumerate(numbers):
        while end < size and len(inside) < pages:
            inside[numbers[end]] = inside.get(numbers[end], 0) + 1
            end += 1
        if len(inside) < pages:
            break
        forward[start] = end - 1
        inside[number] -= 1
        if not inside[number]:
            del inside[number]
    # The window that ends at a place begins at the last start whose window is over by then.
    known = np.flatnonzero(forward >= 0)
    if len(known):
        number = np.searchsorted(forward[known], np.arange(size), side="right") - 1
        backward[number >= 0] = known[number[number >= 0]]
    return forward, backward


def _least_between(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The least of ``values`` from each start to its end, both included."""
    level = np.frexp((ends - starts + 1).astype(float))[1] - 1
    out, table = np.zeros(len(starts), values.dtype), values
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[: len(table) - half], table[half:])
        here = np.flatnonzero(level == k)
        out[here] = np.minimum(table[starts[here]], table[ends[here] - (1 << k) + 1])
    return out


def _largest_over(starts: np.ndarray, ends: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """For each place the largest value of the intervals that contain it."""
    level = np.frexp((ends - starts + 1).astype(float))[1] - 1
    table = np.zeros(size, values.dtype)
    for k in reversed(range(int(level.max()) + 1)):
        here = np.flatnonzero(level == k)
        # Two blocks of this length cover each interval, and two of half of it each block.
        np.maximum.at(table, starts[here], values[here])
        np.maximum.at(table, ends[here] - (1 << k) + 1, values[here])
        if k:
            half = 1 << (k - 1)
            table[half:] = np.maximum(table[half:], table[: size - half].copy())
    return table


def repeated(tokens: np.ndarray, page: np.ndarray, rules: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in a run of one of the ``rules``: so long, on so many distinct pages.

    ``tokens`` are the concatenated streams, with a number of its own after each page.
    """
    size = len(tokens)
    covered = np.zeros(size + 1, np.int64)
    if size:
        array = SuffixArray(tokens, page)
        for length, pages in rules:
            runs = array.longest_runs(pages)
            found = np.flatnonzero(runs >= length)
            np.add.at(covered, found, 1)
            np.add.at(covered, found + runs[found], -1)
    return np.cumsum(covered[:size]) > 0


_HOST = r"^(?:[^:/?#]+:)?//([^/?#]*)"


def _parsed(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``host``, a number of its own (``row``) and the blocks of each page.

    ``content`` is a hash of the page, which the first of equal pages of a task ``lead``.
    """
    schema = (
        "row bigint, page_id bigint, url string, host string, "
        "kinds binary, marks binary, links binary, texts string, content bigint, lead boolean"
    )
    names = [f.split()[0] for f in schema.split(", ")]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 32
        seen: set[bytes] = set()
        for batch in batches:
            blocks = [blocks_of(html.as_py()) for html in batch.column("html")]
            found = [
                (bytes(b.kind for b in x), bytes(b.mark for b in x), bytes(b.links for b in x))
                for x in blocks
            ]
            kinds, marks, links = zip(*found, strict=True) if found else ((), (), ())
            # White space inside a block is one blank, so a line break tells blocks apart.
            texts = ["\n".join(b.text for b in x) for x in blocks]
            digests, lead = [], []
            for host, marked, text in zip(batch.column("host").to_pylist(), found, texts, strict=True):
                told = f"{len(host)} {len(text)} {host}{text}".encode()
                digests.append(blake2b(told + b"".join(marked), digest_size=16).digest())
                lead.append(digests[-1] not in seen)
                seen.add(digests[-1])
            columns = [
                pa.array(range(row, row + len(blocks)), pa.int64()),
                *(batch.column(c) for c in ("page_id", "url", "host")),
                *(pa.array(c, pa.binary()) for c in (kinds, marks, links)),
                pa.array(texts, pa.string()),
                pa.array([int.from_bytes(d[:8], "big", signed=True) for d in digests], pa.int64()),
                pa.array(lead, pa.bool_()),
            ]
            row += len(blocks)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return pages.mapInArrow(parse, schema)


def _blocks(kinds: bytes, marks: bytes, links: bytes, texts: str) -> list[Block]:
    if not kinds:
        return []
    columns = zip(kinds, texts.split("\n"), links, marks, strict=True)
    return [Block(kind, text, bool(link), mark) for kind, text, link, mark in columns]


class Rules(NamedTuple):
    """What counts as a repeated run."""

    min_run: int = MIN_RUN
    min_pages: int = MIN_PAGES
    min_share: float = MIN_SHARE
    long_run: int = LONG_RUN

    def repeats(self, n: int) -> list[tuple[int, int]]:
        """How long runs on how many of a host's ``n`` pages are repeated ones: short and long ones."""
        share = int(np.ceil(self.min_share * n))
        return [(self.min_run, max(self.min_pages, share, 2)), (self.long_run, max(self.min_pages, 2))]


class Streams:
    """The token streams of some pages, one after another. Equal pages are one."""

    def __init__(self, pages: list[list[Block]]):
        numbers: dict[tuple, int] = {}
        #: Which of the distinct pages each page is.
        self.same = [numbers.setdefault(tuple(blocks), len(numbers)) for blocks in pages]
        self.pages = [list(blocks) for blocks in numbers]
        words: defaultdict[str, int] = defaultdict()
        words.default_factory = words.__len__
        tokens: list[int] = []
        sizes = []
        for i, blocks in enumerate(self.pages):
            before = len(tokens)
            for block in blocks:
                tokens.extend(map(words.__getitem__, block.text.split(" ")))
            tokens.append(-1 - i)  # its own
            sizes.append(len(tokens) - before)
        self.words = list(words)
        self.tokens, self.sizes = np.array(tokens, np.int64), np.array(sizes, np.int64)
        self.page = np.repeat(np.arange(len(sizes)), self.sizes)
        #: How many tokens the page has from each position on.
        self.left = np.repeat(np.cumsum(self.sizes), self.sizes) - np.arange(len(self.tokens)) - 1

    @cached_property
    def hashes(self) -> np.ndarray:
        of_words = pd.util.hash_array(np.array(self.words, object), categorize=False)
        out = np.zeros(len(self.tokens), np.uint64)
        out[self.tokens >= 0] = of_words[self.tokens[self.tokens >= 0]]
        return out

    def run_keys(self, length: int, site: int) -> np.ndarray:
        """A hash of the site and the run of ``length`` from each position; any where the page is over."""
        level = self.hashes
        out, done, bit = np.zeros_like(level), 0, 1
        while done < length:
            if length & bit:
                out += _ahead(level, done, 0) * _power(done)
                done += bit
            if done < length:
                level = level + _ahead(level, bit, 0) * _power(bit)
            bit *= 2
        return _mixed(out + np.uint64((site * 0x9E3779B97F4A7C15 + length) % 2**64))

    def anchors(self, length: int, site: int) -> tuple[np.ndarray, np.ndarray]:
        """For each position the anchor of the run of ``length`` from there, and the keys that it is of."""
        keys = self.run_keys(anchor_length(length), site)
        least, width, done = keys, length - anchor_length(length) + 1, 1
        while done < width:
            step = min(done, width - done)
            least = np.minimum(least, _ahead(least, step, _LAST))
            done += step
        return least, keys

    def texts(self, covered: np.ndarray, told: bool) -> list[tuple[str, int]]:
        """For each page its text, and how many tokens of a marked article are ``covered``."""
        out = []
        for blocks, end, size in zip(self.pages, np.cumsum(self.sizes), self.sizes, strict=True):
            lengths = [block.text.count(" ") + 1 for block in blocks]
            of_blocks = np.split(covered[end - size : end - 1], np.cumsum(lengths)[:-1]) if blocks else []
            restored = sum(int(of_blocks[i].sum()) for i in article_of(blocks))
            out.append((text_of(blocks, of_blocks, told), restored))
        return [out[i] for i in self.same]


_LAST = np.uint64(2**64 - 1)


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(0xD1342543DE82EF95, exponent, 2**64))


def _ahead(values: np.ndarray, by: int, rest: int | np.uint64) -> np.ndarray:
    """For each place the value so many places on; ``rest`` beyond the last."""
    out = np.full_like(values, rest)
    out[: max(len(values) - by, 0)] = values[by:]
    return out


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def anchor_length(length: int) -> int:
    return max(length // 3, 1)


def shard_texts(pages: list[list[Block]], rules: Rules = Rules()) -> list[tuple[str, int]]:
    """For each page of a whole host its text, and how many tokens of a marked article are repeated ones.

    Equal pages are one in the suffix array.
    """
    streams = Streams(pages)
    n = len(streams.pages)
    covered = repeated(streams.tokens, streams.page, rules.repeats(n))
    return streams.texts(covered, n >= rules.min_pages)


#: What a message tells of a host: its pages and possible short runs, anchors, and runs of each rule.
SITE, ANCHOR, SHORT, LONG = range(4)
#: A message to the ``bucket`` that adds up, or from there to a group. Of the ``group``'s pages of a
#: site, ``counts`` have each of the ``keys``; those of ``least`` pages in all go back to the group.
_MESSAGE = "bucket int, `group` int, site bigint, kind int, least bigint, keys binary, counts binary"
_MESSAGE_COLUMNS = ["bucket", "group", "site", "kind", "least", "keys", "counts"]
#: Pages whose keys one bucket adds up, about.
BUCKET_PAGES = 4096


class Shard(NamedTuple):
    """A group's pages of one large host."""

    rows: pd.DataFrame
    group: int
    site: int
    streams: Streams
    leads: np.ndarray  #: which distinct pages count here; others are counted in another shard


def _shards(group: pd.DataFrame) -> Iterator[Shard]:
    for _, rows in group[group["large"]].sort_values("row").groupby("host", sort=True):
        streams = Streams(_pages(rows))
        leads = np.zeros(len(streams.pages), bool)
        leads[np.array(streams.same)[rows["lead"].to_numpy(bool)]] = True
        yield Shard(rows, int(rows["group"].iloc[0]), int(rows["site"].iloc[0]), streams, leads)


def _pages(rows: pd.DataFrame) -> list[list[Block]]:
    return [_blocks(*page) for page in zip(*(rows[c] for c in ("kinds", "marks", "links", "texts")), strict=True)]


def _messages(
    shard: Shard, kind: int, least: int, keys: np.ndarray, counts: np.ndarray, buckets: int
) -> Iterator[tuple]:
    """Each key to the bucket that adds up its counts."""
    bucket = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, ends) if len(keys) else ():
        yield (
            int(bucket[part[0]]), shard.group, shard.site, kind, least,
            keys[part].tobytes(), counts[part].astype(np.uint32).tobytes(),
        )


def _local_runs(shard: Shard, rules: Rules, buckets: int) -> Iterator[tuple]:
    """What short runs of a shard may be repeated ones of the host, and all anchors of long runs."""
    streams, n = shard.streams, int(shard.leads.sum())
    array = SuffixArray(streams.tokens, streams.page)
    pages = array.pages_with(rules.min_run, shard.leads)
    # Some shard has the host's share at least; less a little, as these are floating-point numbers.
    may = (streams.left >= rules.min_run) & (pages > 0) & (pages >= rules.min_share * n - 1e-6)
    keys = np.unique(streams.run_keys(rules.min_run, shard.site)[may])
    yield shard.site % buckets, shard.group, shard.site, SITE, n, keys.tobytes(), b""
    length = anchor_length(rules.long_run)
    least, keys = streams.anchors(rules.long_run, shard.site)
    found = np.unique(least[streams.left >= rules.long_run])
    if len(found):
        number = np.minimum(np.searchsorted(found, keys), len(found) - 1)
        at = np.flatnonzero((streams.left >= length) & (found[number] == keys))
        counts = np.zeros(len(found), np.int64)
        counts[number[at]] = array.pages_with(length, shard.leads)[at]
        yield from _messages(shard, ANCHOR, max(rules.min_pages, 2), found, counts, buckets)


def _counted_runs(
    shard: Shard, told: dict[tuple[int, int], np.ndarray], n: int, rules: Rules, buckets: int
) -> Iterator[tuple]:
    """How many pages of a shard have each run that may be a repeated one of the host."""
    streams = shard.streams
    yield shard.site % buckets, shard.group, shard.site, SITE, shard.leads.sum(), b"", b""
    for (length, least), kind, by in zip(rules.repeats(n), (SHORT, LONG), (SITE, ANCHOR), strict=True):
        known = told.get((shard.site, by), ())
        if not len(known):
            continue
        keys = streams.run_keys(length, shard.site)
        marks = streams.anchors(length, shard.site)[0] if by == ANCHOR else keys
        at = np.flatnonzero((streams.left >= length) & np.isin(marks, known))
        found, number = np.unique(keys[at], return_inverse=True)
        pairs = np.unique(number * len(shard.leads) + streams.page[at])
        counts = np.zeros(len(found), np.int64)
        np.add.at(counts, pairs // len(shard.leads), shard.leads[pairs % len(shard.leads)])
        yield from _messages(shard, kind, least, found, counts, buckets)


def _covered(shard: Shard, told: dict[tuple[int, int], np.ndarray], rules: Rules) -> np.ndarray:
    """Which tokens of a shard lie in a run that the host repeats."""
    streams = shard.streams
    edges = np.zeros(len(streams.tokens) + 1, np.int64)
    for kind, length in ((SHORT, rules.min_run), (LONG, rules.long_run)):
        if (known := told.get((shard.site, kind))) is not None:
            keys = streams.run_keys(length, shard.site)
            at = np.flatnonzero((streams.left >= length) & np.isin(keys, known))
            edges[at] += 1
            edges[at + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def _added_up(messages: pd.DataFrame) -> pd.DataFrame:
    """The messages of a bucket, each with those of its keys that have pages enough in all groups."""
    out = []
    sites = messages[messages["kind"] == SITE]
    for site, rows in sites.groupby("site"):
        keys = np.unique(np.frombuffer(b"".join(rows["keys"]), np.uint64)).tobytes()
        n = int(rows["least"].sum())
        out += [(0, int(group), int(site), SITE, n, keys, b"") for group in rows["group"].unique()]
    for kind, rows in messages[messages["kind"] != SITE].groupby("kind"):
        keys = np.frombuffer(b"".join(rows["keys"]), np.uint64)
        counts = np.frombuffer(b"".join(rows["counts"]), np.uint32)
        _, first, number = np.unique(keys, return_index=True, return_inverse=True)
        sizes = [len(x) // 8 for x in rows["keys"]]
        least = np.repeat(rows["least"].to_numpy(np.int64), sizes)
        enough = (np.bincount(number, counts) >= least[first])[number]
        for of, ok, group, site in zip(
            np.split(keys, np.cumsum(sizes)[:-1]), np.split(enough, np.cumsum(sizes)[:-1]),
            rows["group"], rows["site"], strict=True,
        ):
            if ok.any():
                out.append((0, int(group), int(site), int(kind), 0, of[ok].tobytes(), b""))
    return pd.DataFrame(out, columns=_MESSAGE_COLUMNS)


def _told(messages: pd.DataFrame) -> tuple[dict[int, int], dict[tuple[int, int], np.ndarray]]:
    """From the messages to a group: the pages of each site, and its keys of each kind."""
    sites = messages[messages["kind"] == SITE]
    pages = dict(zip(sites["site"].tolist(), sites["least"].tolist(), strict=True))
    keys = {
        (int(site), int(kind)): np.frombuffer(b"".join(rows["keys"]), np.uint64)
        for (site, kind), rows in messages.groupby(["site", "kind"])
    }
    return pages, keys


def main_text(
    pages: DataFrame,
    shard_pages: int = SHARD_PAGES,
    min_run: int = MIN_RUN,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    long_run: int = LONG_RUN,
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` and ``n_repeated`` of each of ``pages`` (``html``).

    ``n_repeated`` counts the tokens of a marked article that its site repeats and that were restored.
    Pages are parsed once, and their blocks are shuffled once. ``shard_pages`` says how many pages of a
    host share a suffix array and changes no result.
    """
    rules = Rules(min_run, min_pages, min_share, long_run)
    url = F.col("url").cast("string")
    given = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        url.alias("url"),
        F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    sizes = F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("html")).alias("distinct")
    counts = written(given.groupBy("host").agg(*sizes), "hosts")
    total, largest = counts.agg(F.sum("n"), F.max("n")).first()
    total, largest = total or 0, largest or 0
    # Hosts of one shard need no number, so only larger ones are joined.
    large = written(
        counts.where(F.col("n") > shard_pages).select(
            "host",
            F.ceil(F.col("n") / shard_pages).alias("shards"),
            F.ceil(F.greatest("distinct", F.lit(1)) / shard_pages).alias("lead_shards"),
        ),
        "large-hosts",
    )
    # Equal pages lead in one shard. The others of a task, which may be many, are dealt out alike.
    shard = F.when(F.col("lead"), F.pmod("content", F.col("lead_shards"))).otherwise(
        F.pmod(F.xxhash64("row"), F.col("shards"))
    )
    dealt = _parsed(given).join(large, "host", "left")
    # Shards of small hosts share groups, of which there are many more than tasks.
    groups = F.pmod(F.xxhash64("host", F.coalesce(shard, F.lit(0))), F.lit(parts_for(total, shard_pages)))
    grouped = dealt.select(
        # As text, since pandas would make floating-point numbers of ids with a null among them.
        *(groups.cast("int").alias("group"), F.col("page_id").cast("string").alias("page_id"), "url", "host"),
        *("row", "kinds", "marks", "links", "texts", "lead"),
        F.col("shards").isNotNull().alias("large"),
        F.xxhash64("host").alias("site"),
    ).groupBy("group")
    buckets = parts_for(total, BUCKET_PAGES)

    def find(group: pd.DataFrame) -> pd.DataFrame:
        found = [m for shard in _shards(group) for m in _local_runs(shard, rules, buckets)]
        return pd.DataFrame(found, columns=_MESSAGE_COLUMNS)

    def count(group: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        n, told = _told(messages)
        found = [m for s in _shards(group) for m in _counted_runs(s, told, n[s.site], rules, buckets)]
        return pd.DataFrame(found, columns=_MESSAGE_COLUMNS)

    def tell_small(group: pd.DataFrame) -> list[pd.DataFrame]:
        found = []
        for _, rows in group[~group["large"]].sort_values("row").groupby("host", sort=True):
            found.append(_with_texts(rows, shard_texts(_pages(rows), rules)))
        return found

    def tell(group: pd.DataFrame) -> pd.DataFrame:
        return pd.concat(tell_small(group))

    def tell_all(group: pd.DataFrame, messages: pd.DataFrame) -> pd.DataFrame:
        n, told = _told(messages)
        found = tell_small(group)
        for shard in _shards(group):
            texts = shard.streams.texts(_covered(shard, told, rules), n[shard.site] >= min_pages)
            found.append(_with_texts(shard.rows, texts))
        return pd.concat(found)

    schema = "page_id string, url string, text string, n_repeated bigint"
    if largest <= shard_pages:
        texts = grouped.applyInPandas(tell, schema)
    else:
        # All three read the same shuffled pages.
        possible = grouped.applyInPandas(find, _MESSAGE).groupBy("bucket").applyInPandas(_added_up, _MESSAGE)
        counted = grouped.cogroup(possible.groupBy("group")).applyInPandas(count, _MESSAGE)
        repeats = counted.groupBy("bucket").applyInPandas(_added_up, _MESSAGE)
        texts = grouped.cogroup(repeats.groupBy("group")).applyInPandas(tell_all, schema)
    return texts.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        "url",
        "text",
        F.length("text").cast("bigint").alias("n_chars"),
        "n_repeated",
    )


def _with_texts(rows: pd.DataFrame, texts: list[tuple[str, int]]) -> pd.DataFrame:
    text, n_repeated = zip(*texts, strict=True)
    return rows[["page_id", "url"]].assign(text=text, n_repeated=n_repeated)
