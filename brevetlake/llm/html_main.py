"""Main text of web pages.

A tolerant parser cuts a page into blocks of text and leaves out what its elements declare as furniture: navigation, forms,
scripts and so on.  Elements whose class, id or role says the same have a vote: their blocks go where other text is left, in an
undeclared page at least `REST` of it; a page that has hardly anything else is not judged by such words.  Then the
host's pages decide, all of them: the token streams of their blocks are concatenated, the end of a block being a token like any other, and a
suffix array finds long runs of tokens that distinct pages repeat, across blocks too, so that menus of short blocks are such runs.  A block that
such runs cover counts its words against the text, any other for it, and each block end is one word against it: the stretch of blocks with
the greatest sum stays.  So furniture around an article goes, and what an article has in common with others stays inside it; repeated
blocks at its very ends go, too.  A page without any repeated block stays whole; one of nothing else has no text.

Where a page declares its article (articles in the main part, else the main part, else articles), a check follows: the declared blocks are
the text, its repeated ends too, unless the host repeats all of them and the stretch has at least `REST` of the page's letters, as
where the main part holds a notice only.

The pages of a host are dealt into shards of bounded size by the hash of their id, each with a suffix array of its own.
A shard counts the distinct pages of every run, the host's shards are summed up by the run's 64-bit hash, and each
shard gets back which of its runs the host repeats: the count is over the whole host, however many shards it has.  Sums are for hosts
that have a page which the runs can decide, one that declares no article or has other text beside it; the other hosts' pages keep what they declare.

Defined cases: a null or empty page has the empty text.  Very long pages are parsed whole; equal blocks of a page are blocks of their
own; extra columns are not read, whatever their names; an empty table gives no row.  Rows that repeat a page_id are parsed alike and count
as one page for repetition.  A null URL has the empty host.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import scan
from .store import cut, small_batches

#: Pages of a shard of a host, about.
SHARD_PAGES = 256
#: Tokens of a repeated run, and distinct pages of the host that hold it, for it to be furniture.
RUN_TOKENS, RUN_PAGES = 4, 3
#: The token that ends a block; no word holds white space.
END = "\n"
#: Share of a block's words that such runs must cover for the block to count as repeated.
COVERED = 0.8
#: Share of an undeclared page's letters that must be left for words of a class to take the others.
REST = 1 / 3

SKIPPED = frozenset("script style noscript template nav footer aside form button select option textarea iframe svg menu dialog head title object embed canvas audio video map datalist".split())
BLOCKS = frozenset("p div section article main header footer aside nav h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address form fieldset hr body html details summary".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
#: Words of a class, id or role that mark furniture.
FURNITURE = frozenset("nav navbar navigation menu menubar sidebar aside footer ad ads advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments reply replies respond discussion related recommended breadcrumb breadcrumbs pagination pager search searchbox widget toolbar masthead skip contentinfo complementary disclaimer paywall".split())
#: Words that mark furniture outside an article only: an article may have a header of its own.
PAGE_FURNITURE = frozenset({"header", "topbar", "site"})
_CLOSES_P = BLOCKS - {"body", "html"}


def _marks(attrs: list[tuple[str, str | None]]) -> set[str]:
    words: set[str] = set()
    for name, value in attrs:
        if name in ("class", "id", "role", "itemprop") and value:
            words.update(value.lower().replace("-", " ").replace("_", " ").split())
    return words


def _hidden(attrs: list[tuple[str, str | None]]) -> bool:
    return any(name == "hidden" or name == "aria-hidden" and value == "true" for name, value in attrs)


class Page(HTMLParser):
    """Blocks of a page, each with its place (an article in the main part, the main part, an article elsewhere, or anywhere else) and whether a class marks it as furniture."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Tag, whether it is left out, whether a class marks it, and bits of its place: 2 inside an article, 1 inside the main part.
        self.stack: list[tuple[str, bool, bool, int]] = []
        # How often each tag is open, and which places of the stack hold blocks or skipped elements: so no step walks the stack, however deep.
        self.open: Counter[str] = Counter()
        self.barriers: list[int] = []
        self.blocks: list[tuple[int, bool, str]] = []
        self.pieces: list[str] = []

    def _place(self) -> tuple[int, bool]:
        return (self.stack[-1][3], self.stack[-1][2]) if self.stack else (0, False)

    def _push(self, tag: str, out: bool, marked: bool, level: int) -> None:
        if tag in BLOCKS or tag in SKIPPED:
            self.barriers.append(len(self.stack))
        self.open[tag] += 1
        self.stack.append((tag, out, marked, level))

    def _cut(self, k: int) -> None:
        """All elements from place `k` on end."""
        for tag, *_ in self.stack[k:]:
            self.open[tag] -= 1
        del self.stack[k:]
        while self.barriers and self.barriers[-1] >= k:
            self.barriers.pop()

    def _out(self) -> bool:
        return bool(self.stack) and self.stack[-1][1]

    def _flush(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            self.blocks.append((*self._place(), text))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("br", "hr") and not self._out():
            self.pieces.append(" ")
        if tag in BLOCKS:
            self._flush()
        if tag in VOID:
            return
        if tag in _CLOSES_P:
            self._close_implied(tag)
        marks, (level, marked) = _marks(attrs), self._place()
        whole = tag in ("html", "body")
        outside = not level & 2
        out = self._out() or not whole and (tag in SKIPPED or _hidden(attrs) or outside and tag == "header")
        marked = marked or not whole and bool(marks & FURNITURE or outside and marks & PAGE_FURNITURE and tag not in ("article", "main"))
        own = 2 if tag == "article" or marks & {"articlebody"} else 1 if tag == "main" or "main" in marks and not whole else 0
        self._push(tag, out, marked, level if out or marked else level | own)

    def _close_implied(self, tag: str) -> None:
        """An open paragraph ends where a block starts, with the inline elements inside; so does an item of a list where the next one starts."""
        ends = {"p"} | ({"li"} if tag == "li" else set()) | ({"dt", "dd"} if tag in ("dt", "dd") else set())
        if self.barriers and self.stack[self.barriers[-1]][0] in ends:
            self._cut(self.barriers[-1])

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        if self.open[tag]:
            k = len(self.stack) - 1
            while self.stack[k][0] != tag:
                k -= 1
            self._cut(k)

    def handle_data(self, data: str) -> None:
        if not self._out():
            self.pieces.append(data)

    def finish(self) -> tuple[bool, list[tuple[bool, str]]]:
        """Whether the page declares its text, and the blocks, each with whether it is declared: articles in the main part, else the main part, else articles.  The marked ones go, of an undeclared page if enough is left."""
        self.close()
        self._flush()
        plain = [(at, t) for at, marked, t in self.blocks if not marked]
        for level in (3, 1, 2):
            if any(at == level for at, _ in plain):
                return True, [(at == level, t) for at, t in plain]
        every = [(False, t) for _, _, t in self.blocks]
        enough = sum(len(t) for _, t in plain) >= REST * sum(len(t) for _, t in every)
        return False, [(False, t) for _, t in plain] if enough else every


def parts(html: str | None) -> tuple[bool, list[tuple[bool, str]]]:
    page = Page()
    page.feed(html or "")
    return page.finish()


def parse(html: str | None) -> tuple[bool, list[str]]:
    """Whether the page declares its text, and the declared blocks, else all."""
    declared, blocks = parts(html)
    return declared, [t for own, t in blocks if own == declared]


def packed(blocks: list[tuple[bool, str]]) -> bytes:
    """Blocks as they travel between tasks, in a third to half of their size; no block holds a line's end."""
    return zlib.compress("\n".join("-+"[own] + t for own, t in blocks).encode("utf-8", "surrogatepass"), 1)


def unpacked(data: bytes) -> list[tuple[bool, str]]:
    return [(x[0] == "+", x[1:]) for x in zlib.decompress(data).decode("utf-8", "surrogatepass").split("\n")]


def suffix_array(tokens: np.ndarray, depth: int | None = None) -> np.ndarray:
    """Starts of the suffixes in order, by doubling the length that ranks stand for, up to `depth` tokens at least: those that agree on them are neighbours."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.full(n, -1, np.int64)
        after[: max(0, n - step)] = rank[step:]
        order = np.lexsort((after, rank))
        new = np.concatenate([[0], np.cumsum((rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1]))]) if n else order
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if not n or new[-1] == n - 1 or step >= min(n, depth or n):
            return order


def stretch(scores: list[int]) -> tuple[int, int]:
    """The blocks from the first of these two numbers up to the second, whose sum of scores, less one for each block end between them, is the greatest above 0; the first of equal ones."""
    best, found, total, first = 0, (0, 0), 0, 0
    for k, score in enumerate(scores):
        if total <= 1:
            total, first = score, k
        else:
            total += score - 1
        if total > best:
            best, found = total, (first, k + 1)
    return found


class Stream:
    """The token stream of some pages (number of the page, blocks): blocks end with a token that all share, pages with one of their own, which no run crosses."""

    def __init__(self, pages: list[tuple[int, list[str]]], length: int):
        self.pages, self.length = pages, length
        self.vocabulary: dict[str, int] = {END: 0}
        known = self.vocabulary
        tokens, sizes = [], []
        self.spans: list[list[tuple[int, int]]] = []
        for k, (_, blocks) in enumerate(pages):
            own, first = [], len(tokens)
            for block in blocks:
                start = len(tokens)
                tokens += [known.setdefault(w, len(known)) for w in block.split()]
                own.append((start, len(tokens)))
                tokens.append(0)
            tokens.append(-1 - k)
            sizes.append(len(tokens) - first)
            self.spans.append(own)
        self.size = len(tokens)
        self._find_runs(np.array(tokens, np.int64), np.repeat(np.array([number for number, _ in pages], np.int64), sizes))
        # A block shorter than a run is one of its own, by its text.
        self.short: dict[str, set[int]] = {}
        for number, blocks in pages:
            for block in blocks:
                if len(block.split()) < length:
                    self.short.setdefault(block, set()).add(number)

    def _find_runs(self, tokens: np.ndarray, page: np.ndarray) -> None:
        """Starts of the runs in the order of the suffix array, the group of equal runs each belongs to, and every group's tokens and number of distinct pages."""
        order = suffix_array(tokens, self.length)
        order = order[order <= len(tokens) - self.length]
        # Neighbours in the array that share the first tokens make one group.
        rows = tokens[order[:, None] + np.arange(self.length)]
        inside = (rows >= 0).all(1)
        self.starts, rows = order[inside], rows[inside]
        first = np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])[: len(rows)]
        self.group = np.cumsum(first) - 1
        self.runs = rows[first]
        most = int(page.max(initial=0)) + 1
        self.counts = np.bincount(np.unique(self.group * most + page[self.starts]) // most, minlength=len(self.runs))

    @cached_property
    def _words(self) -> np.ndarray:
        return np.array([int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little") for w in self.vocabulary], np.uint64)

    @cached_property
    def keys(self) -> np.ndarray:
        """The hash of each run."""
        return scan.window_hashes(self._words[self.runs.ravel()], self.length)[:: self.length]

    @cached_property
    def short_keys(self) -> dict[str, int]:
        return {b: int(scan.window_hashes(self._words[[self.vocabulary[w] for w in own]], len(own))[0]) for b in self.short if (own := b.split())}

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Key and number of distinct pages of each run and of each short block."""
        keys = np.array([self.short_keys[b] for b in self.short_keys], np.uint64)
        counts = np.array([len(self.short[b]) for b in self.short_keys], np.int64)
        return np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts])

    def unique_stretches(self, least: int, shared: np.ndarray) -> list[tuple[list[bool], int, int]]:
        """Which blocks of each page repeat, and its unique stretch, given the runs on `least` pages; `shared` are keys of such runs whose pages are elsewhere in part."""
        wide = self.counts >= least
        if len(shared):
            wide |= np.isin(self.keys, shared)
        starts = self.starts[wide[self.group]]
        edge = np.zeros(self.size + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + self.length, -1)
        total = np.concatenate([[0], np.cumsum(np.cumsum(edge[:-1]) > 0)])
        # A block repeats when runs cover most of it, or all of it is shorter than a run and repeats.
        elsewhere = set(shared.tolist())
        gone = {b for b, held in self.short.items() if len(held) >= least or elsewhere and self.short_keys.get(b) in elsewhere}
        out = []
        for (_, blocks), own in zip(self.pages, self.spans, strict=True):
            repeated = [b in gone or total[e] - total[s] >= COVERED * (e - s) for b, (s, e) in zip(blocks, own, strict=True)]
            first, last = stretch([s - e if r else e - s for (s, e), r in zip(own, repeated, strict=True)]) if any(repeated) else (0, len(blocks))
            out.append((repeated, first, last))
        return out


def checked(blocks: list[tuple[bool, str]], repeated: list[bool], first: int, last: int) -> list[str]:
    """The text's blocks: the declared ones, unless all of them repeat and much of the page is in the stretch; else the stretch."""
    stays, size = [t for _, t in blocks[first:last]], sum(len(t) for _, t in blocks)
    declared = [(t, r) for (own, t), r in zip(blocks, repeated, strict=True) if own]
    if not declared or all(r for _, r in declared) and sum(map(len, stays)) >= REST * size:
        return stays
    return [t for t, _ in declared]


def extract(pages: DataFrame, length: int = RUN_TOKENS, least: int = RUN_PAGES, shard_pages: int = SHARD_PAGES) -> DataFrame:
    """page_id, url and text of every row of `pages`."""
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parts(html) for html in batch.column("html").to_pylist()]
            # Runs can decide a page that has other blocks than declared ones.
            open_ = pa.array([not all(own for own, _ in blocks) for _, blocks in found], pa.bool_())
            blocks = pa.array([packed(blocks) if blocks else None for _, blocks in found], pa.binary())
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), open_, blocks], ["page_id", "url", "open", "blocks"])

    parsed = cut(small_batches(pages.select("page_id", "url", "html")).mapInArrow(run, f"page_id {kind}, url string, open boolean, blocks binary"))
    parsed = parsed.withColumn("host", F.lower(F.coalesce(F.regexp_extract("url", "://([^/?#]*)", 1), F.lit(""))))
    empty = parsed.where("blocks is null").select("page_id", "url", F.lit("").alias("text"))
    filled = parsed.where("blocks is not null")
    # Written, so that Spark knows how small the table of hosts is.
    hosts = cut(filled.groupBy(F.col("host").alias("of_host")).agg(F.ceil(F.count(F.lit(1)) / shard_pages).alias("shards"), F.max("open").alias("sums")))
    dealt = filled.join(hosts, filled.host == hosts.of_host).withColumn("shard", F.pmod(F.xxhash64("page_id"), F.col("shards")))
    dealt = dealt.select("host", (F.col("sums") & (F.col("shards") > 1)).alias("sums"), "shard", "page_id", "url", "blocks")

    def stream(table: pa.Table) -> tuple[list[list[tuple[bool, str]]], Stream]:
        ids = table.column("page_id").to_pylist()
        number = {v: k for k, v in enumerate(dict.fromkeys(ids))}
        blocks = [unpacked(x) for x in table.column("blocks").to_pylist()]
        return blocks, Stream([(number[i], [t for _, t in b]) for i, b in zip(ids, blocks, strict=True)], length)

    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, counts = stream(table)[1].counted()
        host, shard = (pa.repeat(x, len(keys)) for x in key)
        return pa.table([host, shard, pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["host", "shard", "key", "n"])

    def decide(table: pa.Table, shared: pa.Table) -> pa.Table:
        keys = shared.column("key").to_numpy().astype(np.int64).view(np.uint64)
        blocks, streams = stream(table)
        texts = ["\n\n".join(checked(b, *found)) for b, found in zip(blocks, streams.unique_stretches(least, keys), strict=True)]
        return pa.table([table.column("page_id"), table.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    # A page is in one shard, so the shards' numbers of pages add up to the host's; a host of one shard needs no sums.
    counted = cut(dealt.where("sums").groupBy("host", "shard").applyInArrow(count, "host string, shard long, key long, n long"))
    wide = counted.groupBy("host", "key").agg(F.sum("n").alias("pages")).where(F.col("pages") >= least).select("host", "key")
    shared = counted.where(F.col("n") < least).join(wide, ["host", "key"], "left_semi").select("host", "shard", "key")
    decided = dealt.groupBy("host", "shard").cogroup(shared.groupBy("host", "shard")).applyInArrow(decide, f"page_id {kind}, url string, text string")
    return empty.unionByName(decided)
