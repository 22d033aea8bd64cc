"""Main text of web pages: host suffix arrays, then the page's own markup.

1. A page's markup is cut into blocks, menus and all; its words are one token
   stream, blocks in page order.
2. The streams of a host are concatenated and their suffixes sorted to a depth
   of ``RUN`` tokens by prefix doubling; suffixes that share ``RUN`` tokens are
   neighbours, and the distinct streams among them are counted (pages with one
   and the same stream count once). A run on at least ``SHARE`` of the host's
   streams, and on ``PAGES`` of them, is boilerplate.
3. A block all of whose words lie in such runs is boilerplate; a block is never
   cut. On every page the words of the other blocks, the unique ones, decide
   whether an ``article``, ``main`` or all of the page is its content.
4. Markup checks that: text in menus, headers, footers, asides, forms, adverts,
   notices, comments, scripts and so on goes even if it is unique; text in an
   ``article`` or ``main`` stays even if other pages carry the same passage; of
   the rest boilerplate goes, and all of it does where a container is the content.

Every host takes the same path. Its distinct streams are dealt to shards of
about ``SHARD_BYTES`` of html, so neither a large host nor a large group of
copies meets in one task. A run on a share of the host is on that share of some
shard, so the shards' suffix arrays name all candidates; a second pass counts
those over the whole host. The result does not depend on the shards.

Defined results: null or empty html gives an empty text; a null URL is a host
of its own; unclosed and truncated markup is read to its end; repeated rows are
pages with one stream; empty tables stay empty; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, stored, utf8_bytes
from .textkit import byte_hashes, span_hashes
from .url_filter import url_parts

RUN = 8
SHARD_BYTES = 8 << 20
#: Boilerplate stands on at least this share of a host's distinct streams, and on so many of them.
SHARE = 0.5
PAGES = 4

JUNK, LOOSE, MAIN, ARTICLE = 0, 1, 2, 3

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style title textarea iframe noscript noembed noframes xmp template svg math".split())
_INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
              "span strike strong sub sup time tt u var img wbr br ruby rt rp input button select option object audio "
              "video canvas picture source".split()) | _RAW - {"title"}
_HARD_TAGS = set("head button select option datalist object audio video canvas".split())
_JUNK_TAGS = set("nav footer aside form menu dialog".split())
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_JUNK_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_JUNK_WORDS = set("ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo promotion promoted "
                  "banner menu nav navbar navigation breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr "
                  "notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing "
                  "social related recommended recommendations disqus reply replies respond pagination pager widget "
                  "toolbar skip copyright comment comments commentlist".split())
#: Parts that may stand beside a junk word in a compound like ``site-footer``.
_PLACE_WORDS = set("site page main top bottom left right side primary secondary global list item items box bar wrap wrapper "
                   "container block section area form thread slot unit links icons buttons".split())
_HEAD_WORDS = set("header masthead topbar".split())
_MAIN_WORDS = set("article content main post story entry".split())

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[a-z0-9]+")


def _attributes(raw: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(raw)} if raw.strip(" /\n\t") else {}


def _junk_token(token: str) -> bool:
    """Whether a whole class or id token names junk: a junk word, or a compound of one with places."""
    parts = _WORD.findall(token)
    return any(p in _JUNK_WORDS for p in parts) and all(p in _JUNK_WORDS or p in _PLACE_WORDS or p.isdigit() for p in parts)


def _label(tag: str, attrs: dict[str, str], above: int) -> tuple[int, int]:
    """Kind of an element's text, given its parent's, and how it is junk: no (0), unless the
    page's content lies in it (1), or in any case (2)."""
    if tag in _HARD_TAGS or "hidden" in attrs or "display:none" in attrs.get("style", "").replace(" ", ""):
        return above, 2
    role = attrs.get("role", "").lower()
    tokens = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split() if attrs else []
    junk = tag in _JUNK_TAGS or role in _JUNK_ROLES or tag not in ("html", "body") and tag not in _HEADINGS and any(map(_junk_token, tokens))
    if tag == "article" or attrs.get("itemprop", "").lower() == "articlebody":
        return ARTICLE, int(junk)
    if above == LOOSE:
        if tag == "main" or role == "main":
            return MAIN, int(junk)
        if not junk and (tag == "header" or any(t in _HEAD_WORDS for t in tokens)):
            return LOOSE, 1
        if not junk and tag in ("div", "section") and any(_MAIN_WORDS.intersection(_WORD.findall(t)) for t in tokens):
            return MAIN, 0
    return above, int(junk)


def page_blocks(page: str | None) -> list[tuple[int, str]]:
    """(label, text) of a page's blocks in order; empty blocks are left out."""
    out: list[tuple[int, tuple[int, ...], str]] = []
    if not page:
        return []
    # Element, kind of its text, and the junk elements it lies in (0: junk in any case).
    stack: list[tuple[str, int, tuple[int, ...]]] = [("", LOOSE, ())]
    inside: list[bool] = [False]          # of each junk element: whether an article holds it
    parts: dict[tuple[int, ...], list[str]] = {}
    label, at, n = LOOSE, 0, len(page)

    def text(a: int, b: int):
        if b > a:
            part = page[a:b]
            parts.setdefault(stack[-1][2], []).append(entities.unescape(part) if "&" in part else part)

    def flush():
        for chain, some in parts.items():
            block = " ".join("".join(some).split())
            if block:
                out.append((label, chain, block))
        parts.clear()

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            text(at, n)
            break
        text(at, m.start())
        at = m.end()
        closing, tag, raw = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.setdefault(stack[-1][2], []).append(" ")
            continue
        if tag not in _INLINE:
            flush()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        elif tag in _RAW:
            end = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(page, at)
            at = n if end is None else end.start()
            stack.append((tag, stack[-1][1], (0,)))
        elif tag not in _VOID:
            if tag not in _INLINE and stack[-1][0] == "p":
                stack.pop()
            if not raw.endswith("/") or tag in _INLINE:
                _, above, chain = stack[-1]
                kind, junk = _label(tag, _attributes(raw), above)
                if chain != (0,) and junk:
                    if junk == 1:
                        inside.append(above == ARTICLE)
                    chain = (0,) if junk == 2 else (*chain, len(inside) - 1)
                stack.append((tag, kind, chain))
        if tag not in _INLINE:
            label = stack[-1][1]
    flush()
    return _settle(out, inside)


def _settle(blocks: list[tuple[int, tuple[int, ...], str]], inside: list[bool]) -> list[tuple[int, str]]:
    """Blocks with their labels: junk, unless the elements that say so hold the page's content.

    The content is the text in articles if that is most of the text in articles and main, or
    the text in both, or without any all of it. An element that holds more than half of its
    words is no junk; one inside an article only if else nothing of the content would stay."""
    if any(chain and chain != (0,) for _, chain, _ in blocks):
        words = [0] * (ARTICLE + 1)
        for kind, chain, block in blocks:
            words[kind] += block.count(" ") + 1 if chain != (0,) else 0
        core = (ARTICLE,) if words[ARTICLE] > words[MAIN] else (ARTICLE, MAIN) if words[MAIN] else (LOOSE,)
        whole = free = 0
        held: dict[int, int] = {}
        for kind, chain, block in blocks:
            if kind in core and chain != (0,):
                n = block.count(" ") + 1
                whole += n
                free += 0 if any(inside[e] for e in chain) else n
                for e in chain:
                    held[e] = held.get(e, 0) + n
        good = {e for e, n in held.items() if 2 * n > whole and not (inside[e] and free)}
    else:
        good = set()
    return [(JUNK if any(e not in good for e in chain) else kind, block) for kind, chain, block in blocks]


def main_text(blocks: list[tuple[int, str]], covered: np.ndarray | None) -> str:
    """A page's main text: runs and markup weigh its blocks, ``content`` picks the kinds, and
    loose blocks that are boilerplate go."""
    at, seen = 0, []
    for kind, block in blocks:
        n = block.count(" ") + 1
        seen.append((kind, n, covered is not None and bool(covered[at:at + n].all()), block))
        at += n
    kinds = content(seen)
    return "\n".join(block for kind, _, common, block in seen if kind in kinds and not (common and kind == LOOSE))


def content(seen: list[tuple[int, int, bool, str]]) -> tuple[int, ...]:
    """Kinds of block that make up a page's content.

    Articles do if they hold at least half of the page's unique words and more than half of
    those in articles and main together; these two do if they hold half of the page's; else
    the markup proves nothing and all that is not junk counts."""
    words = [0] * (ARTICLE + 1)
    for kind, n, common, _ in seen:
        words[kind] += 0 if common else n
    if not any(words[LOOSE:]):            # nothing unique: all words weigh
        for kind, n, _, _ in seen:
            words[kind] += n
    inner, whole = words[ARTICLE] + words[MAIN], sum(words[LOOSE:])
    if 2 * words[ARTICLE] > inner and 2 * words[ARTICLE] >= whole:
        return (ARTICLE,)
    return (ARTICLE, MAIN) if inner and 2 * inner >= whole else (ARTICLE, MAIN, LOOSE)


def page_tokens(blocks: list[tuple[int, str]]) -> np.ndarray:
    """Hashes of a page's words, in order."""
    data = np.frombuffer(" ".join(t for _, t in blocks).encode(), np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    space = np.flatnonzero(data == 32)
    return byte_hashes(data, np.concatenate(([0], space + 1)), np.append(space, len(data)))


def stream_key(tokens: np.ndarray) -> int:
    """One number for a whole stream."""
    if not len(tokens):
        return 0
    return int(span_hashes(tokens, np.array([0]), np.array([len(tokens)]))[0].view(np.int64))


def run_pages(tokens: np.ndarray, page: np.ndarray, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Substrings of ``run`` tokens: their places in suffix order, the first of each
    substring in that order, and the number of distinct pages it stands on.

    ``page`` numbers the page of each token, ascending. Suffixes get ranks by
    their first 1, 2, 4, ... tokens until the depth is reached; equal ranks then
    share ``run`` tokens. Suffixes that meet the end of their page before that
    are set apart."""
    n = len(tokens)
    if n < run:
        return (np.zeros(0, np.int64),) * 3
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    depth = 1
    while depth < run:
        step = min(depth, run - depth)       # overlapping halves reach any depth
        after = np.zeros(n, dtype=np.int64)
        after[:n - step] = rank[step:]
        rank = np.unique(rank * (n + 2) + after, return_inverse=True)[1].astype(np.int64) + 1
        depth += step
    last = np.minimum(np.arange(n) + run - 1, n - 1)
    at = np.flatnonzero((page[last] == page) & (np.arange(n) + run <= n))
    order = at[np.lexsort((page[at], rank[at]))]              # the suffix array, to this depth
    if not len(order):
        return (np.zeros(0, np.int64),) * 3
    other = np.concatenate(([True], rank[order][1:] != rank[order][:-1]))
    new = np.flatnonzero(other)
    return order, new, np.add.reduceat((other | np.concatenate(([True], page[order][1:] != page[order][:-1]))).astype(np.int64), new)


def covering(n: int, starts: np.ndarray, run: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a substring of ``run`` tokens that begins at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    edge[starts] += 1
    np.add.at(edge, starts + run, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated(tokens: np.ndarray, page: np.ndarray, run: int = RUN) -> np.ndarray:
    """Tokens covered by a substring of ``run`` tokens that stands on distinct pages."""
    order, new, pages = run_pages(tokens, page, run)
    return covering(len(tokens), order[np.repeat(pages > 1, np.diff(np.append(new, len(order))))], run)


def _windows(tokens: np.ndarray, run: int) -> np.ndarray:
    n = len(tokens) - run + 1
    return span_hashes(tokens, np.arange(n), np.arange(n) + run).view(np.int64) if n > 0 else np.zeros(0, np.int64)


def _among(windows: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which windows are in an ascending array."""
    if not len(known):
        return np.zeros(len(windows), dtype=bool)
    return known[np.minimum(np.searchsorted(known, windows), len(known) - 1)] == windows


def _known(column: pa.Array):
    """The int64 array of each row of a list column, empty for null."""
    flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends, ends[1:])]


def _streams(batches):
    """Every stream of a host once a task, dealt by the stream itself."""
    seen = set()
    for batch in batches:
        out = []
        for host, shards, page in zip(*(batch.column(c).to_pylist() for c in ("host", "shards", "html"))):
            blocks = page_blocks(page)
            stream = stream_key(page_tokens(blocks))
            if blocks and (host, stream) not in seen:
                seen.add((host, stream))
                out.append({"host": host, "shard": stream % shards, "stream": stream, "text": " ".join(t for _, t in blocks)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("host", pa.string()), ("shard", pa.int32()), ("stream", pa.int64()),
                                                         ("text", pa.string())]))


def _shard_runs(run: int, share: float):
    """Number of distinct streams of one shard, its runs on ``share`` of them by its suffix array with
    their streams, and the most streams that any other run of the shard can be on."""
    def work(table):
        streams = table["stream"].to_numpy()
        use = np.unique(streams, return_index=True)[1]
        tokens = [page_tokens([(LOOSE, table["text"][int(i)].as_py())]) for i in use]
        flat = np.concatenate(tokens)
        order, new, pages = run_pages(flat, np.repeat(np.arange(len(use)), [len(t) for t in tokens]), run)
        many = pages >= share * len(use)
        start = order[new[many]]
        return pa.table({"host": table["host"].slice(0, 1), "n": pa.array([len(use)], pa.int64()),
                         "unseen": pa.array([max(0, math.ceil(share * len(use)) - 1)], pa.int64()),
                         "w": pa.array([span_hashes(flat, start, start + run).view(np.int64)], pa.list_(pa.int64())),
                         "pages": pa.array([pages[many]], pa.list_(pa.int64()))})
    return work


def _found(run: int):
    """Per stream, once a task, which of its host's candidate runs it holds."""
    def work(batches):
        seen = set()
        for batch in batches:
            out = []
            for host, page, known in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), _known(batch.column("w"))):
                tokens = page_tokens(page_blocks(page))
                stream = stream_key(tokens)
                if len(tokens) and (host, stream) not in seen:
                    seen.add((host, stream))
                    windows = np.unique(_windows(tokens, run))
                    out.append({"host": host, "stream": stream, "w": windows[_among(windows, known)]})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("host", pa.string()), ("stream", pa.int64()), ("w", pa.list_(pa.int64()))]))
    return work


def host_runs(pages: DataFrame, run: int, share: float, least: int) -> DataFrame | None:
    """``host, w``: hashes of the runs that stand on at least ``least`` and ``share``
    of the host's distinct streams; None without any.

    A run on that share of the host is on that share of some shard, since every
    stream has one shard. So the suffix arrays of the shards name all candidates;
    those that the shards which don't name them cannot lift to the share are out,
    and one more pass counts the rest over the whole host."""
    def sets(runs: DataFrame, name: str) -> DataFrame:
        return stored(runs.groupBy("host").agg(F.sort_array(F.collect_list("w")).alias("w")), name)
    found = stored(pages.select("host", "shards", "html").mapInArrow(_streams, "host string, shard int, stream bigint, text string")
                   .groupBy("host", "shard").applyInArrow(_shard_runs(run, share), "host string, n bigint, unseen bigint, "
                                                          "w array<bigint>, pages array<bigint>"), "html-runs")
    sizes = found.groupBy("host").agg(F.sum("n").alias("n"), F.sum("unseen").alias("all_unseen")).where(F.col("n") >= least)
    most = F.col("pages") + F.col("all_unseen") - F.col("unseen")
    named = (found.select("host", "unseen", F.explode(F.arrays_zip("w", "pages")).alias("r"))
             .groupBy("host", F.col("r.w").alias("w")).agg(F.sum("r.pages").alias("pages"), F.sum("unseen").alias("unseen"))
             .join(sizes, "host"))
    some = sets(named.where((most >= least) & (most >= share * F.col("n"))).select("host", "w"), "html-candidates")
    if some.isEmpty():
        return None
    held = pages.select("host", "html").join(some, "host").mapInArrow(_found(run), "host string, stream bigint, w array<bigint>")
    counts = (held.groupBy("host", "stream").agg(F.first("w").alias("w")).select("host", F.explode("w").alias("w"))
              .groupBy("host", "w").agg(F.count("*").alias("pages")))
    return sets(counts.join(sizes, "host").where((F.col("pages") >= least) & (F.col("pages") >= share * F.col("n")))
                .select("host", "w"), "html-boilerplate")


def _texts(run: int):
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for page, known in zip(batch.column("html").to_pylist(), _known(batch.column("w"))):
            blocks = page_blocks(page)
            tokens = page_tokens(blocks)
            texts.append(main_text(blocks, covering(len(tokens), np.flatnonzero(_among(_windows(tokens, run), known)), run)))
        return pa.record_batch([batch.column("key"), batch.column("url"), pa.array(texts, pa.string())], names=["key", "url", "text"])
    return work


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", run: int = RUN,
            shard_bytes: int = SHARD_BYTES, share: float = SHARE, least: int = PAGES) -> DataFrame:
    """``key, url, text`` of every page."""
    slim = pages.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"),
                        url_parts(F.col(f"`{url}`"))[0].alias("host"))
    hosts = stored(slim.groupBy("host").agg(F.sum(utf8_bytes(F.col("html"))).alias("b"))
                   .select("host", F.greatest(F.lit(1), F.ceil(F.col("b") / shard_bytes)).cast("int").alias("shards")), "html-hosts")
    runs = host_runs(slim.join(hosts, "host"), run, share, least)
    ready = slim.withColumn("w", F.lit(None).cast("array<bigint>")) if runs is None else slim.join(runs, "host", "left")
    out = arrow_map(ready.select("key", "url", "html", "w"), _texts(run),
                    f"key {slim.schema['key'].dataType.simpleString()}, url string, text string")
    return out.select(F.col("key").alias(key), F.col("url").alias(url), "text")


def page_digest(pages: DataFrame) -> DataFrame:
    """The contract's row for each page."""
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
