"""Main text of web pages, with a suffix array of each host's pages.

A page is cut into blocks. Markup decides most: what stands in menus, headers, footers, sidebars, notices,
adverts, forms or comments (by element, or class and id) is boilerplate; what else stands in ``article``,
``main`` or a container named like them is content. An article or main text inside a form, or a container
with a listed word only as part of a longer class name or id (``has-sidebar``), is content too, unless an
article is around that; headings in content stay whatever their class. The token streams of all blocks that are not content
are concatenated per host, and a suffix array, sorted to the first ``LENGTH`` tokens by prefix doubling,
shows the runs of that length or more which pages share that are not copies of each other. An open block (neither boilerplate nor
content by markup) goes if such runs cover half of it; unique runs stay. Content stays even where pages
share it: copies of an article are no boilerplate.

Copies are pages of a host without content by markup whose open blocks agree in ALIKE percent of their
tokens or more, and what such pages link: BANDS weighted MinHash bands of ROWS propose them, the full block
sets decide: first against the least page of the band, then, in what that leaves apart, each with each (two
pages at 80% share no band with probability 5e-6, and pages that share one are compared or joined already).
What only copies share stays.

A host over SHARD tokens is dealt by page into shards with a suffix array each; windows that shards have
in common are found by joining their distinct window hashes, so that a shard's cover is that of the host.

Defined results: null html is empty and gives an empty text; pages of equal URL and html are one page;
a page without content whose open blocks are all covered keeps them (a copied page); an unclosed comment,
script or style runs to the end; an empty table gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabspark.llm.common import mix64, written
from tabspark.llm.near_dedup import _across as across
from tabspark.llm.near_dedup import _verified as verified
from tabspark.llm.near_dedup import components

LENGTH, SHARD, BROADCAST_HOSTS = 8, 2_000_000, 10_000
ALIKE, BANDS, ROWS = 80, 12, 2
BOILERPLATE, OPEN, CONTENT = 0, 1, 2
_SKIPPED = "script|style|noscript|template|textarea|title|iframe|svg|math|object|canvas|select"
_TAG = re.compile(
    r"<(?:svg|math)\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?<=/)>|"  # empty, so nothing after it is skipped
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<({_SKIPPED})\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)|<[!?][^>]*+>"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-z][a-z0-9:-]*)([^>]*+)>", re.S | re.I)
_NAMED = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input source".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption summary".split())
_BAD = frozenset("nav footer aside form menu button dialog head".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_BAD_NAME = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|advertising|banners?|sponsor(?:ed)?|promo|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|"
                       r"sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|topbar|comments?|disqus|respond|replies|share|sharing|social|related|recommended|"
                       r"widgets?|toolbar|login|signup|search|copyright|legal|pagination|pager|skip)(?:$|[\s_-])", re.I)
_GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body-?text|page-?text)(?:$|[\s_-])", re.I)


def _role(name: str, attributes: str, inside: bool) -> tuple[int | None, bool, bool]:
    """What an element says about its blocks (None: nothing), whether it is boilerplate only by form or
    part of a class name or id, and whether it is an article or main text. ``inside``: it stands in content."""
    bad, good, names = (name in _BAD and name != "form") or (name == "header" and not inside), name in ("article", "main"), []
    if attributes:
        for m in _NAMED.finditer(attributes):
            value = m[2] or m[3] or m[4] or ""
            kind = m[1].lower()
            if kind == "role":
                good |= value.lower() in ("main", "article")
                bad |= value.lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert")
            elif kind == "hidden" or (kind == "aria-hidden" and value.lower() == "true"):
                bad = True
            elif kind in ("class", "id"):
                names += value.split()
    text, soft = good, name == "form"
    if names and name not in ("html", "body", "main") and not (inside and name in _HEADINGS):
        whole = [x for x in names if not (inside and name == "header" and x.lower() == "header")]
        if any(map(_BAD_NAME.fullmatch, whole)):
            bad = True
        elif not text and not (inside and name == "header") and _BAD_NAME.search(" ".join(names)):
            soft = True
        elif name != "article" and _GOOD_NAME.search(" ".join(names)):
            good = True
    soft &= not bad
    return BOILERPLATE if bad or soft else CONTENT if good else None, soft, text


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(role, text) of each non-empty block in page order; references decoded, white space as one space."""
    page = page or ""
    out: list[tuple[int, str]] = []
    stack = [("", OPEN, False, False)]  # name, role, whether an article inside is content, whether an article is around
    held: list[str] = []
    leaf: int | None = None
    end = 0

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            out.append((stack[-1][1] if leaf is None or stack[-1][1] == BOILERPLATE else leaf, text))
        held.clear()

    for m in _TAG.finditer(page):
        if m.start() > end:
            held.append(page[end : m.start()])
        end = m.end()
        close, name, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not name:
            continue
        name = name.lower()
        if name in _INLINE:
            if name == "br":
                held.append(" ")
            continue
        flush()
        leaf = None
        if name in _LEAF:
            if not close and attributes.strip():
                leaf = _role(name, attributes, stack[-1][1] == CONTENT)[0]
        elif close:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
        elif name not in _VOID and not attributes.endswith("/"):
            _, now, soft, around = stack[-1]
            own, softly, text = _role(name, attributes, now == CONTENT)
            if now == BOILERPLATE:
                if soft and text and own == CONTENT:
                    now = CONTENT
                else:
                    soft = soft and (own != BOILERPLATE or softly)
            elif own is not None:
                now, soft = own, softly and not around
            stack.append((name, now, soft, around or (now == CONTENT and text and name != "main")))
    held.append(page[end:])
    flush()
    return out


def host_of(url: str | None) -> str:
    try:
        return (urlsplit((url or "").strip()).hostname or "").removeprefix("www.")
    except ValueError:
        return ""


def windows(tokens: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Hashes of the runs of ``length`` tokens."""
    n = max(0, len(tokens) - length + 1)
    out = np.full(n, np.uint64(length))
    for i in range(length):
        out = mix64(out ^ tokens[i : i + n].view(np.uint64))
    return out.view(np.int64)


def covered(streams: list[np.ndarray], shared: np.ndarray, length: int = LENGTH, groups: np.ndarray | None = None) -> list[np.ndarray]:
    """Per stream, which tokens lie in a run of ``length`` or more that another stream has too, or in a
    window of ``shared`` (sorted). With ``groups``, a stream of another group must have the run. Suffixes are sorted to their first ``length`` tokens: doubling gives
    the rank of pairs of ranks; equal ranks are neighbours with a common prefix of that length."""
    page = np.repeat(np.arange(len(streams)), [len(s) + 1 for s in streams])
    if not len(page):
        return []
    ends = np.cumsum([len(s) + 1 for s in streams]) - 1
    flat = np.concatenate([x for s in streams for x in (s, np.zeros(1, np.int64))])
    rank = np.unique(flat, return_inverse=True)[1].astype(np.int64) + len(streams)
    rank[ends] = np.arange(len(streams))  # each end differs, so that no common prefix crosses it
    depth = 1
    while depth < length:
        step = min(depth, length - depth)
        ahead = np.zeros_like(rank)
        ahead[:-step] = rank[step:] + 1
        rank = np.unique(rank * (rank.max() + ahead.max() + 2) + ahead, return_inverse=True)[1]
        depth += step
    suffixes = np.argsort(rank, kind="stable")  # the suffix array; within equal prefixes by place, so by page
    first = np.r_[True, np.diff(rank[suffixes]) > 0]
    group = np.cumsum(first) - 1
    start = np.flatnonzero(first)
    of = (np.arange(len(streams)) if groups is None else np.unique(groups, return_inverse=True)[1])[page[suffixes]]
    several = np.minimum.reduceat(of, start) != np.maximum.reduceat(of, start)
    hit = np.zeros(len(flat) + 1, np.int64)
    fits = ends[page] - np.arange(len(flat)) >= length
    at = suffixes[several[group]]
    at = at[fits[at]]
    if len(shared) and len(flat) >= length:
        w = windows(flat, length)
        near = shared[np.minimum(np.searchsorted(shared, w), len(shared) - 1)] == w
        at = np.union1d(at, np.flatnonzero(near & fits[: len(w)]))
    np.add.at(hit, at, 1)
    np.add.at(hit, at + length, -1)
    inside = np.cumsum(hit[:-1]) > 0
    return [inside[e - len(s) : e] for s, e in zip(streams, ends, strict=True)]


def _streams(pages: DataFrame) -> DataFrame:
    """Per page with blocks that are not content: host, page, their tokens as hashes, each token's block,
    the open blocks, whether the page has content, and if not, its distinct open blocks as hashes with their
    sizes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        for batch in batches:
            rows = []
            for page, url, text in zip(batch["page"], batch["url"], batch["html"], strict=True):
                found = blocks(text)
                tokens, of = [], []
                for k, (role, body) in enumerate(found):
                    if role != CONTENT:
                        own = body.split(" ")
                        tokens += own
                        of += [k] * len(own)
                if not tokens:
                    continue
                if len(known) > 400_000:
                    known.clear()
                for t in tokens:
                    if t not in known:
                        known[t] = xxhash.xxh3_64_intdigest(t)
                hashes = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens)).view(np.int64)
                content = any(r == CONTENT for r, _ in found)
                bodies = {} if content else {np.uint64(xxhash.xxh3_64_intdigest(t)).view(np.int64): t.count(" ") + 1 for r, t in found if r == OPEN}
                rows.append((host_of(url), page, hashes, np.array(of, np.int32), [k for k, (r, _) in enumerate(found) if r == OPEN], content, len(tokens),
                             np.array(list(bodies), np.int64), np.array(list(bodies.values()), np.int32)))
            yield pd.DataFrame(rows, columns=["host", "page", "tokens", "blocks", "open", "has_content", "n", "bodies", "sizes"])

    return pages.mapInPandas(run, "host string, page string, tokens array<long>, blocks array<int>, open array<int>, has_content boolean, n long, bodies array<long>, sizes array<int>")


def bands(bodies: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Weighted MinHash bands: per hash function the block with the least exponential of rate its size."""
    out = np.arange(BANDS, dtype=np.uint64)
    for k in range(BANDS * ROWS):
        u = (mix64(bodies.view(np.uint64) ^ mix64(np.full(len(bodies), k, np.uint64))) >> np.uint64(11)).astype(np.float64) + 0.5
        least = bodies[np.argmin(-np.log(u / 2.0**53) / sizes)]
        out[k % BANDS] = mix64(out[k % BANDS : k % BANDS + 1] ^ np.array([least]).view(np.uint64))[0]
    return out.view(np.int64)


def _copies(streams: DataFrame) -> DataFrame:
    """Page and copies (its group's least page) of all pages in a copy group but the least ones."""
    own = streams.where("size(bodies) > 0").select("host", "page", "bodies", "sizes").dropDuplicates(["host", "page"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [bands(np.asarray(b, np.int64), np.asarray(n, np.float64)) for b, n in zip(batch["bodies"], batch["sizes"], strict=True)]
            yield pd.DataFrame({"host": np.repeat(batch["host"].to_numpy(object), BANDS), "page": np.repeat(batch["page"].to_numpy(), BANDS), "band": np.concatenate(found) if found else []})

    rows = written(own.mapInPandas(run, "host string, page string, band long"), "bands")
    rows = rows.select(F.xxhash64("host", "band").alias("band"), "page")
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band")
    # a block of n tokens as n elements of a set, so that the share of common elements is that of tokens
    tokens = F.expr("flatten(zip_with(bodies, sizes, (x, n) -> transform(sequence(1, n), i -> xxhash64(x, i))))")
    rows = rows.join(shared, "band", "left_semi").distinct()
    sets = own.join(rows.select("page").distinct(), "page", "left_semi").select(F.col("page").alias("id"), F.array_distinct(tokens).alias("shingles"))
    sets = written(sets.dropDuplicates(["id"]), "sets")
    members = written(rows.join(sets.select(F.col("id").alias("page"), F.size("shingles").alias("n")), "page").select("band", F.col("page").alias("rep"), "n"), "members")
    lead = members.groupBy("band").agg(F.min("rep").alias("b"))
    pairs = members.join(lead, "band").where("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    of = written(components(written(verified(pairs, sets, ALIKE), "links")), "copies")
    # what the least page of a band leaves apart is compared with each other, in blocks
    now = members.join(of.select(F.col("a").alias("rep"), F.col("b").alias("up")), "rep", "left").select("band", "rep", "n", F.coalesce("up", "rep").alias("comp"))
    more = written(across(now, sets, ALIKE), "links")
    if not more.isEmpty():
        of = components(of.union(more))
    return of.select(F.col("a").alias("page"), F.col("b").alias("copies"))


def _dropped(streams: DataFrame) -> DataFrame:
    """Per page the open blocks that repeated runs cover."""
    large = streams.groupBy("host").agg(F.ceil(F.sum("n") / SHARD).cast("int").alias("shards")).where("shards > 1")
    large = F.broadcast(large) if large.count() <= BROADCAST_HOSTS else large
    streams = streams.join(_copies(streams), "page", "left").withColumn("copies", F.coalesce("copies", "page"))
    dealt = streams.join(large, "host", "left").withColumn("shard", F.pmod(F.xxhash64("page"), F.coalesce("shards", F.lit(1))).cast("int"))

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = [np.unique(windows(t)) for t in batch["tokens"]]
            n = [len(w) for w in own]
            yield pd.DataFrame({"host": np.repeat(batch["host"].to_numpy(object), n), "shard": np.repeat(batch["shard"].to_numpy(), n), "copies": np.repeat(batch["copies"].to_numpy(), n), "window": np.concatenate(own) if own else []})

    seen = dealt.where("shards is not null").select("host", "shard", "copies", "tokens").mapInPandas(distinct, "host string, shard int, copies string, window long")
    seen = seen.groupBy("host", "shard", "window").agg(F.min("copies").alias("lo"), F.max("copies").alias("hi"))
    common = seen.groupBy("host", "window").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo < hi").select("host", "window")
    shared = seen.select("host", "shard", "window").join(common, ["host", "window"], "left_semi")

    def cover(group: pd.DataFrame, more: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("page")
        rows = []
        marks = covered(list(group["tokens"]), np.sort(more["window"].to_numpy(np.int64)), groups=group["copies"].to_numpy())
        for page, of, open_, content, mark in zip(group["page"], group["blocks"], group["open"], group["has_content"], marks, strict=True):
            if not len(open_):
                continue
            size = np.bincount(of, minlength=int(of.max()) + 1)
            hits = np.bincount(of, mark, len(size))
            gone = [int(k) for k in open_ if 2 * hits[k] >= size[k]]
            if gone and (content or len(gone) < len(open_)):
                rows.append((page, gone))
        return pd.DataFrame(rows, columns=["page", "gone"])

    keys = ("host", "shard")
    return dealt.select(*keys, "page", "copies", "tokens", "blocks", "open", "has_content").groupBy(*keys).cogroup(shared.groupBy(*keys)).applyInPandas(cover, "page string, gone array<int>")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: key, url, text (blocks joined by a line break), n_chars (its code points)."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html")).withColumn("page", F.md5(F.concat(F.coalesce("url", F.lit("")), F.lit("\0"), F.coalesce("html", F.lit("")))))
    gone = written(_dropped(written(_streams(rows.select("page", "url", "html")), "streams")), "boilerplate")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for page, drop in zip(batch["html"], batch["gone"], strict=True):
                without = set(drop) if drop is not None else ()
                texts.append("\n".join(t for k, (role, t) in enumerate(blocks(page)) if role != BOILERPLATE and k not in without))
            yield pd.DataFrame({key: batch["key"].astype(object), url: batch["url"].astype(object).where(batch["url"].notna(), None), "text": texts, "n_chars": list(map(len, texts))})

    kind = pages.schema[key].dataType.simpleString()
    return rows.join(gone, "page", "left").select("key", "url", "html", "gone").mapInPandas(run, f"`{key}` {kind}, `{url}` string, text string, n_chars long")
