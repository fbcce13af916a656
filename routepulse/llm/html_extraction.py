"""Main text of web pages: markup, and a suffix array per host over all its pages.

The blocks of a page that no element such as nav or footer removes, those of a marked article
too, make its token stream (the words of a block between two block marks). The streams of a host's pages are concatenated, and their suffixes sorted by
their first ``LONG`` tokens. Neighbours that agree in all of them are a long substring; a
shorter block is one as a whole, with its marks. Near-equal streams count as one page. A
substring that enough of the host's pages hold (see ``_demanded``) is boilerplate, and a block
that such substrings cover almost wholly is removed. Where a page marks its article, that is the text;
a block of it goes only if long substrings cover it that more than half of the host's pages hold, ``ENOUGH`` at
least (a template, not a passage that texts share), and an article that would go whole stays.

Hosts are dealt to tasks by ranges, so that a host with very many pages is cut into
parts. Every part sorts its own suffixes and hands on in how many pages a substring is, with
its first and last page by name, since these may go on in other parts;
the rows of all parts are then brought together, which gives the same result as one array.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routepulse.llm import near_duplicates, page_blocks
from routepulse.llm.common import Powers, gathered, map_batches, mix, only, text_bytes, word_hashes, word_spans
from routepulse.llm.url_filter import host_and_path
from routepulse.session import join_small, settle, stage

#: Tokens of a long substring, block marks included.
LONG = 12
#: Share of a block's tokens that long substrings cover in boilerplate.
COVERED = 0.8
#: A substring in this share of a host's pages is boilerplate; on a host of few pages in more than
#: half of them, but no more than ``ENOUGH`` need be.
SHARE, ENOUGH = 0.05, 10
#: Streams are near-equal if this percentage of their runs of ``NEAR_TOKENS`` tokens is shared.
NEAR_TOKENS, NEAR_PERCENT = 3, 80
#: Tokens whose suffixes are sorted at a time.
PART_TOKENS = 2_000_000
MARK = 1


def _streams(batches):
    """key, host, digest, tokens, blocks (of each token: twice its number, 1 more in a marked article): the pages' token streams."""
    power = Powers()
    for part in gathered(batches, "html"):
        out = {c: [] for c in ("key", "host", "digest", "tokens", "blocks")}
        for key, host, text in zip(part.column("key").to_pylist(), part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True):
            found = page_blocks.blocks(text or "")
            mine = [(2 * i + (kind == page_blocks.ARTICLE), t) for i, (t, kind) in enumerate(found) if kind != page_blocks.DROPPED]
            if not mine:
                continue
            data, offsets = text_bytes(pa.array([t for _, t in mine], pa.string()))
            starts, ends, counts = word_spans(data, offsets)
            words = word_hashes(data, starts, ends, power)
            # a mark before every block, and one at the end
            tokens = np.insert(words, np.append(np.cumsum(counts) - counts, len(words)), np.uint64(MARK))
            blocks = np.append(np.repeat([i for i, _ in mine], counts + 1), mine[-1][0])
            out["key"].append(key)
            out["host"].append(host)
            out["digest"].append(int(mix(tokens * np.arange(1, len(tokens) + 1, dtype=np.uint64)).sum(dtype=np.uint64).view(np.int64)))
            out["tokens"].append(tokens.tobytes())
            out["blocks"].append(blocks.astype(np.int32).tobytes())
        yield out


def windows(tokens: np.ndarray) -> np.ndarray:
    """A hash of every run of ``LONG`` tokens."""
    return _hash_at(tokens, np.arange(max(0, len(tokens) - LONG + 1)))


def short_blocks(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The blocks that, marks included, are shorter than ``LONG``: a hash, the place and the tokens of each."""
    marks = np.flatnonzero(tokens == MARK)
    sizes = np.diff(marks) + 1
    places, sizes = marks[:-1][sizes < LONG], sizes[sizes < LONG]
    total = mix(sizes.astype(np.uint64))
    for j in range(LONG - 1):
        at = np.minimum(places + j, max(0, len(tokens) - 1))
        total = np.where(j < sizes, mix(total + tokens[at] * np.uint64(0xE7037ED1A0B428DB + 2 * j)), total)
    return total, places, sizes


def repeated(streams: list[np.ndarray], digests: list[int], count: bool = False) -> tuple[np.ndarray, ...]:
    """Every different long substring of the streams: its hash, and the least and greatest stream it is in.

    With ``count`` also in how many; ``digests`` must then ascend.

    The streams are concatenated with an end of its own after each. Suffixes are ranked
    by 1, 2, 4, ... tokens, then sorted; equal neighbours are one substring.
    """
    sizes = np.array([len(s) for s in streams])
    text = np.concatenate([np.append(s, np.uint64(0)) for s in streams])
    owner = np.repeat(np.arange(len(streams)), sizes + 1)
    left = np.concatenate([np.arange(n, -1, -1) for n in sizes])  # tokens up to the end
    rank = np.unique(text, return_inverse=True)[1]
    ends = np.flatnonzero(left == 0)
    rank[ends] = rank.max() + 1 + np.arange(len(ends))

    def paired(a: np.ndarray, b: np.ndarray, by: int) -> np.ndarray:
        after = np.zeros(len(a), np.int64)
        after[: max(0, len(a) - by)] = b[by:] + 1
        return np.unique(a * (int(b.max()) + 2) + after, return_inverse=True)[1]

    ranks, have = {1: rank}, 1
    while have * 2 <= LONG:
        ranks[have * 2] = paired(ranks[have], ranks[have], have)
        have *= 2
    rank, rest = ranks[have], LONG - have
    while rest:
        step = max(k for k in ranks if k <= rest)
        rank = paired(rank, ranks[step], LONG - rest)
        rest -= step
    whole = np.flatnonzero(left >= LONG)
    order = whole[np.argsort(rank[whole], kind="stable")]  # the suffix array, sorted by LONG tokens
    if not len(order):
        return (np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * (2 + count))
    first = np.flatnonzero(np.diff(rank[order], prepend=-1))
    stream = np.array(digests, np.int64)[owner[order]]
    hashes = _hash_at(text, order[first])
    out = hashes, np.minimum.reduceat(stream, first), np.maximum.reduceat(stream, first)
    if not count:
        return out
    fresh = np.diff(stream, prepend=-1) != 0
    fresh[first] = True
    return *out, np.add.reduceat(fresh.astype(np.int64), first)


def _repeated_blocks(streams: list[np.ndarray], numbers: list[int]) -> tuple[np.ndarray, ...]:
    """The same, counts included, of the short blocks."""
    found = [short_blocks(s)[0] for s in streams]
    hashes = np.concatenate(found)
    stream = np.repeat(np.array(numbers, np.int64), [len(f) for f in found])
    order = np.lexsort((stream, hashes))
    hashes, stream = hashes[order], stream[order]
    if not len(order):
        return (hashes, *[np.zeros(0, np.int64)] * 3)
    fresh = np.append(True, hashes[1:] != hashes[:-1])
    first = np.flatnonzero(fresh)
    fresh[1:] |= stream[1:] != stream[:-1]
    return hashes[first], stream[first], stream[np.append(first[1:], len(order)) - 1], np.add.reduceat(fresh.astype(np.int64), first)


def _hash_at(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    total = np.zeros(len(places), np.uint64)
    for j in range(LONG):
        total = mix(total + text[places + j] * np.uint64(0x9E3779B97F4A7C15 + 2 * j))
    return total


def _seed(host: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(host.encode(), digest_size=8).digest()))


def _host_key(host: str, hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ _seed(host)).view(np.int64)


def _as_texts(batches):
    """doc_id, text: each stream as words that no other host has."""
    for batch in batches:
        texts = []
        for host, tokens in zip(*(batch.column(c).to_pylist() for c in ("host", "tokens")), strict=True):
            texts.append(" ".join(map("%x".__mod__, mix(np.frombuffer(tokens, np.uint64) ^ _seed(host)).tolist())))
        yield {"doc_id": batch.column("stream"), "text": texts}


def _substrings(batches):
    """site, sub, edge, inner, n: in how many pages (groups of near-equal streams) of this part each long substring is.

    The first and the last page have a row of their own with their name as ``edge``. Of a host that lies in this part
    whole, between two others, substrings of one page are left out.
    """

    def done(host, streams, groups, whole):
        names, numbers = np.unique(np.array(groups, np.int64), return_inverse=True)
        for hashes, low, high, n in (repeated(streams, numbers.tolist(), count=True), _repeated_blocks(streams, numbers.tolist())):
            if whole:
                hashes, low, high, n = (x[n > 1] for x in (hashes, low, high, n))
            subs, end = _host_key(host, hashes), len(names) - 1
            at_first, at_last = low == 0, (high == end) & (end > 0)
            rest = n - at_first - at_last
            for chosen, edge, some in ((at_first, names[0], None), (at_last, names[end], None), (rest > 0, 0, rest)):
                size = int(chosen.sum())
                if size:
                    counts = np.ones(size, np.int64) if some is None else some[chosen]
                    yield {"site": np.full(size, _seed(host).view(np.int64)), "sub": subs[chosen], "edge": np.full(size, edge), "inner": np.full(size, some is not None), "n": counts}

    now, streams, groups, size, before = None, [], [], 0, None  # before: the host of the run before this one
    for batch in batches:
        for host, group, tokens in zip(*(batch.column(c).to_pylist() for c in ("host", "group", "tokens")), strict=True):
            if streams and (host != now or size > PART_TOKENS):
                yield from done(now, streams, groups, before not in (None, (now,)) and host != now)
                streams, groups, size, before = [], [], 0, (now,)
            now = host
            streams.append(np.frombuffer(tokens, np.uint64))
            groups.append(group)
            size += len(streams[-1])
    if streams:
        yield from done(now, streams, groups, False)


def _sites(batches):
    """site: a number for each host, next to its pages."""
    for batch in batches:
        yield {"site": [int(_seed(h).view(np.int64)) for h in batch.column("host").to_pylist()], "pages": batch.column("pages")}


def _demanded(pages):
    """Column: how many of a host's pages must hold a substring."""
    return F.greatest(F.lit(2), F.least(F.floor(pages / 2) + 1, F.lit(ENOUGH)), F.ceil(SHARE * pages))


def _places(batches):
    """key, sub, place, size: the long substrings of each page."""
    for batch in batches:
        for key, host, tokens in zip(*(batch.column(c).to_pylist() for c in ("key", "host", "tokens")), strict=True):
            tokens = np.frombuffer(tokens, np.uint64)
            hashes, (more, places, sizes) = windows(tokens), short_blocks(tokens)
            subs = _host_key(host, np.concatenate([hashes, more]))
            if len(subs):
                yield {"key": np.full(len(subs), key), "sub": subs, "place": np.concatenate([np.arange(len(hashes)), places]), "size": np.concatenate([np.full(len(hashes), LONG), sizes])}


def _removed(batches):
    """key, removed: the numbers of the blocks that substrings cover, those of a marked article by long ones that most pages hold."""
    for batch in batches:
        keys, removed = [], []
        for key, blocks, places in zip(*(batch.column(c).to_pylist() for c in ("key", "blocks", "places")), strict=True):
            of = np.frombuffer(blocks, np.int32)
            start, size, most = (np.array([p[c] for p in places]) for c in ("place", "size", "most"))
            names, at = np.unique(of, return_inverse=True)
            share = []
            for some in (np.ones(len(size), bool), most & (size == LONG)):
                cover = np.zeros(len(of) + 1, np.int64)
                np.add.at(cover, start[some], 1)
                np.add.at(cover, (start + size)[some], -1)
                share.append(np.bincount(at, weights=np.cumsum(cover)[:-1] > 0) / np.bincount(at))
            gone = np.where(names % 2, share[1], share[0]) >= COVERED
            keys.append(key)
            removed.append((names[gone] // 2).tolist())
        yield {"key": keys, "removed": removed}


def _texts(batches):
    for part in gathered(batches, "html"):
        texts = []
        for page, removed in zip(part.column("html").to_pylist(), part.column("removed").to_pylist(), strict=True):
            texts.append(page_blocks.article(page_blocks.blocks(page or ""), frozenset(removed or ()), hinted=True))
        yield {"page": part.column("page"), "url": part.column("url"), "text": texts, "n_chars": [len(t) for t in texts]}


def extract_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per page: id, url, text (empty if none), n_chars (code points of the text).

    Character references are decoded, white space in a block becomes one blank, blocks are joined by a line
    break in page order. NULL and empty html give an empty text. Pages whose url is NULL or has no
    host are one host. Near-equal pages count as one page of their host, so copies do not make each other
    boilerplate (nor do pages that are almost wholly a template, which keep it); repeated rows are extracted each. A class or id that hints at chrome decides
    where a page marks its article; elsewhere the block goes if the suffix array finds it. A block of a marked article goes if long substrings cover it that more than half of the host's
    pages hold (``ENOUGH`` at least), unless nothing of the article would stay. An empty table gives an
    empty table; other columns are not read.
    """
    kind = dict(pages.dtypes)[id_column]
    rows = only(pages, id_column, url_column, html_column).select(F.col(id_column).alias("page"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    rows = rows.withColumn("key", F.xxhash64("page", "url", "html"))
    host, _ = host_and_path(F.col("url"))
    streams = map_batches(rows.select("key", host.alias("host"), "html"), _streams, "key long, host string, digest long, tokens binary, blocks binary")
    streams = stage(streams, "page-streams")
    asked = streams.select("host", "digest", "tokens").dropDuplicates(["host", "digest"])
    asked = stage(asked.withColumn("stream", F.xxhash64("host", "digest")), "page-asked")
    tokens = asked.agg(F.coalesce(F.sum(F.octet_length("tokens")), F.lit(0))).first()[0]
    if not tokens:
        return _written(rows.withColumn("removed", F.array().cast("array<int>")), kind, id_column)
    near = near_duplicates.near_duplicates(map_batches(asked.select("host", "tokens", "stream"), _as_texts, "doc_id long, text string"), NEAR_TOKENS, NEAR_PERCENT)
    near = stage(near.select(F.col("doc_id").alias("stream"), F.col("component_id").alias("group")), "page-groups")
    grouped = asked.join(near, "stream")
    dealt = grouped.select("host", "group", "digest", "tokens").repartitionByRange(max(2, -(-tokens // (8 * PART_TOKENS))), "host", "group", "digest").sortWithinPartitions("host", "group", "digest")
    found = map_batches(dealt, _substrings, "site long, sub long, edge long, inner boolean, n long")
    found = found.groupBy("site", "sub", "edge", "inner").agg(F.sum("n").alias("n"))
    found = found.groupBy("site", "sub").agg(F.sum(F.when(F.col("inner"), F.col("n")).otherwise(1)).alias("n")).where(F.col("n") > 1)
    sites = map_batches(grouped.groupBy("host").agg(F.countDistinct("group").alias("pages")), _sites, "site long, pages long")
    found = join_small(found, stage(sites, "page-sites"), ["site"]).where(F.col("n") >= _demanded(F.col("pages")))
    most = (F.col("n") >= ENOUGH) & (2 * F.col("n") > F.col("pages"))
    found = stage(found.select("sub", most.alias("most")), "page-substrings")
    hits = join_small(map_batches(streams.select("key", "host", "tokens"), _places, "key long, sub long, place int, size int"), found, ["sub"])
    hits = hits.groupBy("key").agg(F.collect_set(F.struct("place", "size", "most")).alias("places"))
    hits = hits.join(streams.select("key", "blocks").dropDuplicates(["key"]), "key").select("key", "blocks", "places")
    removed = stage(map_batches(hits, _removed, "key long, removed array<int>"), "page-removed")
    small, is_small = settle(removed)
    joined = rows.join(F.broadcast(small) if is_small else small, "key", "left")  # 10,000 pages at most, else no hint
    return _written(joined, kind, id_column)


def _written(rows: DataFrame, kind: str, id_column: str) -> DataFrame:
    out = map_batches(rows.select("page", "url", "html", "removed"), _texts, f"page {kind}, url string, text string, n_chars long")
    return out.withColumnRenamed("page", id_column)
