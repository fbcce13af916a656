"""Ranked lexical search with a K2-treap over the grid of terms and documents.

Documents are taken in ranges. The cells (term, document) of a range form a quadtree of which only
cells that hold something are stored, as bit masks of their children, level by level;
every cell knows the largest impact below it. An item's terms are paths down the rows of
that tree: all paths descend together over ranges of documents, those first whose
bound, the weighted sum of the paths' cells, is largest. A range is left once its bound
is below the k-th best score found so far; a single document's bound is its score.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routepulse.llm.common import gathered, lowered, map_batches, only, text_bytes
from routepulse.session import stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Documents of a grid, and cells after which one is closed (memory only).
RANGE = 4096
CELLS = 1 << 20
#: Pairs of item and term that are sent to the tasks at a time; more items take more passes.
BLOCK_TERMS = 1 << 16
#: Ranges of documents that are split at a time: few until k documents are found, then (what is
#: not below the k-th is looked at in any case) many.
FIRST_STEP, LAST_STEP = 16, 1024
SLICE_BYTES = 2 << 20

# Of a cell's mask: how many children stand before each.
_BEFORE = np.array([[bin(mask & ((1 << child) - 1)).count("1") for child in range(4)] for mask in range(16)], np.int64)


def _spread(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at the even places of 64."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Treap:
    """The cells of one range of documents: ``best`` impact, ``mask`` of children, ``first`` child."""

    def __init__(self, row: np.ndarray, column: np.ndarray, impact: np.ndarray, height: int):
        """``row`` and ``column`` are below 2 ** height; there is one impact for each pair."""
        code = _spread(row) << np.uint64(1) | _spread(column)
        order = np.argsort(code)
        code, best = code[order], impact[order]
        levels = [(best, np.zeros(len(best), np.uint8), np.zeros(len(best), np.int64))]
        for _ in range(height):
            parent = code >> np.uint64(2)
            start = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
            mask = np.bitwise_or.reduceat(np.uint8(1) << (code & np.uint64(3)).astype(np.uint8), start)
            code, best = parent[start], np.maximum.reduceat(best, start)
            levels.append((best, mask, start))
        self.height = height
        levels.reverse()
        self.best = np.concatenate([x[0] for x in levels])
        self.mask = np.concatenate([x[1] for x in levels])
        behind = np.cumsum([len(x[0]) for x in levels])
        self.first = np.concatenate([x[2] + n for x, n in zip(levels, behind, strict=True)])

    def children(self, node: np.ndarray, child: np.ndarray) -> np.ndarray:
        """The child cells, -1 where there is none (or no parent)."""
        mask = np.where(node >= 0, self.mask[node], 0)
        return np.where(mask >> child & 1, self.first[node] + _BEFORE[mask, child], -1)

    def search(self, rows: np.ndarray, weights: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Columns and scores that may be among the ``k`` best, and are no less than ``least``."""
        node = np.zeros((1, len(rows)), np.int64)
        level, column = np.zeros(1, np.int64), np.zeros(1, np.int64)
        bound = np.array([int(weights.sum()) * int(self.best[0])])
        found, scores = [], np.zeros(0, np.int64)
        while len(bound):
            step = LAST_STEP if least else FIRST_STEP
            if len(bound) > step:
                order = np.argpartition(-bound, step)
                now, later = order[:step], order[step:]
            else:
                now, later = np.arange(len(bound)), np.zeros(0, np.int64)
            down = rows >> (self.height - 1 - level[now])[:, None] & 1
            parts = [(self.children(node[now], 2 * down + side), level[now] + 1, 2 * column[now] + side) for side in (0, 1)]
            child, deeper, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            sums = np.where(child >= 0, self.best[child], 0) @ weights
            last = deeper == self.height
            hit = last & (sums > 0) & (sums >= least)
            if hit.any():
                found.append((at[hit], sums[hit]))
                scores = np.concatenate([scores, sums[hit]])
                if len(scores) >= k:
                    scores = np.partition(scores, len(scores) - k)[len(scores) - k :]
                    least = max(least, int(scores.min()))
            inner = ~last & (sums > 0) & (sums >= least)
            later = later[bound[later] >= least]
            node, level, column, bound = (np.concatenate([a[later], b[inner]]) for a, b in ((node, child), (level, deeper), (column, at), (bound, sums)))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, sums = (np.concatenate(x) for x in zip(*found, strict=True))
        return at[sums >= least], sums[sums >= least]


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term adds per unit of weight: by its occurrences, less in longer documents."""
    return 1_000_000_000 * tf // (1000 * tf + 20 * (50 + 50 * n * documents // terms))


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Best:
    """The k best documents of one item so far: higher scores first, then smaller ids."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 0

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[: self.k]
        self.score, self.doc = score[order], doc[order]


def _postings(docs: DataFrame, terms: list[bytes], id_column: str, text_column: str) -> DataFrame:
    """Per document: its terms with repeats, and (place in ``terms``, occurrences) of those it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # at most BLOCK_TERMS

    def work(batches):
        wanted, n_terms = pa.array(shared.value, pa.large_binary()), len(shared.value)
        for part in gathered(batches, text_column, SLICE_BYTES):
            data, offsets = text_bytes(part.column(text_column))
            data = lowered(data)
            inside = ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122)) | (data >= 128)
            border = np.zeros(len(data) + 1, bool)
            border[offsets] = True
            starts = np.flatnonzero(inside & (border[:-1] | ~np.concatenate([[False], inside])[:-1]))
            edges = np.searchsorted(starts, offsets)
            packed = np.ascontiguousarray(data[inside])
            cut = np.append(np.cumsum(inside, dtype=np.int64)[starts] - 1, len(packed))
            cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(packed)])
            found = pc.fill_null(pc.index_in(cells, wanted), -1).to_numpy()
            n = np.diff(edges)
            at = np.flatnonzero(found >= 0)
            pair, tf = np.unique((np.searchsorted(edges, at, "right") - 1) * n_terms + found[at], return_counts=True)
            held = np.concatenate([[0], np.cumsum(np.bincount(pair // n_terms, minlength=len(n)))]).astype(np.int64) * 8
            both = np.stack([pair % n_terms, tf], axis=1).astype("<u4").tobytes()
            postings = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(held), pa.py_buffer(both)])
            yield {"doc": part.column(id_column), "n": n, "postings": postings.cast(pa.binary())}

    return map_batches(only(docs, id_column, text_column).where(F.col(id_column).isNotNull()), work, "doc long, n long, postings binary")


def _pairs(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the batch, place of the term, occurrences) of its postings."""
    data, offsets = text_bytes(part.column("postings").cast(pa.large_binary()).view(pa.large_string()))
    both = np.frombuffer(data.tobytes(), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(part.num_rows), np.diff(offsets) // 8), both[:, 0], both[:, 1]


def _holding(postings: DataFrame, n_terms: int) -> dict[int, int]:
    """How many documents hold each term."""

    def work(batches):
        total = np.zeros(n_terms, np.int64)
        for part in gathered(batches, "postings", SLICE_BYTES):
            total += np.bincount(_pairs(part)[1], minlength=n_terms)
        at = np.flatnonzero(total)
        yield {"term": at, "holding": total[at]}

    counted = map_batches(postings.select("postings"), work, "term long, holding long")
    return {r.term: r.holding for r in counted.groupBy("term").agg(F.sum("holding").alias("holding")).collect()}  # at most BLOCK_TERMS rows


def _best(postings: DataFrame, items: list, n_terms: int, documents: int, total: int, k: int) -> DataFrame:
    """Each task's k best documents per item. ``items``: (id, rows, weights)."""
    shared = postings.sparkSession.sparkContext.broadcast(items)

    def work(batches):
        best = [Best(k) for _ in shared.value]
        held = []

        def search():
            doc = np.concatenate([x[0] for x in held])
            before = np.cumsum([0] + [len(x[0]) for x in held])
            column, row, impact = (np.concatenate(x) for x in zip(*[(c + at, r, i) for (_, c, r, i), at in zip(held, before, strict=False)], strict=True))
            held.clear()
            if not len(column):
                return
            height = max(1, int(max(n_terms, len(doc)) - 1).bit_length())
            treap = Treap(row, column, impact, height)
            for (_, rows, weights), kept in zip(shared.value, best, strict=True):
                at, score = treap.search(rows, weights, kept.least(), k)
                if len(at):
                    kept.add(score, doc[at])

        for batch in batches:
            for part in gathered([batch], "postings", CELLS * 8):
                column, row, tf = _pairs(part)
                n = part.column("n").to_numpy()
                held.append((part.column("doc").to_numpy(), column, row, impacts(tf, n[column], documents, total)))
                if sum(len(x[0]) for x in held) >= RANGE or sum(len(x[1]) for x in held) >= CELLS:
                    search()
        if held:
            search()
        for (item, _, _), kept in zip(shared.value, best, strict=True):
            yield {"item_id": np.full(len(kept.doc), item), "doc_id": kept.doc, "score": kept.score}

    return map_batches(postings.where("n > 0"), work, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank (from 1), doc_id, score.

    Terms are maximal stretches of ASCII letters, digits and any other than ASCII characters, A-Z in
    lower case. An item asks for each of its terms once; a term weighs more the fewer
    documents hold it, and adds more the more often it occurs, less in long documents
    (``weight``, ``impacts``; whole numbers throughout). Documents with a score above 0
    are ranked by score, equal ones by id.

    NULL, empty and blank texts and items hold no terms and find nothing. Items (table with item_id, text) and
    documents with a NULL id take no part, also not in the statistics; an item id with several texts asks for
    the terms of all. Repeated documents count and are ranked each. Empty tables give an
    empty one; other columns are not read. Texts are read whole; what is kept of one is bounded by the
    items' terms. Many items take several passes, with at most BLOCK_TERMS pairs
    of item and term each (or one item); no item is split.
    """
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), 0)
    asked = only(items, "item_id", "text").where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), F.explode(words).alias("term")).distinct()
    asked = stage(asked, "search-items")
    passes = max(1, -(-asked.count() // BLOCK_TERMS))
    out = []
    for number in range(passes):
        part = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number).orderBy("item_id", "term").toArrow()
        place: dict[str, int] = {}
        rows: dict[int, list[int]] = {}
        for item, term in zip(part.column("item_id").to_pylist(), part.column("term").to_pylist(), strict=True):
            rows.setdefault(item, []).append(place.setdefault(term, len(place)))
        postings = stage(_postings(docs, [t.encode() for t in place], id_column, text_column), "search-postings")
        documents, total = postings.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        holding = _holding(postings, len(place))
        weights = np.array([weight(documents, holding[i]) if i in holding else 0 for i in range(len(place))], np.int64)
        wanted = []
        for item, of in rows.items():
            of = np.array(of)
            of = of[weights[of] > 0]  # the others add nothing
            if len(of):
                wanted.append((item, of, weights[of]))
        out.append(_best(postings, wanted, max(1, len(place)), documents, total, k))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
