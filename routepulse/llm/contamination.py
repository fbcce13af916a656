"""Benchmark items inside documents: MinHash containment search over size partitions.

Items are partitioned by the size of their shingle sets. An item of n shingles has a
sketch: its smallest values under one universal hash, as many as the largest size of its partition
may miss, plus one. A document that holds the asked share of the item's shingles holds at
least one value of the sketch, however long the document is, so looking up a document's
shingles among all sketch values finds every candidate. Candidates are
verified by exact containment of the item's shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routepulse.llm.common import HASHED_BYTES, Powers, gathered, lowered, map_batches, mix, only, shingle_hashes, text_bytes, word_hashes, word_spans

#: Items that go through the documents at a time, and their total text: each block of items is sent to the tasks.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 16 << 20


def sketch_size(shingles: int, percent: int) -> int:
    """Values in the sketch of an item: enough for every size of its partition (a power of two up to its double)."""
    largest = (1 << shingles.bit_length()) - 1
    return min(shingles, largest - -(-percent * largest // 100) + 1)


class Items:
    """A block of items: their shingle sets and the sketches that find them."""

    def __init__(self, items: list[tuple[int, str]], words: int, percent: int):
        self.percent, power = percent, Powers()
        self.sets: list[tuple[int, np.ndarray]] = []
        values: dict[int, list[tuple[np.ndarray, int]]] = {}
        for key, text in items:
            data, offsets = text_bytes(pa.array([text], pa.string()))
            data = lowered(data)
            starts, ends, counts = word_spans(data, offsets)
            k = int(min(words, counts[0]))  # an item of fewer words is one shingle of that many
            if not k:
                continue
            hashes, _ = shingle_hashes(word_hashes(data, starts, ends, power), counts, k)
            shingles = np.unique(hashes)
            order = np.argsort(mix(shingles + np.uint64(977)))
            values.setdefault(k, []).append((shingles[order[: sketch_size(len(shingles), percent)]], len(self.sets)))
            self.sets.append((key, shingles))
        self.sketches = {}
        for k, found in values.items():
            value = np.concatenate([v for v, _ in found])
            owner = np.concatenate([np.full(len(v), i) for v, i in found])
            order = np.argsort(value, kind="stable")
            self.sketches[k] = value[order], owner[order]

    def search(self, texts: pa.Array, power: Powers) -> list[list[tuple[int, int, int]]]:
        """Per text: item, its shingles, and how many of them the text holds."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        data, offsets = text_bytes(texts)
        data = lowered(data)
        starts, ends, counts = word_spans(data, offsets)
        words = word_hashes(data, starts, ends, power)
        for k, (value, owner) in self.sketches.items():
            hashes, sizes = shingle_hashes(words, counts, k)
            edges = np.concatenate([[0], np.cumsum(sizes)])
            low, high = np.searchsorted(value, hashes, "left"), np.searchsorted(value, hashes, "right")
            hit = np.flatnonzero(high > low)
            doc = np.searchsorted(edges, hit, "right") - 1
            times = (high - low)[hit]
            which = np.repeat(low[hit] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            pairs = np.unique(np.repeat(doc, times) * len(self.sets) + owner[which])
            held, at = None, -1
            for d, i in zip((pairs // len(self.sets)).tolist(), (pairs % len(self.sets)).tolist(), strict=True):
                if d != at:
                    held, at = np.unique(hashes[edges[d] : edges[d + 1]]), d
                key, shingles = self.sets[i]
                shared = len(np.intersect1d(held, shingles, assume_unique=True))
                if 100 * shared >= self.percent * len(shingles):
                    out[d].append((key, len(shingles), shared))
        return [sorted(found) for found in out]


def find_items(docs: DataFrame, benchmark: DataFrame, words: int = 5, percent: int = 80, text_column: str = "text") -> DataFrame:
    """``docs`` with ``matches``: array of (item_id, n_shingles, n_shared), by item_id.

    An item is in a document when the document holds at least ``percent`` of the item's
    distinct shingles (runs of ``words`` words; A-Z in lower case; an item of fewer words
    is one shingle of all of them). NULL, empty and blank texts and items match nothing, items
    with a NULL id take no part, an item id with several texts matches with each of them
    (equal matches once). Repeated documents are searched each. Empty tables give no
    matches. ``docs`` keeps all its columns; a column named "matches" is replaced.
    """
    spark = docs.sparkSession
    items = only(benchmark, "item_id", "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-size[1] // BLOCK_BYTES))
    columns = [c for c in docs.columns if c != "matches"]
    kinds = [docs.schema[c].dataType.simpleString() for c in columns]
    schema = "".join(f"c{i} {kind}, " for i, kind in enumerate(kinds)) + "matches array<struct<item_id:bigint,n_shingles:bigint,n_shared:bigint>>"
    out = only(docs, *columns).withColumn("matches", F.array().cast("array<struct<item_id:bigint,n_shingles:bigint,n_shared:bigint>>"))
    for number in range(blocks):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number) if blocks > 1 else items
        shared = spark.sparkContext.broadcast(sorted((r.item_id, r.text) for r in block.collect()))  # one block
        out = map_batches(out, _searching(shared, words, percent, columns, text_column), schema)
        out = out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(columns)})
    return out


def _searching(shared, words, percent, columns, text_column):
    def work(batches):
        items, power = Items(shared.value, words, percent), Powers()
        for part in gathered(batches, text_column, HASHED_BYTES):
            found = items.search(part.column(text_column), power)
            before = part.column("matches").to_pylist()
            names = ("item_id", "n_shingles", "n_shared")
            matches = [sorted({tuple(x.values()) for x in old} | set(new)) for old, new in zip(before, found, strict=True)]
            yield {f"c{i}": part.column(c) for i, c in enumerate(columns)} | {"matches": [[dict(zip(names, m, strict=True)) for m in ms] for ms in matches]}

    return work
