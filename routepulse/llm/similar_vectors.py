"""Exact top-k inner products by a bit-sliced index.

Vector components are whole numbers. A block of rows keeps, for every attribute and bit,
one bitmap over its rows (a slice). The score of a query is a sum of slices times
constants; it is built as a bit-sliced number by carry-save addition of bitmaps, for
all queries of a block at once. A negative factor takes a slice's complement and a
constant. The top rows are then read off from the most significant slice downward. Only
the higher bits of the attributes have slices, so a row's score is known up to a bounded
error; rows that the error leaves undecided at the boundary are resolved by their exact
inner products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routepulse.llm.common import map_batches, only

#: Rows of an index block, and queries that go through the blocks at a time.
BLOCK_ROWS = 1 << 15
BLOCK_QUERIES = 4096
#: Queries whose bitmaps are added at a time.
AT_ONCE = 64
#: Lowest bits of the attributes that the slices leave to the exact step.
LOW_BITS = 3
#: The largest component, and the largest score that a long holds.
LARGEST = 1 << 62
LONG = (1 << 63) - 1


def quantised(vector, scale: float = 256.0):
    """Column of floor(scale * x) per component, x as double; NULL where a component is not finite.

    Numbers beyond LARGEST are taken as that.
    """
    usable = F.size(vector).isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))

    def whole(x):
        number = F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))
        return F.floor(number).cast("long")

    return F.when(F.coalesce(usable, F.lit(False)), F.transform(vector, whole))


class Slices:
    """The bit-sliced index of a block of rows."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.repeats = len(np.unique(ids)) < len(ids)
        self.low = rows.min(axis=0) if len(rows) else np.zeros(rows.shape[1], np.int64)
        shifted = rows.astype(np.uint64) - self.low.astype(np.uint64)  # never below 0, whatever the span
        self.most = float(np.abs(rows.astype(np.float64)).max(initial=0))
        self.bits = max(0, int(shifted.max()).bit_length() - LOW_BITS) if shifted.size else 0
        self.words = -(-len(rows) // 64)
        padded = np.zeros((self.words * 64, rows.shape[1]), np.uint64)
        padded[: len(rows)] = shifted
        # slices[attribute][bit]: a bitmap over the rows
        self.slices = np.empty((rows.shape[1], self.bits, self.words), np.uint64)
        for bit in range(self.bits):
            plane = np.packbits(((padded >> np.uint64(bit + LOW_BITS)) & np.uint64(1)).astype(np.uint8), axis=0, bitorder="little")
            self.slices[:, bit] = np.ascontiguousarray(plane.T).view(np.uint64).reshape(rows.shape[1], self.words)

    def sums(self, queries: np.ndarray) -> tuple[list[np.ndarray], list[int]]:
        """Bit-sliced sums per query, and how far a row's true sum may lie above its own."""
        high = np.abs(queries)
        negative = queries < 0
        # an attribute is 2 ** LOW_BITS * its slices plus at most 2 ** LOW_BITS - 1
        error = [sum(q) * ((1 << LOW_BITS) - 1) for q in high.tolist()]
        factor_bits = int(high.max()).bit_length() if high.size else 0
        columns: list[list[np.ndarray]] = [[] for _ in range(factor_bits + self.bits + queries.shape[1].bit_length() + 1)]
        sign = np.where(negative, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
        result = []
        waiting: list[list[np.ndarray]] = columns
        for d in range(queries.shape[1]):
            chosen = self.slices[d][:, None, :] ^ sign[:, d][None, :, None]
            for j in range(factor_bits):
                mask = np.where((high[:, d] >> j) & 1, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
                if not mask.any():
                    continue
                for bit in range(self.bits):
                    _add(waiting, bit + j, chosen[bit] & mask[:, None])
        for place, maps in enumerate(waiting):
            while len(maps) > 1:  # two left: a half adder
                a, b = maps.pop(), maps.pop()
                if maps:
                    c = maps.pop()
                    x = a ^ b
                    maps.append(x ^ c)
                    waiting[place + 1].append((a & b) | (x & c))
                else:
                    maps.append(a ^ b)
                    if place + 1 < len(waiting):
                        waiting[place + 1].append(a & b)
            result.append(maps[0] if maps else None)
        return result, error

    def top(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query its k best different ids and their best scores, ties to the smaller id."""
        if not len(self.rows):
            return [(self.ids, np.zeros(0, np.int64))] * len(queries)
        planes, error = self.sums(queries)
        valid = np.zeros(self.words * 64, np.uint8)
        valid[: len(self.rows)] = 1
        valid = np.packbits(valid, bitorder="little").view(np.uint64)
        out = []
        count = lambda x: int(np.bitwise_count(x).sum())
        for q in range(len(queries)):
            wanted = min(k + 1, len(self.rows))  # the query's own row may be among them
            slack = -(-int(error[q]) >> LOW_BITS) + 1
            while True:
                # the wanted-th largest sum, from the most significant slice downward
                tie, sure, value = valid.copy(), 0, 0
                for place in range(len(planes) - 1, -1, -1):
                    plane = planes[place]
                    have = tie & plane[q] if plane is not None else np.zeros_like(tie)
                    n = count(have)
                    if sure + n >= wanted:
                        tie, value = have, value | (1 << place)
                    else:
                        sure += n
                        tie = tie & ~have
                if not self.repeats or wanted == len(self.rows):
                    break
                # rows of one id, the query's own included, fill no more than one place
                inside = self.ids[self._reaching(planes, q, valid, value)]
                if len(np.unique(inside[inside != own[q]])) >= k:
                    break
                wanted = min(2 * wanted, len(self.rows))
            # all rows whose sum plus the error may reach it: sum >= value - slack
            rows = self._reaching(planes, q, valid, max(0, value - slack))
            rows = rows[self.ids[rows] != own[q]]
            scores, best = self._exact(rows, queries[q])
            if self.repeats:
                best = best[np.sort(np.unique(self.ids[rows][best], return_index=True)[1])]
            best = best[:k]
            out.append((self.ids[rows][best], scores[best]))
        return out

    def _exact(self, rows: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' inner products, and their order: higher scores first, then smaller ids."""
        ids = self.ids[rows]
        if self.most * float(np.abs(query.astype(np.float64)).sum()) < LARGEST:
            scores = self.rows[rows] @ query
            return scores, np.lexsort((ids, -scores))
        # too large for 64 bits: as Python's numbers
        exact = [sum(a * b for a, b in zip(row, query.tolist(), strict=True)) for row in self.rows[rows].tolist()]
        order = sorted(range(len(rows)), key=lambda i: (-exact[i], ids[i]))
        return np.array([max(-LONG, min(LONG, x)) for x in exact], np.int64), np.array(order, np.int64)

    def _reaching(self, planes: list[np.ndarray], q: int, valid: np.ndarray, bound: int) -> np.ndarray:
        """The rows whose sum is at least ``bound``."""
        above, equal = np.zeros_like(valid), valid.copy()
        for place in range(len(planes) - 1, -1, -1):
            plane = planes[place][q] if planes[place] is not None else np.zeros_like(valid)
            if (bound >> place) & 1:
                equal = equal & plane
            else:
                above |= equal & plane
                equal = equal & ~plane
        return np.flatnonzero(np.unpackbits((above | equal).view(np.uint8), bitorder="little"))


def _add(waiting: list[list[np.ndarray]], place: int, bitmap: np.ndarray) -> None:
    """Add a bitmap at a place; three at one place become a sum and a carry."""
    maps = waiting[place]
    maps.append(bitmap)
    while len(waiting[place]) >= 3:
        a, b, c = waiting[place].pop(), waiting[place].pop(), waiting[place].pop()
        x = a ^ b
        waiting[place].append(x ^ c)
        carry = (a & b) | (x & c)
        place += 1
        waiting[place].append(carry)


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows with the highest inner product.

    ``rows`` and ``queries`` have vec_id and vector (array of whole numbers); a query's own id is
    no candidate, ties go to the smaller id, fewer rows are all returned. NULL ids and
    vectors, and vectors of another length than a query's, take no part with it. Rows
    repeated under one id are one candidate (with the best of their scores); a repeated query id
    with one vector is one query. Empty tables give no rows. Queries go through
    all blocks of rows in blocks of about ``block_queries``, each sent to the tasks.
    Scores are exact; one beyond 64 bits is given as the nearest number that a long holds.
    """
    spark = rows.sparkSession
    usable = F.col("vec_id").isNotNull() & F.col("vector").isNotNull()
    rows, queries = only(rows, "vec_id", "vector").where(usable), only(queries, "vec_id", "vector").where(usable).distinct()
    blocks = max(1, -(-queries.count() // block_queries))
    found = []
    for number in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == number) if blocks > 1 else queries
        found.append(_block(rows, spark.sparkContext.broadcast(_matrices(part.toArrow())), k))
    out = found[0]
    for more in found[1:]:
        out = out.unionAll(more)
    best = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def _matrices(table: pa.Table | pa.RecordBatch) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors by the vectors' length."""
    ids, vectors = table.column("vec_id"), table.column("vector")
    if isinstance(ids, pa.ChunkedArray):
        ids, vectors = ids.combine_chunks(), vectors.combine_chunks()
    lengths, out = pc.list_value_length(vectors).to_numpy(zero_copy_only=False), {}
    for n in np.unique(lengths).tolist():
        mask = pa.array(lengths == n)
        values = pc.list_flatten(vectors.filter(mask)).to_numpy(zero_copy_only=False).astype(np.int64)
        out[n] = ids.filter(mask).to_numpy(zero_copy_only=False).astype(np.int64), values.reshape(int(mask.sum().as_py()), n)
    return out


def _block(rows: DataFrame, queries, k: int) -> DataFrame:
    def work(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield from search(pa.Table.from_batches(held))
                held, n = [], 0
        if held:
            yield from search(pa.Table.from_batches(held))

    def search(table):
        for size, (ids, vectors) in _matrices(table).items():
            own, asked = queries.value.get(size, (None, ()))
            if not len(asked) or not size:
                continue
            index = Slices(ids, vectors)
            for i in range(0, len(asked), AT_ONCE):
                best = index.top(asked[i : i + AT_ONCE], own[i : i + AT_ONCE], k)
                yield {
                    "query_id": np.repeat(own[i : i + AT_ONCE], [len(x) for x, _ in best]),
                    "vec_id": np.concatenate([x for x, _ in best]),
                    "score": np.concatenate([x for _, x in best]),
                }

    return map_batches(rows, work, "query_id long, vec_id long, score long")
