"""What several operators share: batches of text, word hashes, staged tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routepulse.session import tune

# Text that a worker handles at a time; only memory depends on it, never a result.
SLICE_BYTES = 4 << 20
# The same where shingles are hashed, which takes about fifty bytes for each byte of text.
HASHED_BYTES = 1 << 20
# Rows that Spark hands to a Python worker at a time: the longest texts must fit many times over.
ROWS_PER_BATCH = 256

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def prepare(spark: SparkSession) -> SparkSession:
    """Adaptive settings, and small batches for Python workers since texts may be very long."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns alone: further ones, clashing names included, are not read."""
    return df.select(*(F.col(f"`{c}`") for c in columns))


def map_batches(df: DataFrame, work: Callable, schema: str) -> DataFrame:
    """``work(iterator of pyarrow batches)`` yields dicts of columns for ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in work(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most ``limit`` bytes in ``column``, or one row."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy()
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def gathered(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring slices put together up to about ``limit`` bytes in ``column``."""
    held, total = [], 0
    for batch in batches:
        for part in slices(batch, column, limit):
            n = pa.compute.sum(pa.compute.binary_length(part.column(column))).as_py() or 0
            if held and total + n > limit:
                yield pa.concat_batches(held)
                held, total = [], 0
            held.append(part)
            total += n
    if held:
        yield pa.concat_batches(held)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; NULL counts as empty."""
    texts = pa.concat_arrays([pa.compute.fill_null(texts, "").cast(pa.large_string())])
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


class Powers:
    """Powers of the hash base, kept between batches of a task."""

    def __init__(self):
        self.n = 0

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = n
            self.up, self.down = powers(_BASE, n), powers(_BASE_INVERSE, n)
        return self.up[:n], self.down[:n]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of each row, and words per row."""
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, power: Powers) -> np.ndarray:
    """A 64-bit hash of every word, from running sums over the bytes."""
    up, down = power(len(data) + 1)
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * up[:-1], dtype=np.uint64)])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, in order, and their number per row.

    A row with fewer words has one shingle, its whole sequence; without words it has none.
    """
    factors = mix(np.arange(11, 11 + k, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)) | np.uint64(1)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    n = len(words)
    place = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.repeat(counts, counts) - place
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += np.where(left > j, padded[j : j + n] * factors[j], np.uint64(0))
    short = np.repeat(counts, counts) < k
    total = mix(total + np.where(short, np.repeat(counts, counts), k).astype(np.uint64))
    keep = (left >= k) | (short & (place == 0))
    return total[keep], np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))


def shingle_sets(texts: pa.Array, k: int, power: Powers) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(texts)
    data = lowered(data)
    starts, ends, counts = word_spans(data, offsets)
    hashes, sizes = shingle_hashes(word_hashes(data, starts, ends, power), counts, k)
    at = 0
    for n in sizes.tolist():
        yield np.unique(hashes[at : at + n])
        at += n
