"""Periodic runs of words: stretches that repeat themselves with a period.

Words that occur too rarely within their segment to belong to a run (once: a run of
twelve words or more, two periods at least, holds each of its words twice) split it; the
parts are split again by what is rare in them, until nothing changes. What survives is
scanned lag by lag: short lags word by word; for longer ones, equal blocks at the lag
are looked for first (a run holds whole aligned blocks) and extended over equal words.
All texts of a batch are handled as one array, so that a step is a handful of array
operations whatever the number of texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from routepulse.llm.common import gathered, map_batches, mix, only, text_bytes, word_spans

#: Words that a run has at least.
LEAST_WORDS = 12
#: Lags below this one are compared word by word.
DIRECT_LAGS = 16
#: Rounds of splitting. What is not settled by then is scanned as it is: the scan is exact
#: for any segment, so this bounds the time of texts made to split slowly and no result.
ROUNDS = 64
#: Bytes of text and block comparisons handled at a time (memory only).
SLICE_BYTES = 1 << 20
COMPARED = 1 << 22

_FACTOR = np.uint64(0x9FB21C651E98DF25)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each pair, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def settled_segments(words: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments that splitting at rare words leaves, in order."""
    n = len(words)
    order = np.argsort(words, kind="stable")
    same = words[order[1:]] == words[order[:-1]]
    before, after = np.full(n, -1), np.full(n, n)
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    low, high, settled = edges[:-1], edges[1:], []
    for _ in range(ROUNDS):
        long = high - low >= LEAST_WORDS
        low, high = low[long], high[long]
        if not len(low):
            break
        size = high - low
        at, segment = ranges(low, size), np.repeat(np.arange(len(low)), size)
        rare = (before[at] < low[segment]) & (after[at] >= high[segment])
        done = np.bincount(segment[rare], minlength=len(low)) == 0
        settled.append((low[done], high[done]))
        stays = ~rare & ~done[segment]
        joined = stays[1:] & stays[:-1] & (segment[1:] == segment[:-1])
        first, last = stays.copy(), stays.copy()
        first[1:] &= ~joined
        last[:-1] &= ~joined
        low, high = at[first], at[last] + 1
    settled.append((low, high))
    low, high = (np.concatenate(x) for x in zip(*settled, strict=True))
    order = np.argsort(low)
    return low[order], high[order]


def _primes(n: int) -> list[int]:
    out, d = [], 2
    while d * d <= n:
        if n % d == 0:
            out.append(d)
            while n % d == 0:
                n //= d
        d += 1
    return [*out, n] if n > 1 else out


def _primitive(x: np.ndarray, start: np.ndarray, lag: int) -> np.ndarray:
    """Whether the first ``lag`` words of each run do not repeat a shorter part."""
    good = np.ones(len(start), bool)
    for prime in _primes(lag):
        part = lag // prime
        offsets = np.arange(lag - part)
        for i in range(0, len(start), max(1, COMPARED // lag)):
            at = start[i : i + max(1, COMPARED // lag), None] + offsets
            good[i : i + len(at)] &= (x[at] != x[at + part]).any(axis=1)
    return good


def _equal_after(x: np.ndarray, i: int, j: int) -> int:
    """How many words from ``i`` on equal those from ``j`` > ``i`` on."""
    total, step = 0, 64
    while (n := min(step, len(x) - j - total)) > 0:
        unequal = x[i + total : i + total + n] != x[j + total : j + total + n]
        k = int(unequal.argmax())
        if unequal[k]:
            return total + k
        total, step = total + n, step * 4
    return total


def _equal_before(x: np.ndarray, i: int, j: int) -> int:
    """How many words before ``i`` equal those before ``j`` > ``i``."""
    total, step = 0, 64
    while (n := min(step, i - total)) > 0:
        unequal = (x[i - total - n : i - total] != x[j - total - n : j - total])[::-1]
        k = int(unequal.argmax())
        if unequal[k]:
            return total + k
        total, step = total + n, step * 4
    return total


def _short_lags(x: np.ndarray) -> list[np.ndarray]:
    found = []
    for lag in range(1, min(DIRECT_LAGS, len(x))):
        equal = np.zeros(len(x) - lag + 2, np.int8)
        equal[1:-1] = x[lag:] == x[:-lag]
        turn = np.flatnonzero(np.diff(equal))
        start, end = turn[::2], turn[1::2]
        long = end - start >= max(LEAST_WORDS - lag, lag)
        start, end = start[long], end[long]
        good = _primitive(x, start, lag)
        found.append(np.stack([start[good], (end - start)[good] + lag, np.full(good.sum(), lag)], axis=1))
    return found


def _long_lags(x: np.ndarray, segment: np.ndarray, size: np.ndarray, found: list[np.ndarray]) -> None:
    """Runs with lags from DIRECT_LAGS on, a class of lags (2 ** k to 2 ** (k + 1) - 1) at a time.

    Words that equal those one lag on make a stretch of ``lag`` words at least, which
    holds an aligned block of half the least lag of the class.
    """
    n = len(x)
    block, hashes = 1, mix(x.astype(np.uint64))
    while 4 * block <= size.max(initial=0):
        if block >= DIRECT_LAGS // 2:
            rows = np.arange(0, n, block)
            rows = rows[(size[segment[rows]] >= 4 * block) & (rows + block <= n)]
            found.append(_lag_class(x, segment, rows, block, hashes, np.concatenate(found)))
        # the hash of twice as long a block that starts at the same word
        hashes = mix(hashes * _FACTOR + np.concatenate([hashes[block:], np.zeros(min(block, n), np.uint64)]))
        block *= 2


def _lag_class(x, segment, rows, block, hashes, known):
    n, lags = len(x), np.arange(2 * block, 4 * block)
    # the run of a short period that covers a block: there is one at most
    cover = np.full(n // block + 1, -1)
    near = np.flatnonzero((known[:, 2] <= block // 2) & (known[:, 1] >= 3 * block))
    low, high = -(-known[near, 0] // block), (known[near, 0] + known[near, 1]) // block
    cover[ranges(low, high - low)] = np.repeat(near, high - low)
    padded = np.concatenate([hashes, np.zeros(4 * block, np.uint64)])
    windows = np.lib.stride_tricks.sliding_window_view(padded, 2 * block)
    hit_row, hit_lag = [], []
    step = max(1, COMPARED // (2 * block))
    for i in range(0, len(rows), step):
        part = rows[i : i + step]
        row, lag = np.nonzero(windows[part + 2 * block] == hashes[part, None])
        row, lag = part[row], lags[lag]
        inside = row + lag < n
        row, lag = row[inside], lag[inside]
        run = cover[row // block]
        start, length, period = known[run].T if len(known) else (row, row, lag)
        part_of_known = (run >= 0) & (lag % period == 0) & (row + lag + block <= start + length)
        keep = (segment[row] == segment[row + lag]) & ~part_of_known
        hit_row.append(row[keep])
        hit_lag.append(lag[keep])
    if not hit_row:
        return np.zeros((0, 3), np.int64)
    row, lag = np.concatenate(hit_row), np.concatenate(hit_lag)
    order = np.lexsort((row, lag))
    row, lag = row[order], lag[order]
    first = np.ones(len(row), bool)  # blocks one after the other are in one stretch
    first[1:] = (lag[1:] != lag[:-1]) | (row[1:] != row[:-1] + block)
    out, last, end = [], 0, 0
    for c, q in zip(row[first].tolist(), lag[first].tolist(), strict=True):
        if q == last and c < end:
            continue
        after = _equal_after(x, c, c + q)
        start, last, end = c - _equal_before(x, c, c + q), q, c + after
        if end - start >= q and _primitive(x, np.array([start]), q)[0]:
            out.append((start, end - start + q, q))
    return np.array(out, np.int64).reshape(-1, 3)


def runs_of(words: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs in the sequences that ``edges`` cut ``words`` into.

    ``words`` are whole numbers, equal for equal words. Rows are ordered by start and period.
    """
    low, high = settled_segments(words, edges)
    size = high - low
    if not len(low):
        return np.zeros((0, 3), np.int64)
    # segments one after the other, a number of its own after each
    at = np.cumsum(size + 1) - (size + 1)
    x = np.empty(int(size.sum()) + len(size), np.int64)
    x[at + size] = int(words.max()) + 1 + np.arange(len(size))
    x[ranges(at, size)] = words[ranges(low, size)]
    segment = np.repeat(np.arange(len(size)), size + 1)
    found = _short_lags(x)
    _long_lags(x, segment, size, found)
    runs = np.concatenate(found)
    runs[:, 0] += (low - at)[segment[runs[:, 0]]]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _found(texts: pa.Array) -> dict:
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_spans(data, offsets)
    edges = np.concatenate([[0], np.cumsum(counts)])
    lengths = ends - starts
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    packed = np.ascontiguousarray(data[inside])
    cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)), pa.py_buffer(packed)])
    words = cells.dictionary_encode().indices.to_numpy().astype(np.int64)
    runs = runs_of(words, edges)
    # words after the first period of a run go
    turn = np.zeros(len(words) + 1, np.int64)
    np.add.at(turn, runs[:, 0] + runs[:, 2], 1)
    np.add.at(turn, runs[:, 0] + runs[:, 1], -1)
    stays = np.cumsum(turn[:-1]) == 0
    owner = np.repeat(np.arange(len(counts)), counts)
    last = np.full(len(counts), -1)
    last[owner[stays]] = np.flatnonzero(stays)
    kept = np.flatnonzero(stays)
    joined = kept[kept != last[owner[kept]]]  # a blank follows these
    out = data.copy()
    gone = np.zeros(len(data) + 1, np.int8)
    np.add.at(gone, starts[~stays], 1)
    np.add.at(gone, ends[~stays], -1)
    taken = inside & (np.cumsum(gone[:-1], dtype=np.int8) == 0)
    out[ends[joined]], taken[ends[joined]] = 32, True
    n_kept = np.bincount(owner[kept], minlength=len(counts))
    size = np.bincount(owner[kept], weights=lengths[kept], minlength=len(counts)).astype(np.int64) + np.maximum(n_kept - 1, 0)
    buffers = [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(out[taken]))]
    document = np.searchsorted(edges, runs[:, 0], "right") - 1
    columns = [pa.array(c) for c in (runs[:, 0] - edges[document], runs[:, 1], runs[:, 2])]
    return {
        "n_words": counts.astype(np.int64),
        "runs": _lists(pa.StructArray.from_arrays(columns, ["start", "length", "period"]), np.bincount(document, minlength=len(counts))),
        "collapsed": pa.LargeStringArray.from_buffers(len(counts), buffers[1], buffers[2]).cast(pa.string()),
    }


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_words, runs, collapsed.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a stretch with smallest
    period q (words q apart are equal) of at least max(12, 2q) words that no neighbouring word
    extends; ``runs`` lists (start, length, period) by start, then period. ``collapsed``
    is the text without the words that any run holds after its first period, the others
    joined by single blanks.

    NULL, empty and blank texts have no words, no runs and an empty collapsed text. Runs of
    equal length, start or overlap are all listed. Repeated rows, also of one id or a NULL id,
    are handled each; an empty table gives an empty one; other columns are not read. A text
    is handled whole however long: memory is some forty bytes for each byte of the longest one,
    time grows with n log n of its words.
    """
    schema = f"key {dict(docs.dtypes)[id_column]}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

    def work(batches):
        for part in gathered(batches, text_column, SLICE_BYTES):
            yield {"key": part.column(id_column)} | _found(part.column(text_column))

    return map_batches(only(docs, id_column, text_column), work, schema).withColumnRenamed("key", id_column)
