"""Packing of token sequences: shortest pack first over the histogram of lengths.

Documents are encoded and cut into whole sequences and a tail. Of the tails only the
histogram of their lengths reaches the driver program: lengths are placed longest first,
each into the shortest packs that still have room, and only patterns (which lengths fill
a pack) and their counts are kept. A tail finds its place from its rank among the tails
of its length. Packs that stay short are laid one after the other and cut anew at
the sequences' borders, the last of them at powers of two.
"""

from __future__ import annotations

import heapq
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routepulse.llm.common import gathered, map_batches, only, text_bytes, word_spans
from routepulse.session import stage

#: Bytes of text, and of token ids, handled at a time (memory only).
SLICE_BYTES = 2 << 20
IDS_BYTES = 4 << 20
#: Words whose tokens a task remembers between batches (memory only).
REMEMBERED = 1 << 19
#: Rank offsets (one per task and length) that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1 << 18
#: The number of a whole sequence: this times its task's number, plus its number in the task.
TASK = 1 << 40


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start .. start + size - 1 of each pair, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


#: Fixed value: how the tokenizers that ``WordTokens`` knows cut a word.
CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANK, LETTER, DIGIT, SIGN, OTHER = range(5)


class WordTokens:
    """The tokens of texts, from the library's tokens of their distinct words.

    Only for tokenizers that drop white space: a word's tokens don't depend on its neighbours.
    Words of ASCII and Latin-1 letters, digits and signs are put in lower case and cut as the
    tokenizer does it, so that fewer distinct ones are left; others are left to the library as they are.
    """

    def __init__(self, definition: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        content = json.loads(definition)
        steps = [json.dumps(content[x]) for x in ("normalizer", "pre_tokenizer")]
        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.end_id = end_id
        suffix = content["model"].get("end_of_word_suffix")
        self.kinds = np.full(256, OTHER, np.uint8)  # of bytes
        self.kinds[[9, 10, 11, 12, 13, 32]] = BLANK
        if suffix and json.dumps(CUT_PATTERN) in steps[1] and "Lowercase" in steps[0]:
            self.kinds[33:127] = SIGN
            self.kinds[ord("0") : ord("9") + 1] = DIGIT
            self.kinds[ord("A") : ord("Z") + 1] = self.kinds[ord("a") : ord("z") + 1] = LETTER
            self.kinds[[ord("'"), *(ord(t["content"][0]) for t in content["added_tokens"])]] = OTHER
        vocabulary = content["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # the tokens that end a word
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.known = {b"": 0}  # the end of a text
        self.ids, self.size = [np.array([self.end_id], np.uint32)], [np.ones(1, np.int64)]

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The words or their parts, and their number per text."""
        starts, ends, counts = word_spans(data, offsets)
        kinds = self.kinds[data]
        latin = np.flatnonzero((data[:-1] == 0xC3) & (self.kinds[ord("A")] == LETTER))
        latin = latin[(data[latin + 1] != 0x97) & (data[latin + 1] != 0xB7)]
        kinds[latin] = kinds[latin + 1] = LETTER
        odd = np.concatenate([[0], np.cumsum(kinds == OTHER, dtype=np.int32)])
        odd = odd[ends] > odd[starts]
        whole = np.repeat(odd, ends - starts)  # of the bytes that are no blanks
        packed, kinds = np.ascontiguousarray(data[kinds != BLANK]), kinds[kinds != BLANK]
        capital = ~whole & ((packed >= 65) & (packed <= 90))
        capital[1:] |= ~whole[1:] & (packed[:-1] == 0xC3) & (packed[1:] <= 0x9E) & (packed[1:] >= 0x80)
        packed[capital] += 32
        begins = np.zeros(len(packed), bool)
        begins[1:] = ~whole[1:] & ((kinds[1:] != kinds[:-1]) | (kinds[1:] == DIGIT))
        word_at = np.cumsum(ends - starts) - (ends - starts)
        begins[word_at] = True
        borders = np.append(np.flatnonzero(begins), len(packed)).astype(np.int64)
        cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(packed)])
        edges = np.append(word_at, len(packed))[np.concatenate([[0], np.cumsum(counts)])]
        return cells, np.diff(np.searchsorted(borders, edges))

    def learn(self, words: list[bytes]) -> None:
        """Encode words and remember their tokens."""
        plain = re.compile(b"[a-z]+|(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+") if self.kinds[ord("a")] == LETTER else re.compile(b"(?!)")
        joined, single = [], []
        for w in words:
            (joined if plain.fullmatch(w) else single).append(w)
        chunks = [joined[i : i + 256] for i in range(0, len(joined), 256)]
        ids, size = [], []
        for found, chunk in zip(self.library.encode_batch_fast([b" ".join(c).decode() for c in chunks], add_special_tokens=False), chunks, strict=True):
            ids.append(np.array(found.ids, np.uint32))
            ends = np.flatnonzero(self.ends[ids[-1]])
            if len(ends) != len(chunk):
                raise ValueError("the tokenizer does not cut words at blanks")
            size.append(np.diff(ends, prepend=-1))
        for found in self.library.encode_batch_fast([w.decode() for w in single], add_special_tokens=False):
            ids.append(np.array(found.ids, np.uint32))
            size.append(np.array([len(ids[-1])]))
        n = len(self.known)
        self.known.update(zip(joined + single, range(n, n + len(words)), strict=True))
        self.ids, self.size = [np.concatenate(self.ids + ids)], [np.concatenate(self.size + size)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and their number per text."""
        cells, counts = self.cut(*text_bytes(texts))
        cells = cells.dictionary_encode()
        if len(self.known) > REMEMBERED:
            self.clear()
        distinct = cells.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.known]
        if new:
            self.learn(new)
        words = np.array([self.known[w] for w in distinct], np.int64)[cells.indices.to_numpy()]
        words = np.insert(words, np.cumsum(counts), 0)
        ids, size = self.ids[0], self.size[0]
        first = np.cumsum(size) - size
        total = np.concatenate([[0], np.cumsum(size[words])])
        return ids[ranges(first[words], size[words])], np.diff(total[np.concatenate([[0], np.cumsum(counts + 1)])])


def ranks(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The rank of each value among equal ones, after those that ``seen`` counts; counts them there."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.searchsorted(ordered, ordered)
    out += seen[values]
    seen += np.bincount(values, minlength=len(seen))
    return out


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Patterns (tokens, packs, [(length, pieces of it)]) that hold every length once for each count.

    There are at most three patterns for each length.
    """
    packs = [(capacity, 0, 0, [])]  # by tokens; the first entry only ends the search
    serial = 0

    def put(used, count, content):
        nonlocal serial
        serial += 1
        heapq.heappush(packs, (used, serial, count, content))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            used, _, count, content = packs[0]
            if used + length > capacity:  # not even the shortest has room
                each = capacity // length
                if n >= each:
                    put(each * length, n // each, [(length, each)])
                if n % each:
                    put(n % each * length, 1, [(length, n % each)])
                break
            heapq.heappop(packs)
            if n < count:
                put(used, count - n, content)
                count = n
            # as many of the length at once as leave the pack the shortest
            times = max(1, min(n // count, (min(packs[0][0], capacity) - used) // length))
            put(used + times * length, count, [*content, (length, times)])
            n -= times * count
    return [(used, count, content) for used, _, count, content in packs if count]


def layout(histogram: dict[int, int], capacity: int, padding: int) -> dict:
    """Which ranks of each length go where; at most a few rows for each length of a pattern.

    A row of "rows": length, first rank, first sequence, pieces of the length in a sequence, their
    offset. Packs with more than ``padding`` free tokens are laid out one after the other: their rows have
    no pieces, and the place from which on the length is laid out in place of the sequence.
    """
    placed = dict.fromkeys(histogram, 0)
    rows, sequences = [], 0
    for used, count, content in shortest_pack_first(histogram, capacity):
        if capacity - used > padding and used & (used - 1):
            continue
        offset = 0
        for length, times in content:
            rows.append((length, placed[length], sequences, times, offset))
            placed[length] += count * times
            offset += length * times
        sequences += count
    at = 0
    for length in sorted(histogram, reverse=True):
        if placed[length] < histogram[length]:
            rows.append((length, placed[length], at, 0, 0))
            at += (histogram[length] - placed[length]) * length
    # the last sequences are as long as the powers of two that make up the rest
    rest = [1 << k for k in range(capacity.bit_length(), -1, -1) if at % capacity >> k & 1]
    return {"rows": np.array(sorted(rows), np.int64).reshape(-1, 5), "whole": at // capacity, "first": sequences, "borders": at - at % capacity + np.cumsum([0, *rest])}


def place(found: dict, capacity: int, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """(which tail, start in the tail, length, sequence, offset) of all pieces of tails of a length and rank."""
    high = np.int64(1) << 40  # no length has so many tails
    lengths, first_rank, base, pieces, offset = found["rows"].T
    row = np.searchsorted(lengths * high + first_rank, length * high + rank, "right") - 1
    ahead, times = rank - first_rank[row], pieces[row]
    fixed = np.flatnonzero(times)
    f, t = row[fixed], times[fixed]
    out = [(fixed, np.zeros(len(fixed), np.int64), length[fixed], base[f] + ahead[fixed] // t, offset[f] + ahead[fixed] % t * length[fixed])]
    whole, borders = found["whole"], found["borders"]
    which = np.flatnonzero(times == 0)
    begin = at = base[row[which]] + ahead[which] * length[which]
    end = begin + length[which]
    while len(which):
        early = at < whole * capacity
        part = np.searchsorted(borders, at, "right") - 1  # of the last sequences
        start = np.where(early, at - at % capacity, borders[part])
        stop = np.minimum(end, np.where(early, start + capacity, borders[np.minimum(part + 1, len(borders) - 1)]))
        out.append((which, at - begin, stop - at, found["first"] + np.where(early, at // capacity, whole + part), at - start))
        more = stop < end
        which, begin, at, end = which[more], begin[more], stop[more], end[more]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _encoded(docs: DataFrame, definition: str, capacity: int, end_id: int, id_column: str, text_column: str) -> DataFrame:
    """Per document its ids, the length of its tail, and its place among the task's rows."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)  # one tokenizer file
    schema = f"key {dict(docs.dtypes)[id_column]}, ids binary, n long, tail int, rank long, task int, whole_before long"

    def work(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder, seen, whole_before = WordTokens(shared.value, end_id), np.zeros(capacity, np.int64), 0
        for part in gathered(batches, text_column, SLICE_BYTES):
            ids, n = encoder.encode(part.column(text_column))
            borders = np.concatenate([[0], np.cumsum(n)]).astype(np.int64) * 4
            cells = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(borders), pa.py_buffer(ids.astype("<u4"))])
            whole = np.cumsum(n // capacity)
            yield {
                "key": part.column(id_column),
                "ids": cells.cast(pa.binary()),
                "n": n,
                "tail": (n % capacity).astype(np.int32),
                "rank": ranks(n % capacity, seen),
                "task": np.full(len(n), task, np.int32),
                "whole_before": whole_before + whole - n // capacity,
            }
            whole_before += int(whole[-1]) if len(whole) else 0

    return map_batches(only(docs, id_column, text_column), work, schema)


def pack_documents(
    docs: DataFrame, definition: str, capacity: int = 2048, end_id: int = 1, padding: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id, offset.

    A document's tokens are those of its text by the tokenizer ``definition`` (one that
    drops white space), and ``end_id``. ``start`` counts the document's tokens before the piece, ``ids`` are
    the piece's tokens as unsigned 32-bit little-endian numbers, ``offset`` its place in
    the sequence. Pieces fill each sequence from 0 without a gap and to at most ``capacity`` tokens; a sequence that is
    neither full nor a power of two long has at most ``padding`` tokens less. With 0,
    nothing is ever padded.

    NULL and empty texts are one end token. Documents of equal length are ranked by their place in
    the input; repeated rows, also of one id or a NULL id, are packed each. An empty table gives an empty
    one; other columns are not read. However long, a text is encoded whole, in one task: memory grows with the longest one.
    The ids are written once in between.
    """
    encoded = stage(_encoded(docs, definition, capacity, end_id, id_column, text_column), "token-ids")
    tails = stage(encoded.groupBy("task", "tail").agg(F.count("*").alias("n")), "token-tails")
    histogram = {r.tail: r.n for r in tails.where("tail > 0").groupBy("tail").agg(F.sum("n").alias("n")).collect()}  # fewer than capacity rows
    before = F.sum("n").over(Window.partitionBy("tail").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    offsets = tails.select("task", "tail", F.coalesce(before, F.lit(0)).alias("before"))
    if tails.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    ranked = encoded.join(offsets, ["task", "tail"]).select("key", "ids", "n", "tail", (F.col("rank") + F.col("before")).alias("rank"), (F.col("task") + 1).cast("long").alias("task"), "whole_before")
    shared = docs.sparkSession.sparkContext.broadcast(layout(histogram, capacity, padding))  # its size depends on the capacity alone
    schema = f"key {dict(docs.dtypes)[id_column]}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def work(batches):
        found = shared.value
        for part in gathered(batches, "ids", IDS_BYTES):
            n, tail, rank, task, whole_before = (part.column(c).to_numpy() for c in ("n", "tail", "rank", "task", "whole_before"))
            whole = n // capacity
            which = np.repeat(np.arange(len(n)), whole)
            number = ranges(np.zeros(len(n), np.int64), whole)
            pieces = [(which, number * capacity, np.full(len(which), capacity), task[which] * TASK + whole_before[which] + number, np.zeros(len(which), np.int64))]
            with_tail = np.flatnonzero(tail)
            of, start, *rest = place(found, capacity, tail[with_tail].astype(np.int64), rank[with_tail])
            of = with_tail[of]
            pieces.append((of, whole[of] * capacity + start, *rest))
            which, start, length, sequence, offset = (np.concatenate(x) for x in zip(*pieces, strict=True))
            cells = part.column("ids").to_pylist()
            ids = [cells[w][4 * s : 4 * (s + k)] for w, s, k in zip(which.tolist(), start.tolist(), length.tolist(), strict=True)]
            yield {"key": part.column("key").take(pa.array(which)), "start": start, "length": length, "ids": ids, "doc_tokens": n[which], "sequence_id": sequence, "offset": offset}

    return map_batches(ranked, work, schema).withColumnRenamed("key", id_column)
