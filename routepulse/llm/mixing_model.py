"""A language model by logistic mixing of hashed-context bit predictors.

A text has a class, and is a sequence of words, each spelled as its bytes and a blank,
and an end. Every byte is eight binary decisions. Predictors see the decision's node
together with a hashed context: the place in the word, the last one to four bytes, the
word so far, some of them with the class. A predictor is a table of how often either bit
followed, learned from all training words; the tables' sizes follow the number of training words up to
``LONGEST``. The predictions meet in the logistic domain; the gate is how much the longest contexts
have seen, and a predictor's weight also depends on how much it has seen itself. Weights are
learned in rounds, each from other words, and each occurrence is predicted from
tables without itself. A final adaptive table refines the mixed probability.

Before a word is spelled, one decision for each of the words that followed the previous word most often
says whether it is that word (see ``Followers``); a word that is hit is not spelled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from routepulse.llm.common import mix, powers

#: Slots at most of the predictors of bounded contexts, as powers of two: place with class, last byte, last 2
#: and 3 bytes with class, last 4 bytes. The word so far, without and with class, has ``LONGEST`` at most.
SHORT_BITS, LONGEST = (14, 16, 19, 19, 20), 22
ORDERS = len(SHORT_BITS) + 2
GATES, LEVELS, STEPS = 64, 16, 33
#: Prior count of either bit, in tables and in the final refinement.
PRIOR = 0.4
#: Rounds of learning the weights; each takes its share of the words, dealt by their hashes.
#: A step carries this share of the step before.
ROUNDS, CARRIED = 16, 0.5
#: Words whose decisions are worked out together, and bytes at a time: their arrays stay in the processor's cache.
AT_ONCE, CACHED = 40_000, 1 << 14
_BASE = 0x9E3779B97F4A7C15


def layout(words: int) -> tuple[int, ...]:
    """The predictors' table sizes, as powers of two, for a number of different training words."""
    longest = int(np.clip(np.ceil(np.log2(max(words, 1))) + 4, 12, LONGEST))
    return tuple(min(b, longest) for b in SHORT_BITS) + (longest, longest)


def slots_of(bits: tuple[int, ...]) -> int:
    return sum(1 << b for b in bits)


def spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words with their ends, and the length of each; the empty word is the end of a text."""
    data = np.frombuffer(b"".join([w + b" " if w else b"\n" for w in words]), np.uint8)
    return data, np.array([len(w) + 1 for w in words])


def contexts(data: np.ndarray, sizes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words share their beginnings: every different (class, word so far, byte) once, as a hash per predictor, its place in
    the word and its byte; and which of them each byte is.
    """
    group = mix(np.repeat(classes, sizes).astype(np.uint64) + np.uint64(31))
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    place = np.arange(len(data)) - starts
    up, down = powers(_BASE, len(data) + 1), powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
    table = mix(np.arange(1, 257, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * up[:-1], dtype=np.uint64)])
    so_far = (sums[:-1] - sums[starts]) * down[starts] + place.astype(np.uint64)
    salt = [np.uint64(1_000_003 * (i + 1)) for i in range(ORDERS)]
    last = mix(so_far + group + salt[-1])
    key = mix(last ^ (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xE7037ED1A0B428DB))
    back = pa.array(key).dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(back), prepend=-1))  # they are in order of occurrence
    group, place, so_far = group[first], place[first], so_far[first]
    out = np.empty((ORDERS, len(first)), np.uint64)
    out[0] = mix(np.minimum(place, 15).astype(np.uint64) + group + salt[0])
    joined = np.zeros(len(first), np.uint64)
    for n in range(1, 5):
        before = np.where(place >= n, data[np.maximum(first - n, 0)], 32).astype(np.uint64)
        joined = joined * np.uint64(256) + before
        out[n] = mix(joined + np.uint64(1) + (group if n in (2, 3) else np.uint64(0)) + salt[n])
    out[-2], out[-1] = mix(so_far + salt[-2]), last[first]
    return out, place, data[first], back


def decisions(data: np.ndarray, hashes: np.ndarray, sizes: tuple[int, ...]):
    """For each of a byte's eight bits: the slots of all predictors, and the bit."""
    starts = np.concatenate([[0], np.cumsum([1 << b for b in sizes])])
    for j in range(8):
        node = (np.uint64(1 << j) | (data.astype(np.uint64) >> np.uint64(8 - j))) if j else np.ones(len(data), np.uint64)
        node = node * np.uint64(0xA0761D6478BD642F)
        slots = np.empty((ORDERS, len(data)), np.int64)
        for i, bits in enumerate(sizes):
            slots[i] = ((hashes[i] ^ node) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)
            slots[i] += starts[i]
        yield slots, ((data >> (7 - j)) & 1).astype(np.float32)


def _parts(data: np.ndarray):
    for i in range(0, len(data), CACHED):
        yield slice(i, i + CACHED)


def learn_tables(words: list[bytes], classes: np.ndarray, counts: np.ndarray, tables: np.ndarray, bits: tuple[int, ...]) -> None:
    """Add the words' bits, ``counts`` times each, to ``tables`` (slots x 2)."""
    flat = tables.reshape(-1)
    for i in range(0, len(words), AT_ONCE):
        data, sizes = spelled(words[i : i + AT_ONCE])
        hashes, _, data, back = contexts(data, sizes, classes[i : i + AT_ONCE])
        weight = np.bincount(back, weights=np.repeat(counts[i : i + AT_ONCE], sizes)).astype(flat.dtype)
        for part in _parts(data):
            for slots, bit in decisions(data[part], hashes[:, part], bits):
                slots += slots + bit.astype(np.int64)
                for order in range(ORDERS):
                    np.add.at(flat, slots[order], weight[part])


def compact(tables: np.ndarray) -> np.ndarray:
    """The tables in half the space: counts up to 2048 are exact, of larger ones the ratio is kept."""
    out = np.empty(tables.shape, np.float16)
    for i in range(0, len(tables), 1 << 18):
        part = tables[i : i + (1 << 18)]
        out[i : i + (1 << 18)] = part * np.minimum(1, 60_000 / np.maximum(part.max(axis=1, keepdims=True), 1))
    return out


def _inputs(zeros: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretched predictions, and how much each predictor has seen (a level)."""
    stretched = np.log((ones + PRIOR) / (zeros + PRIOR))
    seen = zeros + ones
    level = np.minimum(np.log2(seen + 1), 11).astype(np.int64)
    sure = (np.minimum(zeros, ones) == 0) & (seen > 0)  # only one bit seen so far
    return stretched.astype(np.float32), np.where(sure, np.minimum(level, 3) + 12, level)


def ready_tables(tables: np.ndarray) -> np.ndarray:
    """Stretched predictions and levels of all slots of compact tables, side by side in one number each."""
    out = np.empty((len(tables), 2), np.float32)
    for i in range(0, len(tables), 1 << 18):
        part = tables[i : i + (1 << 18)].astype(np.float32)
        out[i : i + (1 << 18), 0], out[i : i + (1 << 18), 1] = _inputs(part[:, 0], part[:, 1])
    return out.view(np.uint64).ravel()


#: From a level to one of five: nothing, little, much, very much, or only one bit seen.
_COARSE = np.array([0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 3, 3, 4, 4, 4, 4])


def _gate(level: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (_COARSE[level[-1]] * 5 + _COARSE[level[-2]]) * 2 + (place > 0)


def _cells(gate: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Where the weights of all predictors lie."""
    return (gate * ORDERS + np.arange(ORDERS)[:, None]) * LEVELS + level


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def _step(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of a stretched probability in the refining table, and the share of the next place."""
    at = (np.clip(x, -11.99, 11.99) + 12) * ((STEPS - 1) / 24)
    return at.astype(np.int64), at - at.astype(np.int64)


class Mixer:
    """Gated weights and the refining table."""

    def __init__(self, weights: np.ndarray | None = None, refine: np.ndarray | None = None, step: np.ndarray | None = None):
        self.weights = np.full((GATES, ORDERS, LEVELS), 0.2, np.float64) if weights is None else weights
        self.step = np.zeros_like(self.weights) if step is None else step
        centre = _squash((np.arange(STEPS) / (STEPS - 1)) * 24 - 12)
        self.refine = np.stack([np.tile(1 - centre, (GATES, 1)), np.tile(centre, (GATES, 1))]) * 20 if refine is None else refine

    def mixed(self, cells: np.ndarray, stretched: np.ndarray) -> np.ndarray:
        return np.clip((self.weights.ravel().take(cells) * stretched).sum(axis=0), -12, 12)

    def refined(self, gate: np.ndarray, x: np.ndarray) -> np.ndarray:
        at, share = _step(x)
        ones = (self.refine[1] / (self.refine[0] + self.refine[1])).ravel()
        at += gate * STEPS
        table = ones[at] * (1 - share) + ones[at + 1] * share
        return np.clip((_squash(x) + table) / 2, 1e-6, 1 - 1e-6)

    #: Numbers that a round's sums have: gradient and curvature of the weights, and the refining table.
    SUMS = 2 * GATES * ORDERS * LEVELS + 2 * GATES * STEPS

    def sums(self, words: list[bytes], classes: np.ndarray, counts: np.ndarray, tables: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
        """What the words add to a round, predicted from compact tables: sums over their decisions, whatever their order and the tasks they lie in."""
        both = tables.view(np.uint32).ravel()
        out = np.zeros(self.SUMS)
        cut = GATES * ORDERS * LEVELS
        push, curve, refine = out[:cut], out[cut : 2 * cut], out[2 * cut :].reshape(2, GATES * STEPS)
        for i in range(0, len(words), AT_ONCE):
            data, sizes = spelled(words[i : i + AT_ONCE])
            hashes, place, data, back = contexts(data, sizes, classes[i : i + AT_ONCE])
            weight = np.bincount(back, weights=np.repeat(counts[i : i + AT_ONCE], sizes))
            for part in _parts(data):
                self._add(push, curve, refine, both, weight[part], place[part], decisions(data[part], hashes[:, part], bits))
        return out

    def _add(self, push, curve, refine, both, weight, place, decided) -> None:
        """Add these decisions to a round's sums."""
        for slots, bit in decided:
            # both counts of a slot lie side by side and are fetched as one number
            pair = both.take(slots).view(np.float16).reshape(*slots.shape, 2).astype(np.float32)
            zeros, ones = np.maximum(pair[..., 0] - (1 - bit), 0), np.maximum(pair[..., 1] - bit, 0)
            stretched, level = _inputs(zeros, ones)
            gate = _gate(level, place)
            cells = _cells(gate, level)
            x = self.mixed(cells, stretched)
            p = _squash(x)
            error, slope = (bit - p) * weight, np.maximum(p * (1 - p), 0.01) * weight
            size = np.abs(stretched)
            whole = size.sum(axis=0) * slope
            push += np.bincount(cells.ravel(), weights=(error * stretched).ravel(), minlength=len(push))
            curve += np.bincount(cells.ravel(), weights=(whole * size).ravel(), minlength=len(curve))
            at, share = _step(x)
            cell = gate * STEPS + at + (GATES * STEPS) * bit.astype(np.int64)
            for shift, part in ((0, 1 - share), (1, share)):
                refine += np.bincount(cell + shift, weights=part * weight, minlength=refine.size).reshape(refine.shape)

    def after(self, sums: np.ndarray) -> Mixer:
        """The mixer after a round: a step that the curvature bounds; earlier rounds count half in the refining table."""
        cut = GATES * ORDERS * LEVELS
        step = CARRIED * self.step + (sums[:cut] / (sums[cut : 2 * cut] + 1)).reshape(self.step.shape)
        refine = np.maximum(self.refine / 2, Mixer().refine) + sums[2 * cut :].reshape(2, GATES, STEPS)
        return Mixer(self.weights + step, refine, step)

    def log10(self, words: list[bytes], classes: np.ndarray, ready: np.ndarray, bits: tuple[int, ...]) -> np.ndarray:
        """log10 of the probability of each word; ``ready`` holds the tables, see ``ready_tables``."""
        out = np.zeros(len(words))
        for i in range(0, len(words), AT_ONCE):
            data, sizes = spelled(words[i : i + AT_ONCE])
            hashes, place, data, back = contexts(data, sizes, classes[i : i + AT_ONCE])
            total = np.zeros(len(data))
            for part in _parts(data):
                for slots, bit in decisions(data[part], hashes[:, part], bits):
                    pair = ready.take(slots).view(np.float32).reshape(*slots.shape, 2)
                    level = pair[..., 1].astype(np.int64)
                    gate = _gate(level, place[part])
                    p = self.refined(gate, self.mixed(_cells(gate, level), pair[..., 0]))
                    total[part] += np.log10(np.where(bit == 1, p, 1 - p))
            out[i : i + AT_ONCE] = np.add.reduceat(total[back], np.cumsum(sizes) - sizes)
        return out


class Followers:
    """Whether a word is one of those that followed the previous word most often: one decision for each, best first.

    Words are codes below ``n``; ``n`` stands for the border of a text, before its first word
    and after its last. Three predictors see a decision: the previous word's own
    counts, the counts of all previous words of that rank and size, and those of the word in
    question over all previous words. Their gate is rank and size. Weights are learned online over
    the previous words in order, of which there is a bounded number.
    """

    RANKS, SIZES = 4, 40

    def __init__(self, n: int, before: np.ndarray, word: np.ndarray, rank: np.ndarray, hits: np.ndarray, total: np.ndarray):
        """One row per previous word and rank (from 0): the word, how often it followed, out of how many."""
        order = np.lexsort((rank, before))
        before, word, rank, hits, total = (x[order] for x in (before, word, rank, hits, total))
        self.n = n
        self.word = np.full((n + 1, self.RANKS), -1, np.int64)
        self.word[before, rank] = word
        ones, left = np.zeros((n + 1, self.RANKS)), np.zeros((n + 1, self.RANKS))
        ones[before, rank], left[before, rank] = hits, total
        left[:, 1:] -= np.where(left[:, 1:] > 0, np.cumsum(ones, axis=1)[:, :-1], 0)
        ones, zeros = ones[before, rank], (left - ones)[before, rank]
        size = np.minimum(np.log2(ones + zeros + 1).astype(np.int64), self.SIZES - 1)
        gate = rank * self.SIZES + size
        gates = self.RANKS * self.SIZES
        seen = [(ones, zeros)]
        for of, most in ((gate, gates), (word, n + 1)):
            seen.append(tuple(np.bincount(of, weights=x, minlength=most)[of] for x in (ones, zeros)))
        weights = np.full((gates, 3), 1 / 3)
        for i in range(0, len(before), 1024):
            part = slice(i, i + 1024)
            for bit, weight in ((1, ones[part]), (0, zeros[part])):
                x = np.stack([np.log((np.maximum(a[part] - bit, 0) + PRIOR) / (np.maximum(b[part] - 1 + bit, 0) + PRIOR)) for a, b in seen])
                p = _squash((weights[gate[part]].T * x).sum(axis=0))
                whole = np.maximum(p * (1 - p), 0.05) * weight * np.abs(x).sum(axis=0)
                for k in range(3):
                    push = np.bincount(gate[part], weights=(bit - p) * weight * x[k], minlength=gates)
                    weights[:, k] += 0.5 * push / (np.bincount(gate[part], weights=whole * np.abs(x[k]), minlength=gates) + 1)
        x = np.stack([np.log((a + PRIOR) / (b + PRIOR)) for a, b in seen])
        p = np.zeros((n + 1, self.RANKS))
        p[before, rank] = np.clip(_squash((weights[gate].T * x).sum(axis=0)), 1e-6, 1 - 1e-6)
        miss = np.cumsum(np.log10(1 - p), axis=1)
        #: log10 of the probability of each rank's word, and last of none of them.
        self.scores = np.column_stack([miss[:, :1] * 0, miss[:, :-1], miss[:, -1:]])
        self.scores[:, :-1] += np.log10(np.where(p > 0, p, 1))

    def log10(self, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return decided(self.word, self.scores, before, word)


def decided(followers: np.ndarray, scores: np.ndarray, before: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word (code, or -1) after another: log10 of the decisions' probability, and whether it must be spelled."""
    known = before >= 0
    ranks = np.full(len(before), followers.shape[1])
    for rank in range(followers.shape[1]):
        ranks[known & (word >= 0) & (followers[before, rank] == word)] = rank
    return np.where(known, scores[before, ranks], 0.0), ranks == followers.shape[1]
