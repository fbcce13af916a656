"""Scoring texts with the logistic mixing model, learned from all training documents.

The words' counts, per class of text, and those of neighbouring words are gathered from the corpus; they grow
with it. Tables of the model and the most frequent words have fixed bounds and are sent
to the tasks; counts of all other words are joined. Nothing that is learned depends on how texts or words
are dealt to tasks: tables are sums, and so are the steps of the weights.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from routepulse.llm import mixing_model as model
from routepulse.llm.common import Powers, gathered, lowered, map_batches, mix, only, text_bytes, word_hashes, word_spans
from routepulse.session import stage

#: Frequent words that tell classes of texts apart, and the number of classes (one more is for texts without them).
ANCHORS, CLASSES = 64, 8
#: An anchor has at least this share of all words; they are sought in as many sums of words by their hashes.
ANCHOR_SHARE, ANCHOR_SUMS = 0.0005, 1 << 16
#: Frequent words that a task names.
NAMED = 1 << 12
#: Words (the most frequent) whose followers are counted.
FOLLOWED = 1 << 16
#: Pairs of neighbours that a task holds before it hands them on (memory only).
HELD_PAIRS = 1 << 20
#: The same for words, per slice and class.
HELD_WORDS = 1 << 20
#: Frequent words at most whose counts and scores are sent to the tasks; the counts of the
#: others are joined, their scores worked out where they occur.
FREQUENT = 1 << 20
#: Different words (per class) that one task adds to the tables, and to a round's sums.
LEARNER_WORDS, ROUND_WORDS = 1_000_000, 40_000
#: Numbers in a part of the tables, and parts that one task adds up at most.
CHUNK, FAN = 1 << 16, 32
SLICE = 3 << 20
#: Word scores that a task remembers (memory only).
REMEMBERED = 1 << 20
#: Stands for the end of a text among the words' hashes, which are even numbers.
END = 1


class Tokens:
    """The words of a slice of texts: ``distinct`` holds the hash of every different word in ascending order, ``spelling`` its bytes, ``of`` the place of each word among them."""

    def __init__(self, texts: pa.Array, power: Powers):
        data, offsets = text_bytes(texts)
        data = lowered(data)
        self.starts, self.ends, self.counts = word_spans(data, offsets)
        # words are told apart by a cheap fingerprint, and only the different ones are hashed
        coded = pa.array(_fingerprints(data, self.starts, self.ends, power)).dictionary_encode()
        of = coded.indices.to_numpy()
        first = np.flatnonzero(np.diff(np.maximum.accumulate(of), prepend=-1))  # places are in order of occurrence
        joined, edges = _gathered_words(data, self.starts[first], self.ends[first])
        hashes = (word_hashes(joined, edges[:-1], edges[1:], power) & ~np.uint64(1)).view(np.int64)
        spelling = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(edges), pa.py_buffer(joined)])
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.distinct, self.spelling, self.of = hashes[order], spelling.take(pa.array(order)), place[of]
        self.docs = np.repeat(np.arange(len(texts)), self.counts)

    def times(self) -> np.ndarray:
        """How often each different word occurs."""
        return np.bincount(self.of, minlength=len(self.distinct))

    def neighbours(self, codes: np.ndarray, border: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every word and every end with what stands before it, as codes; and the texts they lie in."""
        ends = np.cumsum(self.counts)
        rows = len(self.counts)
        after = np.insert(codes, ends, border)
        before = np.insert(codes, ends - self.counts, border)
        return before, after, np.repeat(np.arange(rows), self.counts + 1)

    def per_class(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different words of each class of texts: class, word (its place), how often; and which of them each word is."""
        both = classes[self.docs] * len(self.distinct) + self.of
        n = np.bincount(both, minlength=(CLASSES + 1) * len(self.distinct))
        found = np.flatnonzero(n)
        place = np.zeros(len(n), np.int64)
        place[found] = np.arange(len(found))
        return found // max(len(self.distinct), 1), found % max(len(self.distinct), 1), n[found], place[both]


#: Words of more bytes are told apart by their hashes.
PLAIN_BYTES = 64
_LOWEST = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


def _gathered_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of these words one after the other, and their edges."""
    edges = np.concatenate([[0], np.cumsum(ends - starts)])
    return data[np.repeat(starts - edges[:-1], ends - starts) + np.arange(edges[-1])], edges


def _fingerprints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, power: Powers) -> np.ndarray:
    """64 bits for every word, from eight of its bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, strides=(1,))
    sizes = ends - starts
    out = mix((eights[starts] & _LOWEST[np.minimum(sizes, 8)]) + sizes.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    more = np.flatnonzero((sizes > 8) & (sizes <= PLAIN_BYTES))
    for at in range(8, PLAIN_BYTES, 8):
        if not len(more):
            break
        out[more] = mix(out[more] * np.uint64(0xE7037ED1A0B428DB) + (eights[starts[more] + at] & _LOWEST[np.minimum(sizes[more] - at, 8)]))
        more = more[sizes[more] > at + 8]
    long = np.flatnonzero(sizes > PLAIN_BYTES)
    if len(long):
        joined, edges = _gathered_words(data, starts[long], ends[long])
        out[long] = word_hashes(joined, edges[:-1], edges[1:], power)
    return out


def score_texts(docs: DataFrame, training: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Tokens are the words and one end per text. ``base_score`` sums log10((c + 0.5) / (N + 0.5 * (V + 1)))
    with the counts in ``training`` (same columns as ``docs``); ``n_known`` are tokens with c > 0. ``score`` is the
    model's log10 probability of the text's class and tokens in their order, and ``bits_per_byte`` the same
    per byte of the words, one blank after each and one end. NULL, empty and blank texts have
    one token, the end. Repeated rows are learned and scored each. Without training
    documents the model is its prior, N and V are 0. Words and pairs that are equally frequent
    are ordered by their hashes. A very long text is cut into words whole, at some hundred bytes of memory for each of its bytes. An empty
    table gives an empty table; other columns are not read.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_column]
    texts = only(docs, id_column, text_column).select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    train = only(training, text_column).select(F.coalesce(F.col(text_column), F.lit("")).alias("text"))

    anchors, groups = _classes(train)
    shared_groups = spark.sparkContext.broadcast((anchors, groups))  # ANCHORS words
    counted = stage(_word_counts(train, shared_groups), "lm-words")
    words = stage(counted.groupBy("hash").agg(F.sum("n").alias("n")), "lm-unigrams")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()

    rows = counted.count()
    bits = model.layout(rows)
    # four bytes a slot, at most 42 MB; the driver program keeps none of it
    shared_tables = spark.sparkContext.broadcast({"compact": _tables(counted, rows, bits)})
    sizes = dict(counted.where(F.col("hash") == END).groupBy("class").agg(F.sum("n")).collect())  # CLASSES + 1 rows
    prior = np.array([sizes.get(c, 0) + 1.0 for c in range(CLASSES + 1)])
    mixer = _mixer(counted, rows, shared_tables, bits)

    followed = _followed(words)
    followers = _followers(train, spark.sparkContext.broadcast(followed))
    top = _sorted(_most_frequent(words).select("hash", "n"))
    scored = map_batches(_most_frequent(counted), _word_scores(mixer, shared_tables, bits), "key long, score double")
    shared = spark.sparkContext.broadcast((top, _sorted(scored), followed, (followers.word, followers.scores)))  # FREQUENT and FOLLOWED words
    whole = total + 0.5 * (distinct + 1) if total else 0.5
    settings = mixer, np.log10(prior / prior.sum()), whole, bits

    schema = f"id {kind}, key long, n_tokens long, n_known long, base double, score double, bits_per_byte double, rare array<long>, times array<long>"
    main = stage(map_batches(texts, _scoring(shared, shared_tables, shared_groups, settings), schema), "lm-scored")
    rare = main.select("key", F.explode(F.arrays_zip("rare", "times")).alias("word")).select("key", F.col("word.rare").alias("hash"), F.col("word.times").alias("n"))
    found = rare.join(words.select("hash", F.col("n").alias("c")), "hash", "left")
    rest = found.groupBy("key").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("gain"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n"))).alias("known"),
    )
    out = main.join(rest, "key", "left")
    return out.select(
        F.col("id").alias(id_column),
        "n_tokens",
        (F.col("n_known") + F.coalesce("known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("gain", F.lit(0.0))).alias("base_score"),
        "score",
        "bits_per_byte",
    )


def _classes(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Anchor words (hashes) and the class of each: anchors that occur in the same texts.

    Anchors are the most frequent words of the whole corpus. How often two anchors occur in the same texts is summed
    over all texts, and the anchors are joined step by step, the closest groups first.
    """

    anchors = _anchors(train)
    if not len(anchors):
        return anchors, np.zeros(0, np.int64)

    def together(batches):
        power, total = Powers(), np.zeros((len(anchors), len(anchors)), np.int64)
        for part in gathered(batches, "text", SLICE):
            share = _shares(Tokens(part.column("text"), power), anchors, part.num_rows)
            share = share[share.sum(axis=1) > 0]
            share /= share.sum(axis=1, keepdims=True)
            whole = np.rint(share * 1000).astype(np.int64)
            total += whole.T @ whole
        i, j = np.nonzero(total)
        yield {"i": i, "j": j, "n": total[i, j]}

    both = np.zeros((len(anchors), len(anchors)))
    for i, j, n in map_batches(train, together, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n")).collect():  # ANCHORS ** 2 rows
        both[i, j] = n
    size = np.sqrt(np.maximum(np.diag(both), 1))
    close = both / np.outer(size, size)
    groups = [[i] for i in range(len(anchors))]
    while len(groups) > CLASSES:
        near = {(a, b): close[np.ix_(groups[a], groups[b])].mean() for a in range(len(groups)) for b in range(a + 1, len(groups))}
        a, b = max(near, key=near.get)
        groups[a] += groups.pop(b)
    of = np.zeros(len(anchors), np.int64)
    for c, members in enumerate(groups):
        of[members] = c + 1
    return anchors, of


def _anchors(train: DataFrame) -> np.ndarray:
    """The most frequent words, sorted by hash.

    Every task names its most frequent words, and how often any other may occur in it. Mostly these bounds
    settle which words are the most frequent; else all words are counted, see ``_all_anchors``.
    """

    def named(batches):
        power, total, below = Powers(), 0, 0  # below: any word may occur so often besides what is held of it
        held, waiting, whole = [], 0, None  # whole: words that have been held from the start

        def settled():
            nonlocal held, waiting, whole, below
            hashes, times = _summed(held)
            if len(hashes) > NAMED:
                order = np.argsort(-times, kind="stable")
                below += int(times[order[NAMED]])
                order = np.sort(order[:NAMED])
                hashes, times = hashes[order], times[order]
            held, waiting = [(hashes, times)], 0
            whole = hashes if whole is None else np.intersect1d(whole, hashes)

        for part in gathered(batches, "text", SLICE):
            tokens = Tokens(part.column("text"), power)
            total += len(tokens.of)
            held.append((tokens.distinct, tokens.times()))
            waiting += len(tokens.distinct)
            if waiting > HELD_WORDS:
                settled()
        if held:
            settled()
            (hashes, times), = held
            yield {"hash": [END], "n": [total], "below": [below]}  # of all words
            yield {"hash": hashes, "n": times, "below": np.where(np.isin(hashes, whole), below, 0)}

    found = map_batches(train, named, "hash long, n long, below long").groupBy("hash").agg(F.sum("n").alias("n"), F.sum("below").alias("below"))
    found = stage(found, "lm-frequent")
    all_words = found.where(F.col("hash") == END).first()
    if not all_words or not all_words.n:
        return np.zeros(0, np.int64)
    least = max(1, ANCHOR_SHARE * all_words.n)
    words = found.where(F.col("hash") != END).select("hash", "n", (F.col("n") + all_words.below - F.col("below")).alias("most"))
    best = words.where(F.col("n") >= float(least)).orderBy(F.desc("n"), "hash").limit(ANCHORS).collect()
    bar = float(best[-1].n if len(best) == ANCHORS else least)
    rivals = words.where((F.col("most") > bar) | (F.col("most") == bar) & (F.col("n") < bar)).count()
    if rivals > sum(w.most > bar for w in best) or all_words.below >= bar:
        return _all_anchors(train)
    return np.array(sorted(w.hash for w in best), np.int64)


def _all_anchors(train: DataFrame) -> np.ndarray:
    """The same from counts of all words: they are summed by some bits of their hashes, and those that lie in a large enough sum are counted."""

    def place(hashes):
        return ((hashes.view(np.uint64) >> np.uint64(20)) % np.uint64(ANCHOR_SUMS)).astype(np.int64)

    def summed(batches):
        power, n = Powers(), np.zeros(ANCHOR_SUMS, np.int64)
        for part in gathered(batches, "text", SLICE):
            tokens = Tokens(part.column("text"), power)
            np.add.at(n, place(tokens.distinct), tokens.times())
        at = np.flatnonzero(n)
        yield {"at": at, "n": n[at]}

    sums = map_batches(train, summed, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # ANCHOR_SUMS rows
    at, n = (sums.column(i).to_numpy() for i in range(2))
    least = max(1, ANCHOR_SHARE * n.sum())
    large = np.zeros(ANCHOR_SUMS, bool)
    large[at[n >= least]] = True

    def counts(batches):
        power = Powers()
        for part in gathered(batches, "text", SLICE):
            tokens = Tokens(part.column("text"), power)
            mine = large[place(tokens.distinct)]
            yield {"hash": tokens.distinct[mine], "n": tokens.times()[mine]}

    top = map_batches(train, counts, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= float(least))
    return np.array(sorted(r.hash for r in top.orderBy(F.desc("n"), "hash").limit(ANCHORS).collect()), np.int64)


def _shares(tokens: Tokens, anchors: np.ndarray, rows: int) -> np.ndarray:
    """How often each text has each anchor."""
    at = _codes(anchors, tokens.distinct)[tokens.of]
    hit = np.flatnonzero(at >= 0)
    return np.bincount(tokens.docs[hit] * len(anchors) + at[hit], minlength=rows * len(anchors)).reshape(rows, len(anchors)).astype(float)


def _class_of(tokens: Tokens, anchors: np.ndarray, groups: np.ndarray, rows: int) -> np.ndarray:
    """The class of each text: the one whose anchors it has most of, 0 without any."""
    if not len(anchors):
        return np.zeros(rows, np.int64)
    sums, shares = np.zeros((rows, CLASSES + 1)), _shares(tokens, anchors, rows)
    for c in range(1, CLASSES + 1):
        sums[:, c] = shares[:, groups == c].sum(axis=1)
    return sums.argmax(axis=1)


def _word_counts(train: DataFrame, shared_groups) -> DataFrame:
    """class, hash, word, n: how often each word occurs in the training texts of a class; the end is the empty word."""

    def work(batches):
        def joined():
            of, hashes, spelling, n = (pa.concat_arrays(x) for x in zip(*held, strict=True))
            of, hashes, n = of.to_numpy(), hashes.to_numpy(), n.to_numpy()
            order = np.lexsort((hashes, of))
            of, hashes = of[order], hashes[order]
            first = np.flatnonzero(np.append(True, (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])))
            return {"class": of[first], "hash": hashes[first], "word": spelling.take(pa.array(order[first])).cast(pa.binary()), "n": np.add.reduceat(n[order], first)}

        power, held, waiting, ends = Powers(), [], 0, np.zeros(CLASSES + 1, np.int64)
        for part in gathered(batches, "text", SLICE):
            rows = part.num_rows
            tokens = Tokens(part.column("text"), power)
            classes = _class_of(tokens, *shared_groups.value, rows)
            ends += np.bincount(classes, minlength=CLASSES + 1)
            of, word, n, _ = tokens.per_class(classes)
            if len(of):
                held.append((pa.array(of), pa.array(tokens.distinct[word]), tokens.spelling.take(pa.array(word)), pa.array(n)))
                waiting += len(of)
            if waiting > HELD_WORDS:
                yield joined()
                held, waiting = [], 0
        if held:
            yield joined()
        ended = np.flatnonzero(ends)
        yield {"class": ended, "hash": np.full(len(ended), END), "word": [b""] * len(ended), "n": ends[ended]}

    found = map_batches(train, work, "class int, hash long, word binary, n long")
    return found.groupBy("class", "hash", "word").agg(F.sum("n").alias("n"))


def _blocks(batches):
    for batch in batches:
        yield batch.column("word").to_pylist(), batch.column("class").to_numpy().astype(np.int64), batch.column("n").to_numpy().astype(float)


def _in_order(counted: DataFrame) -> DataFrame:
    """Words by class and spelling, as one value: Spark compares its first bytes as a number."""
    return counted.sortWithinPartitions(F.concat(F.col("class").cast("string").cast("binary"), F.col("word")))


def _tables(counted: DataFrame, rows: int, bits: tuple[int, ...]) -> np.ndarray:
    """The predictors' tables: a task's words lie in order, so that neighbours share
    beginnings; the tasks' tables, as many as the words need, are added up in parts, ``FAN`` at a time.
    """
    slots, learners = model.slots_of(bits), max(1, -(-rows // LEARNER_WORDS))

    def work(batches):
        tables = np.zeros((slots, 2), np.float32)
        for words, classes, n in _blocks(_joined(batches)):
            model.learn_tables(words, classes, n, tables, bits)
        flat, learner = tables.reshape(-1), TaskContext.get().partitionId()
        for i in range(0, len(flat), CHUNK):
            if flat[i : i + CHUNK].any():
                yield {"chunk": [i // CHUNK], "learner": [learner], "part": [flat[i : i + CHUNK].tobytes()]}

    def add(group: pa.Table) -> pa.Table:
        total = 0
        for part in group.sort_by("learner").column("part"):
            total = total + np.frombuffer(part.as_py(), np.float32).astype(np.float64)
        first = group.slice(0, 1)
        return pa.table({"chunk": first.column("chunk"), "learner": first.column("group"), "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    schema = "chunk int, learner int, part binary"
    parts = map_batches(_in_order(counted.coalesce(learners)), work, schema)
    while learners > 1:
        learners = -(-learners // FAN)
        parts = parts.withColumn("group", F.floor(F.col("learner") / FAN).cast("int")).groupBy("chunk", "group").applyInArrow(add, schema)
    flat = np.zeros(2 * slots, np.float16)
    for row in parts.toLocalIterator():  # one table in all
        part = model.compact(np.frombuffer(row.part, np.float32).reshape(-1, 2)).reshape(-1)
        flat[row.chunk * CHUNK : row.chunk * CHUNK + len(part)] = part
    return flat.reshape(slots, 2)


def _joined(batches, rows: int = model.AT_ONCE):
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _mixer(counted: DataFrame, rows: int, shared_tables, bits: tuple[int, ...]) -> model.Mixer:
    """Round by round, online: every word is in one round, whose sums over all its words make one step."""
    mixer = model.Mixer()
    tasks = max(1, -(-rows // (model.ROUNDS * ROUND_WORDS)))
    for turn in range(model.ROUNDS):

        def work(batches, mixer=mixer):
            total = np.zeros(mixer.SUMS)
            for words, classes, n in _blocks(_joined(batches)):
                total += mixer.sums(words, classes, n, shared_tables.value["compact"], bits)
            at = np.flatnonzero(total)
            yield {"at": at, "n": total[at]}

        mine = counted.where(F.pmod(F.shiftright("hash", 33), F.lit(model.ROUNDS)) == turn).select("class", "word", "n")
        found = map_batches(_in_order(mine.coalesce(tasks)), work, "at int, n double")
        found = found.groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # Mixer.SUMS rows
        sums = np.zeros(mixer.SUMS)
        sums[found.column("at").to_numpy()] = found.column("n").to_numpy()
        mixer = mixer.after(sums)
    return mixer


def _followed(words: DataFrame) -> np.ndarray:
    """The hashes of the most frequent words, in order; a word's place is its code."""
    found = words.where(F.col("hash") != END).orderBy(F.desc("n"), "hash").limit(FOLLOWED).select("hash").toArrow()
    return np.sort(found.column("hash").to_numpy())


def _codes(followed: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(followed):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(followed, hashes), len(followed) - 1)
    return np.where(followed[at] == hashes, at, -1)


def _followers(train: DataFrame, shared_followed) -> model.Followers:
    """Counts of neighbouring words over all training texts, and the best followers of each frequent word."""
    n = len(shared_followed.value)
    base = n + 2  # codes, the border, and n + 1 for all other words

    def work(batches):
        power, held, waiting = Powers(), [], 0
        for part in gathered(batches, "text", SLICE):
            tokens = Tokens(part.column("text"), power)
            before, after, _ = tokens.neighbours(_codes(shared_followed.value, tokens.distinct)[tokens.of], n)
            mine = before >= 0
            held.append(np.unique(before[mine] * base + np.where(after[mine] < 0, n + 1, after[mine]), return_counts=True))
            waiting += len(held[-1][0])
            if waiting > 2 * HELD_PAIRS:
                held, waiting = [_summed(held)], 0
                if len(held[0][0]) > HELD_PAIRS:
                    yield {"pair": held[0][0], "n": held[0][1]}
                    held = []
        if held:
            pairs, times = _summed(held)
            yield {"pair": pairs, "n": times}

    pairs = map_batches(train, work, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = stage(pairs.select(F.expr(f"pair div {base}").alias("before"), (F.col("pair") % base).alias("word"), "n"), "lm-pairs")
    totals = pairs.groupBy("before").agg(F.sum("n").alias("total"))
    place = F.row_number().over(Window.partitionBy("before").orderBy(F.desc("n"), "word"))
    best = pairs.where((F.col("word") <= n) & (F.col("n") > 1)).withColumn("rank", place - 1).where(F.col("rank") < model.Followers.RANKS)
    found = best.join(totals, "before").select("before", "word", "rank", "n", "total").toArrow()  # RANKS rows for each of FOLLOWED words
    before, word, rank, hits, total = (found.column(i).to_numpy().astype(np.int64) for i in range(5))
    return model.Followers(n, before, word, rank, hits, total)


def _summed(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all these counts, in order, and their sums."""
    keys, times = (np.concatenate(x) for x in zip(*counts, strict=True))
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[first], np.add.reduceat(times[order], first) if len(first) else times


def _most_frequent(words: DataFrame) -> DataFrame:
    """The words with the highest counts, ``FREQUENT`` of them at most: those above a count, no matter which."""
    step = F.floor(8 * F.log2("n"))
    sizes = words.groupBy(step.alias("step")).agg(F.count("*").alias("rows")).collect()  # a few hundred rows
    least, held = 1 << 20, 0
    for row in sorted(sizes, reverse=True):
        held += row.rows
        if held > FREQUENT:
            break
        least = row.step
    return words.where(step >= least)


def _sorted(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    found = table.toArrow()
    keys, values = (found.column(i).to_numpy() for i in range(2))
    order = np.argsort(keys)
    return keys[order], values[order]


def _key(hashes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A word of a class."""
    return mix(hashes.view(np.uint64) + classes.astype(np.uint64)).view(np.int64)


def _ready(held: dict) -> np.ndarray:
    """The tables ready for scoring: a worker process works them out once, for all its tasks."""
    if "ready" not in held:
        held["ready"] = model.ready_tables(held["compact"])
    return held["ready"]


def _word_scores(mixer, shared_tables, bits):
    def work(batches):
        ready = _ready(shared_tables.value)
        for batch in _joined(batches):
            classes = batch.column("class").to_numpy().astype(np.int64)
            scores = mixer.log10(batch.column("word").to_pylist(), classes, ready, bits)
            yield {"key": _key(batch.column("hash").to_numpy(), classes), "score": scores}

    return work


def _scoring(shared, shared_tables, shared_groups, settings):
    def work(batches):
        ready = _ready(shared_tables.value)
        (top, counts), (top_keys, top_scores), followed, followers = shared.value
        mixer, prior, whole, bits = settings
        border, number = len(followed), TaskContext.get().partitionId() << 40
        power = Powers()
        gains = np.log10(counts + 0.5)
        end = np.searchsorted(top, END)
        has_end = end < len(top) and top[end] == END
        end_gain = gains[end] if has_end else np.log10(0.5)
        ends = mixer.log10([b""] * (CLASSES + 1), np.arange(CLASSES + 1), ready, bits)
        known_keys, known_scores = top_keys, top_scores
        for part in gathered(batches, "text", SLICE):
            rows = part.num_rows
            tokens = Tokens(part.column("text"), power)
            classes = _class_of(tokens, *shared_groups.value, rows)
            of, word, _, back = tokens.per_class(classes)
            distinct = _key(tokens.distinct[word], of)
            order = np.argsort(distinct)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            distinct, of, word, back = distinct[order], of[order], word[order], place[back]
            hashes = tokens.distinct[word]
            gain, hit = (x[word] for x in _found(top, gains, tokens.distinct))  # in order of the hashes
            base = np.bincount(tokens.docs, weights=gain[back], minlength=rows)
            known = np.bincount(tokens.docs, weights=hit[back], minlength=rows).astype(np.int64) + int(has_end)
            # scores of words that the task has not met before
            scores, old = _found(known_keys, known_scores, distinct)
            spelling = tokens.spelling.take(pa.array(word[~old])).to_pylist()
            scores[~old] = mixer.log10(spelling, of[~old], ready, bits)
            before, after, docs = tokens.neighbours(_codes(followed, tokens.distinct)[tokens.of], border)
            said, spelled = model.decided(*followers, before, after)
            spell = np.insert(scores[back], np.cumsum(tokens.counts), ends[classes])
            total = np.bincount(docs, weights=said + np.where(spelled, spell, 0.0), minlength=rows) + prior[classes]
            # words whose counts the task does not hold, with how often each text has them
            rare = np.flatnonzero(~hit[back])
            pairs, times = np.unique(tokens.docs[rare] * len(distinct) + back[rare], return_counts=True)
            lists = np.searchsorted(pairs, np.arange(rows + 1) * max(len(distinct), 1)).astype(np.int32)
            if len(known_keys) > len(top_keys) + REMEMBERED:
                known_keys, known_scores = top_keys, top_scores
            places = np.searchsorted(known_keys, distinct[~old])
            known_keys, known_scores = np.insert(known_keys, places, distinct[~old]), np.insert(known_scores, places, scores[~old])
            n_tokens = tokens.counts + 1
            size = np.bincount(tokens.docs, weights=tokens.ends - tokens.starts + 1, minlength=rows) + 1
            yield {
                "id": part.column("id"),
                "key": number + np.arange(rows),
                "n_tokens": n_tokens,
                "n_known": known,
                "base": base + end_gain - n_tokens * np.log10(whole),
                "score": total,
                "bits_per_byte": -total * np.log2(10) / size,
                "rare": pa.ListArray.from_arrays(lists, hashes[pairs % max(len(distinct), 1)]),
                "times": pa.ListArray.from_arrays(lists, times),
            }
            number += rows

    return work


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the wanted keys (0 where absent), and which are there."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    there = keys[at] == wanted
    return np.where(there, values[at], 0.0), there
