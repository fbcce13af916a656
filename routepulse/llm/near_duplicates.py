"""Near-duplicate documents: MinHash with banding, exact links, connected components.

1. Every document gets the minima of many universal hash functions over its set of word
   shingles, and a fingerprint of the set. Documents with equal sets are a class; only
   one document of a class goes on.
2. Bands of minima deal the classes into buckets. Documents with a similarity at the
   threshold share a bucket with a probability of 1 - (1 - s^4)^24 (0.999997 at 0.8).
3. Every bucket names a hub, another one in every band. A document is compared with the
   hub that it shares most buckets with: signatures first, then the full shingle sets.
   Links that hold make components.
4. Large buckets of a few bands are dealt into blocks at random, and each block links its
   members by their full sets. This joins most of what belongs together.
5. Buckets whose members are still in different components are searched whole. Small
   ones by pairs that cross components, signatures first; large ones in blocks: members
   outside the bucket's largest component against all its members, by their full sets.
   A block returns the links that join its components, never its pairs. So no pair that
   shares a bucket is left out, and pairs inside a component, which add nothing, are never made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routepulse.llm.common import HASHED_BYTES, Powers, gathered, map_batches, mix, only, shingle_sets
from routepulse.llm.components import components
from routepulse.session import settle, stage

BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: Standard errors that a signature may fall short of the threshold before full sets are compared.
SLACK = 4.5
#: Buckets with at most this many members are paired by a join, larger ones are searched
#: in blocks of about so many members and shingles.
SMALL_BUCKET, BLOCK, BLOCK_SHINGLES = 16, 256, 200_000
#: Bands whose large buckets are linked first.
FIRST_BANDS = 3


def least_equal(percent: int) -> int:
    """Equal minima that two signatures need for their sets to be compared."""
    share = percent / 100
    return max(1, int(np.floor(HASHES * (share - SLACK * np.sqrt(share * (1 - share) / HASHES)))))


class Minima:
    """The minima of ``HASHES`` universal hash functions."""

    def __init__(self):
        numbers = np.random.default_rng(20_011).integers(0, 1 << 63, (2, HASHES, 1), dtype=np.uint64)
        self.factor, self.offset = numbers[0] * np.uint64(2) + np.uint64(1), numbers[1]

    def __call__(self, values: np.ndarray) -> np.ndarray:
        least = np.full(HASHES, 0xFFFFFFFF, np.uint64)
        for i in range(0, len(values), 1024):
            hashed = (values[None, i : i + 1024] * self.factor + self.offset) >> np.uint64(32)
            np.minimum(least, hashed.min(axis=1), out=least)
        return least.astype(np.uint32)


def _signatures(k: int):
    def work(batches):
        minima, power = Minima(), Powers()
        for part in gathered(batches, "text", HASHED_BYTES):
            sizes, first, second, signatures = [], [], [], []
            for values in shingle_sets(part.column("text"), k, power):
                sizes.append(len(values))
                first.append(int(mix(values).sum(dtype=np.uint64)))
                second.append(int(mix(values ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                signatures.append(minima(values).tobytes() if len(values) else None)
            prints = [np.array(x, np.uint64).view(np.int64) for x in (first, second)]
            yield {"id": part.column("id"), "n_shingles": sizes, "a": prints[0], "b": prints[1], "signature": signatures}

    return work


def _bands(batches):
    salts = mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for batch in batches:
        signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(salts, signatures.shape[:2])
        for row in range(ROWS):
            key = mix(key + signatures[:, :, row])
        # the lowest bits name the band
        key = (key & ~np.uint64(31)) | np.arange(BANDS, dtype=np.uint64)
        yield {"key": key.ravel().view(np.int64), "id": np.repeat(batch.column("id").to_numpy(), BANDS)}


def _alike(least: int):
    def work(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
            keep = pa.array((a == b).sum(axis=1) >= least)
            part = batch.filter(keep)
            yield {"a": part.column("a"), "b": part.column("b")}

    return work


def _confirmed(k: int, percent: int):
    def work(batches):
        power, held = Powers(), {}
        for batch in batches:
            for part in gathered([batch], "ta", HASHED_BYTES):
                lefts = shingle_sets(part.column("ta"), k, power)
                keep = []
                for left, b, text in zip(lefts, part.column("b").to_pylist(), part.column("tb").to_pylist(), strict=True):
                    if b not in held:  # rows arrive sorted by b
                        held = {b: next(shingle_sets(pa.array([text], pa.string()), k, power))}
                    right = held[b]
                    both = len(np.intersect1d(left, right, assume_unique=True))
                    keep.append(100 * both >= percent * (len(left) + len(right) - both) and both > 0)
                part = part.filter(pa.array(keep, pa.bool_()))
                yield {"a": part.column("a"), "b": part.column("b")}

    return work


def _block_links(k: int, percent: int):
    """Links (a, b) between components of a block: asking members against all, by full sets."""

    def work(group: pa.Table) -> pa.Table:
        ids, component, asks = (group.column(c).to_numpy() for c in ("id", "component", "asks"))
        power, sets = Powers(), []
        for part in gathered(group.select(["text"]).to_batches(), "text", HASHED_BYTES):
            sets += shingle_sets(part.column("text"), k, power)
        sizes = np.array([len(x) for x in sets])
        # which members hold each shingle
        codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(codes, kind="stable")
        holders, edges = owner[order], np.concatenate([[0], np.cumsum(np.bincount(codes))])
        starts = np.cumsum(sizes) - sizes
        root = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        found = []
        for i in np.flatnonzero(asks).tolist():
            mine = codes[starts[i] : starts[i] + sizes[i]]
            many = edges[mine + 1] - edges[mine]
            places = np.repeat(edges[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            both = np.bincount(holders[places], minlength=len(sets))
            hit = 100 * both >= percent * (sizes + sizes[i] - both)
            hit &= (both > 0) & (component != component[i])
            for j in np.flatnonzero(hit).tolist():
                x, y = find(component[i]), find(component[j])
                if x != y:
                    root[x] = y
                    found.append((ids[i], ids[j]))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return work


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept (id = component_id).

    Words are runs of characters other than blanks and \\t to \\r, A-Z in lower case; a set holds all
    runs of ``words`` words, or the whole sequence of a shorter text. Sets are linked
    with 100 * intersection >= ``percent`` * union. NULL, empty and blank texts have no shingle and
    are linked with nothing. Ids are whole numbers; rows that share an id are one document with the links of
    all of them, each returned; rows with a NULL id have component NULL and kept NULL. An
    empty table gives an empty table; other columns are not read.
    """
    texts = only(docs, id_column, text_column).select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    least = least_equal(percent)
    seen = stage(map_batches(texts, _signatures(words), "id long, n_shingles long, a long, b long, signature binary"), "signatures")

    full = seen.where((F.col("n_shingles") > 0) & F.col("id").isNotNull())
    classes = full.groupBy("a", "b").agg(F.min("id").alias("first"))
    members = full.join(classes, ["a", "b"]).select("id", "first", "n_shingles", F.when(F.col("id") == F.col("first"), F.col("signature")).alias("signature"))
    members = stage(members, "classes")
    heads = members.where(F.col("signature").isNotNull()).select("id", "signature")

    dealt = map_batches(heads, _bands, "key long, id long")
    salt = F.xxhash64(F.col("key").bitwiseAND(F.lit(31)))
    mark = F.col("id").bitwiseXOR(salt)
    buckets = dealt.groupBy("key").agg(F.min(mark).alias("low"), F.max(mark).alias("high")).where(F.col("low") != F.col("high"))
    shared = stage(dealt.join(buckets, "key").select("key", "id", F.col("low").bitwiseXOR(salt).alias("hub")), "buckets")
    # the texts that any later step may compare are picked out once
    asked = stage(texts.join(shared.select("id").distinct(), "id", "left_semi"), "texts")
    nearest = shared.where(F.col("id") != F.col("hub")).groupBy("id", "hub").agg(F.count("*").alias("n"))
    nearest = nearest.groupBy("id").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub"))
    pairs = stage(nearest.select(F.col("id").alias("a"), F.col("hub").alias("b")), "pairs")
    sizes = members.where(F.col("signature").isNotNull()).select("id", "n_shingles")
    links = _links(pairs, heads, asked, words, percent, least)
    groups = stage(components(links), "groups")

    first = _mixed(shared.where(F.col("key").bitwiseAND(F.lit(31)) < FIRST_BANDS), groups, sizes)
    first = first.where(F.col("size") > SMALL_BUCKET)
    if not first.isEmpty():
        spread = F.pmod(F.xxhash64("id", "key"), F.col("blocks"))
        dealt = first.select("key", "id", "component", spread.alias("block"), F.lit(0).alias("round"), F.lit(True).alias("asks"))
        more = _linked_blocks(dealt, asked, words, percent)
        groups = stage(components(_stars(groups).unionAll(more)), "groups")

    rest = _mixed(shared, groups, sizes)
    more = _confirm(stage(_crossing(rest, heads, pairs, least), "pairs"), asked, words, percent)
    large = rest.where(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        more = more.unionAll(_linked_blocks(_asking(large), asked, words, percent))
    copies = members.where(F.col("id") != F.col("first")).select(F.col("id").alias("a"), F.col("first").alias("b"))
    final = stage(components(_stars(groups).unionAll(more).unionAll(copies)), "groups")

    out = seen.select("id", "n_shingles").join(final.select(F.col("node").alias("id"), "component"), "id", "left")
    out = out.select(F.col("id").alias(id_column), "n_shingles", F.coalesce("component", "id").alias("component_id"))
    return out.withColumn("kept", F.col(id_column) == F.col("component_id"))


def _links(pairs: DataFrame, heads: DataFrame, texts: DataFrame, words: int, percent: int, least: int) -> DataFrame:
    """The pairs (a, b) whose signatures and then full sets are alike."""
    left, right = (heads.select(F.col("id").alias(c), F.col("signature").alias(f"s{c}")) for c in "ab")
    near = map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), _alike(least), "a long, b long")
    return _confirm(stage(near.distinct(), "pairs"), texts, words, percent)


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are linked."""
    ids, small = settle(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    asked = texts.join(F.broadcast(ids) if small else ids, "id", "left_semi")  # 10,000 ids at most, else no hint
    left, right = (asked.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").sortWithinPartitions("b").select("a", "b", "ta", "tb")
    return stage(map_batches(both, _confirmed(words, percent), "a long, b long").distinct(), "confirmed")


def _stars(groups: DataFrame) -> DataFrame:
    """Links that make the same components again."""
    return groups.where(F.col("node") != F.col("component")).select(F.col("node").alias("a"), F.col("component").alias("b"))


def _mixed(shared: DataFrame, groups: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members of the buckets with several components, with figures of their bucket."""
    placed = shared.select("key", "id").join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = placed.join(sizes, "id")
    counts = placed.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    mixed = counts.groupBy("key").agg(
        F.sum("n").alias("size"), F.sum("shingles").alias("shingles"), F.max("n").alias("largest"),
        F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"),
    )
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    rounds = F.ceil((F.col("size") - F.col("largest")) * blocks / F.col("size")).cast("int")
    mixed = mixed.where(F.col("parts") > 1).select("key", "size", "main", blocks.alias("blocks"), rounds.alias("rounds"))
    return stage(placed.join(mixed, "key").select("key", "id", "component", "size", "main", "blocks", "rounds"), "mixed")


def _asking(large: DataFrame) -> DataFrame:
    """All members of a bucket in blocks, each block once for every block of members outside its largest component."""
    spread = F.xxhash64("id", "key")
    columns = ["key", "id", "component"]
    each = F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("round")
    members = large.select(*columns, F.pmod(spread, F.col("blocks")).alias("block"), each, F.lit(False).alias("asks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    outside = large.where(F.col("component") != F.col("main"))
    asking = outside.select(*columns, every, F.pmod(spread, F.col("rounds")).alias("round"), F.lit(True).alias("asks"))
    return members.withColumn("block", F.col("block").cast("int")).unionByName(asking.withColumn("round", F.col("round").cast("int")))


def _linked_blocks(dealt: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    whole = dealt.join(texts, "id").select("key", "block", "round", "id", "component", "asks", "text")
    found = whole.groupBy("key", "block", "round").applyInArrow(_block_links(words, percent), "a long, b long")
    return stage(found, "confirmed")


def _crossing(mixed: DataFrame, heads: DataFrame, done: DataFrame, least: int) -> DataFrame:
    """Pairs that share a small bucket, lie in different components, and have like signatures."""
    little = mixed.where(F.col("size") <= SMALL_BUCKET).select("key", "id", "component")
    other = little.select("key", F.col("id").alias("b"), F.col("component").alias("other"))
    little = little.join(other, "key").where((F.col("id") < F.col("b")) & (F.col("component") != F.col("other")))
    little = little.select(F.col("id").alias("a"), "b").distinct()
    checked = done.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    little = little.join(checked, ["a", "b"], "left_anti")
    left, right = (heads.select(F.col("id").alias(c), F.col("signature").alias(f"s{c}")) for c in "ab")
    return map_batches(little.join(left, "a").join(right, "b").select("a", "b", "sa", "sb"), _alike(least), "a long, b long").distinct()
