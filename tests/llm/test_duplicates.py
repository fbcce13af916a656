"""Near duplicates, components and decontamination against brute force."""

import random
import re

import pytest

from routepulse.llm import contamination, near_duplicates
from routepulse.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if 0 < len(words) < k:
        return {tuple(words)}
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def brute(rows, k, percent):
    sets, union = [(i, shingles(t, k)) for i, t in rows if i is not None], Union()
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                union.join(i, j)
    return {i: union.find(i) for i, _ in sets}


def corpus(seed, groups, size, words=60):
    """Groups of near copies (each one changed word away from another of its group), exact copies, and others."""
    dice, out = random.Random(seed), []
    vocabulary = [f"w{n}" for n in range(400)]
    for _ in range(groups):
        family = [dice.choices(vocabulary, k=words)]
        for _ in range(size):
            copy = list(dice.choice(family))
            copy[dice.randrange(words)] = dice.choice(vocabulary)
            family.append(copy)
        out += [" ".join(f) for f in family]
    out += [out[0], out[0].upper(), "  " + out[1].replace(" ", "\t") + "\n", "one", "One", "two words", "two words ", "", "  ", None, "x " * 20_000, "x " * 20_001]
    dice.shuffle(out)
    return list(zip(dice.sample(range(10_000), len(out)), out, strict=True))


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_groups_equal_brute_force(spark, k, percent):
    rows = corpus(k, 6, 12)
    docs = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, component_id string, key int").repartition(4)
    got = near_duplicates.near_duplicates(docs, k, percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute(rows, k, percent)
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (len(shingles(text, k)), want[i], want[i] == i)


def test_large_buckets_in_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_duplicates, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near_duplicates, "BLOCK", 4)
    monkeypatch.setattr(near_duplicates, "FIRST_BANDS", 1)
    # chains: far members of a group are not alike, so hubs alone cannot link them all
    rows = corpus(11, 2, 60, words=40)
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85)
    assert {r.doc_id: r.component_id for r in got.collect()} == brute(rows, 3, 85)


def test_repeated_and_missing_ids(spark):
    a, b = "a b c d e f g h i j", "k l m n o p q r s t"
    rows = [(1, a), (1, a), (2, a), (5, b), (2, b), (None, a), (9, None), (9, "")]
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got if r.doc_id) == [(1, 1, True), (1, 1, True), (2, 1, False), (2, 1, False), (5, 1, False), (9, 9, True), (9, 9, True)]
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, None)]
    assert near_duplicates.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_components_equal_union_find(spark):
    dice, union = random.Random(3), Union()
    links = [(dice.randrange(300), dice.randrange(300)) for _ in range(170)] + [(1000 + n, 1001 + n) for n in range(60)] + [(7, 7)]
    for a, b in links:
        if a != b:
            union.join(a, b)
    got = components(spark.createDataFrame([*links, (None, 4), (5, None)], "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: union.find(x) for x in union.up}
    assert len(got) == len(union.up)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_items_in_documents_equal_brute_force(spark, monkeypatch):
    dice = random.Random(8)
    vocabulary = [f"v{n}" for n in range(3000)]
    items = [(n, " ".join(dice.choices(vocabulary, k=dice.randint(1, 40)))) for n in range(60)] + [(100, None), (101, " "), (None, "v1 v2"), (5, "another text of item five here"), (5, "another text of item five here")]
    docs = []
    for n in range(120):
        words = dice.choices(vocabulary, k=dice.randint(0, 300))
        if n % 2:
            held = (dice.choice(items[:60])[1]).split()
            held = held[: max(1, round(len(held) * dice.choice([0.5, 0.8, 0.9, 1])))]
            at = dice.randint(0, len(words))
            words[at:at] = [w.upper() for w in held]
        docs.append((n, "\n".join(words)))
    docs += [(500, None), (501, ""), (502, "another TEXT of item five here"), (502, "another TEXT of item five here"), (None, items[0][1])]

    def brute():
        out = []
        for d, text in docs:
            words = WORD.findall((text or "").translate(LOWER))
            found = set()
            for i, item in items:
                n = min(5, len(WORD.findall(item or "")))
                if i is None or not n:
                    continue
                want = shingles(item, n)
                have = {tuple(words[j : j + n]) for j in range(len(words) - n + 1)}
                if 100 * len(want & have) >= 80 * len(want):
                    found.add((i, len(want), len(want & have)))
            out.append((d or -1, sorted(found)))
        return sorted(out)

    frame = spark.createDataFrame([(d, t, "old", 3) for d, t in docs], "doc_id long, text string, matches string, item_id int")
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")

    def run():
        found = contamination.find_items(frame, benchmark)
        assert found.columns == ["doc_id", "text", "item_id", "matches"]
        return sorted((r.doc_id or -1, [tuple(m) for m in r.matches]) for r in found.collect())

    want = brute()
    assert run() == want
    assert sum(bool(m) for _, m in want) > 30
    monkeypatch.setattr(contamination, "BLOCK_ITEMS", 20)  # several blocks of items
    assert run() == want
    assert contamination.find_items(frame, benchmark.where("false")).where("size(matches) > 0").collect() == []
    assert contamination.find_items(frame.where("false"), benchmark).collect() == []


def test_sketches_cover_what_may_be_missing():
    for n in range(1, 300):
        least = -(-80 * n // 100)
        assert min(n, n - least + 1) <= contamination.sketch_size(n, 80) <= n
