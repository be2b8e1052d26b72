"""Near copies by the forest against a comparison of all pairs."""

import math
import random

import numpy as np
import pytest

from tallyline.llm import lsh_forest


def shingles(text):
    lower = {c: c + 32 for c in range(65, 91)}
    words = (text or "").translate(lower)
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows, percent=85):
    """doc_id, n_shingles, component_id, kept of each (doc_id, text)."""
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    made = []
    for i, (doc_id, _) in enumerate(rows):
        component = least.get(find(i)) if sets[i] else doc_id
        made.append((doc_id, len(sets[i]), component, doc_id is not None and doc_id == component))
    return sorted(made, key=str)


def edited(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def corpus(seed, families=6, members=60):
    rng = random.Random(seed)
    rows = [None, "", " \t\n", "One", "one", "ONE two", "É e", "é e", "\x1c a b c d e", "a b c d e"]
    shared = [f"p{rng.randrange(500)}" for _ in range(60)]
    for _ in range(families):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.choice([30, 120, 200]))]
        for _ in range(rng.randint(1, members)):
            rows.append(edited(rng, words, rng.choice([0, 1, 1, 2, 3, 5])))
    for _ in range(60):  # a passage that many documents share, without being near copies
        rows.append(" ".join(shared + [f"v{rng.randrange(10**6)}" for _ in range(rng.choice([20, 60]))]))
    rows += [rows[11].upper(), rows[11] + "\n"] + [rows[12]] * 20
    rng.shuffle(rows)
    numbered = [(None if i % 37 == 5 else i // 2 if i % 29 == 3 else i, t) for i, t in enumerate(rows)]
    return numbered


def found_rows(docs):
    return sorted((tuple(r) for r in lsh_forest.near_copies(docs).collect()), key=str)


@pytest.mark.parametrize("small", [False, True])
def test_near_copies_equal_a_comparison_of_all_pairs(spark, monkeypatch, small):
    if small:
        for name, value in (("REGION", 8), ("NEXT", 6), ("BLOCK", 10), ("CHUNK", 32), ("BROADCAST_NODES", 3)):
            monkeypatch.setattr(lsh_forest, name, value)
    rows = corpus(3 + small)
    docs = spark.createDataFrame([(i, t, b"x", 0) for i, t in rows], "doc_id long, text string, name binary, node long")
    want = plain(rows)
    assert sum(not row[3] for row in want) > 60
    assert found_rows(docs) == want


def test_empty_table_and_lone_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "doc_id long, text string")
    assert found_rows(docs) == [(1, 1, 1, True), (2, 0, 2, True), (3, 1, 3, True)]
    assert found_rows(docs.limit(0)) == []


def test_star_of_copies_that_only_their_original_links(spark, monkeypatch):
    """Each copy is linked with the original alone, in a cluster larger than a block."""
    monkeypatch.setattr(lsh_forest, "REGION", 16)
    monkeypatch.setattr(lsh_forest, "BLOCK", 32)
    rng = random.Random(8)
    words = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = [(0, " ".join(words))]
    for i in range(1, 150):
        at = rng.randrange(0, 370)
        rows.append((i, " ".join(words[:at] + [f"n{i}x{k}" for k in range(28)] + words[at + 28 :])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows)
    assert sum(row[2] == 0 for row in want) > 100
    assert found_rows(docs) == want


def test_one_very_long_text(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(9000)}" for _ in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:290_000])), (3, " ".join(words[:200_000]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r[2] for r in found_rows(docs)] == [1, 1, 3]


def test_chances():
    """A pair at the threshold shares a region of some tree, and its sketches agree in enough places."""
    assert (1 - 0.85**lsh_forest.DEPTH) ** lsh_forest.TREES < 1e-6
    places, least = lsh_forest.PLACES, lsh_forest.AGREEING
    below = sum(math.comb(places, k) * 0.85**k * 0.15 ** (places - k) for k in range(least))
    assert below < 2e-6


def test_sketches_estimate_the_similarity():
    rng = np.random.default_rng(1)
    own, agreed = lsh_forest.factors(), []
    for _ in range(60):
        codes = rng.integers(0, 1 << 63, 460).astype(np.uint64) * np.uint64(2)
        a, b = np.sort(codes[:430]), np.sort(codes[30:])  # 400 of 460
        agreed.append((lsh_forest.minima(a, own) == lsh_forest.minima(b, own)).mean())
    assert abs(np.mean(agreed) - 400 / 460) < 0.02
    assert np.std(agreed) < 0.045
