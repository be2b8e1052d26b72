"""Collocations against a plain count of all phrases, and the double-array trie against a dictionary."""

import random
import re
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import collocations

WORDS = ["new", "York", "the", "of", "É", "x1", "city", "a", "ß", "zoo", "-", "漢"]


def plain(rows, min_count, longest, top, share):
    counts, totals = Counter(), Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    counts[lang, tuple(words[at : at + size])] += 1
    found = {key: a for key, a in counts.items() if a >= min_count and len(key[1]) > 1}
    longer = {}
    for (lang, words), a in found.items():
        for size in range(2, len(words)):
            for at in range(len(words) - size + 1):
                key = lang, words[at : at + size]
                longer[key] = max(a, longer.get(key, 0))
    made = {}
    for (lang, words), a in found.items():
        if 100 * longer.get((lang, words), 0) >= share * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        made.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
        for lang, held in made.items() for rank, (score, a, phrase, left, right) in enumerate(sorted(held)[:top], 1)
    )


def texts(seed, count=500):
    random.seed(seed)
    rows = []
    for _ in range(count):
        words = random.choices(WORDS, weights=range(len(WORDS), 0, -1), k=random.randint(0, 40))
        if random.random() < 0.4:
            words += "New york City of the Zoo".split()
        text = "".join(w + random.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "\r\n", "; ", "\x0b"]) for w in words)
        rows.append((text, random.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", "fr"), (" \n.", "fr"), ("new york " * 3000, "en"), rows[0], rows[0]]


@pytest.mark.parametrize("part, gathered, held, tasks", [(400_000, 1 << 19, 10**6, 3), (60, 50, 20, 3), (400_000, 30, 5, 2)])
def test_collocations_equal_a_plain_count(spark, monkeypatch, part, gathered, held, tasks):
    monkeypatch.setattr(collocations, "PART", part)
    monkeypatch.setattr(collocations, "GATHERED", gathered)
    monkeypatch.setattr(collocations, "CANDIDATES", held)
    monkeypatch.setattr(collocations, "WORDS", 10)
    monkeypatch.setattr(collocations, "CHUNK", 16)
    monkeypatch.setattr(collocations, "BUCKETS", 1 << (3 if held == 5 else 12))
    rows = texts(part % 5)
    docs = spark.createDataFrame([(t, g, 1, "x") for t, g in rows], "text string, lang string, score int, phrase string")
    found = collocations.collocations(docs.repartition(tasks), min_count=12, top=40, share=90)
    want = plain(rows, 12, 5, 40, 90)
    assert len(want) > 60
    assert sorted(tuple(r) for r in found.collect()) == want


def test_empty_tables_and_rare_words(spark):
    docs = spark.createDataFrame([("one two three", "en")], "text string, lang string")
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(docs.limit(0)).collect() == []


def test_colliding_words_get_another_salt(spark, monkeypatch):
    docs = spark.createDataFrame([("b a b a c " * 3, "en")], "text string, lang string")
    real, tried = collocations.F.xxhash64, []

    def clashing(*columns):
        tried.append(1)
        code = real(*columns)
        return collocations.F.lit(5).cast("long") if len(tried) == 1 else code

    monkeypatch.setattr(collocations.F, "xxhash64", clashing)
    _, _, salt = collocations.word_table(docs, 2)
    assert salt == 1


def test_scores_of_large_counts_are_exact(spark):
    a, n, left, right = 10**12 + 7, 10**14 + 3, 10**13 + 9, 10**13 + 1
    made = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    assert made.select(collocations.score().alias("s")).first().s == 1000 * a * n // (left * right)


def test_trie_equals_a_dictionary():
    rng = np.random.default_rng(3)
    for words, count, spread in ((1, 50, 200), (2, 400, 40), (3, 3000, 30), (5, 2000, 6)):
        phrases = np.unique(rng.integers(1, spread, (count, words)) ** 3 - 5000, axis=0)
        phrases = rng.permutation(phrases)
        known = {tuple(p): i for i, p in enumerate(phrases.tolist())}
        codes = rng.integers(0, spread, 5000) ** 3 - 5000
        at, which = collocations.Trie(phrases).accepted(codes)
        want = [(i, known[tuple(codes[i : i + words])]) for i in range(len(codes)) if tuple(codes[i : i + words]) in known]
        assert sorted(zip(at.tolist(), which.tolist())) == want


def test_tasks_without_codes_keep_nothing(spark, monkeypatch):
    """A scan may have more tasks than hold rows; they must not make all candidates be sought a second time."""
    codes = np.array([7, 1 << 40, 0, 7, 1 << 40, 0, -3, 7, 0] * 3, dtype=np.int64)
    coded = spark.range(0, 8, 1, 8).where("id < 2").select(F.lit(bytearray(codes.tobytes())).alias("codes"))
    shorter = spark.createDataFrame([(7,), (1 << 40,), (-3,)], "w1 long")
    seek, allowances = collocations._seek, []

    def noted(shared, whole_trie, allowance):
        allowances.append(allowance)
        return seek(shared, whole_trie, allowance)

    monkeypatch.setattr(collocations, "_seek", noted)
    found = collocations.candidates(coded, shorter, 2, 10)
    assert allowances == [4]
    listed = {tuple(r) for r in found.collect()}
    assert (7, 1 << 40) in listed and listed <= {(7, 1 << 40), (-3, 7)}


@pytest.mark.parametrize("size", [1, 5, 1000])
def test_symbols_are_found_by_upper_bits(size):
    rng = np.random.default_rng(size)
    codes = rng.integers(-(1 << 63), (1 << 63) - 1, size, dtype=np.int64)
    trie = collocations.Trie(np.concatenate([codes, [np.int64(1), np.int64(2)]])[:, None])
    asked = np.concatenate([codes, [1, 2, 3, 0, -1, codes[0] ^ 1]])
    known = {int(c): int(s) for c, s in zip(trie.codes, trie.symbols)}
    assert trie.symbols_of(asked).tolist() == [known.get(int(c), -1) for c in asked]


def test_counts_stay_off_the_driver(spark, monkeypatch):
    """The driver gets a bit for each bucket and no counts; frequent phrases are written by the tasks."""
    monkeypatch.setattr(collocations, "CHUNK", 16)
    monkeypatch.setattr(collocations, "BUCKETS", 1 << 10)
    codes = np.array(([7, 9, 0] * 6 + [8, 7, 0] * 5 + [9, 9, 8, 0]) * 4, dtype=np.int64)
    coded = spark.range(0, 3, 1, 3).select(F.lit(bytearray(codes.tobytes())).alias("codes"))
    shorter = spark.createDataFrame([(7,), (8,), (9,)], "w1 long")
    kind, collect, came = type(coded), type(coded).collect, []

    def noted(self):
        found = collect(self)
        came.extend(len(v) for row in found for v in row if isinstance(v, (bytes, bytearray)))
        return found

    def none_made(*_, **__):
        raise AssertionError("rows were made on the driver")

    with monkeypatch.context() as patched:
        patched.setattr(kind, "collect", noted)
        patched.setattr(type(spark), "createDataFrame", none_made)
        listed = collocations.candidates(coded, shorter, 2, 60)
        found = collocations.counted(coded, listed, 2, 60)
        none = collocations.counted(coded, listed, 2, 1000)
    assert 0 < sum(came) <= collocations.BUCKETS // 8
    assert sorted(tuple(r) for r in found.collect()) == [(7, 9, 72), (8, 7, 60)]
    assert none is None


def test_large_tries_take_seconds():
    """Places for the children are sought for all states together, not state by state (20 s and more for these)."""
    rng = np.random.default_rng(5)
    words = np.unique(rng.integers(-(1 << 63), (1 << 63) - 1, 60_000, dtype=np.int64))
    near = (rng.random((400_000, 2)) ** 4 * len(words)).astype(np.int64)
    phrases = np.unique(words[near], axis=0)
    assert len(phrases) > 200_000
    began = time.process_time()
    trie = collocations.Trie(phrases)
    assert time.process_time() - began < 5
    known = {tuple(p): i for i, p in enumerate(phrases.tolist())}
    codes = words[(rng.random(20_000) ** 4 * len(words)).astype(np.int64)]
    at, which = trie.accepted(codes)
    pairs = list(zip(codes[:-1].tolist(), codes[1:].tolist()))
    assert list(zip(at.tolist(), which.tolist())) == [(i, known[p]) for i, p in enumerate(pairs) if p in known]


def test_symbols_of_other_parts_lead_nowhere():
    trie = collocations.Trie(np.array([[3, 5], [3, 8], [8, 3]]), np.array([11, 5, 2]))
    assert (trie.symbols_of(np.array([2, 3, 5, 8, 11])) >= 0).all()
    assert trie.spelled()[trie.symbols_of(np.array([2, 11, 8]))].tolist() == [2, 11, 8]
    at, which = trie.accepted(np.array([11, 3, 11, 2, 3, 8, 3, 5, 11]))
    assert list(zip(at.tolist(), which.tolist())) == [(4, 1), (5, 2), (6, 0)]


@pytest.mark.parametrize("words", [1, 2, 4])
@pytest.mark.parametrize("buckets", [1 << 3, 1 << 16])
def test_narrowed_codes_hold_all_longer_phrases(words, buckets):
    rng = np.random.default_rng(words)
    codes = np.append(rng.integers(0, 7, 4000), 0) * 1_000_003

    def places(held, size):
        runs = (tuple(held[i : i + size].tolist()) for i in range(len(held) - size + 1))
        return [run for run in runs if 0 not in run]

    counts = Counter(places(codes, words))
    frequent = {run for run, n in counts.items() if n > np.median(list(counts.values()))}
    marks = np.zeros(buckets, dtype=bool)
    for run in frequent:
        marks[int(collocations.buckets_of(np.array(run), np.array([0]), words, buckets)[0])] = True
    left = collocations.narrow(codes, words, np.packbits(marks))

    def longer(held):
        return Counter(run for run in places(held, words + 1) if run[1:] in frequent and run[:-1] in frequent)

    assert longer(left) == longer(codes) and longer(codes)
    assert left[-1] == 0 and not ((left[1:] == 0) & (left[:-1] == 0)).any()
    assert len(left) < len(codes) - 500 or buckets == 1 << 3
    assert len(collocations.narrow(codes[:words], words, np.packbits(marks))) == 0


def test_counts_travel_without_those_that_do_not_occur(spark):
    """What a task sends grows with what it holds, not with the phrases of the trie."""
    rows = [batch for batch in collocations.tallied(iter([np.array([5, 2, 5]), np.array([10**6, 5])]), "i4")]
    assert sum(batch.nbytes for batch in rows) < 200
    found = {chunk: total for chunk, total in collocations.sums_of(iter(rows), "i4")}
    at = 10**6 // collocations.CHUNK
    assert set(found) == {0, at} and found[0][[2, 5]].tolist() == [1, 3] and found[0].sum() == 4
    assert found[at][10**6 % collocations.CHUNK] == 1


def test_later_levels_read_fewer_codes(spark, monkeypatch):
    """Places that cannot hold a longer frequent phrase are read once, whatever the phrases found elsewhere."""
    random.seed(2)
    rare = [f"r{i}" for i in range(3000)]
    rows = [(" ".join([*random.choices(rare, k=60), "one two", *random.choices(rare, k=60), "three four five six"]), "en") for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    seek, sizes = collocations.candidates, []

    def noted(coded, shorter, words, min_count):
        sizes.append((coded.agg(F.sum(F.length("codes"))).first()[0] or 0) // 8)
        return seek(coded, shorter, words, min_count)

    monkeypatch.setattr(collocations, "candidates", noted)
    found = collocations.collocations(docs, min_count=50)
    assert sorted((r.phrase, r.a) for r in found.collect()) == [("one two", 60), ("three four five six", 60)]
    assert len(sizes) == 4 and sizes[0] < 60 * 15 and sizes[1] < sizes[0] and sizes[1] <= 60 * 6 and sizes[3] <= sizes[1]
