"""The Jaccard join, its components and the pipeline."""

import random

import brute
import numpy as np
import pytest

import corpus_pipeline
from tallyline.llm import jaccard_join
from tallyline.llm.components import components

KINDS = "doc_id long, text string, key string, name int, n_links string"


def made(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "n") for i, t in rows], KINDS)


def agrees(spark, rows):
    found = jaccard_join.join(made(spark, rows)).collect()
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in found), key=str)
    want = sorted(((i, *c) for (i, _), c in zip(rows, brute.classes(rows))), key=str)
    assert got == want


def varied(text, n, changes):
    words = text.split()
    for _ in range(n):
        copy = list(words)
        for k in random.sample(range(len(words)), changes):
            copy[k] = f"new{random.randrange(10**6)}"
        yield " ".join(copy)


def test_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    odd = [(9001, None), (9002, ""), (9003, "two words"), (9004, "two words"), (9004, "two words"), (None, docs[0].text)]
    agrees(spark, [(r.doc_id, r.text) for r in docs] + odd)


def test_large_groups_are_split(spark, monkeypatch):
    random.seed(3)
    base = " ".join(f"w{random.randrange(10**6)}" for _ in range(200))
    other = " ".join(base.split()[:150] + [f"v{i}" for i in range(50)])
    rows = list(enumerate([*varied(base, 60, 2), *varied(other, 60, 2), *[base] * 40, *varied(base, 20, 7)]))
    monkeypatch.setattr(jaccard_join, "BUCKET", 16)
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    agrees(spark, rows)


def test_families_are_compared_whole(spark, monkeypatch):
    random.seed(5)
    shared = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(shared + [f"t{i}x{k}" for k in range(45)])) for i in range(40)]
    for name, value in (("BUCKET", 4), ("BLOCK", 3)):
        monkeypatch.setattr(jaccard_join, name, value)
    agrees(spark, rows + [(100 + i, t) for i, t in rows[:20]])


def test_empty_and_one(spark):
    assert jaccard_join.join(made(spark, [])).isEmpty()
    assert jaccard_join.keep_one(made(spark, [(1, None)])).count() == 1


def test_one_row_of_each_class_stays(spark):
    random.seed(7)
    base = [" ".join(f"w{random.randrange(10**6)}" for _ in range(100)) for _ in range(6)]
    near = [next(varied(text, 1, 1)) for text in base]
    rows = [
        (1, base[0]), (1, base[0]), (2, near[0]),  # the kept row is repeated
        (3, base[1]), (3, near[1]),  # near copies of one id
        (None, base[2]), (None, near[2]), (None, base[2]),  # no ids
        (None, base[3]), (4, near[3]), (5, base[4]), (6, base[5]), (6, base[5]), (7, base[5]),
        (8, None), (8, None), (9, ""), (None, ""),
    ]
    docs = made(spark, rows)
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert sorted(i or 0 for i, t in found if t) == [0, 1, 3, 4, 5, 6]
    assert {(1, base[0]), (4, near[3]), (5, base[4]), (6, base[5])} <= set(found)
    assert sorted((r for r in found if not r[1]), key=str) == sorted(rows[-4:], key=str)
    assert kept.select("key", "name", "n_links").distinct().count() == 1


def test_runs_reach_the_recall():
    runs = jaccard_join.runs_needed()
    assert jaccard_join.missed(jaccard_join.DEPTH + jaccard_join.SPLIT) ** runs <= 1 - jaccard_join.RECALL
    rng = np.random.default_rng(0)
    places = 600
    a = rng.integers(0, 2**32, (places, jaccard_join.PLACES), dtype=np.uint32)
    b = np.where(rng.random(a.shape) < 0.8, a, a + 1)
    met = np.zeros(places, dtype=bool)
    paths = jaccard_join.mixed(np.full(2 * places, 7, dtype=np.uint64))
    owner = np.arange(2 * places)
    for _ in range(jaccard_join.DEPTH):
        paths, owner = jaccard_join.descend(paths, owner, np.concatenate([a, b]))
    left, right = {}, {}
    for p, o in zip(paths.tolist(), owner.tolist()):
        (left if o < places else right).setdefault(o % places, set()).add(p)
    met = np.array([bool(left[i] & right[i]) for i in range(places)])
    assert met.mean() == pytest.approx(1 - jaccard_join.missed(jaccard_join.DEPTH), abs=0.08)


def test_recall_over_one_sketch():
    runs, depth, own = jaccard_join.runs_needed(), jaccard_join.DEPTH + jaccard_join.SPLIT, jaccard_join.factors()
    assert jaccard_join.RECALL == 0.99999
    assert jaccard_join.missed_by_all(runs, depth) <= 1e-5
    rng = np.random.default_rng(1)
    pairs = 5000  # sets of 90 with 80 in common
    sets = rng.integers(0, 2**63, (pairs, 100), dtype=np.uint64)
    sketches = np.array([jaccard_join.sketch(x, own) for x in [*sets[:, :90], *sets[:, 10:]]])
    agree = (sketches[:pairs] == sketches[pairs:]).mean(axis=1)
    assert agree.mean() == pytest.approx(0.8, abs=0.005) and agree.std() == pytest.approx((0.16 / 128) ** 0.5, rel=0.1)
    # All pairs are walked, those met are left out of the next run.
    left, after = np.arange(pairs), []
    for number in range(runs):
        both = np.concatenate([sketches[left], sketches[pairs + left]])
        owner = np.arange(len(both))
        paths = np.full(len(both), jaccard_join.mixed(np.array([number + 1], dtype=np.uint64) * jaccard_join.MIX)[0])
        for _ in range(depth):
            paths, owner = jaccard_join.descend(paths, owner, both)
        first = owner < len(left)
        one = {*zip(paths[first].tolist(), owner[first].tolist())}
        met = {o - len(left) for p, o in zip(paths[~first].tolist(), owner[~first].tolist()) if (p, o - len(left)) in one}
        left = np.delete(left, sorted(met))
        after.append(len(left))
    assert after[-1] <= 1  # of 5000; 15 runs leave four of these


def test_components(spark):
    random.seed(1)
    chain = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (5, 5)]
    random.shuffle(chain)
    found = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 140)}, 201: 200}


def test_pipeline(spark, sf):
    """Every stage against a plain version over its own input."""
    from tallyline.llm import quality_rules

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.assess(docs).where("kept").collect()}
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality_rules", "jaccard_join", "decontaminate", "secret_scan", "piece_tokens"]
    one = stage["quality_rules"](spark, docs, sf)
    rows = [(r.doc_id, r.text) for r in one.collect()]
    assert {i for i, _ in rows} == kept and one.columns == docs.columns
    two = stage["jaccard_join"](spark, one, sf)
    assert {r.doc_id for r in two.collect()} == {i for (i, _), (c, _) in zip(rows, brute.classes(rows)) if i == c}
    three = stage["decontaminate"](spark, two, sf)
    four = stage["secret_scan"](spark, three, sf)
    assert four.columns == docs.columns and four.count() == three.count()
    assert not [r for r in four.collect() if brute.base_spans(r.text)]
    final = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in final.select("doc_id").collect()} == {r.doc_id for r in three.collect()}
