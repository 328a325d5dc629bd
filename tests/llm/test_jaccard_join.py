"""The Jaccard join against all pairs of sets."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailflow.llm import jaccard_join
from retailflow.llm.jaccard_join import near_classes, prefix, prefix_size, shingle_set

from .conftest import by_id, prose


def plain_set(text, k=4):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + min(k, len(w))]) for i in range(len(w) - min(k, len(w)) + 1)} if w else set()


def plain_classes(rows, percent=85, k=4):
    sets = [plain_set(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            up[max(root(i), root(j))] = min(root(i), root(j))
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    return by_id((doc, len(sets[i]), min((x for x in ids[root(i)] if x is not None), default=None))
                 for i, (doc, _) in enumerate(rows))


def near_copies():
    """Clusters of edited copies, chains of edits, a passage that many share, short texts."""
    rng = random.Random(9)
    rows, doc = [], 100
    passage = prose(50, 60)
    for size, words, edits in ((60, 170, 2), (25, 80, 1), (12, 400, 6), (8, 30, 1)):
        base = prose(size, words).split()
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits + 1)):
                copy[rng.randrange(words)] = f"edit{rng.randrange(10_000)}"
            rows.append((doc, " ".join(copy)))
            doc += 1
    chain = prose(77, 120).split()
    for i in range(20):
        chain[3 * i] = f"step{i}"
        rows.append((doc, " ".join(chain)))
        doc += 1
    for i in range(90):
        rows.append((doc, prose(1_000 + i, 60 + i) + " " + passage + " " + prose(2_000 + i, 40)))
        doc += 1
    for i in range(40):
        rows.append((doc, " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))))
        doc += 1
    return rows


@pytest.mark.parametrize("limits", [(64, 1_000_000), (3, 1_000_000), (3, 200)])
def test_classes_are_those_of_all_pairs(spark, monkeypatch, limits):
    monkeypatch.setattr(jaccard_join, "LONG_LIST", limits[0])
    monkeypatch.setattr(jaccard_join, "HOT", limits[1])
    monkeypatch.setattr(jaccard_join, "EXCESS", 0.1 if limits[0] < 64 else 4)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = near_classes(docs).collect()
    assert by_id((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_classes(rows)


@pytest.mark.parametrize("rounds", [0, 2])
def test_rest_and_rounds_alone_find_every_link(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    rows = near_copies()[:150]
    got = near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_id((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_classes(rows)


def test_signatures_of_linked_sets_are_near():
    rng = np.random.default_rng(4)
    for _ in range(300):
        a = np.unique(rng.integers(0, 1 << 62, int(rng.integers(1, 400))).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.95], rng.integers(0, 1 << 62, 5).astype(np.uint64)]))
        apart = sum(int(x).bit_count() for x in (jaccard_join._signature(a) ^ jaccard_join._signature(b)).view(np.uint64))
        assert apart <= len(np.setxor1d(a, b))


def test_awkward_documents(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = near_classes(awkward.withColumn("sid", F.lit(1)).withColumn("h", F.lit("x"))).collect()
    assert by_id((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_classes(rows)
    assert near_classes(nothing).collect() == []


def test_clashing_numbers_take_another_seed(spark, monkeypatch):
    seen = []
    real = jaccard_join._clash
    monkeypatch.setattr(jaccard_join, "_clash", lambda sets: seen.append(real(sets)) or len(seen) < 2)
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "A b c d e"), (3, "z")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_classes(docs).collect()) == [(1, 1), (2, 1), (3, 3)]
    assert seen == [False, False]


def test_prefixes_of_linked_sets_share_enough():
    import duckdb

    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 60))
        base = rng.choice(10_000, n, replace=False).astype(np.uint64)
        other = np.concatenate([base[int(rng.integers(0, n // 6 + 1)):], (20_000 + np.arange(int(rng.integers(0, n // 6 + 1)))).astype(np.uint64)])
        a, b = np.sort(base), np.sort(other)
        common = len(np.intersect1d(a, b))
        if 100 * common < 85 * (len(a) + len(b) - common):
            continue
        hot = np.sort(rng.choice(np.union1d(a, b), int(rng.integers(0, n)), replace=False))
        k = len(np.intersect1d(prefix(a, hot), prefix(b, hot)))
        sql = jaccard_join.least_common(str(len(a)), str(len(b))).replace(" div ", " // ")
        assert k >= duckdb.connect().execute(f"SELECT {sql}").fetchone()[0] >= 1
    assert prefix_size(0) == 0 and prefix_size(1) == 1 and len(shingle_set(b"")) == 0


def test_pairs_that_cannot_link_are_left_out_by_wide_parities(spark):
    """Sets of 600 shingles that differ in 400: the 256 parities cannot tell, the wide ones must."""
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 1 << 62, 600).astype(np.uint64))
    other = np.concatenate([base[:400], rng.integers(0, 1 << 62, 200).astype(np.uint64)])
    copy = np.concatenate([base[:-20], rng.integers(0, 1 << 62, 300).astype(np.uint64)])[:600]
    short = base[:520]  # 86 % of the base, and parities of another width
    known = [base, other, copy, short]
    assert len(jaccard_join._wide(base)) > len(jaccard_join._wide(short[:500]))
    sets = spark.createDataFrame([(i, len(s), bytearray(jaccard_join._wide(s).tobytes()), i, i) for i, s in enumerate(known)],
                                 "sid long, n long, wide binary, k1 long, k2 long")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "a long, b long")
    fitting, places = jaccard_join._fitting(sets, pairs, 85)
    assert sorted(map(tuple, fitting.collect())) == [(0, 2), (0, 3)]
    assert sorted(r.sid for r in places.collect()) == [0, 1, 2, 3]


def test_folded_parities_are_those_of_fewer_bits():
    rng = np.random.default_rng(6)
    for n in (0, 1, 128, 129, 1_000):
        s = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        wide = jaccard_join._wide(s)
        assert 8 * len(wide) >= max(256, 2 * n) and (jaccard_join._folded(wide, 32).view(np.int64) == jaccard_join._signature(s)).all()
