"""Periodic runs against plain scans of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailflow.llm import periodic_runs
from retailflow.llm.periodic_runs import find_runs, runs_of, with_cycles

from .conftest import by_id


def plain_runs(t, min_length=24, repeats=3):
    out = {}
    for p in range(1, len(t) // repeats + 1):
        x = 0
        while x < len(t) - p:
            start = x
            while x < len(t) - p and t[x] == t[x + p]:
                x += 1
            if x > start and x + p - start >= max(min_length, repeats * p):
                out.setdefault((start, x + p - start), p)
            x += x == start
    return sorted((s, p, n) for (s, n), p in out.items())


def sample_texts(seed):
    rng = random.Random(seed)
    for k in range(240):
        n = rng.choice([0, 1, 23, 24, 25, 60, 200, 400])
        if k % 5 == 0:
            t = [rng.randrange(2) for _ in range(n)]
        elif k % 5 == 1:
            t = [0] * n
        elif k % 5 == 2:
            t = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] * 400)[:n]
        elif k % 5 == 3:
            t = []
            while len(t) < n:
                t += [rng.randrange(3) for _ in range(rng.randrange(1, 15))] * rng.randrange(1, 12)
        else:
            a, t = [0], [0, 1]
            while len(t) < n:
                a, t = t, t + a
            t = t[:n]
        yield np.array(t, np.int64).reshape(-1)


@pytest.mark.parametrize("options", [(24, 3), (4, 2), (2, 2), (10, 4)])
def test_runs_are_those_of_a_plain_scan(options):
    texts = list(sample_texts(3))
    for t, found in zip(texts, runs_of(texts, *options), strict=True):
        assert [(s, p, n) for s, n, p in found.tolist()] == plain_runs(t.tolist(), *options)


def test_small_batches_of_grid_places_change_nothing(monkeypatch):
    texts = list(sample_texts(4))
    want = [f.tolist() for f in runs_of(texts)]
    monkeypatch.setattr(periodic_runs, "GRID", 64)
    assert [f.tolist() for f in runs_of(texts)] == want


def test_extensions_on_the_grammar():
    rng = np.random.default_rng(1)
    v, _, _ = periodic_runs._laid([np.tile(rng.integers(0, 3, 7), 30), rng.integers(0, 2, 300), np.zeros(90, np.int64)])
    g = periodic_runs.Grammar(v)
    a = rng.integers(1, len(v) - 2, 2_000)
    b = np.minimum(a + rng.integers(1, 200, 2_000), len(v) - 1)
    a, b = a[a < b], b[a < b]
    for x, y, ahead, behind in zip(a.tolist(), b.tolist(), g.extension(a, b, True), g.extension(a, b, False), strict=True):
        n = 0
        while y + n < len(v) and v[x + n] == v[y + n]:
            n += 1
        m = 0
        while m < x and v[x - 1 - m] == v[y - 1 - m]:
            m += 1
        assert (n, m) == (ahead, behind)


def damaged(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is None or text is None:
        return w
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_documents(awkward, nothing):
    more = awkward.sparkSession.range(100, 220).selectExpr("id AS doc_id", "'the same few words ' || id || repeat(' a b', int(id)) AS text")
    docs = awkward.select("doc_id", "text").unionAll(more)
    got = find_runs(with_cycles(docs)).collect()
    want = []
    for r in docs.collect():
        w = damaged(r.doc_id, r.text)
        names = {x: i for i, x in enumerate(dict.fromkeys(w))}
        runs = plain_runs([names[x] for x in w])
        gone = {i for s, p, n in runs for i in range(s + p, s + n)}
        want.append((r.doc_id, len(w), str([(s, n, p) for s, p, n in runs]),
                     hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    assert by_id((r.doc_id, r.n_words, str([tuple(x) for x in r.runs]), hashlib.sha256(r.collapsed.encode()).hexdigest())
                 for r in got) == by_id(want)
    assert sum(len(r.runs) > 0 for r in got) > 100
    assert find_runs(with_cycles(nothing)).collect() == []


def test_strongest_is_exact(spark):
    df = spark.createDataFrame([([(5, 30, 9), (2, 40, 12), (9, 40, 12)],), ([],)],
                               "runs array<struct<start:long,length:long,period:long>>")
    got = df.select(periodic_runs.strongest(F.col("runs")).alias("b"), periodic_runs.run_lines(F.col("runs")).alias("t")).collect()
    assert tuple(got[0].b) == (2, 40, 12) and got[0].t == "5,30,9\n2,40,12\n9,40,12\n"
    assert got[1].b is None and got[1].t == ""


def test_options_are_checked(awkward):
    with pytest.raises(ValueError):
        find_runs(awkward, repeats=1)
