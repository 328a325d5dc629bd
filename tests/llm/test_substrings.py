"""Repeated words and bytes against brute force."""

import hashlib
import tracemalloc
from collections import Counter
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pytest
from .conftest import by_id
from hypothesis import given, settings
from hypothesis import strategies as st

from retailflow.llm import repeats, substring_trees, suffix_arrays


def brute(rows, cut, join, window):
    units = [cut((t or "").encode()) for _, t in rows]
    seen = Counter(u[i:i + window] for u in units for i in range(len(u) - window + 1))
    out = []
    for (doc_id, _), u in zip(rows, units, strict=True):
        gone = [False] * len(u)
        for i in range(len(u) - window + 1):
            if seen[u[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = join([x for x, g in zip(u, gone, strict=True) if not g])
        out.append((doc_id, len(u), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return by_id(out)


CASES = {
    "words": (substring_trees.dedup_words, lambda b: tuple(b.split()), b" ".join, 35),
    "bytes": (suffix_arrays.dedup_bytes, lambda b: b, bytes, 400),
}


@pytest.mark.parametrize("bound", [repeats.GROUP_ROWS, 1])
@pytest.mark.parametrize("kind", CASES)
def test_equals_brute_force(awkward, kind, bound, monkeypatch):
    operator, cut, join, window = CASES[kind]
    monkeypatch.setattr(repeats, "GROUP_ROWS", bound)  # 1: every open gram goes the digest way
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    got = by_id(operator(awkward).collect())
    assert got == brute(rows, cut, join, window)
    assert sum(r[2] for r in got) > 0


@pytest.mark.parametrize("kind", CASES)
def test_empty_table(nothing, kind):
    assert CASES[kind][0](nothing).collect() == []


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    v = rng.integers(0, 3, 3_000).astype(np.uint64)
    whole = repeats.text_runs([v], 40, 8)[0]
    monkeypatch.setattr(repeats, "CHUNK", 500)
    pieces = repeats.text_runs([v, v[:30], v], 40, 8)

    def windows(runs):
        at, n, _ = repeats.unpacked(runs["at"])
        return sorted(p for a, k in zip(at, n, strict=True) for p in range(a, a + k))

    assert windows(whole) == windows(pieces[0]) == windows(pieces[2]) == list(range(len(v) - 39))
    assert len(pieces[1]) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=12, max_size=40), min_size=2, max_size=8))
def test_sorted_suffixes_find_equal_windows(texts):
    window, gram = 12, 4
    values = [suffix_arrays.Bytes().values(np.frombuffer(t.encode(), np.uint8)) for t in texts]
    runs = repeats.text_runs(values, window, gram)
    rows = []
    for t, r in zip(texts, runs, strict=True):
        at, n, _ = repeats.unpacked(r["at"])
        rows += [(int(g), int(a), t.encode()[p:p + k - 1 + window], p, k, t)
                 for g, a, p, k in zip(r["g"].view(np.int64) if r["g"].flags.c_contiguous else r["g"].copy().view(np.int64),
                                       r["at"], at.tolist(), n.tolist(), strict=True)]
    rows.sort(key=lambda r: r[0])
    seen = Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    for compare in (suffix_arrays.compare_suffixes,):
        lo, hi = compare(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), [r[2] for r in rows], window)
        for r, a, b in zip(rows, lo, hi, strict=True):
            hit = [j for j in range(r[4]) if seen[r[5][r[3] + j:r[3] + j + window]] > 1]
            assert (a, b) == ((hit[0], hit[-1]) if hit else (-1, -1))


@pytest.mark.parametrize("kind", CASES)
def test_many_copies_of_one_row(spark, kind):
    from .conftest import prose

    operator, cut, join, window = CASES[kind]
    other = prose(60, 300)
    rows = [(7, prose(61, 300) + " " + other[:900])] * 500 + [(i, other + " " + prose(70 + i, 120)) for i in range(20)] + [(99, prose(62, 200))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert by_id(operator(docs).collect()) == brute(rows, cut, join, window)


@pytest.mark.parametrize("step", ["index", "finish_closed", "finish_open"])
def test_a_task_holds_a_part_of_a_batch(spark, step, monkeypatch):
    """24 MB of texts in one batch: what a Python worker allocates beside the batch stays far below the batch."""
    source, units = MagicMock(), suffix_arrays.Bytes()
    monkeypatch.setattr(repeats, "on_workers", lambda df: source)
    for name in ("select", "join"):
        getattr(source, name).return_value = source
    args = {"index": (units, 400, 64), "finish_closed": (MagicMock(), units, 400), "finish_open": (MagicMock(), units, 400)}
    getattr(repeats, step)(source, *args[step])
    run = source.mapInArrow.call_args[0][0]
    texts = [np.random.default_rng(i).bytes(8_000) for i in range(3_000)]
    ids = pa.array(range(len(texts)))
    runs = pa.array([[{"at": (i << 32) + (40 << 16), "g": i, "whole": True, "ask": False, "big": False} for i in range(20)]]
                    * len(texts))
    columns = {"index": [ids, ids, ids, pa.array(texts)], "finish_closed": [ids, ids, ids, pa.array(texts), runs],
               "finish_open": [ids, pa.array(texts), pa.array([b""] * len(texts)),
                               pa.array([[]] * len(texts), pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())])))]}
    batch = pa.RecordBatch.from_arrays(columns[step], [str(i) for i in range(len(columns[step]))])
    del texts, columns, runs
    tracemalloc.start()
    n = sum(b.num_rows for b in run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 3_000
    assert peak < 60e6 if step == "index" else peak < 20e6, peak
