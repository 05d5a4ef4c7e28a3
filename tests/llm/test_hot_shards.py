"""Shards and subtrees that many rows share: cut into parts, merged, and searched in blocks."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from brute import covered

from trendstrata.llm import mtree, suffixes


def _noise(r, n):
    return "".join(r.choice("abcdefghij ") for _ in range(n))


def test_one_line_in_many_texts(spark):
    """Its shard is cut twice, by runs and by bytes; what repeats lies in different parts."""
    r = random.Random(5)
    line = "the very same line of a licence that stands in each of these texts and says nothing of note"
    texts = [f"{_noise(r, 250)}{line}{_noise(r, 250)}" for _ in range(1500)]
    for k in range(0, 60, 2):  # pairs that share more than the line
        texts[k + 700] = f"{_noise(r, 90)}{texts[k][150:420]}{_noise(r, 70)}"
    texts += [f"{_noise(r, 120)}{line * 5}{_noise(r, 10)}" for _ in range(3)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(9999, f"{line}{_noise(r, 300)}")] * 1000
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    spans = suffixes.repeated_spans(df)
    marked = suffixes.with_spans(df, spans).select("doc_id", "text", "_spans")
    found = marked.mapInArrow(suffixes._digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    want = [(i, *c) for (i, _), c in zip(rows, covered([t for _, t in rows]), strict=True)]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert sum(w[2] > 0 for w in want) > 1060


def test_merging_sorted_arrays():
    r = np.random.default_rng(1)
    arrays = [np.unique(r.integers(0, 4000, r.integers(1, 900)).astype(np.uint64)) for _ in range(7)]
    merged = [(a, a[:0]) for a in arrays]
    while len(merged) > 1:
        merged = [suffixes._both(*merged[i : i + 2]) if i + 1 < len(merged) else merged[i] for i in range(0, len(merged), 2)]
    values, counts = np.unique(np.concatenate(arrays), return_counts=True)
    assert (merged[0][0] == values).all() and (merged[0][1] == values[counts > 1]).all()


@pytest.mark.parametrize("kind", ["spread", "equal", "ties", "repeated ids", "clusters"])
def test_a_subtree_answers_all_queries_at_once(kind):
    r = np.random.default_rng(3)
    x = r.integers(-300, 300, (900, 5))
    x = {"equal": np.repeat(x[:1], 900, 0), "ties": x // 150, "clusters": x // 8 + r.integers(-3, 4, (900, 1)) * 2000}.get(kind, x)
    ids = np.arange(900) * 3 % 901
    if kind == "repeated ids":
        ids = ids // 7
    square = float((x.astype(np.float64) ** 2).sum(1).max())
    tree = mtree.MTree(ids, x, square, None)
    own, queries = ids[:40], x[:40]
    which, found, scores = tree.search_all(own, queries, np.full(40, np.inf), 6)
    for i in range(40):
        best: dict[int, int] = {}
        for one, score in zip(ids.tolist(), (x @ queries[i]).tolist(), strict=True):
            if one != own[i]:
                best[one] = max(score, best.get(one, score))
        want = sorted(((-s, one) for one, s in best.items()))[:6]
        got = sorted((-s, one) for s, one in zip(scores[which == i].tolist(), found[which == i].tolist(), strict=True))
        assert got == want
    if kind == "clusters":
        assert tree.computed < 40 * 900  # bounds spare computations


def test_limits_of_a_subtree_only_leave_out_what_is_farther():
    r = np.random.default_rng(4)
    x = r.integers(-300, 300, (500, 4))
    square = float((x.astype(np.float64) ** 2).sum(1).max())
    tree = mtree.MTree(np.arange(500), x, square, None)
    query = x[7:8]
    whole = tree.search_all(np.array([7]), query, np.array([np.inf]), 5)
    length = float((query.astype(np.float64) ** 2).sum())
    third = np.sqrt(length + square - 2 * float(whole[2][2]))
    bounded = tree.search_all(np.array([7]), query, np.array([third]), 5)
    assert set(zip(whole[1][:3].tolist(), whole[2][:3].tolist(), strict=True)) <= set(zip(bounded[1].tolist(), bounded[2].tolist(), strict=True))
