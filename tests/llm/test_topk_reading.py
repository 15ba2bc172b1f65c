"""The sorted lists are read until outsiders cannot qualify, or to their ends; either way the scores are exact."""

from __future__ import annotations

import numpy as np
import pytest

from lakecart.llm import topk


def _want(q, qid, x, xid, k):
    out = {}
    for i, a in zip(qid.tolist(), q, strict=True):
        pairs = sorted((-int(a.astype(object) @ b.astype(object)), j) for j, b in zip(xid.tolist(), x, strict=True) if j != i)
        out[i] = [(-s, j) for s, j in pairs[:k]]
    return out


def _got(q, qid, x, xid, k, progress):
    out = {}
    for i, j, s in zip(*(a.tolist() for a in topk.tile_topk(q, qid, x, xid, k, progress)), strict=True):
        out.setdefault(i, []).append((s, j))
    return out


def test_skewed_lists_stop_early():
    rnd = np.random.default_rng(1)
    x = np.zeros((4000, 6), np.int64)
    x[:200] = rnd.integers(200, 900, (200, 6))
    x[200:] = rnd.integers(0, 20, (3800, 6))
    ids, progress = np.arange(4000), []
    q, qid = np.abs(rnd.integers(1, 50, (8, 6))), np.arange(10_000, 10_008)
    assert _got(q, qid, x, ids, 5, progress) == _want(q, qid, x, ids, 5)
    assert progress[-1][0] == 500 and progress[-1][1] < 8 * 4000 * topk.SURVIVORS + 1  # an eighth of each list


def test_even_lists_are_read_past_their_middle():
    rnd = np.random.default_rng(2)
    x = rnd.integers(-60, 60, (900, 32))
    ids, progress = np.arange(900), []
    q, qid = x[::90], ids[::90]
    assert _got(q, qid, x, ids, 20, progress) == _want(q, qid, x, ids, 20)
    assert progress[-1][0] == 675 and progress[2][1] > 0.5 * 9000  # bounds at half of each list prune too little
    assert [r for r, _ in progress] == sorted({r for r, _ in progress})


def test_equal_rows_are_read_to_the_ends():
    x, ids, progress = np.full((300, 4), 7), np.arange(300), []
    assert _got(x[:3], ids[:3], x, ids, 5, progress) == _want(x[:3], ids[:3], x, ids, 5)
    assert progress[-1][0] == 300


@pytest.mark.parametrize("n", [1, 2, 5, 20, 21, 22])
def test_tiles_about_k(n):
    rnd = np.random.default_rng(n)
    x, ids, progress = rnd.integers(-5, 5, (n, 3)), np.arange(n), []
    got = _got(x, ids, x, ids, 20, progress)
    want = {i: v for i, v in _want(x, ids, x, ids, 20).items() if v}
    assert got == want and progress[-1][0] <= n

