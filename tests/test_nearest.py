"""Distances of the search: estimates in single precision, results as exact as
a scan in doubles, and little held of a tile."""

import tracemalloc

import numpy as np
import pytest

from ragloom.operators import metric_index
from ragloom.operators.metric_index import nearest, squares
from ragloom.operators.retrieval import _TopK


def _brute(q, own, c, ids, worst, k):
    out = []
    for i in range(len(q)):
        d = q[i].astype(np.float64) - c.astype(np.float64)
        d = np.einsum("ij,ij->i", d, d)
        near = [j for j in np.lexsort((ids, d)) if d[j] <= worst[i] and (own is None or ids[j] != own[i])]
        out += [(i, int(j)) for j in near[:k]]
    return out


@pytest.mark.parametrize("width", [np.float32, np.float64])
@pytest.mark.parametrize("scale", [1e-14, 1.0, 1e14])
@pytest.mark.parametrize("offset", [0, 1000])  # near vectors that single precision does not tell apart
def test_nearest_equals_a_scan_in_doubles(width, scale, offset):
    rng = np.random.default_rng(1)
    for trial in range(12):
        dim, k = int(rng.integers(1, 40)), int(rng.integers(1, 6))
        q = ((rng.normal(size=(int(rng.integers(1, 30)), dim)) + offset) * scale).astype(width)
        c = ((rng.normal(size=(int(rng.integers(1, 200)), dim)) + offset) * scale).astype(width)
        if trial % 2:
            c[::2] = c[0]
        if trial % 3 == 0:
            c[1::3] = 0
            q[:2] = 0
        ids = rng.permutation(2 * len(c))[:len(c)].astype(np.int64)
        own = rng.integers(0, len(c), len(q)) if trial % 4 == 0 else None
        worst = np.full(len(q), np.inf)
        if trial % 5 == 0:
            worst = np.quantile(((q[:, None].astype(np.float64) - c[None]) ** 2).sum(axis=2), 0.3, axis=1)
        rows, cols, _ = nearest(q, squares(q), own, c, squares(c), ids, worst, k)
        assert list(zip(rows.tolist(), cols.tolist(), strict=True)) == _brute(q, own, c, ids, worst, k), trial


def test_a_full_top_k_takes_little_for_a_further_tile():
    """Once the places are filled, a tile costs its estimates in single
    precision and the pairs that may enter, no doubles for every pair."""
    rng = np.random.default_rng(2)
    q, c = rng.normal(size=(1024, 64)), rng.normal(size=(2048, 64))
    top = _TopK(len(q), 3)
    top.offer(q, squares(q), c[:1024], np.arange(1024))
    tracemalloc.start()
    top.offer(q, squares(q), c[1024:], np.arange(1024, 2048))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6, peak
    want = _brute(q[:20], None, c, np.arange(2048), np.full(20, np.inf), 3)
    assert top.ids[:20].reshape(-1).tolist() == [j for _, j in want]


def test_single_precision_is_left_where_it_tells_nothing(monkeypatch):
    """Vectors far from the origin and close to each other: the estimates are
    made again in doubles instead of an exact distance for every pair."""
    rng = np.random.default_rng(3)
    q, c = (rng.normal(size=(200, 16)) * 1e-3 + 100 for _ in range(2))
    widths, estimated = [], metric_index._estimated

    def counted(*args):
        out = estimated(*args)
        widths.append((args[-1], len(out[0])))
        return out
    monkeypatch.setattr(metric_index, "_estimated", counted)
    nearest(q, squares(q), None, c, squares(c), np.arange(200), np.full(200, np.inf), 3)
    assert [w for w, _ in widths] == [np.float32, np.float64] and widths[1][1] < 2000 < widths[0][1]
