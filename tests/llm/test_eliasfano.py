import numpy as np
import pytest

from voicecorpus.llm.eliasfano import EliasFano


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (1, 1 << 50), (1000, 900), (5000, 1 << 30), (3000, 1 << 55), (2000, 1 << 14)])
def test_get_find_all(n, top):
    rng = np.random.default_rng(n + top % 97)
    v = np.sort(rng.integers(0, top, n)).astype(np.uint64)
    e = EliasFano.build(v)
    assert e.all().tolist() == v.tolist()
    i = rng.permutation(n)
    assert e.get(i).tolist() == v[i].tolist()
    lo = rng.integers(0, n + 1, 500)
    hi = np.minimum(n, lo + rng.integers(0, n + 1, 500))
    q = np.concatenate((v[rng.integers(0, n, 250)], rng.integers(0, top + 5, 250).astype(np.uint64))) if n else rng.integers(0, 9, 500).astype(np.uint64)
    got = e.find(lo, hi, q)
    for a, b, x, g in zip(lo.tolist(), hi.tolist(), q.tolist(), got.tolist(), strict=True):
        k = a + int(np.searchsorted(v[a:b], np.uint64(x)))
        assert g == (k if k < b and v[k] == x else -1)
