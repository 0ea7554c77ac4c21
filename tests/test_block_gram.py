"""The distributed block Gram matrix against plain sums."""

import numpy as np
import pytest

from clusterfold.operators import block_gram as bg
from clusterfold.operators import linear as lin


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(2)
    X, y = rng.normal(0, 0.3, (230, 21)), rng.normal(0, 1, 230)
    return X, y, spark.createDataFrame([(x.tolist(), float(v)) for x, v in zip(X, y)], "x array<double>, y double")


@pytest.mark.parametrize("size,task_values,parts", [(5, 60, 40), (7, 1 << 20, 3), (22, 1 << 20, 20), (100, 1, 1)])
def test_blocks_hold_the_whole_product(wide, size, task_values, parts):
    X, y, train = wide
    gram = bg.BlockGram(train.repartition(parts), 21, size, task_values)
    n = -(-22 // size)
    assert gram.m == 230 and gram.blocks.count() == n * (n + 1) // 2  # one block a place
    w = np.linspace(-1, 1, 21)
    assert np.allclose(gram.product(w), X.T @ (X @ w - y))


def test_descent_equals_the_other_methods(wide, monkeypatch):
    _, _, train = wide
    w0 = [0.1] * 21
    want = lin.batch_gd(train, w0, 6, 0.1, "gram")
    assert np.allclose(lin.batch_gd(train, w0, 6, 0.1, "blocks"), want)
    monkeypatch.setattr(lin, "MAX_GRAM_FEATURES", 20)
    assert np.allclose(lin.batch_gd(train, w0, 6, 0.1, "gram"), want)
    assert lin.batch_gd(train.limit(0), w0, 6, 0.1, "blocks") == w0
    with pytest.raises(Exception, match="length"):
        lin.batch_gd(train, [0.0] * 22, 1, 0.1, "blocks")
    with pytest.raises(FloatingPointError):
        lin.batch_gd(train, [1e308] * 21, 2, 1e6, "blocks")


def test_passes_cover_every_block():
    for sides, size, most in ((1, 4, 1), (5, 4, 50), (6, 10, 10**9)):
        groups = bg._passes(sides, size, most)
        assert sorted(p for g in groups for p in g) == [(i, j) for i in range(sides) for j in range(i, sides)]
        assert all(len(g) * size * size <= max(most, size * size) for g in groups)
