"""The bounds of the top-k search close, whatever the vectors."""

import numpy as np

from recspark.llm import topk


def test_bounds_leave_the_best_only():
    rng = np.random.default_rng(3)
    x = np.floor(64 * rng.normal(size=(300, 64)) / 8).astype(np.float32)
    q = x[:9]
    alive = topk.bounded(q, x, np.ones((9, 300), bool), 5)
    exact = q.astype(int) @ x.astype(int).T
    assert (alive == (exact >= np.sort(exact, axis=1)[:, -5][:, None])).all()
