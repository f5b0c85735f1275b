"""The keyed state's accesses are messages to the JVM: few a user, whatever the user has rated."""

from types import SimpleNamespace

import numpy as np

from conftest import rows
from recspark.operators import similarity as SIM
from recspark.streaming import online as STR


class Store:
    def __init__(self):
        self.value, self.pieces, self.messages = None, [], 0

    def getValueState(self, *_):
        return SimpleNamespace(get=lambda: self.sent(self.value), update=lambda v: self.sent(setattr(self, "value", v)))

    def getListState(self, *_):
        return SimpleNamespace(get=lambda: self.sent(list(self.pieces)), appendValue=lambda v: self.sent(self.pieces.append(v)))

    def sent(self, result):
        self.messages += 1
        return result


def test_a_user_costs_few_messages():
    store = Store()
    state = STR.UserState(3, True)
    state.init(store)
    state.handleInitialState((1,), SimpleNamespace(products=list(range(100)), n=0, ts=[], p=[], s=[]), None)
    assert store.messages == 1 and store.value is None
    for batch, n in ((range(90, 140), 50), (range(130, 150), 70)):
        store.messages = 0
        events = [SimpleNamespace(ts=10 + p, productId=p, score=2.5) for p in batch]
        (out,) = state.handleInputRows((1,), iter(events), None)
        assert store.messages <= 4 and out.version == n and out.b_p == list(batch)
        assert out.q_p == [batch[-1], batch[-2], batch[-3]] and sorted(out.rated) == list(range(batch[-1] + 1))
    assert sum(len(p) for (p,) in store.pieces) == 4 * 150  # each product once


def test_asked_pairs_are_dealt_over_tasks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    v = [(i, rng.normal(size=5).tolist()) for i in [*range(40), 7, 7]] + [(50, [0.0] * 5), (None, [1.0] * 5)]
    asked = [(a, b) for a in range(40) for b in range(0, 42, 2)] * 2
    df = spark.createDataFrame(v, "productId int, vector array<double>")
    pairs = spark.createDataFrame(asked, "productId int, simProductId int")
    dealt, of = [], SIM._of_block
    monkeypatch.setattr(SIM, "_of_block", lambda n, c="id": dealt.append(n) or of(n, c))
    monkeypatch.setattr(SIM, "ASKED", 50)
    got = rows(SIM.cosine_pairs(df, min_sim=0.1, pairs=pairs).selectExpr("productId", "simProductId", "round(sim, 9)"))
    unit = [(i, np.array(x) / np.linalg.norm(x)) for i, x in v if i is not None and any(x)]
    exp = [(a, b, round(float(x @ y), 9)) for a, x in unit for b, y in unit if a != b and (a, b) in set(asked) and x @ y > 0.1]
    assert got == sorted(exp) and max(dealt) > 10
