"""A worker keeps the encoder for tasks that tokenise, not for later stages."""

import pyarrow as pa

from recspark.llm import tokens
from recspark.llm.common import HELD, small_batches


def batch(n):
    return pa.RecordBatch.from_arrays([pa.array(["some words and more " * 50] * n)], names=["text"])


def test_other_tasks_let_the_encoder_go():
    e = tokens.encoder()
    ids = e.encode(["some words"])
    assert len(list(small_batches(iter([batch(3)]), held=tokens.KIND))) == 1
    assert tokens.encoder() is e
    assert sum(b.num_rows for b in small_batches(iter([batch(3)]))) == 3
    assert not HELD and not tokens._LOADED
    assert tokens.encoder() is not e and tokens.encoder().encode(["some words"]) == ids


def test_batches_are_small():
    slices = list(small_batches(iter([batch(5000)])))
    assert sum(b.num_rows for b in slices) == 5000
    assert max(b.column(0).nbytes for b in slices) <= 3 << 20
