"""What the quality classifier holds at once does not grow with a batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from spark_elt.llm import quality


def test_batch_of_short_words_takes_little_memory():
    texts = pa.array(["a b c d " * 640] * 400)  # 2 MB, a million words
    vectors = quality.index_vectors()
    tracemalloc.start()
    try:
        table = list(quality._contexts(iter([pa.RecordBatch.from_arrays([texts], ["text"])])))[0]
        pooled = quality.pool(texts, vectors)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 100e6
    assert np.array_equal(pooled[0], pooled[-1]) and pooled[0, -1] == np.float32(np.log1p(4 * 640))
    one = list(quality._contexts(iter([pa.RecordBatch.from_arrays([texts[:1]], ["text"])])))[0]
    assert np.array_equal(400 * np.array(one.column(1).to_pylist()), np.array(table.column(1).to_pylist()))
