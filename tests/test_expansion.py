import math

import numpy as np
import pyarrow as pa

from quarry.operators.blocks import best_seed_fn


def _run(seeds, docs):
    fn = best_seed_fn(np.asarray([s[0] for s in seeds]), [s[1] for s in seeds], np.array([s[2] for s in seeds], float), ["url"])
    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs]), pa.nulls(len(docs), pa.list_(pa.int32())),
                                        pa.array([d[2] for d in docs])], names=["url", "seq", "dims", "ws"])
    return pa.Table.from_batches(fn(iter([batch]))).to_pandas()


def test_threshold_is_strict_and_needs_two_predecessors():
    seeds = [(0, "s0", [1.0, 0.0]), (1, "s1", [0.0, 1.0])]
    half = [0.5, math.sqrt(0.75)]
    out = _run(seeds, [("x", 5, half), ("only-one", 1, [1.0, 0.0]), ("first", 0, [1.0, 0.0])]).set_index("url")
    assert out.loc["x", "seed_url"] == "s1" and out.loc["x", "sim"] > 0.5
    assert out.loc["only-one", "n_pred"] == 1 and out.loc["only-one", "seed_url"] is None
    assert out.loc["first", "n_pred"] == 0


def test_exact_half_is_not_expanded():
    seeds = [(0, "s0", [1.0, 0.0]), (1, "s1", [-1.0, 0.0])]
    out = _run(seeds, [("x", 5, [0.5, math.sqrt(0.75)])]).set_index("url")
    assert out.loc["x", "sim"] == 0.5 and not out.loc["x", "sim"] > 0.5


def test_ties_take_earliest_seed():
    seeds = [(0, "s0", [1.0, 0.0]), (1, "s1", [1.0, 0.0])]
    out = _run(seeds, [("x", 9, [1.0, 0.0])]).set_index("url")
    assert out.loc["x", "seed_url"] == "s0"
