"""Links of vectors whose steps lie along few directions, against all cosines."""

import numpy as np
import pytest

from rowgate.llm import pq
from tests.llm import helpers


@pytest.mark.parametrize("lists", [10, 75])
def test_three_main_directions(spark, lists):
    rng = np.random.default_rng(8)
    scale = np.append(np.ones(3), np.full(61, 0.02))
    vectors = (rng.normal(size=(3000, 64)) * scale).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r.vec_id: r for r in pq.near_duplicates(table, per_list=3000 // lists, chunk=200).collect()}
    raw = vectors.astype(np.float64)
    norm = np.sqrt((raw**2).sum(1))
    near = raw @ raw.T >= 0.95 * norm[:, None] * norm[None, :]
    np.fill_diagonal(near, False)
    label = helpers.components(3000, lambda a, b: near[a:b] | (np.arange(a, b)[:, None] == np.arange(3000)[None, :]))
    assert [got[i].n_links for i in range(3000)] == near.sum(1).tolist()
    assert [got[i].component_id for i in range(3000)] == label.tolist()
