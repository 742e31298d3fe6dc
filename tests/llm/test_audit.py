"""The recall audit of the embedding graph, with beams that miss links of ordinary vectors."""

import numpy as np
import pytest

from shoalspark.llm import embeddings


def _vectors(pairs, crowd, lone):
    rng = np.random.default_rng(12)
    base = rng.normal(size=(pairs, 32))
    x = np.r_[np.repeat(base, 2, 0) + 0.05 * rng.normal(size=(2 * pairs, 32)), rng.normal(size=(1, 32)) + 0.02 * rng.normal(size=(crowd, 32)), rng.normal(size=(lone, 32))]
    return x / np.linalg.norm(x, axis=1)[:, None]


@pytest.mark.parametrize(("pairs", "crowd", "lone"), [(400, 400, 0), (20, 400, 1500)])
def test_a_hot_group_does_not_hide_lost_pairs(monkeypatch, pairs, crowd, lone):
    """A beam below 256 loses the links of all that lie outside the hot group."""
    x, search = _vectors(pairs, crowd, lone), embeddings.Graph.search

    def narrow(self, q, width):
        ids, score = search(self, q, width)
        ordinary = (score >= 0.93).sum(1) < width
        if width < 256:
            score[ordinary, 1:] = -3
        return ids, score

    monkeypatch.setattr(embeddings.Graph, "search", narrow)
    hits = embeddings.shard_links(x, x, own=True)
    truth = [np.flatnonzero(r >= 0.93) for r in x @ x.T]
    some = [k for k in range(2 * pairs) if len(truth[k]) > 1]
    lost = sum(len(truth[k]) - len(hits[k]) for k in some)
    assert len(some) > 1.8 * pairs and lost <= 0.02 * sum(len(truth[k]) - 1 for k in some)
