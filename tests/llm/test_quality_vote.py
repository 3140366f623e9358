"""The blocked votes of the quality classifier against cosines worked out one by one."""

import numpy as np

from starlift.llm import quality_knn as Q


def test_votes_equal_plain_cosines():
    rng = np.random.default_rng(3)
    features, rank, labelled = 12, 5, 3 * Q.NEIGHBOURS
    axes = np.linalg.qr(rng.normal(size=(features, rank)))[0].astype(np.float32)
    z = rng.normal(size=(labelled, rank)).astype(np.float32)
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    model = {"share": 0.25, "idf": rng.uniform(1, 3, features).astype(np.float32), "axes": axes, "z": z,
             "y": rng.integers(0, 2, labelled).astype(np.float32), "w": rng.uniform(0.5, 2, labelled).astype(np.float32)}
    x = rng.integers(0, 9, (Q.BLOCK + 7, features)).astype(np.float32)
    got = Q.vote(model, x)
    for i in [*range(0, 40), Q.BLOCK - 1, Q.BLOCK, Q.BLOCK + 6]:
        v = (np.log1p(x[i].astype(np.float64)) * model["idf"]) @ axes.astype(np.float64)
        sims = [max(0.0, min(1.0, float(v @ n) / np.linalg.norm(v))) for n in z.astype(np.float64)]
        near = sorted(range(labelled), key=lambda j: -sims[j])[:Q.NEIGHBOURS]
        weight = [sims[j] ** Q.SHARPNESS * float(model["w"][j]) for j in near]
        want = sum(w * float(model["y"][j]) for w, j in zip(weight, near)) / sum(weight)
        assert abs(got[i] - want) < 2e-4
    assert set(Q.vote({**model, "z": z[:0]}, x[:3])) == {0.25}
