import numpy as np

from tarn.llm import projection_dedup as pd_

SCHEMA = "vec_id long, embedding array<float>, label int, size int"


def brute(rows):
    good = {}
    for k, (i, v, label, _) in enumerate(rows):
        if v and label is not None and i is not None and not any(c is None or not np.isfinite(c) for c in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[k] = (label, len(v), x / np.sqrt(x @ x))
    links, root = dict.fromkeys(range(len(rows)), 0), list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in good:
        for b in good:
            if a < b and good[a][:2] == good[b][:2] and good[a][2] @ good[b][2] >= 0.98:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {rows[k][0]: (links[k], rows[find(k)][0]) for k in range(len(rows))}


def vectors(seed, n=150, size=16):
    rng = np.random.default_rng(seed)
    rows = []
    for label in (0, 1, 2):
        centres = rng.normal(size=(8, size))
        for _ in range(n):
            x = centres[rng.integers(8)] + rng.normal(scale=rng.choice([0.02, 0.1, 1.0]), size=size)
            rows.append((len(rows), x.astype(np.float32).tolist(), label, 1))
        rows += [(len(rows) + k, rows[-1][1], label, 1) for k in range(20)]
    return rows


def test_finds_all_links_of_small_labels(spark):
    rows = vectors(1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = {r.vec_id: (r.n_links, r.component_id) for r in pd_.near_vectors(df).collect()}
    assert found == brute(rows)


def test_small_blocks_keep_precision_and_count_pairs_once(spark, monkeypatch):
    monkeypatch.setattr(pd_, "BLOCK", 32)
    rows = vectors(2)
    true = brute(rows)
    found = {r.vec_id: r for r in pd_.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(r.n_links <= true[i][0] and r.component_id >= true[i][1] and r.kept == (i == r.component_id) for i, r in found.items())
    assert sum(r.n_links for r in found.values()) >= 0.9 * sum(n for n, _ in true.values())


def test_dense_group_of_many_blocks_has_all_links(spark, monkeypatch):
    monkeypatch.setattr(pd_, "BLOCK", 8)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(k, (centre + rng.normal(scale=0.08, size=16)).astype(np.float32).tolist(), k % 50 // 49, 1) for k in range(700)]
    true = brute(rows)
    found = {r.vec_id: (r.n_links, r.component_id) for r in pd_.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert found == true


def test_pairs_in_a_large_label_are_found_by_small_windows(spark, monkeypatch):
    """Windows of at most 32 of 3,000 neighbours find nine in ten of the pairs near the threshold, and nothing else."""
    monkeypatch.setattr(pd_, "BLOCK", 16)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(1500, 32))
    near = base + rng.normal(scale=0.19, size=base.shape)
    rows = [(k, x.astype(np.float32).tolist(), 7, 1) for k, x in enumerate(np.concatenate([base, near]))]
    true = brute(rows)
    pairs = sum(n for n, _ in true.values())
    assert 1000 < pairs < 3000  # so that the planted pairs lie on both sides of the threshold
    found = {r.vec_id: (r.n_links, r.component_id) for r in pd_.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert all(n <= true[i][0] and (n == 0 or (n, c) == true[i]) for i, (n, c) in found.items())
    assert sum(n for n, _ in found.values()) >= 0.9 * pairs


def test_group_at_the_threshold_that_is_denser_than_windows(spark, monkeypatch):
    """Windows hold few of a group's links, of which some pairs are and some aren't; the count inside it has all."""
    monkeypatch.setattr(pd_, "BLOCK", 16)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=32)
    rows = [(k, (centre + rng.normal(scale=0.15, size=32)).astype(np.float32).tolist(), 1, 1) for k in range(1200)]
    true = brute(rows)
    assert 0.2 < sum(n for n, _ in true.values()) / 1200**2 < 0.8
    found = {r.vec_id: (r.n_links, r.component_id) for r in pd_.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}
    assert found == true


def test_one_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0], 0, 1), (1, [0.0, 1.0], 0, 1), (2, [0.0, 1.01], 0, 1), (3, [1.0, 0.01], 0, 1), (3, [1.0, 0.01], 5, 1)]
    found = sorted((r.vec_id, r.n_links, r.component_id) for r in pd_.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    assert found == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 0, 3), (3, 1, 1)]


def test_edge_cases(spark):
    x, nan = [1.0, 2.0], float("nan")
    rows = [(1, x, 0, 1), (2, x, 1, 1), (3, x, None, 1), (4, None, 0, 1), (5, [], 0, 1), (6, [0.0, 0.0], 0, 1), (7, [1.0, None], 0, 1), (8, [nan, 1.0], 0, 1), (9, [1.0, 2.0, 0.0], 0, 1), (10, [2.0, 4.0], 0, 1)]
    df = spark.createDataFrame([*rows, (None, x, 0, 1)], SCHEMA)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pd_.near_vectors(df).collect()}
    assert found.pop(None) == (0, None, False)
    assert found == {i: (1, 1, i == 1) if i in (1, 10) else (0, i, True) for i in range(1, 11)}
    assert pd_.near_vectors(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, x, 0, 1)] * 2, SCHEMA)
    assert [r.n_links for r in pd_.near_vectors(twice).collect()] == [1, 1]
