import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction
from math import comb

import pytest

from tarn.llm import mixing


def water(sizes, total):
    """Targets by resharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, full, left = dict.fromkeys(names, 0.0), set(), float(total)
    while True:
        free = [s for s in names if s not in full]
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            full.add(s)


def table(seed, n, hot):
    rng = random.Random(seed)
    for i in range(n):
        source = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", "é", None])
        yield i, " ".join(["w"] * (rng.choice([0, 1, 5, 30]) if i % 50 else 900)), source


@pytest.mark.parametrize(("seed", "n", "hot"), [(1, 300, 0.3), (2, 3000, 0.95), (3, 3000, 0.0)])
def test_targets_and_taken(spark, seed, n, hot):
    rows = list(table(seed, n, hot))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = mixing.mix_counts(df).collect()
    again = mixing.mix_counts(df.repartition(5)).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again)) and len(found) == n
    size = {i: len(t.split()) for i, t, _ in rows}
    total = Counter()
    for i, _, s in rows:
        total[s] += size[i]
    target, taken = water(total, sum(total.values())), Counter()
    of = {i: s for i, _, s in rows}
    for r in found:
        s = of[r.doc_id]
        assert (r.size, r.source_size) == (size[r.doc_id], total[s]) and r.target == pytest.approx(target[s])
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 3
        taken[s] += r.taken
    for s in total:
        near = 450 if n < 1000 else 30  # half the longest document where a source has but a few
        assert abs(taken[s] - target[s]) <= max(near, 0.01 * target[s]), (s, taken[s], target[s])


def test_mixed_rows_and_shards(spark):
    rows = [(*r, 7) for r in table(4, 2000, 0.6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int")
    out = mixing.mixed(df, shards=5).collect()
    copies = {r.doc_id: r.copies for r in mixing.mix_counts(df).collect()}
    assert Counter(r.doc_id for r in out) == Counter({i: c for i, c in copies.items() if c})
    assert {r.shard for r in out} == {7} and {r.shard_ for r in out} == set(range(5))


def test_split_is_even_and_whole(spark):
    blocks = spark.createDataFrame([(s, 0, b) for s in range(3) for b in range(100 * s + 7)], "src int, pass int, block long")
    out = mixing.split(blocks, 7).collect()
    sizes = Counter(r.shard for r in out)
    assert len(out) == 321 and len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 1
    mine = defaultdict(int)
    for r in out:
        mine[r.src, r.shard] += 1
    assert all(15 <= mine[2, k] <= 45 for k in range(7))  # 207 of 321 blocks: about 30 of 46 a shard
    assert len({(r.src, r["pass"], r.block) for r in out}) == 321


def drawn(own, rest, need, chance):
    """A hypergeometric number: exact weights, from the likeliest number up and then down."""
    weight = {k: comb(own, k) * comb(rest, need - k) for k in range(max(0, need - rest), min(own, need) + 1)}
    mode = max(min(weight), min(max(weight), (need + 1) * (own + 1) // (own + rest + 2)))
    left = Fraction(chance) * sum(weight.values())
    for k in [*range(mode, max(weight) + 1), *range(mode - 1, min(weight) - 1, -1)]:
        left -= weight[k]
        if left < 0:
            return k


def test_the_tree_draws_hypergeometric_numbers(spark):
    counts = {1: 40, 2: 7, 3: 301, 4: 1, 5: 90}
    found = defaultdict(dict)
    for r in mixing.tree(spark.createDataFrame(list(counts.items()), "src int, n long"), 5).collect():
        found[r.shard][r.src] = r.n
    expected, nodes = {}, [(0, 5, counts)]
    while nodes:
        low, high, own = nodes.pop()
        if high - low == 1:
            expected[low] = own
            continue
        middle, total, left = (low + high) // 2, sum(own.values()), {}
        need, rest = total * (middle - low) // (high - low), total
        for src, n in sorted(own.items()):
            rest -= n
            left[src] = drawn(n, rest, need, int(hashlib.md5(f"tarn:{low}:{high}:{src}".encode()).hexdigest()[:13], 16) / 2**52)
            need -= left[src]
        nodes += [(low, middle, left), (middle, high, {s: n - left[s] for s, n in own.items()})]
    assert found == expected
    many = spark.createDataFrame([(i, 20) for i in range(200)], "src int, n long")
    spread = Counter(r.n for r in mixing.tree(many, 2).where("shard = 0").collect())
    assert abs(sum(k * n for k, n in spread.items()) / 200 - 10) < 1e-9 and 3.5 < sum((k - 10) ** 2 * n for k, n in spread.items()) / 200 < 6.8  # 20 / 4 by the law


def test_documents_go_where_the_tree_says(spark, monkeypatch):
    df = spark.createDataFrame(list(table(5, 500, 0.5)), "doc_id long, text string, source string")
    before = {r.doc_id: r.shards for r in mixing.mix_counts(df).collect()}
    monkeypatch.setattr(mixing, "tree", lambda counts, shards: counts.selectExpr("src", "0 as shard", "n"))
    after = {r.doc_id: r.shards for r in mixing.mix_counts(df).collect()}
    assert before != after and {x for v in after.values() for x in v.split(",")} <= {"", "0"}


def test_same_rows_as_the_sql(spark, tmp_path):
    import duckdb

    rows = [*table(6, 1500, 0.4), (None, "a b", None), (3, "w w", "a"), (3, "w w", "a")]
    for name, some in (("documents", rows), ("none", [])):
        df = spark.createDataFrame(some, "doc_id long, text string, source string")
        df.write.parquet(str(tmp_path / name))
        con = duckdb.connect()
        con.execute(f"create view documents as select * from read_parquet('{tmp_path}/{name}/*.parquet')")
        out = con.execute(mixing.ORACLE)
        names = [d[0] for d in out.description]
        found = mixing.mix_counts(df).select(*names).collect()
        assert sorted(map(tuple, found), key=str) == sorted(out.fetchall(), key=str)


def test_edge_cases(spark):
    schema = "doc_id long, text string, source string, size int"
    df = spark.createDataFrame([(1, "a b c", "x", 0)] * 3 + [(None, "a", None, 1), (2, None, "y", 2)], schema)
    out = mixing.mix_counts(df).collect()
    assert len(out) == 5 and len({r.taken for r in out if r.doc_id == 1}) == 1
    assert mixing.mixed(df).count() == sum(r.copies for r in out)
    assert mixing.mix_counts(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, None, "x", 0)], schema)
    assert [(r.target, r.taken) for r in mixing.mix_counts(empty).collect()] == [(0.0, 0)]
