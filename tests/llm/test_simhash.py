import random
import re

import numpy as np
import xxhash

from tarn.llm import simhash
from tarn.llm.components import components


def brute(rows):
    def mark(text):
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        grams = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fp = {i: mark(t) for i, t in rows}
    root = {i: i for i in fp}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in fp:
        for j in fp:
            if j < i and (fp[i] ^ fp[j]).bit_count() <= 3:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, f"{fp[i]:016x}", find(i)) for i in fp}


def texts():
    rng = random.Random(2)
    vocabulary = [rng.choice("abcdEFGHÉé") + rng.choice("xyzäß") + str(i) for i in range(300)]
    yield from [None, "", " \t", "One", "one", "one two", "One\ntwo", "a b c"]
    for _ in range(30):
        words = rng.choices(vocabulary, k=rng.choice([4, 40, 400]))
        yield " ".join(words)
        for _ in range(3):
            w = list(words)
            w[rng.randrange(len(w))] = "other"
            yield " ".join(w)
        yield " ".join(words).upper()


def test_matches_brute_force(spark):
    rows = list(enumerate(texts()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in simhash.near_duplicates(df).collect()} == brute(rows)
    kept = {r.doc_id for r in simhash.deduplicated(df.unionAll(df)).collect()}
    assert kept == {c for _, _, c in brute(rows)}


def test_hot_groups_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(simhash, "LARGEST_GROUP", 4)
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    fps = {centre} | {centre ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 9), replace=False)) for _ in range(400)}
    rows = [(simhash._signed(f), i) for i, f in enumerate(sorted(fps))]
    classes = spark.createDataFrame(rows, "fp long, rep long")
    found = {r.id: r.root for r in components(simhash.links(classes)).collect()}
    near = np.bitwise_count(np.array([f for f, _ in rows]).view(np.uint64)[:, None] ^ np.array([f for f, _ in rows]).view(np.uint64)[None, :]) <= 3
    label = np.arange(len(rows))
    for _ in range(len(rows)):
        label = np.where(near, label[None, :], len(rows)).min(1)
    assert [found.get(i, i) for i in range(len(rows))] == label.tolist()


def test_masks_hold_every_close_pair():
    rng = random.Random(4)
    masks = simhash.first_masks()
    for _ in range(500):
        flips = sum(1 << b for b in rng.sample(range(64), 3))
        hit = [m for m in masks if not m % (1 << 64) & flips]
        assert hit and all(any(not f % (1 << 64) & flips for f in simhash.finer_masks(m)) for m in hit)


def test_edge_cases(spark):
    df = spark.createDataFrame([(5, "a b c d", 1), (5, "a b c d", 2), (None, "a b c d", 3), (None, "q", 4), (7, None, 5)], "doc_id long, text string, fp int")
    found = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str)
    assert found == sorted([(5, 5), (5, 5), (None, 5), (None, None), (7, 7)], key=str)
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.deduplicated(df).columns == df.columns


def test_one_row_of_each_component_stays(spark):
    text = " ".join(f"word{i}" for i in range(400))
    near = text.replace("word7 ", "other ")
    rows = [(None, text, "a", 1), (None, near, "b", 1), (9, near, "c", 1), (9, text, "d", 1), (9, text, "d", 1), (None, "x y z", "e", 1), (None, "x y z", "e", 1), (3, None, "f", 1), (4, "", "f", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, _one int").repartition(4)
    assert simhash.near_duplicates(df).where("fingerprint <> '0'").count() == len(rows)
    found, again = (sorted((tuple(r) for r in simhash.deduplicated(d).collect()), key=str) for d in (df, df.repartition(2)))
    assert found == again and len(found) == 3 and {r[0] for r in found} == {9, None, 3}
    assert simhash.deduplicated(df.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(500, 500), (7, None)]
    found = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}}
