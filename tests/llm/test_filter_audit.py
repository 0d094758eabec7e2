import itertools
import re
from collections import Counter, defaultdict

import pytest

from tarn.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(60))
DOCS = [
    (1, LONG, "a"), (2, LONG, "a"), (3, "few words", "a"), (4, None, "a"), (5, "", None), (6, "x " * 70, "b"), (7, LONG.upper(), "b"),
    (8, LONG + " #", "b"), (None, LONG, "b"), (None, "only # here", ""), (9, "same id", "c"), (9, "same id", "c"), (10, "same id", "c"), (11, "x y " * 55 + "É", "c"),
    (12, ("deep\x0bw " * 3000) + LONG, "c"), (13, "FEW # WORDS", None), (14, "FEW # WORDS", "c"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, None, None), (3, 0, 1), (13, 1, 1), (None, 1, 1), (999, 1, 1), (9, None, 1)]


def brute(docs, labels):
    marks = defaultdict(lambda: [False, False])
    for i, q, t in labels:
        marks[i][0] |= q == 1
        marks[i][1] |= t == 1
    found, removed_by = {}, Counter()
    rows = []
    for i, text, source in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": copy}
        rows.append((source or "", {k for k, v in fails.items() if v}, *(marks[i] if i is not None else (False, False))))
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {r[0] for r in rows}:
            alive = [(f, g, t, True) for p, f, g, t in rows if p == part]
            for step, x in enumerate(order, 1):
                gone = [r for r in alive if r[3] and x in r[0]]
                redundant = sum(not r[3] and x in r[0] for r in alive)
                alive = [(f, g, t, a and x not in f) for f, g, t, a in alive]
                found[part, order, step] = [sum(r[3] for r in alive), len(gone), redundant, sum(r[0] == {x} for r in alive), sum(r[1] for r in gone), sum(r[2] for r in gone)]
                removed_by[part, x] += len(gone)
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


@pytest.mark.parametrize("parts", [1, 5])
def test_matches_brute_force(spark, parts):
    docs = spark.createDataFrame([(*d, i % 3 == 0, "z") for i, d in enumerate(DOCS)], "doc_id long, text string, source string, mask boolean, part string").repartition(parts)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(docs, labels)
    assert [t for _, t in out.dtypes] == ["string", "string", "int", *["bigint"] * 7]
    rows = out.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(rows) == len(found) == 600 * 4
    assert found == brute(DOCS, LABELS)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, source string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "x", "s")], docs.schema)
    assert filter_audit.audit(one, labels).where("removed = 1 and step = 1 and filter_order like 'A%'").count() == 24
