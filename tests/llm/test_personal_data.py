import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tarn.llm import crf
from tarn.llm import personal_data as p

SCHEMA = "doc_id long, text string, spans string, n_ip int"


def plain(text):
    """The four patterns as they are written in the contract."""
    found = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if k % 2 == 0 else 2 * x if x < 5 else 2 * x - 9 for k, x in enumerate(reversed(d))) % 10 == 0:
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
    return sorted(found)


def test_patterns_find_what_the_contract_says():
    rng = random.Random(1)
    cards = ["4111111111111111", "4111 1111-1111 1111", "4111111111111112", "0" * 19, "0" * 20, "10.0.0.255", "10.0.0.256", "1.2.3.4.5.6.7.8.9", "+1 (521) 555-6210", "a.b+c@d-e.f.g", "a@b", "@", "é@b.c", "\U0001f642", "٣", "255.255.255.0001"]
    for _ in range(20_000):
        text = "".join(rng.choice(["a", "B", "7", "12", "@", ".", "-", "+", " ", "(", ")", "%", "\n", "x@y.z"] + cards) for _ in range(rng.randrange(1, 14)))
        assert p.base_spans(text) == plain(text), text
    for hostile in ("1" * 300_000, "a" * 300_000 + "@", "@" * 300_000, "+1" + "(" * 300_000, "1." * 200_000, "a-" * 200_000 + "@b" + "-" * 200_000, "+1(" * 100_000):
        p.base_spans(hostile)  # linear, so it ends


def test_viterbi_and_training_match_enumeration():
    rng = np.random.default_rng(2)
    m = crf.Model(["O", "A", "B"], {f"f{i}": i for i in range(6)}, np.vstack([rng.normal(size=(6, 3)), np.zeros((1, 3))]), rng.normal(size=(3, 3)), rng.normal(size=3), rng.normal(size=3))
    sequences = [[[f"f{i}" for i in rng.integers(0, 7, 2)] for _ in range(n)] for n in (5, 1, 4, 3)]

    def score(seq, path):
        s = sum(m.weights[m.features.get(f, 6)][y] for t, y in zip(seq, path) for f in t)
        return s + m.first[path[0]] + m.last[path[-1]] + sum(m.moves[a, b] for a, b in zip(path, path[1:]))

    paths = [list(itertools.product(range(3), repeat=len(s))) for s in sequences]
    best = [[m.labels[y] for y in max(own, key=lambda x: score(s, x))] for s, own in zip(sequences, paths)]
    assert crf.decoded(sequences, m) == best == crf.decoded(sequences, m, at_once=1)
    falling = sorted(sequences, key=len, reverse=True)
    ids, lengths = crf._indexed(falling, m.features)
    chances, moves = crf._expected(m.weights[ids].sum(2), lengths, m)
    want, wanted_moves = np.zeros_like(chances), np.zeros((3, 3))
    for k, s in enumerate(falling):
        own = list(itertools.product(range(3), repeat=len(s)))
        weight = np.exp([score(s, x) for x in own])
        for x, w in zip(own, weight / weight.sum()):
            for t, y in enumerate(x):
                want[k, t, y] += w
            for a, b in zip(x, x[1:]):
                wanted_moves[a, b] += w
    inside = np.arange(ids.shape[1]) < lengths[:, None]
    assert np.allclose(chances[inside], want[inside]) and np.allclose(moves, wanted_moves)


def test_held_out_sentences():
    texts = [p.parsed(r) for r in p.labelled_table(seed=1001)]
    found = p.added_spans([t for t, _ in texts], p.model_of())
    hits = sum(len(set(a) & set(b)) for a, (_, b) in zip(found, texts))
    assert hits / sum(map(len, found)) > 0.97 and hits / sum(len(b) for _, b in texts) > 0.97
    clean = ["Licensed under CC BY-NC 4.0.", 'token = "681c09b8e90e7e8c9575180f595f646cf2969054" and', "on page 12 of 345, 1999-12-31 at 10:30", "version 3.10.2 costs $1,299.00", "at the dot of noon"]
    assert p.added_spans(clean, p.model_of()) == [[]] * len(clean)


def test_rows(spark):
    texts = {
        1: "mail a.b@c.de or jane (at) host.org now", 2: "call (521) 555-6210 or +1 (521) 555-6210 today", 3: None, 4: "", 5: "nothing here at all", 6: "é\U0001f642 card 9807915762804490 and 4111 1111 1111 1111.",
        7: "word " * 50_000 + "10.0.0.1 " + "x" * 2000 + "@" + "y" * 2000 + "7" * 2000, 8: "1 2 3 " * 20_000,
    }
    rows = [(i, t, "x", 1) for i, t in texts.items()] + [(1, texts[1], "x", 1), (None, texts[1], None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = p.found(df)
    assert [t for _, t in out.dtypes] == ["bigint"] * 5 + ["string"] * 2
    got = out.collect()
    assert len(got) == len(rows) and len({tuple(r)[1:] for r in got if r.doc_id in (1, None)}) == 1
    by = {r.doc_id: r for r in got}
    for i, text in texts.items():
        base = plain(text or "")
        assert [by[i][f"n_{k}"] for k in p.KINDS] == [sum(s[0] == n for s in base) for n in range(4)]
        joined = ",".join(f"{p.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert by[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) - {""} <= set(by[i].spans.split(","))
    assert by[1].spans == "email:5:13,email:17:35"
    assert by[2].spans == "phone:5:19,phone:23:40"
    assert by[6].spans == "card:8:24,card:29:48"
    assert by[3].spans == by[4].spans == by[5].spans == by[8].spans == ""
    assert p.found(df.limit(0)).count() == 0
    unique = df.where("doc_id is not null").dropDuplicates(["doc_id"])
    clean = {r.doc_id: r.text for r in p.masked(unique, out.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()}
    assert clean[1] == "mail [email] or [email] now" and clean[3] is None and clean[5] == texts[5] and clean[6] == "é\U0001f642 card [card] and [card]."


def test_own_labelled_table(spark):
    table = spark.createDataFrame([(f"see {{card:{n} {n}}} there",) for n in range(100, 160)] + [(f"see {n} there",) for n in range(100, 160)] + [(None,)], "row string")
    df = spark.createDataFrame([(1, "see 123 4567890 there")], "doc_id long, text string")
    assert p.found(df, table).first().spans == ""  # too few digits for a card


@pytest.mark.parametrize("base, added, want", [([(0, 5, 9)], [(3, 8, 12), (1, 9, 11), (2, 0, 5)], [(0, 5, 9), (1, 9, 11), (2, 0, 5)]), ([], [], []), ([(0, 0, 2), (1, 0, 50), (0, 3, 4)], [(3, 40, 60), (3, 50, 60)], [(0, 0, 2), (0, 3, 4), (1, 0, 50), (3, 50, 60)])])
def test_union_keeps_base_spans(base, added, want):
    assert p.united(base, added) == want
