import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tarn.llm import anchors, repeats, run_index


def brute(texts, match=400):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + match] for d in data for i in range(len(d) - match + 1))
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - match + 1):
            if seen[d[i : i + match]] > 1:
                gone[i : i + match] = True
        flags = gone[:-1] if len(d) else gone[:0]
        spans = int((gone[:-1] & ~np.concatenate([[False], gone[:-1]])[: len(d)]).sum()) if len(d) else 0
        rest = bytes(np.frombuffer(d, np.uint8)[~flags])
        yield len(d), int(flags.sum()), spans, hashlib.sha256(rest).hexdigest()


def prose(rng, n):
    return "".join(rng.choice("abcdé \n") for _ in range(n))


def corpus(seed):
    rng = random.Random(seed)
    passage, line, almost = prose(rng, 700), prose(rng, 140), prose(rng, 360)
    texts = [None, "", "short", "a" * 399, "a" * 400, "ab" * 900, "xyz" * 300 + "ab" * 300, prose(rng, 5000)]
    for _ in range(12):
        texts.append(prose(rng, rng.randrange(600)) + passage[rng.randrange(100) : 700 - rng.randrange(250)] + prose(rng, rng.randrange(600)))
        texts.append(prose(rng, rng.randrange(600)) + line + prose(rng, rng.randrange(600)))
        texts.append(prose(rng, rng.randrange(600)) + almost + prose(rng, rng.randrange(600)))
    whole = prose(rng, 2500)
    texts += [whole, whole, whole[:1200] + "!" + whole[1201:], whole[300:1900], whole[:1000] + prose(rng, 30) + whole[1000:]]
    texts += [texts[7][1000:1399] + "#", texts[7][2000:2401] + "#", passage, passage]
    return texts


def check(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r.doc_id: tuple(r)[1:] for r in repeats.repeat_counts(df).collect()}
    shorter = [(r[1], r[2]) for r in brute(texts, repeats.PASSAGE)]
    assert [found[i] for i in range(len(texts))] == [(*x, *y) for x, y in zip(brute(texts), shorter)]  # noqa: B905


def test_matches_brute_force(spark):
    check(spark, corpus(1))


def test_hot_groups_and_long_texts_are_split_without_loss(spark, monkeypatch):
    monkeypatch.setattr(repeats, "LARGEST_GROUP", 3)
    monkeypatch.setattr(repeats, "AT_ONCE", 777)
    texts = corpus(2)
    check(spark, texts)


def test_hot_anchors_that_repeat_within_a_segment_lose_no_tail(spark, monkeypatch):
    monkeypatch.setattr(repeats, "LARGEST_GROUP", 3)
    monkeypatch.setattr(repeats, "BUCKET", 1000)
    rng = random.Random(5)
    texts = []
    for width in (1, 7, 61, 61, 130):
        line, tail = prose(rng, width), prose(rng, 200)
        for k in range(8):
            run = line * ((500 + 97 * k) // width)
            texts.append(prose(rng, 300) + run + (tail if k % 2 else "") + prose(rng, 300))
    check(spark, texts)


def test_passages_of_fifty_words_go_and_other_text_stays(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghé") for _ in range(rng.choice((2, 3, 4, 5, 9))))
    words = lambda n: " ".join(word() for _ in range(n))
    rows, clean = [], {}
    for k in range(30):
        passage = words(rng.randrange(51, 61))
        for j in range(2):
            clean[2 * k + j] = (words(120), words(120))
            rows.append((2 * k + j, f"{clean[2 * k + j][0]} {passage} {clean[2 * k + j][1]}"))
    rows += [(100 + k, words(300)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in repeats.without_repeats(df, match=repeats.PASSAGE).collect()}
    assert all(found[i] == t for i, t in rows[60:])
    for i, (a, b) in clean.items():  # a few bytes beside a passage may happen to be equal as well
        assert len(a) + len(b) - 8 <= len(found[i]) <= len(a) + len(b) + 2
        assert found[i].startswith(a[:-8]) and found[i].endswith(b[8:])


@pytest.mark.parametrize("match", [40, 200, 400])
def test_segments_of_strings_one_after_the_other(match):
    rng = random.Random(match)
    parts = [prose(rng, n).encode()[:n] for n in (match, match + 1, 3 * match, 2 * match)] + [b"ab" * match, b"a" * match]
    starts = np.cumsum([0, *map(len, parts)])
    value, first, last, place, many = anchors.segments(np.frombuffer(b"".join(parts), np.uint8), starts, match)
    k, anchor = 0, anchors.anchor_length(match)
    for base, part in zip(starts, parts):  # noqa: B905
        h = anchors.anchor_hashes(np.frombuffer(part, np.uint8), anchor)
        least = [h[i : i + match - anchor + 1].min() for i in range(len(part) - match + 1)]
        i = 0
        while i < len(least):
            j = next((j for j in range(i, len(least)) if least[j] != least[i]), len(least))
            at = [x for x in range(i, j + match - anchor) if h[x] == least[i]]
            assert (value[k], first[k] - base, last[k] - base, place[k] - base, many[k]) == (least[i], i, j, at[0], len(at) > 1)
            i, k = j, k + 1
    assert k == len(value)


@pytest.mark.parametrize("seed", range(4))
def test_run_index(seed):
    rng = random.Random(seed)
    base = bytes(rng.choice(b"ab\0") for _ in range(60))
    parts = [base[i:j] for i, j in (sorted(rng.sample(range(60), 2)) for _ in range(8))] + [b"a" * 30]
    index, left = run_index.build(parts)
    text = [(k, p, i) for k, p in enumerate(parts) for i in range(len(p) + 1)]

    def common(x, y):
        a, b = x[1][x[2] :], y[1][y[2] :]
        return next((n for n in range(min(len(a), len(b))) if a[n] != b[n]), min(len(a), len(b)))

    expected = [max((common(x, y) for y in text if y is not x), default=0) for x in text]
    assert run_index.statistics(index).tolist() == expected
    assert index.lengths.sum() == len(text) and len(index.heads) == len(index.symbols)


def test_kept_columns_and_edge_cases(spark):
    whole = "é" + "abc " * 200
    rows = [(1, whole, "x", "t"), (None, whole, "y", None), (3, None, None, "v"), (3, "q" + "é" * 300 + whole[200:], "z", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, t string")
    out = repeats.without_repeats(df)
    assert out.schema == df.schema
    assert sorted((r.spans or "", r.text) for r in out.collect()) == [("", None), ("x", ""), ("y", ""), ("z", "q")]
    assert repeats.repeat_counts(df.limit(0)).count() == repeats.without_repeats(df.limit(0)).count() == 0
