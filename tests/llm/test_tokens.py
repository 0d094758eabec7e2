import bisect
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tarn.llm import encoding, exact_packing, token_files
from tarn.llm.encoding import Encoder, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


def texts():
    rng = random.Random(1)
    yield from [None, "", " ", "  a  b \n\n c", "it's we'll\tgo \r\n x", "é e\u0301 ÀÉ ß ſ İ", "a\u00a0 b\u2003 \u3000c \u2028d", "x\x1cy \x1f z\x85", "<|endoftext|> <|startoftext|>"]
    yield from ["\u65e5\u672c\u8a9e \u30c6\u30ad\u30b9\u30c8 12345 ½ \u0663", "\U0001f642\U0001f642 \U0001f469\u200d\U0001f467 a", "\u0301a \u0301 b", "word " * 5000]
    alphabet = "ab'sé\u00a01\n\t ,!\u038fñ\u0301\u2003"
    for _ in range(200):
        yield "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))


def whole(name):
    t = tokenizers.Tokenizer.from_file(tokenizer_path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("name", "keeps_spaces"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunks_give_the_ids_of_whole_texts(name, keeps_spaces, monkeypatch):
    monkeypatch.setattr(encoding, "AT_ONCE", 200)
    monkeypatch.setattr(encoding, "REMEMBERED", 50)
    expected, found = [whole(name)(t) for t in texts()], []
    for ids, counts in Encoder(tokenizer_path(name), keeps_spaces)(list(texts())):
        found += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
    assert found == expected


def test_unusual_texts_are_forgotten():
    rng = random.Random(3)
    texts = [f"{rng.random()}\u00a0" + " ".join(f"{rng.randrange(10**9)}" for _ in range(400)) for _ in range(300)]
    e = Encoder(tokenizer_path("byte_bpe_50k.json"), True)
    n = sum(len(ids) for ids, _ in e(texts))
    assert n > 300_000 and len(e.known) == 0 and e.n_ids == 0 and len(e.ids) < 1 << 22
    limit = Encoder(tokenizer_path("byte_bpe_50k.json"), True, 1 << 20)
    most = 0
    for _ in limit([" ".join(f"w{rng.randrange(10**9)}" for _ in range(2000)) for _ in range(200)] * 2):
        most = max(most, limit.held)
    assert most < (1 << 20) + 400 * encoding.AT_ONCE  # one stretch of texts beyond the limit at most
    assert limit.held >= sum(map(len, limit.known)) + 4 * limit.n_ids


def test_token_files_round_trip(spark):
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    encode, start = whole("byte_bpe_50k.json"), 0
    found = {r.doc_id: r for r in token_files.round_trip(df).collect()}
    for i, t in sorted(rows):
        ids = np.array([*encode(t), 2], "<u4")
        assert tuple(found[i]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    odd = spark.createDataFrame([(None, "a b", 1), (3, None, 2), (3, None, 2)], "doc_id long, text string, start int")
    assert sorted((r.doc_id or -1, r.n_tokens) for r in token_files.round_trip(odd).collect()) == [(-1, 3), (3, 1), (3, 1)]
    assert token_files.round_trip(odd.limit(0)).count() == 0


def test_packing(spark):
    rows = [(i, t) for i, t in enumerate([*texts(), *[f"{'a b ' * (k % 700)}" for k in range(900)]])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = exact_packing.packed(df).collect()
    encode, docs, sequences = whole("word_bpe_49k.json"), defaultdict(list), defaultdict(list)
    for r in out:
        docs[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, t in rows:
        ids = np.array([*encode(t), 0], "<u4")
        own = sorted(docs[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in own] == [(k, 2048 * k, min(2048, len(ids) - 2048 * k)) for k in range(-(-len(ids) // 2048))]
        assert all(r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in own)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist() and sum(r.length for r in own) <= 2048
    total = sum(r.length for r in out)
    assert len(sequences) <= 1.01 * total / 2048 + 1
    joined = {r.sequence_id: r.ids for r in exact_packing.sequences(df).collect()}
    assert all(zlib.crc32(np.array(joined[s][r.offset : r.offset + r.length], "<u4").tobytes()) == r.ids_crc32 for s, own in sequences.items() for r in own)


def test_packing_edge_cases(spark):
    df = spark.createDataFrame([(None, "a", 1), (3, None, 2), (3, None, 2)], "doc_id long, text string, length int")
    out = exact_packing.packed(df).collect()
    assert sorted(r.length for r in out) == [1, 1, 2] and len({r.sequence_id for r in out}) == 1
    assert exact_packing.packed(df.limit(0)).count() == 0


def best_fit_decreasing(lengths, room=2048):
    gaps = []
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, x)
        gap = gaps.pop(at) if at < len(gaps) else room
        if gap > x:
            bisect.insort(gaps, gap - x)
        elif gap == x:
            bisect.insort(gaps, 0)
    return len(gaps)


def mixes():
    rng = random.Random(3)
    yield [x for x in range(300, 1501, 7) for _ in range(20)]
    yield [rng.randrange(1, 2049) for _ in range(5000)]
    yield [min(2048, int(rng.lognormvariate(5.5, 1.1)) + 1) for _ in range(5000)]
    yield [rng.choice((1025, 513, 257, 129, 65, 700, 701)) for _ in range(5000)]
    yield [rng.randrange(600, 760) for _ in range(3000)]
    yield [2048, 1, 1, 2047]


@pytest.mark.parametrize("mix", list(mixes()))
def test_never_more_sequences_than_best_fit(mix):
    patterns = exact_packing.plan(Counter(mix))
    made = sum(n for _, n in patterns)
    assert -(-sum(mix) // 2048) <= made <= best_fit_decreasing(mix)


def test_every_exact_fill_is_found():
    rng = random.Random(6)
    for _ in range(300):
        count = np.zeros(61, np.int64)
        for x in rng.sample(range(1, 60), rng.randrange(1, 12)):
            count[x] = rng.choice((1, 1, 2, 3))
        gap, own = rng.randrange(1, 60), [x for x in range(61) for _ in range(count[x])]
        for most in (1, 2, 3):
            able = any(sum(c) == gap for k in range(1, most + 1) for c in itertools.combinations(own, k))
            found = exact_packing.fillers(count, gap, most)
            assert (found is not None) == able
            assert found is None or sum(found) == gap and len(found) <= most and all(count[x] >= found.count(x) for x in found)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = random.Random(seed)
    counts = {rng.randrange(1, 2049): rng.choice([1, 3, 50, 10**9]) for _ in range(rng.choice([1, 5, 300, 2000]))}
    used, n = Counter(), 0
    for pattern, times in exact_packing.plan(counts):
        assert sum(pattern) <= 2048 and times > 0
        n += times
        for x in pattern:
            used[x] += times
    assert used == Counter(counts) and n * 2048 >= sum(k * v for k, v in counts.items())
    table = exact_packing.places(exact_packing.plan(counts))
    assert len(table) < 40_000
