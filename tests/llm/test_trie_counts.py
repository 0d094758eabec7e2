import random

from tarn.llm import trie_counts
from tarn.llm.encoding import tokenizer_path
from tarn.llm.trie_counts import MARK, Trie, vocabulary


def brute(word, scores, byte_score):
    """(score, tokens) of the best segmentation, tried from the end."""
    best = [(0.0, 0)]
    text = MARK + word
    for end in range(1, len(text) + 1):
        size = len(text[end - 1].encode())
        options = [(best[end - 1][0] + size * byte_score, -best[end - 1][1] - size)]
        options += [(best[b][0] + scores[text[b:end]], -best[b][1] - 1) for b in range(end) if text[b:end] in scores]
        score, tokens = max(options)
        best.append((score, -tokens))
    return best[-1][1]


def test_counts_match_brute_force(spark, monkeypatch):
    scores, byte_score = vocabulary(tokenizer_path("piece_bpe_32k.model"))
    rng = random.Random(6)
    words = ["".join(rng.choice("theandingoü日\U0001f642") for _ in range(rng.randrange(1, 12))) for _ in range(300)] + ["the", "them", "theme", "x" * 200, "theandü" * 100]
    trie = Trie(scores, byte_score)
    assert [trie.count(w.encode()) for w in words] == [brute(w, scores, byte_score) for w in words]
    assert len(trie.forward) < sum(len(w) + 1 for w in words)  # prefixes are shared
    monkeypatch.setattr(trie_counts, "NODES", 50)
    monkeypatch.setattr(trie_counts, "AT_ONCE", 7)
    rows = [(i, " ".join(rng.choices(words, k=20)), 1) for i in range(40)] + [(100, None, 1), (101, "", 1), (None, "\x0bthe\n", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    found = {r.doc_id: (r.n_words, r.n_tokens) for r in trie_counts.token_counts(df).collect()}
    assert found == {i: (len((t or "").split()), sum(brute(w, scores, byte_score) for w in (t or "").split())) for i, t, _ in rows}
    assert trie_counts.token_counts(df.limit(0)).count() == 0


def test_very_long_words_take_no_nodes():
    trie = Trie(*vocabulary(tokenizer_path("piece_bpe_32k.model")))
    word = "unspaced🙂text" * 200
    assert trie.count(word.encode()) == brute(word, trie.scores, trie.byte_score)
    assert len(trie.forward) == 1


def test_long_words_are_forgotten(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(trie_counts, "WORD_BYTES", 50_000)
    path = tokenizer_path("piece_bpe_32k.model")
    long = [f"{k:06d}" + "x" * 294 for k in range(500)]
    texts = [" ".join(long), " ".join(long[:3] + ["the"]), " ".join(f"w{k}" for k in range(30_000))]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], names=["id", "text"])
    (out,) = trie_counts._counter(path, 1 << 20)(iter([batch]))
    trie = trie_counts._tries[path]
    assert all(len(w) <= trie_counts.LONG for w in trie.words) and sum(map(len, trie.words)) <= trie.held <= 50_000 + 400 * trie_counts.AT_ONCE
    fresh = Trie(*vocabulary(path))
    assert out.column(2).to_pylist() == [sum(fresh.count(w.encode()) for w in t.split()) for t in texts]
