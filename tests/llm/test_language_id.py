import math
import random
import zlib

import numpy as np

from tarn.llm import language_id

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["str", "eng", "ich", "ung"], "cc": ["é", "oux", "ai", "tré"]}


def text(rng, lang, n=80):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def rows(n=600):
    rng = random.Random(5)
    for i in range(n):
        lang = rng.choice(["aa", "bb", "cc"])
        yield i, text(rng, lang, rng.choice([20, 200])), lang, "x"


SCHEMA = "doc_id long, text string, lang string, score string"


def test_held_out_accuracy_and_reruns(spark):
    df = spark.createDataFrame(list(rows()), SCHEMA)
    found = {r.doc_id: r for r in language_id.languages(df.repartition(3)).collect()}
    again = {r.doc_id: r for r in language_id.languages(df.repartition(2)).collect()}
    assert found == again
    held = [(i, lang) for i, _, lang, _ in rows() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in found)
    assert np.mean([found[i].lang_pred == lang for i, lang in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_defined_cases(spark):
    odd = [(1000, None, "aa", "x"), (1001, "", "aa", "x"), (1002, "12 !? _", "bb", "x"), (1003, "½ ² Ⅷ ①", "bb", "x"), (None, "ka lo mi", None, "x")]
    df = spark.createDataFrame([*rows(200), *odd], SCHEMA)
    found = {r.doc_id: r for r in language_id.languages(df).collect()}
    assert all((found[i].lang_pred, found[i].score, found[i].accepted) == ("und", 0.0, False) for i in (1000, 1001, 1002, 1003))
    assert found[None].lang_pred in SYLLABLES and not found[None].held_out
    blank = spark.createDataFrame([(1, "ka lo", None, "x")], SCHEMA)
    assert [r.lang_pred for r in language_id.languages(blank).collect()] == ["und"]
    assert language_id.languages(df.limit(0)).count() == 0


def test_hot_ids_and_copies_dont_fill_the_sample(spark):
    """An id with two thirds of the rows, and a row repeated, bring no more rows to the driver than others do."""
    rng = random.Random(6)
    hot = [(1, text(rng, "aa", 20), "aa", "x") for _ in range(1000)]
    copies = [(2, "lo mi tu ka", "aa", "x")] * 1000
    df = spark.createDataFrame([*hot, *copies, *rows(600)], SCHEMA)
    found = language_id.sampled(df, per_language=50).collect()
    assert len(found) == len({(r.lang, r.text) for r in found})
    sizes = {lang: sum(r.lang == lang for r in found) for lang in SYLLABLES}
    assert all(0 < n <= 90 for n in sizes.values()), sizes
    assert zlib.crc32(b"1") % 5 and zlib.crc32(b"2") % 5  # both may be learned from


def test_predictions_match_brute_force(spark):
    df = spark.createDataFrame(list(rows(300)), SCHEMA)
    model = language_id.fitted(df)

    def plain(text):
        data, total = f" {text.lower()} ".encode(), [0.0] * len(model.languages)
        grams = 0
        for n in (2, 3, 4):
            for i in range(len(data) - n + 1):
                h = data[i] * 0x9E3779B1 % 2**32
                for b in data[i + 1 : i + n]:
                    h = ((h ^ h >> 15) * 0x85EBCA6B + b) % 2**32
                row = model.weights[(h * 0xC2B2AE35 % 2**32) >> 32 - 13]
                total = [t + w for t, w in zip(total, row)]  # noqa: B905
                grams += 1
        z = [(t / grams + b) / model.temperature for t, b in zip(total, model.bias)]  # noqa: B905
        e = [math.exp(v - max(z)) for v in z]
        return model.languages[z.index(max(z))], max(e) / sum(e)

    found = {r.doc_id: r for r in language_id.predicted(df, model).where("doc_id < 40").collect()}
    for i, text, _, _ in rows(40):
        lang, score = plain(text)
        assert found[i].lang_pred == lang and abs(found[i].score - score) < 1e-9
        assert found[i].accepted == (found[i].score >= model.threshold)


def test_long_texts_count_whole(monkeypatch):
    data = "abc é " * 500
    whole = language_id.counts(data)
    monkeypatch.setattr(language_id, "SLICE", 97)
    assert (language_id.counts(data) == whole).all() and whole.sum() == 3 * len(f" {data} ".encode()) - 6
