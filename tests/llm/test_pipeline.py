import random
from collections import Counter

import pytest

import corpus_pipeline
from tarn.llm import exact_packing, mixing, quality_rules, repeats, simhash


def documents():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    shared = " ".join(word() for _ in range(90))
    for i in range(120):
        body = [" ".join(word() for _ in range(12)) + "." for _ in range(12)]
        if i % 10 == 3:
            body.insert(4, shared + ".")
        if i % 15 == 4:
            body = [" ".join(word() + "%%%" for _ in range(70))]
        yield i, "\n".join(body), "en", f"s{i % 3}", 0
    first = "\n".join(" ".join(word() for _ in range(12)) + "." for _ in range(12))
    yield from ((200 + k, first, "en", "s0", 0) for k in range(4))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_take_effect(spark, tmp_path):
    rows = list(documents())
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    docs, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
        assert all(r.n_chars == len(r.text) for r in seen[name])
    bad = {i for i in range(120) if i % 15 == 4}
    assert {r.doc_id for r in seen["quality_rules"]} == {r[0] for r in rows} - bad
    assert {r.doc_id for r in seen["simhash_dedup"]} == {r[0] for r in rows} - bad - {201, 202, 203}
    assert {r.doc_id for r in seen["repeat_removal"]} == {r.doc_id for r in seen["simhash_dedup"]}
    cut = {r.doc_id for r in seen["repeat_removal"]} & {i for i in range(120) if i % 10 == 3}
    longer = {r.doc_id: r.n_chars for r in seen["simhash_dedup"]}
    assert all((r.n_chars < longer[r.doc_id] - 390) == (r.doc_id in cut) for r in seen["repeat_removal"])
    copies = Counter(r.doc_id for r in seen["source_mixing"])
    frame = spark.createDataFrame(seen["repeat_removal"], SCHEMA)
    assert copies == Counter({r.doc_id: r.copies for r in mixing.mix_counts(frame).collect() if r.copies})
    packed = corpus_pipeline.packing_stage(spark, docs, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == copies
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_every_operator_is_used(spark, tmp_path, monkeypatch):
    """Each stage goes through its operator: with the operator gone, the stage fails."""
    df = spark.createDataFrame([(1, "a b c", "en", "s", 5)], SCHEMA)
    operators = {"quality_rules": (quality_rules, "cleaned"), "simhash_dedup": (simhash, "deduplicated"), "repeat_removal": (repeats, "without_repeats"), "source_mixing": (mixing, "mixed"), "exact_packing": (exact_packing, "packed")}
    assert [name for name, _ in corpus_pipeline.STAGES] == list(operators)
    for name, stage in corpus_pipeline.STAGES:
        with monkeypatch.context() as m:
            m.delattr(*operators[name])
            with pytest.raises(AttributeError):
                stage(spark, df, str(tmp_path))


def test_edge_cases_of_the_whole(spark, tmp_path):
    text = "\n".join(" ".join(f"word{i}x{j}" for j in range(10)) + "." for i in range(12))
    wide = SCHEMA + ", size int, shard string, _one int"
    rows = [(None, text, "en", None, 0, 1, "x", 2), (1, None, None, "s", 0, 1, "x", 2), (2, text, "en", "s", 0, None, None, None), (2, text, "en", "s", 0, None, None, None), (3, "", "en", "s", 0, 1, "x", 2)]
    for name, some in (("some", rows), ("none", [])):
        spark.createDataFrame(some, wide).write.parquet(str(tmp_path / name / "documents.parquet"))
        out = corpus_pipeline.run(spark, str(tmp_path / name)).collect()
        assert {r.doc_id for r in out} == ({2} if some else set())
