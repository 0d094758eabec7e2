import random
import re
from collections import Counter

from tarn.llm import quality_rules as qr

WORDS = re.compile(r"[^\x20\x09-\x0d]+")


def brute(text):
    w = WORDS.findall(text or "")
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(1)
    yield from [None, "", " \n\t", "\x0b\x0ca b\x0bc\r\t ", "  a  b", "a b c a b c", "x " * 300, "one two\none two\n\n \n#$ | <>"]
    for size in (5, 60, 500):
        for alphabet in ("abc", "abcdefghijklmnop"):
            yield from ("\n".join(" ".join(rng.choice(alphabet) + rng.choice(alphabet) for _ in range(size)) for _ in range(rng.choice([1, 3]))) for _ in range(8))
    yield "a b c d e\n" * 3000


def test_counts_match_brute_force(spark):
    rows = list(enumerate(texts()))
    found = {r.doc_id: r for r in qr.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        r = found[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), text
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


PROSE = " ".join(f"word{i} and thing{i} go on." for i in range(30))


def test_lines_decide(spark):
    nav = "\n".join(f"home | shop{i} | about{i} | contact{i} | more{i}" for i in range(30))
    rows = [
        (1, PROSE), (2, nav), (3, PROSE + "\nAll rights reserved."), (4, PROSE + "\n" + nav),
        (5, "!! ".join(PROSE.upper().split())), (6, " ".join(w + "%%%" for w in PROSE.split())),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in qr.quality(df).collect()}
    assert kept == {1: True, 2: False, 3: True, 4: False, 5: False, 6: False}
    assert {r.doc_id: r.text for r in qr.cleaned(df).collect()} == {1: PROSE, 3: PROSE}


def test_clashing_columns_repeats_and_empty_tables(spark):
    df = spark.createDataFrame([(1, PROSE, "x", 7, 8)] * 2 + [(None, None, None, None, None)], "doc_id long, text string, n_words string, _v int, kept int")
    assert [r.kept for r in qr.quality(df).collect()] == [True, True, False]
    out = qr.cleaned(df)
    assert out.columns == df.columns and [tuple(r) for r in out.collect()] == [(1, PROSE, "x", 7, 8)] * 2
    assert qr.quality(df.limit(0)).count() == qr.cleaned(df.limit(0)).count() == 0
