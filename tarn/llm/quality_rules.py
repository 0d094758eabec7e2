"""Quality rules, line first: bad lines go, then documents that lost too much.

Only built-in SQL functions are used; the work needs no shuffle, so neither
hot sources nor groups of copies matter, and a very long text stays inside
one row's arrays.

Defined cases: a null text has no words and no lines, fails the base rules
and is not kept; so does an empty text or one of white space. Repeated rows
are judged one by one and alike. An empty table gives an empty result.
Columns other than the two that are named are never read, whatever their
names are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, fresh

# Phrases of page furniture, matched in lower case in lines of at most 120 characters.
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript",
    "lorem ipsum", "log in", "powered by", "privacy policy", "read more",
    "share this", "sign in", "sign up", "skip to content", "subscribe to",
    "terms of service", "terms of use", "use cookies",
)

#: A document that loses more than this percentage of its line characters is rejected.
MAX_LOST_PERCENT = 40


def bad_line(line: Column) -> Column:
    """Whether a line fails a rule.

    Punctuation: one marked symbol for every four words or more (two at
    least), or three exclamation marks in a line without a lower-case letter
    or with one for every two words. Navigation: three separators (pipe,
    guillemet, bullet), or at most three words without any mark of a
    sentence. Boilerplate: a phrase of page furniture in a short line. Blank
    lines pass; they hold no text.
    """
    words = F.regexp_count(line, F.lit(WORD))
    symbols = F.regexp_count(line, F.lit(r"[#*$%&|<>~^_=\\]+"))
    shouts = F.length(line) - F.length(F.replace(line, F.lit("!"), F.lit("")))
    pattern = "(?i)" + "|".join(BOILERPLATE)
    marked = ((symbols >= 2) & (symbols * 4 >= words)) | ((shouts >= 3) & (~line.rlike(r"\p{Ll}") | (shouts * 2 >= words))) | line.rlike(r"(?s)[|»•·].*[|»•·].*[|»•·]")
    return (
        (line.rlike(r"[#*$%&|<>~^_=\\!»•·]") & marked)
        | ((F.length(line) <= 60) & ~line.rlike(r"[.!?…。！？:;,\"'”»)]|[\p{L}\p{N}]{12}") & (words > 0) & (words <= 3))
        | ((F.length(line) <= 120) & line.rlike(pattern))
    )


def judged(df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with a struct column ``to``: clean_text, n_lines, n_lines_removed, line_chars, kept_chars."""
    lines, good = fresh(df, "_lines"), fresh(df, "_good")
    chars = lambda a: F.length(F.array_join(a, ""))
    return (
        df.withColumn(lines, F.split(F.coalesce(F.col(text), F.lit("")), "\n"))
        .withColumn(good, F.filter(lines, lambda x: ~bad_line(x)))
        .withColumn(
            to,
            F.struct(
                F.array_join(good, "\n").alias("clean_text"),
                F.size(lines).alias("n_lines"),
                (F.size(lines) - F.size(good)).alias("n_lines_removed"),
                chars(F.col(lines)).alias("line_chars"),
                chars(F.col(good)).alias("kept_chars"),
            ),
        )
        .drop(lines, good)
    )


def lost_little(verdict: str) -> Column:
    lost = F.col(f"{verdict}.line_chars") - F.col(f"{verdict}.kept_chars")
    return lost * 100 <= F.col(f"{verdict}.line_chars") * MAX_LOST_PERCENT


def _places_by_sort(hashes: str) -> str:
    """SQL for the places, in order, of all elements of an array that occur twice or more."""
    pairs = f"sort_array(transform({hashes}, (h, p) -> struct(h, p)))"
    near = "i -> get(s, i).h = get(s, i - 1).h or get(s, i).h = get(s, i + 1).h"
    equal = f"filter(sequence(0, size(s) - 1), {near})"
    return f"sort_array(flatten(transform(array({pairs}), s -> transform({equal}, i -> get(s, i).p))))"


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the base counts of each text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Three-word windows are sorted by their 64-bit hash; equal neighbours are
    repeats, and the places of all repeats, in order, cover min(3, distance
    to the next) words each. Places are looked up if few windows repeat and
    come from a sort otherwise: n log n in the length of a text.
    """
    words, lines, hashes, twice, places = (fresh(df, f"_{x}") for x in ("words", "wordy", "hashes", "twice", "places"))
    return (
        df.withColumn(words, F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r")))
        .withColumn(words, F.when(F.col(words) == "", F.expr("cast(array() as array<string>)")).otherwise(F.split(words, r"[\x20\x09-\x0D]+")))
        .withColumn(lines, F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: x.rlike(WORD)))
        .withColumn(
            hashes,
            F.when(
                F.size(words) >= 3,
                F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))),
            ).otherwise(F.expr("cast(array() as array<bigint>)")),
        )
        .withColumn(twice, F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), F.sort_array(hashes)))
        .withColumn(twice, F.expr(f"array_distinct(transform(filter(sequence(1, size({twice})), i -> get({twice}, i) = get({twice}, i - 1)), i -> get({twice}, i)))"))
        .withColumn(places, F.expr(f"""
            case when {twice} is null then cast(array() as array<int>)
                 when size({twice}) <= 64 then filter(sequence(0, size({hashes}) - 1), i -> array_contains({twice}, get({hashes}, i)))
                 else {_places_by_sort(hashes)} end"""))
        .withColumns({
            "n_words": F.size(words).cast("long"),
            "word_chars": F.length(F.array_join(words, "")).cast("long"),
            "n_symbols": F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>]")), F.lit(0)).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": F.expr(f"""
                aggregate(sequence(0, size({places})), 0L,
                          (n, i) -> n + case when i >= size({places}) then 0
                                             else least(3, coalesce(get({places}, i + 1) - get({places}, i), 3)) end)"""),
        })
        .drop(words, lines, hashes, twice, places)
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def barred(condition: Column) -> Column:
    """``condition`` in a form that filters aren't pushed through.

    Spark would move a filter below the projections and write the arrays of a
    text into it where they are used, to be made anew for every element.
    """
    return condition & (F.monotonically_increasing_id() >= 0)


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: its id, base counts, line counts, base_failed and kept."""
    rows = judged(base_counts(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text"), "text", "_v")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"),
        barred(~base_failed() & lost_little("_v")).alias("kept"),
        F.col("_v.n_lines").cast("long").alias("n_lines"),
        F.col("_v.n_lines_removed").cast("long").alias("n_lines_removed"),
    )


def cleaned(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with their columns; failed lines are gone from the text."""
    verdict, text = fresh(df, "_verdict"), fresh(df, "_text")
    columns = df.columns
    rows = df.withColumn(text, F.struct(*df.columns))  # the counts' names may clash with columns of df
    rows = judged(base_counts(rows.select(text, F.col(f"{text}.{text_col}").alias("_t")), "_t"), "_t", verdict)
    keep = fresh(rows, "_keep")
    rows = rows.withColumn(keep, barred(~base_failed() & lost_little(verdict))).where(keep)
    return rows.select(*[F.col(f"{verdict}.clean_text").alias(c) if c == text_col else F.col(f"{text}.`{c}`").alias(c) for c in columns])


_WORD = r"[^\x20\x09-\x0D]+"
_LINE_WORDS = f"len(regexp_extract_all(x, '{_WORD}'))"
_SYMBOLS = r"len(regexp_extract_all(x, '[#*$%&|<>~^_=\\]+'))"
_SHOUTS = "(length(x) - length(replace(x, '!', '')))"
_BAD = rf"""
    (regexp_matches(x, '[#*$%&|<>~^_=\\!»•·]') and (({_SYMBOLS} >= 2 and {_SYMBOLS} * 4 >= {_LINE_WORDS})
        or ({_SHOUTS} >= 3 and (not regexp_matches(x, '\p{{Ll}}') or {_SHOUTS} * 2 >= {_LINE_WORDS})) or regexp_matches(x, '(?s)[|»•·].*[|»•·].*[|»•·]')))
    or (length(x) <= 60 and not regexp_matches(x, '[.!?…。！？:;,"''”»)]|[\p{{L}}\p{{N}}]{{12}}') and {_LINE_WORDS} between 1 and 3)
    or (length(x) <= 120 and regexp_matches(x, '(?i){"|".join(BOILERPLATE)}'))"""

#: SQL for the rows of ``quality`` over documents.
ORACLE = rf"""
    with w as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_WORD}') as words, string_split(coalesce(text, ''), chr(10)) as lines from documents),
    g as (select doc_id, unnest(list_transform(range(1, len(words) - 1), lambda i: {{'p': i, 'g': words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]}})) as x from w),
    r as (select doc_id, x.p as p from g qualify count(*) over (partition by doc_id, x.g) > 1),
    c as (select doc_id, least(3, coalesce(lead(p) over (partition by doc_id order by p) - p, 3)) as n from r),
    n as (select doc_id, sum(n) as n from c group by 1),
    l as (select *, list_filter(lines, lambda x: regexp_matches(x, '{_WORD}')) as wordy, list_filter(lines, lambda x: not ({_BAD})) as good from w),
    q as (select l.doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
                 len(wordy) - len(list_distinct(wordy)) as n_dup_lines, cast(coalesce(n.n, 0) as bigint) as n_repeat_words, len(lines) as n_lines, len(lines) - len(good) as n_lines_removed,
                 length(array_to_string(lines, '')) as line_chars, length(array_to_string(good, '')) as kept_chars
          from l left join n on n.doc_id = l.doc_id)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
           not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and (line_chars - kept_chars) * 100 <= line_chars * {MAX_LOST_PERCENT} as kept, n_lines, n_lines_removed
    from q"""
