"""Personal data: patterns of four kinds, and a conditional random field that finds what they miss.

Patterns for e-mail addresses, IP addresses, card and phone numbers are applied
to whole texts first and what they find stays. They are written so that time is
linear in a text's length: a search for addresses starts at an ``@``, a run of
digits is begun once. Then a linear-chain CRF (``crf``) reads the words around
every digit, ``@`` and written-out mark (dot, at in brackets), as no personal
data of these kinds is without one, and adds spans that are written another
way: phone numbers without a plus sign, card numbers with a slip of a digit or
of 15 digits, addresses with ``(at)`` and ``dot``, IPv6 and defanged
IPs. Tokens are runs of letters, runs of digits and single marks; features
are shapes of the token, of its neighbours and of the number that it is a part
of. The model learns from a small labelled table: ``LABELLED`` sentences with
made-up values, or one of the caller's (text with spans in braces). It is
trained on the driver (a table of at most ``MOST`` rows) and sent to tasks.
Added spans never overlap those of the patterns.

Defined cases: a null text is empty; it and an empty text have no spans, and
``base_sha256`` of no spans is that of the empty string. Very long texts are
searched whole; the CRF sees snippets, decoded some thousands at a time, and a
run of more than 200 characters without white space is cut at a snippet's
border (but never digits). Repeated rows are judged alike; null ids are kept.
Empty tables give empty results. Columns other than the two that are named
aren't read.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf

KINDS = ("email", "ip", "card", "phone")
#: Rows of a labelled table that are used at most, and characters around a mark that the model reads.
MOST, AROUND, LONGEST = 5000, 64, 200
Span = tuple[int, int, int]  # number of the kind, start, end

# The patterns. Possessive, as no part could give up a character to the next; an IP starts at the start of a run of digits.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    """Whether the check digit fits: every second digit from the right counts double, as the sum of its digits."""
    doubled = [2 * int(c) for c in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            end = domain.end()
            yield start, end
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """What the patterns find, by kind and start."""
    found: list[Span] = []
    if not _ANY.search(text):
        return found
    found += [(0, *x) for x in _emails(text)]
    found += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-9:]) < 256 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() <= 37 and 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and luhn(d):
            found.append((2, *m.span()))
    found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return found


# ---- the words that the model reads, and their features

_MARK = re.compile(r"[0-9@]+|(?<![A-Za-z])[Dd][Oo][Tt](?![A-Za-z])|[\[({]\s?[Aa][Tt]\s?[\])}]")
_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
_NUMBER = re.compile(r"(?:\+|\(\+?)?[0-9](?:[0-9]|[ ().\-/]{1,2}(?=[0-9(]))*")
# Words that tell what follows.
CUES = frozenset("at dot com org net email mail e mailto contact phone tel telephone call fax mobile cell sms whatsapp card visa mastercard amex credit debit ip ipv6 host server address version isbn order invoice date page token id".split())


def snippets(text: str) -> Iterator[tuple[int, int]]:
    """Stretches of text around marks, at borders of words; those that touch are one."""
    start = end = None
    for m in _MARK.finditer(text):
        low, high = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if start is not None and low <= end:
            end = max(end, high)
            continue
        if start is not None:
            yield _widened(text, start, end)
        start, end = low, high
    if start is not None:
        yield _widened(text, start, end)


def _widened(text: str, start: int, end: int) -> tuple[int, int]:
    """Both ends moved outwards to white space, by ``LONGEST`` at most."""
    low, high = max(0, start - LONGEST), min(len(text), end + LONGEST)
    while start > low and not text[start - 1].isspace():
        start -= 1
    while end < high and not text[end].isspace():
        end += 1
    return start, end


def _shape(token: str) -> str:
    if token[0].isalpha():
        case = "A" if token.isupper() else "Aa" if token[0].isupper() else "a"
        return case + str(min(len(token), 4)) + ("x" if len(token) <= 4 and all(c in "abcdefABCDEF" for c in token) else "")
    if token[0] in "0123456789":
        return f"9{min(len(token), 20)}"
    return token


def features(snippet: str, tokens: list[tuple[int, int]]) -> crf.Sequence:
    """Feature names of each token."""
    words = [snippet[a:b] for a, b in tokens]
    shapes = [_shape(w) for w in words]
    gaps = ["^" if k == 0 else "" if a == tokens[k - 1][1] else "n" if "\n" in snippet[tokens[k - 1][1] : a] else "s" for k, (a, _) in enumerate(tokens)]
    cues = [w.lower() if w.lower() in CUES else "" for w in words]
    number: dict[int, tuple[str, int, bool]] = {}
    starts = [a for a, _ in tokens]
    at = 0
    for m in _NUMBER.finditer(snippet):
        digits = sum(c in "0123456789" for c in m.group())
        pattern = re.sub("[0-9]+", lambda x: str(min(len(x.group()), 20)), m.group()) if len(m.group()) < 40 else "long"
        glued = m.start() > 0 and (snippet[m.start() - 1].isalnum() or snippet[m.start() - 1] in "#$_") or m.end() < len(snippet) and (snippet[m.end()].isalnum() or snippet[m.end()] == "_")
        while at < len(starts) and starts[at] < m.start():
            at += 1
        while at < len(starts) and starts[at] < m.end():
            number[at] = (pattern, digits, glued)
            at += 1
    out = []
    get = lambda xs, k: xs[k] if 0 <= k < len(xs) else "|"
    for k, shape in enumerate(shapes):
        here = ["bias", f"w={shape}", f"g={gaps[k]}{get(gaps, k + 1)}", f"p={get(shapes, k - 1)}{gaps[k]}", f"n={get(gaps, k + 1)}{get(shapes, k + 1)}",
                f"wn={shape}{get(gaps, k + 1)}{get(shapes, k + 1)}", f"pw={get(shapes, k - 1)}{gaps[k]}{shape}", f"pp={get(shapes, k - 2)}", f"nn={get(shapes, k + 2)}"]
        here += [f"c{d}={get(cues, k + d)}" for d in range(-4, 4) if 0 <= k + d < len(cues) and cues[k + d]]
        here += [f"m{d}={words[k + d]}" for d in (-3, -2, -1, 1, 2, 3) if 0 <= k + d < len(words) and words[k + d] in "@+:[]()"]
        if k in number:
            pattern, digits, glued = number[k]
            inner = "in" if number.get(k - 1) is number[k] else "first"
            here += [f"#={pattern}{'*' if glued else ''}", f"#w={pattern}{'*' if glued else ''}{inner}", f"#n={digits}{'*' if glued else ''}{inner}"]
        out.append(here)
    return out


# ---- the labelled table

# Sentences with a place for a value each, and values by kind; 9 is any digit, 1 one that isn't zero, x a hexadecimal one, a a name, d a domain.
SENTENCES = {
    "email": ("write to {} please", "contact: {}", "e-mail {} for more", "reach me at {}, thanks.", "{}", "my mail is {} and that is all", "Send it to {}."),
    "ip": ("the host {} was down", "connect from {} to it", "IP: {}", "server address {}.", "{}", "requests by {} were blocked,", "blocked {} again and again"),
    "card": ("card {} was charged", "paid with {} today", "credit card: {}", "Visa {}, valid", "{}", "the number {} of the card", "some words {} other words."),
    "phone": ("call {} today", "Tel. {}", "phone: {}", "my number is {}, or write", "{}", "fax {} or mail", "mobile {}.", "some words {} other words"),
    "": ("it is {} here", "version {}", "Order {} was sent", "{}", "from {} to the end.", "Licensed under {}.", "see page {}, again", "token = \"{}\" and words", "the sum was {} at most", "({})", "some words {} other words"),
}
VALUES = {
    "email": ("a(at)d", "a (at) d", "a [at] d", "a at a dot com", "a dot a at a dot org", "a(at)a(dot)net", "a [at] a [dot] com", "a{at}d", "a @ d", "a AT a DOT com"),
    "ip": ("xxxx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx:xxxx", "xxxx:xxx::xxxx", "xxxx::x", "1xx:xxxx:x::x:xxxx", "199[.]99[.]9[.]19", "19[.]9[.]9[.]199", "199(.)199(.)99(.)9"),
    "card": ("1999999999999999", "1999 9999 9999 9999", "1999-9999-9999-9999", "1999 999999 99999", "199999999999999", "1999.9999.9999.9999"),
    "phone": ("(199) 999-9999", "199-999-9999", "(199)999-9999", "199.999.9999", "1-199-999-9999", "0199 9999999", "0199/9999999", "00 19 199 9999999", "01 99 99 99 99", "(019) 9999 9999", "0199-999-9999", "0019 199 999 9999"),
    "": (
        "1", "19", "199", "1999", "19999", "199999", "1999999", "1.9", "1.9.9", "19.9.1999", "19.99.1999", "1999-99-99", "99/99/1999", "99:99", "99:99:99", "1999-99-99 99:99:99", "1,999.99", "$199.99", "19%", "1999-1999", "19-19",
        "1 2 3 4 5 6", "10 20 30", "978-1-99-999999-9", "9781999999999", "CC BY-NC 4.0", "Apache License, Version 2.0", "3.9.19", "v1.9", "xxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxxx", "xxxxxxxxxxxxxxxxxxxx", "xxxxxxxx", "#199999", "19999999",
        "a1999", "a_99", "19kg", "19 of 19", "a dot", "a at a", "a at the dot", "@a", "@ 19", "19:19 and 19:29", "xx:xx:xx:xx:xx:xx", "xxxxxxxx-xxxx-xxxx-xxxx-xxxxxxxxxxxx", "199 199 199", "1.999.999", "f(19, 29)", "[19]", "19999999999999999999999",
    ),
}
ROWS_EACH = 14


def _name(rng: random.Random) -> str:
    return "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) + rng.choice(["", "n", "r", "s"])


def _value(pattern: str, rng: random.Random) -> str:
    fill = {"9": lambda: rng.choice("0123456789"), "1": lambda: rng.choice("123456789"), "x": lambda: rng.choice("0123456789abcdef"), "a": lambda: _name(rng), "d": lambda: f"{_name(rng)}.{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"}
    words = {"at", "dot", "com", "org", "net", "of", "and", "the", "kg", "CC", "BY", "NC", "AT", "DOT", "Apache", "License", "Version"}
    parts = re.findall(r"[A-Za-z]+|.", pattern)
    return "".join(p if p in words else "".join(fill[c]() if c in fill else c for c in p) for p in parts)


def labelled_table(seed: int = 7, each: int = ROWS_EACH) -> list[str]:
    """The built-in labelled sentences, such as ``call {phone:(521) 555-6210} today``."""
    rng, rows = random.Random(seed), []
    for kind, patterns in VALUES.items():
        for pattern in patterns:
            for _ in range(each):
                value = _value(pattern, rng)
                if kind == "ip" and rng.random() < 0.1:
                    value = value.upper()
                sentence = rng.choice(SENTENCES[kind] + (SENTENCES["phone"][-1:] if kind else ()))
                if rng.random() < 0.2:
                    sentence = sentence.upper()
                before, after = (" ".join(_name(rng) for _ in range(rng.randrange(0, 4))) for _ in range(2))
                if rng.random() < 0.25:  # cues stand beside other things as well
                    before += " " + rng.choice(sorted(CUES - {"at", "dot"}))
                after = rng.choice(["", ".", "###", "!!", "%%%", " |"]) + " " + after
                rows.append(f"{before} {sentence.format('{' + kind + ':' + value + '}' if kind else value)}{after}".strip())
    return rows


def parsed(row: str) -> tuple[str, list[Span]]:
    """Text and spans of a labelled row."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"\{(%s):((?:\{at\}|[^{}])*)\}" % "|".join(KINDS), row):
        text += row[at : m.start()]
        spans.append((KINDS.index(m.group(1)), len(text), len(text) + len(m.group(2))))
        text, at = text + m.group(2), m.end()
    return text + row[at:], spans


def _tagged(rows: list[str]) -> tuple[list[crf.Sequence], list[list[str]]]:
    sequences, tags = [], []
    for row in rows:
        text, spans = parsed(row)
        for low, high in snippets(text):
            tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text[low:high])]
            own = ["O"] * len(tokens)
            for kind, start, end in spans:
                inner = [k for k, (a, b) in enumerate(tokens) if start <= a + low and b + low <= end]
                for k in inner:
                    own[k] = ("B-" if k == inner[0] else "I-") + KINDS[kind]
            sequences.append(features(text[low:high], tokens))
            tags.append(own)
    return sequences, tags


_models: dict[tuple[str, ...], crf.Model] = {}


def model_of(rows: list[str] | None = None) -> crf.Model:
    """The model of a labelled table, or of the built-in one; trained once a process."""
    rows = labelled_table() if rows is None else rows
    if (key := tuple(rows)) not in _models:
        _models[key] = crf.trained(*_tagged(rows))
    return _models[key]


#: Digits that a span of a kind may have, so that a number in passing isn't taken for one.
DIGITS = {"email": (0, 99), "ip": (2, 32), "card": (14, 19), "phone": (9, 15)}


def added_spans(texts: list[str], model: crf.Model) -> list[list[Span]]:
    """What the model finds in each text."""
    places, sequences, found = [], [], [[] for _ in texts]

    def flush() -> None:
        for (i, low, tokens), tags in zip(places, crf.decoded(sequences, model)):  # noqa: B905
            k = 0
            while k < len(tags):
                end = k + 1
                if tags[k] != "O":
                    kind = tags[k][2:]
                    while end < len(tags) and tags[end] == f"I-{kind}":
                        end += 1
                    start, stop = tokens[k][0] + low, tokens[end - 1][1] + low
                    least, most = DIGITS[kind]
                    if tags[k][0] == "B" and least <= sum(c in "0123456789" for c in texts[i][start:stop]) <= most and end - k < 60:
                        found[i].append((KINDS.index(kind), start, stop))
                k = end
        places.clear()
        sequences.clear()

    size = 0
    for i, text in enumerate(texts):
        for low, high in snippets(text):
            snippet = text[low:high]
            tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(snippet)]
            for at in range(0, len(tokens), 5000):  # a stretch of nothing but numbers in pieces
                some = tokens[at : at + 5000]
                first, last = some[0][0], some[-1][1]
                places.append((i, low + first, [(a - first, b - first) for a, b in some]))
                sequences.append(features(snippet[first:last], places[-1][2]))
                size += len(some)
                if size > 20_000:
                    flush()
                    size = 0
    flush()
    return found


def united(base: list[Span], added: list[Span]) -> list[Span]:
    """All spans by kind and start; added ones that overlap a base span are left out."""
    taken = sorted((a, b) for _, a, b in base)
    free, k = [], 0
    for span in sorted(added, key=lambda s: s[1]):
        while k < len(taken) and taken[k][1] <= span[1]:
            k += 1
        if not any(a < span[2] and b > span[1] for a, b in taken[max(0, k - 1) : k + 4]):
            free.append(span)
    return sorted(base + free)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _finder(model: crf.Model):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                base: list[list[Span]] = []
                marked: dict[int, str] = {}  # texts with a mark are kept for the model, others have nothing
                for k, cell in enumerate(batch.column(1)):
                    text = cell.as_py() or ""
                    base.append(base_spans(text))
                    if _MARK.search(text):
                        marked[k] = text
                every = list(base)
                for k, more in zip(marked, added_spans(list(marked.values()), model)):  # noqa: B905
                    every[k] = united(base[k], more)
                counts = [pa.array([sum(s[0] == kind for s in spans) for spans in base], pa.int64()) for kind in range(len(KINDS))]
                digests = pa.array([hashlib.sha256(_joined(s).encode()).hexdigest() for s in base])
                yield pa.RecordBatch.from_arrays([batch.column(0), *counts, digests, pa.array(map(_joined, every), pa.string())], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return find


def found(df: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    ``labelled`` has labelled rows in its first column, of which at most
    ``MOST`` (the first in order of their text) are used.
    """
    rows = None
    if labelled is not None:
        row = F.col(f"`{labelled.columns[0]}`").cast("string")
        rows = [r[0] for r in labelled.select(row.alias("row")).where("row is not null").orderBy("row").limit(MOST).collect()]
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _finder(model_of(rows)), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
    )
    return rows


def masked(df: DataFrame, spans: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``df`` with every span of a text replaced by its kind in brackets; ids must be unique, and null texts stay null."""
    own = spans.select(F.col("doc_id").alias("_key"), F.col("spans").alias("_spans"))
    rows = df.join(own, df[id_col].eqNullSafe(F.col("_key")), "left").drop("_key")
    parts = F.transform(F.filter(F.split(F.coalesce("_spans", F.lit("")), ","), lambda s: s != ""), lambda s: F.split(s, ":"))
    backwards = F.array_sort(F.transform(parts, lambda p: F.struct((-p[1].cast("int")).alias("minus"), p[2].cast("int").alias("end"), p[0].alias("kind"))))
    swap = lambda t, p: F.concat(F.substring(t, F.lit(1), -p["minus"]), F.lit("["), p["kind"], F.lit("]"), F.substring(t, p["end"] + 1, F.length(t)))
    return rows.withColumn(text_col, F.aggregate(backwards, F.col(text_col).cast("string"), swap)).drop("_spans")
