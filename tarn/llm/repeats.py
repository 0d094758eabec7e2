"""Exact removal of byte strings of a given length that occur twice or more, anywhere in a corpus.

Every window of ``match`` bytes has an anchor, the smallest hash of a third of
its bytes or so (128 of 400, 64 of 224); equal windows have equal anchors.
Consecutive windows with one anchor are a segment of some 1.4 times ``match``
bytes. A segment whose anchor occurs once is unique. Equal segments repeat as
a whole. Of each anchor's different segments one copy each is taken, and
run-length indexes over buckets of such copies give matching statistics, which
mark windows that also start in another segment or place.

An anchor with very many different segments (a common line or passage) is
split: equal windows share all bytes around the anchor, so they share the half
of the missing ones to its left or to its right. Segments are dealt by the
hash of the anchor with either half; what is alone then matches nothing. A
segment that holds its anchor several times is dealt for each place by which
one of its windows is known. Where a group is still large (very many near
copies of one text), the hashes of its segments' windows are counted instead.
Nothing is lost, and no group meets in one task.

Whatever repeats at a greater length also repeats, at the same places, at a
smaller one, so a second, greater length is searched for in the spans that the
smaller one has found.

Defined cases: a null text is empty. Texts shorter than ``match`` lose nothing.
Matches never cross documents; equal documents of that length and more, repeated
rows among them, lose everything. Ids may be null or repeated: spans belong to
the text. Empty tables give empty results. ``repeat_counts`` reads only the
two columns that are named, ``without_repeats`` keeps the others; it leaves out
a character of which removal leaves only some bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import anchor_hashes, anchor_length, segments
from .common import fresh, kept, pieces_of, tidy, written
from .run_index import repeated_spans

#: Bytes of a string whose repeats are removed.
MATCH = 400
#: Bytes of a passage: fifty words hold more, unless they have three letters or fewer on average.
PASSAGE = 224
#: Segments of an anchor beyond which it is split.
LARGEST_GROUP = 1000
#: Bytes of segments in an index, about.
BUCKET = 500_000
#: Bytes of texts that are cut into segments at once.
AT_ONCE = 1 << 17


def merged(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of an array of lists in order, those that touch or overlap as one: place of the list, start and end."""
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    s, e = (lists.flatten().field(k).to_numpy() for k in (0, 1))
    if not len(s):
        return owner, s, e
    far = int(e.max()) + 2
    s, e = s + owner * far, e + owner * far
    order = np.argsort(s, kind="stable")
    s, reached = s[order], np.maximum.accumulate(e[order])
    new = np.concatenate([[True], s[1:] > reached[:-1]])
    s, e = s[new], reached[np.append(new[1:], True)]
    owner = s // far
    return owner, s - owner * far, e - owner * far


def cuts_of(lists: pa.Array) -> list[list[tuple[int, int]]]:
    """The merged spans of each list."""
    cuts: list[list[tuple[int, int]]] = [[] for _ in range(len(lists))]
    for k, s, e in zip(*(x.tolist() for x in merged(lists))):  # noqa: B905
        cuts[k].append((s, e))
    return cuts


def _parts(text: bytes, spans: list[tuple[int, int]], match: int, at_once: int) -> Iterator[tuple[int, bytes]]:
    """Places and bytes of the parts of a text in which windows are looked for; parts overlap, windows don't repeat."""
    for s, e in spans:
        for base in range(s, e - match + 1, at_once):
            yield base, text[base : min(e, base + at_once + match - 1)]


def _segments(match: int, at_once: int, within: bool):
    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest

        def cut(t: pa.Array, parts: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
            """The segments of some parts (row, base, bytes)."""
            row, base = (np.array([p[k] for p in parts], np.int64) for k in (0, 1))
            joined = b"".join(p[2] for p in parts)
            starts = np.cumsum([0, *(len(p[2]) for p in parts)])
            v, a, b, p, many = segments(np.frombuffer(joined, np.uint8), starts, match)
            seg = np.fromiter((digest(joined[i:j]) for i, j in zip(a.tolist(), (b + match - 1).tolist())), np.uint64, len(a))  # noqa: B905
            own = np.searchsorted(starts, a, "right") - 1
            columns = v.view(np.int64), seg.view(np.int64), a - starts[own] + base[own], b - a << 21 | p - a << 1 | many
            return pa.RecordBatch.from_arrays([t.take(pa.array(row[own])), *map(pa.array, columns)], names=["t", "v", "seg", "a", "x"])

        for batch in batches:
            parts, size, t = [], 0, batch.column("t")
            spans = cuts_of(batch.column("spans")) if within else None
            for k, value in enumerate(batch.column("data")):
                text = value.as_py()
                for base, part in _parts(text, spans[k] if within else [(0, len(text))], match, at_once):
                    parts.append((k, base, part))
                    size += len(part)
                    if size > at_once:
                        yield cut(t, parts)
                        parts, size = [], 0
            if parts:
                yield cut(t, parts)

    return segment


#: Of a segment's shape x (its windows, its anchor's place, whether the anchor stands in it more than once): the first and the last.
_WINDOWS, _MANY = "shiftright(x, 21)", "x & 1"


def _slices(match: int, at_once: int):
    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces_of(whole, "data", at_once)):
            lists, wanted = batch.column("wanted"), batch.column("wanted").flatten()
            of = {f.name: wanted.field(k) for k, f in enumerate(wanted.type)}
            first, x = of["a"].to_numpy(), of["x"].to_numpy()
            last, found, at = first + (x >> 21) + match - 1, [], 0
            for k, n in enumerate(pc.list_value_length(lists).to_pylist()):
                text = batch.column("data")[k].as_py()
                found += [text[i:j] for i, j in zip(first[at : at + n].tolist(), last[at : at + n].tolist())]  # noqa: B905
                at += n
            columns = [of["v"], of["seg"], pa.array(x >> 1 & 0xFFFFF), of["m"], pa.array(x & 1), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["v", "seg", "p", "m", "many", "slice"])

    return slices


def places_of(data: bytes, v: int, match: int) -> np.ndarray:
    """Places of the anchor ``v`` in a segment, one at least for each different window.

    A window's own bytes name its place: the end of its first evenly spaced
    row of places if that ends within the window, else its first place. So
    equal windows name the same place, and a periodic run has few of them.
    """
    anchor = anchor_length(match)
    h = anchor_hashes(np.frombuffer(data, np.uint8), anchor)
    at = np.flatnonzero(h.view(np.int64) == v)
    windows = np.arange(len(data) - match + 1)
    first, last = np.searchsorted(at, windows), np.searchsorted(at, windows + match - anchor, "right") - 1
    gap = np.append(np.diff(at), 0)
    end = np.arange(len(at))
    for k in range(len(at) - 2, -1, -1):
        end[k] = end[k + 1] if gap[k] == gap[k + 1] else k + 1
    row = np.minimum(end[first], last)
    ends = (first < last) & ((row < last) | (at[row] + gap[first] <= windows + match - anchor))
    named = at[np.where(ends, row, first)]
    whole = np.zeros(len(windows), np.uint64)
    for k in (*range(0, match - anchor, anchor), match - anchor):
        whole = whole * np.uint64(0x9E3779B97F4A7C15) + h[windows + k]
    return np.unique(named[np.unique(whole, return_index=True)[1]])


def _placed(match: int):
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each place by which a window of the segment is known."""
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("v", "p", "many", "slice"))
            found = [places_of(data, v, match) if many else [p] for v, p, many, data in zip(*columns)]  # noqa: B905
            take = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            p = pa.array(np.concatenate([np.zeros(0, np.int64), *found]).astype(np.int64))
            yield pa.RecordBatch.from_pydict({c: p if c == "p" else batch.column(c).take(take) for c in ("v", "seg", "p", "slice")})

    return placed


def _halves(match: int):
    anchor = anchor_length(match)
    more = (match - anchor + 1) // 2

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row with the hash of the anchor and half of the missing bytes on its left, and on its right, where the segment has them."""
        import xxhash

        for batch in batches:
            row, keys = [], []
            for k, (p, data) in enumerate(zip(batch.column("p").to_pylist(), batch.column("slice").to_pylist())):  # noqa: B905
                for i, j, side in ((p - more, p + anchor, 1), (p, p + anchor + more, 2)):
                    if i >= 0 and j <= len(data):
                        row.append(k)
                        keys.append(xxhash.xxh3_64_intdigest(data[i:j], side))
            take = pa.array(row, pa.int64())
            columns = [batch.column(c).take(take) for c in ("v", "seg", "slice")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.array(keys, np.uint64).view(np.int64))], names=["v", "seg", "slice", "key"])

    return halves


def _windows(match: int, at_once: int):
    anchor = anchor_length(match)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The hash of each window of each segment, made of those of the anchors that cover it, and the window's place."""
        for batch in (part for whole in batches for part in pieces_of(whole, "slice", at_once)):
            length = pc.binary_length(batch.column("slice")).to_numpy().astype(np.int64)
            data = np.frombuffer(b"".join(batch.column("slice").to_pylist()), np.uint8)
            first = np.cumsum(length) - length
            n = length - match + 1
            row = np.repeat(np.arange(len(n)), n)
            s = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            hashes, whole = anchor_hashes(data, anchor), np.zeros(len(row), np.uint64)
            for k in (*range(0, match - anchor, anchor), match - anchor):
                whole = (whole ^ whole >> np.uint64(29)) * np.uint64(0x9E3779B97F4A7C15) + hashes[first[row] + s + k]
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays([batch.column("v").take(take), batch.column("seg").take(take), pa.array(s), pa.array(whole.view(np.int64))], names=["v", "seg", "s", "h"])

    return windows


def _indexed(match: int):
    def indexed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Spans (v, seg, s, e) of the segments of a bucket."""
        parts = {(v, s): x for v, s, x in zip(*(table.column(c).to_pylist() for c in ("v", "seg", "slice")))}  # noqa: B905
        rows = [(v, g, s, e) for (v, g), spans in zip(parts, repeated_spans(list(parts.values()), match)) for s, e in spans]  # noqa: B905
        return pa.table({n: pa.array([r[k] for r in rows], pa.int64()) for k, n in enumerate(("v", "seg", "s", "e"))})

    return indexed


def split_groups(rows: DataFrame, match: int) -> tuple[DataFrame, DataFrame]:
    """Segments of very large groups as smaller groups (v, seg, slice, key), and spans (v, seg, s, e) of windows of those still large."""
    rows = rows.select("v", "seg", "p", "many", "slice").mapInArrow(tidy("repeats", _placed(match)), "v long, seg long, p long, slice binary")
    rows = written(rows.mapInArrow(tidy("repeats", _halves(match)), "v long, seg long, slice binary, key long"), "halves")
    groups = kept(rows.select("v", "seg", "key").distinct().groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    rows = rows.join(groups, "key")
    small = rows.where(F.col("n") <= LARGEST_GROUP).select("v", "seg", "slice", "key")
    still = rows.where(F.col("n") > LARGEST_GROUP).select("v", "seg", "slice").dropDuplicates(["v", "seg"])
    windows = written(still.mapInArrow(tidy("repeats", _windows(match, AT_ONCE)), "v long, seg long, s long, h long"), "windows")
    again = kept(windows.groupBy("v", "h").agg(F.count("*").alias("n")).where("n > 1").select("v", "h"))
    return small, windows.join(again, ["v", "h"]).select("v", "seg", "s", (F.col("s") + match).alias("e"))


def searched(docs: DataFrame, match: int) -> tuple[DataFrame, DataFrame]:
    """(t, data, copies) of the texts of ``docs`` (doc_id, data, t) that share an anchor with another or within, and
    (t, spans): byte spans to remove from them; t is the MD5 of data. Equal rows of ``docs`` give equal texts.

    With a column ``spans`` only windows within those spans are looked at.
    """
    spark = docs.sparkSession
    long = docs.where(F.octet_length("data") >= match)
    rows = long.mapInArrow(tidy("repeats", _segments(match, AT_ONCE, "spans" in docs.columns)), "t binary, v long, seg long, a long, x long")
    rows = written(rows, "segments")
    again = kept(rows.groupBy("v").agg(F.sum(F.expr(f"1 + ({_MANY})")).alias("n")).where("n > 1").select("v"))
    rows = written(rows.join(again, "v"), "candidates")
    each = rows.groupBy("v", "seg").agg(F.count("*").alias("c"), F.min(F.struct("t", "a")).alias("at"), F.max("x").alias("x"))
    each = kept(each)
    groups = kept(each.groupBy("v").agg(F.count("*").alias("m"), F.max(F.expr(_MANY)).alias("many"), F.min("c").alias("c")).where("c = 1 and (m > 1 or many = 1)").select("v", "m"))
    wanted = each.join(groups, "v").groupBy("at.t").agg(F.collect_list(F.struct("v", "seg", F.col("at.a").alias("a"), "x", "m")).alias("wanted"))
    one = docs.groupBy("t").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies")).join(rows.select("t").distinct(), "t").join(wanted, "t", "left")  # a row of each text
    one = one.select(F.col("t").alias("_t"), F.col("doc_id").alias("_id"), "copies", "wanted")
    texts = written(long.join(one, (F.col("t") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_id"))).select("t", "data", "copies", "wanted"), "texts")
    sliced = texts.where("wanted is not null").select("data", "wanted").mapInArrow(tidy("repeats", _slices(match, AT_ONCE)), "v long, seg long, p long, m long, many long, slice binary")
    sliced = written(sliced, "slices")
    size, hot = sliced.agg(F.coalesce(F.sum(F.octet_length("slice")), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))).first()
    dealt = sliced.where(F.col("m") <= LARGEST_GROUP).select("v", "seg", "slice", F.col("v").alias("key"))
    spans = None
    if hot > LARGEST_GROUP:
        large = sliced.where(F.col("m") > LARGEST_GROUP)
        small, spans = split_groups(large, match)
        dealt = dealt.unionAll(small).unionAll(large.where("many = 1").select("v", "seg", "slice", F.xxhash64("v", "seg").alias("key")))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))
    tasks = min(buckets, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = dealt.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).repartition(tasks, "bucket")
    found = dealt.groupBy("bucket").applyInArrow(_indexed(match), "v long, seg long, s long, e long")
    found = found.unionAll(each.where("c > 1").select("v", "seg", F.lit(0).cast("long"), F.expr(_WINDOWS) + match - 1))
    found = found if spans is None else found.unionAll(spans)
    found = kept(found.groupBy("v", "seg").agg(F.collect_set(F.struct("s", "e")).alias("spans")))
    marks = rows.select("v", "seg", "t", "a").distinct().join(found, ["v", "seg"])
    marks = marks.select("t", F.expr("transform(spans, x -> struct(x.s + a as s, x.e + a as e))").alias("spans"))
    return texts.select("t", "data", "copies"), written(marks.groupBy("t").agg(F.flatten(F.collect_set("spans")).alias("spans")), "marks")


def repeated(docs: DataFrame, match: int = MATCH) -> DataFrame:
    """(t, spans): byte spans to remove from the texts of ``docs`` (doc_id, data, t), t the MD5 of data."""
    return searched(docs, match)[1]


def rest_of(data: bytes, cuts: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for c in cuts for x in c), len(data)]
    return b"".join(data[i:j] for i, j in zip(edges[::2], edges[1::2]))  # noqa: B905


COUNTS = "t binary, n_removed long, n_spans long, sha string, n_passage_bytes long, n_passages long"


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a text loses at the two lengths, and the checksum of the rest if it loses something at the greater one."""
    for batch in (part for whole in batches for part in pieces_of(whole, "data", AT_ONCE)):
        n, columns = len(batch), [batch.column("t")]
        for name in ("longer", "spans"):
            owner, s, e = merged(batch.column(name))
            columns += [pa.array(np.bincount(owner, e - s, n).astype(np.int64)), pa.array(np.bincount(owner, minlength=n))]
        cuts = cuts_of(batch.column("longer"))
        sha = [hashlib.sha256(rest_of(batch.column("data")[k].as_py(), c)).hexdigest() if c else None for k, c in enumerate(cuts)]
        columns.insert(3, pa.array(sha, pa.string()))
        yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in COUNTS.split(", ")])


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The longest span of each text, once spans that touch or overlap are one."""
    for batch in batches:
        owner, s, e = merged(batch.column("spans"))
        longest = np.zeros(len(batch), np.int64)
        np.maximum.at(longest, owner, e - s)
        yield pa.RecordBatch.from_arrays([batch.column("t"), batch.column("spans"), pa.array(longest)], names=["t", "spans", "longest"])


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return df.select(F.col(id_col).cast("long").alias("doc_id"), data.alias("data"), F.unhex(F.md5(data)).alias("t"))


def repeat_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH, passage: int = PASSAGE) -> DataFrame:
    """One row for each row of ``df``: doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of what is left) at ``match`` bytes.

    n_passage_bytes and n_passages are what is covered at the smaller length
    ``passage``. Only texts that may lose something are shuffled to be cut.
    """
    if not 0 < passage <= match:
        raise ValueError("a passage is as long as a match at most")
    docs = _keyed(df, id_col, text_col)
    texts, marks = searched(docs, passage)
    marks = marks.mapInArrow(tidy("repeats", _longest), "t binary, spans array<struct<s: long, e: long>>, longest long")
    rows = written(texts.join(marks, "t"), "passages")
    longer = repeated(rows.where(F.col("longest") >= match).select(F.lit(0).cast("long").alias("doc_id"), "data", "t", "spans"), match)
    none = F.expr("cast(null as array<struct<s: bigint, e: bigint>>)")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("s"), F.octet_length("data").cast("long").alias("e")))  # one of the copies was searched
    spans = F.when((F.col("copies") > 1) & (F.octet_length("data") >= match), whole)
    able = rows.where(F.col("longest") >= match).join(longer.select("t", F.col("spans").alias("longer")), "t", "left")
    rows = able.select("t", "data", F.coalesce(spans, "longer").alias("longer"), "spans").unionAll(rows.where(F.col("longest") < match).select("t", "data", none.alias("longer"), "spans"))
    found = kept(rows.mapInArrow(tidy("repeats", _counts), COUNTS).dropDuplicates(["t"]))
    all_ = docs.select("doc_id", "t", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("whole")).join(found, "t", "left")
    number = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return all_.select("doc_id", "n_bytes", number("n_removed"), number("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"), number("n_passage_bytes"), number("n_passages"))


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", match: int = MATCH) -> DataFrame:
    """The rows of ``df`` with their repeated strings cut from the text; null texts stay null."""
    t, cuts = fresh(df, "_t"), fresh(df, "_spans")
    marks = repeated(_keyed(df, id_col, text_col), match).select(F.col("t").alias(t), F.col("spans").alias(cuts))
    rows = df.join(marks, F.unhex(F.md5(df[text_col].cast("binary"))) == F.col(t), "left").drop(t)
    place = df.columns.index(text_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in pieces_of(whole, text_col, AT_ONCE)):
            columns = [batch.column(k) for k in range(len(batch.columns) - 1)]
            spans = cuts_of(batch.column(cuts))
            if any(spans):
                texts = columns[place].to_pylist()
                columns[place] = pa.array([rest_of(t.encode(), x).decode("utf-8", "ignore") if x else t for t, x in zip(texts, spans)], pa.string())  # noqa: B905
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return rows.mapInArrow(tidy("repeats", cut), df.schema)
