"""Near-duplicate texts by SimHash: 64-bit fingerprints at three or fewer differing bits.

Pigeonhole blocks: a fingerprint falls into six blocks; three differing bits
touch three of them at most, so close fingerprints agree on one of the twenty
choices of three blocks (some 32 bits). Fingerprints are joined on those and
then compared. A group that is still large is split on: of its remaining bits
four further blocks are made, of which close fingerprints agree on one, and
so forth until groups are small or all their members link for certain. No
pair is lost and no group's pairs are listed: each group gives a forest.

Defined cases: a null or empty text, or one of white space, has no words and
the fingerprint zero, which links like any other. Fewer than three words are
one shingle. Rows with equal ids are one document. A row without an id links
like others; its component is named by the smallest id in it, and has a null
name if there is none. Empty tables give empty results. ``near_duplicates``
reads the two named columns only. ``deduplicated`` keeps one row of each
component: the one with the smallest id (rows without one come last), of those
with equal ids the one with the smallest hash of all columns, and of equal rows
one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, kept, tidy
from .components import components

DISTANCE = 3
#: Groups of more fingerprints than this are split by further blocks.
LARGEST_GROUP = 1024
SHINGLES_AT_ONCE = 1 << 15


def fingerprint(text: bytes) -> int:
    """The SimHash of a text's three-word shingles, unsigned."""
    import xxhash

    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    pairs = zip([0, *ends], ends[2:]) if len(words) >= 3 else [(0, len(joined) + 1)]  # noqa: B905
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a : b - 1], 42) for a, b in pairs], dtype=">u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), SHINGLES_AT_ONCE):
        ones += np.unpackbits(hashes[k : k + SHINGLES_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        found = np.fromiter((fingerprint(x.as_py() or b"") for x in texts), np.uint64, len(texts))
        columns = {c: batch.column(c) for c in batch.schema.names if c != "text"}
        yield pa.RecordBatch.from_pydict(columns | {"fp": pa.array(found.view(np.int64))})


def _blocks(bits: list[int], parts: int) -> list[int]:
    """``parts`` masks of neighbouring bits."""
    cuts = [len(bits) * k // parts for k in range(parts + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(cuts, cuts[1:])]  # noqa: B905


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def first_masks() -> list[int]:
    return [_signed(sum(x)) for x in combinations(_blocks(list(range(64)), 2 * DISTANCE), DISTANCE)]


def finer_masks(mask: int) -> list[int]:
    """Close fingerprints that agree on ``mask`` agree on one of these as well."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [_signed((mask % (1 << 64)) | x) for x in _blocks(rest, DISTANCE + 1)]


def forest(fps: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that join what is within the distance, directly or through others, to its smallest id."""
    if len(fps) == 2:
        if (int(fps[0]) ^ int(fps[1])).bit_count() <= DISTANCE:
            yield int(ids.max()), int(ids.min())
        return
    order = np.argsort(ids)
    fps, ids = fps[order], ids[order]
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= DISTANCE
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    for k in np.flatnonzero(label != np.arange(len(fps))):
        yield int(ids[k]), int(ids[label[k]])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = batch.column(0)
        at, inner = members.offsets.to_numpy(), members.values
        fps, ids = (inner.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        links = [x for i, j in zip(at, at[1:]) for x in forest(fps[i:j].view(np.uint64), ids[i:j])]  # noqa: B905
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each finer mask of each row's mask."""
    known: dict[int, list[int]] = {}
    for batch in batches:
        masks = batch.column("mask").to_pylist()
        finer = [known.setdefault(m, finer_masks(m)) for m in masks]
        take = pa.array(np.repeat(np.arange(len(masks)), [len(x) for x in finer]))
        yield pa.RecordBatch.from_arrays([batch.column("fp").take(take), batch.column("rep").take(take), pa.array([m for x in finer for m in x], pa.int64())], names=["fp", "rep", "mask"])


def links(classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect the classes (fp, rep) just as all pairs within the distance would."""
    rows = classes.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in first_masks()])))
    found = None
    while True:
        rows = rows.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        groups = kept(rows.groupBy("mask", "key").agg(F.count("*").alias("n"), F.min("rep").alias("least")).where("n > 1"))
        rows = rows.join(groups, ["mask", "key"])
        sure = F.bit_count("mask") >= 64 - DISTANCE
        lists = rows.where((F.col("n") <= LARGEST_GROUP) & ~sure).groupBy("mask", "key").agg(F.collect_list(F.struct("fp", "rep")).alias("members"))
        new = lists.select("members").mapInArrow(tidy("simhash", _forests), "a long, b long")
        new = new.unionAll(rows.where(sure & F.expr("rep <> least")).select("rep", "least"))
        found = new if found is None else found.unionAll(new)
        hot = (F.col("n") > LARGEST_GROUP) & ~sure
        if not groups.where(hot).head(1):
            return found
        rows = kept(rows.where(hot).select("fp", "rep", "mask").mapInArrow(tidy("simhash", _finer), "fp long, rep long, mask long").distinct())


def classes_of(docs: DataFrame) -> DataFrame:
    """(fp, root) for each fingerprint of ``docs`` (doc_id, fp): root is the smallest fingerprint that it reaches."""
    fps = kept(docs.select("fp").distinct())
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("b"), F.max("fp").alias("y")).where("b <> y")
    same = docs.join(ids, "doc_id").where("fp <> b").select(F.col("fp").alias("a"), "b")  # ids with several texts tie their classes
    roots = components(links(fps.withColumn("rep", F.col("fp"))).unionAll(same))
    return kept(fps.join(roots, F.col("fp") == F.col("id"), "left").select("fp", F.coalesce("root", "fp").alias("root")))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, fingerprint (16 hex digits) and component_id (the smallest id reached)."""
    docs = kept(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(tidy("simhash", _fingerprints), "doc_id long, fp long"))
    classes = classes_of(docs)
    least = docs.groupBy("fp").agg(F.min("doc_id").alias("least")).join(classes, "fp")
    names = kept(least.groupBy("root").agg(F.min("least").alias("component_id")))
    of = kept(classes.join(names, "root").select("fp", "component_id"))
    return docs.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` without near-duplicates: one row of each component stays.

    Rows are known by two hashes of all their columns, and texts are shuffled
    once. Of rows that are equal in every column, which have equal hashes, one is kept.
    """
    one, two, n = fresh(df, "_one"), fresh(df, "_two"), fresh(df, "_n")
    able = [F.to_json(F.struct(f"`{c}`")) if "map<" in t or "variant" in t else F.col(f"`{c}`") for c, t in df.dtypes]
    marks = [F.xxhash64(F.lit(k), *[F.struct(c.isNull(), c) for c in able]) for k in (1, 2)]
    keys = df.select(F.col(id_col).cast("long").alias("doc_id"), marks[0].alias("one"), marks[1].alias("two"), F.col(text_col).alias("text"))
    docs = kept(keys.mapInArrow(tidy("simhash", _fingerprints), "doc_id long, one long, two long, fp long"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "one", "two"))
    best = docs.groupBy("fp").agg(first.alias("x")).join(classes_of(docs.select("doc_id", "fp")), "fp").groupBy("root").agg(F.min("x").alias("x"))
    best = best.select("x.one", "x.two")
    times = docs.join(best, ["one", "two"]).groupBy("one", "two").agg(F.count("*").alias("n"))
    best = kept(times.select(F.col("one").alias(one), F.col("two").alias(two), F.col("n").alias(n)))
    rows = df.withColumns({f"{one}x": marks[0], f"{two}x": marks[1]}).join(best, (F.col(f"{one}x") == F.col(one)) & (F.col(f"{two}x") == F.col(two)))
    out = rows.where(F.col(n) == 1).select(*[F.col(f"`{c}`") for c in df.columns])
    if best.where(F.col(n) > 1).head(1):
        out = out.unionAll(rows.where(F.col(n) > 1).dropDuplicates([one, two]).select(*[F.col(f"`{c}`") for c in df.columns]))
    return out
