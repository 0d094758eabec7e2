"""Near-duplicate vectors by sorted projection passes, and exact counts inside the groups that they find.

Equal vectors of a label are one class. In each of ``PASSES`` passes a class
gets a key of 64 random hashes (the signs of projections), and the classes of
a label are ordered by their keys, bit after bit, so that close vectors, which
agree on most bits, tend to be neighbours. The order is cut into blocks of
``BLOCK``; a block is compared with itself and the next, so a window holds
between one and two blocks on either side. All passes are one sort and one
shuffle of vectors: what is sent and compared is linear in the table. Pairs of
cosine ``COSINE`` or more are verified links, of which a task gives a forest;
forests of all passes are united to components.

Where a group is denser than a window, the windows hold a part of its links
only. So links are counted once more inside each component, by all pairs of
its blocks but those whose centres lie further apart than their radii and the
distance of a link allow. Every link between classes of one component is
counted, so a link is missed only if no pass unites its ends by any path. Two
vectors at cosine 0.98 agree on a bit with probability 0.936: in a label of
ten million classes that no other vector joins, eight passes miss two in a
hundred of such pairs, and fewer of closer ones. The exact count takes work
that grows with the square of a component's different vectors, never of a
label's; a large component is as many tasks as it has pairs of tiles. No pair
is emitted anywhere.

Defined cases: vectors that are null, empty or zero or hold null or non-finite
components, and those without label or id, link with nothing; nor do vectors
of different lengths. A cosine of exactly ``COSINE``, as computed in double
precision from vectors scaled to length 1, links. Equal ids with equal vectors
are different rows of one class; equal ids with different vectors or labels
are different classes. Empty tables give empty results. Columns other than the
three that are named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, ranked, written
from .components import components

COSINE = 0.98
PASSES = 8
BITS = 64
BLOCK = 512
#: Blocks of a task of a pass.
CHUNK = 16
#: The distance of unit vectors at COSINE, and some room for rounding.
REACH = (2 - 2 * COSINE) ** 0.5 + 1e-6
SEED = 20

_planes: dict = {}


def planes(size: int) -> np.ndarray:
    """The normals of the hashes of all passes for vectors of ``size`` entries."""
    if size not in _planes:
        _planes.clear()  # one size at a time, as lengths may be many
        _planes[size] = np.random.default_rng(SEED + size).normal(size=(size, PASSES * BITS))
    return _planes[size]


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes; null for those that link with nothing."""
    for batch in batches:
        vectors = []
        for v in batch.column("embedding").to_pylist():
            x = None if v is None or not v or any(c is None for c in v) else np.array(v, np.float64)
            good = x is not None and np.isfinite(x).all() and x.any()
            vectors.append((x + 0.0).astype("<f8").tobytes() if good else None)  # -0.0 is 0.0
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(vectors, pa.binary())], names=["vec_id", "label", "vector"])


def _units(vectors: list[bytes]) -> np.ndarray:
    """Vectors of one length, scaled to length 1; scaled by their largest entry first, so that no square overflows."""
    x = np.frombuffer(b"".join(vectors), "<f8").reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each class and pass, with the key of hashes as a number in the order of its bits."""
    for batch in batches:
        vectors, sizes = batch.column("vector").to_pylist(), batch.column("size").to_numpy()
        codes = np.zeros((len(batch), PASSES), np.int64)
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            bits = _units([vectors[k] for k in at]) @ planes(int(size) // 8) > 0
            codes[at] = (np.packbits(bits, axis=1).view(">u8") ^ np.uint64(1 << 63)).astype(np.uint64).view(np.int64)
        for p in range(PASSES):
            columns = [batch.column("key"), batch.column("label"), batch.column("size"), pa.array(np.full(len(batch), p, np.int32)), pa.array(codes[:, p])]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "size", "pass", "code"])


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of 0 to n - 1 reaches by the links (i, j)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _runs(table: pa.Table, by: list[str]) -> Iterator[tuple[int, int, np.ndarray]]:
    """First, last + 1 and unit vectors of each run of at least two rows with equal columns ``by``."""
    group = np.stack([table.column(c).to_numpy() for c in by], axis=1)
    cuts = np.flatnonzero(np.concatenate([[True], (group[1:] != group[:-1]).any(1), [True]]))
    for a, b in zip(cuts, cuts[1:]):  # noqa: B905
        if b - a > 1:
            yield int(a), int(b), _units(table.column("vector").slice(a, b - a).to_pylist())


def _near(x: np.ndarray, left: slice, right: slice) -> np.ndarray:
    """Which rows of two slices link; of a slice with itself, each pair once."""
    near = x[left] @ x[right].T >= COSINE
    return np.triu(near, 1) if left == right else near


def _passes(size: int):
    def link(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """A forest of the links between each block of a chunk and itself or the next block."""
        table = table.sort_by([("rank", "ascending")])
        keys, block = table.column("key").to_numpy(), table.column("rank").to_numpy() // size
        root = np.arange(len(keys))
        for a, b, x in _runs(table, ["pass", "label", "size"]):
            cuts = [0, *(np.flatnonzero(np.diff(block[a:b])) + 1), b - a]
            blocks = [slice(int(i), int(j)) for i, j in zip(cuts, cuts[1:])]  # noqa: B905
            found = [[], []]
            for k, one in enumerate(blocks):
                for other in blocks[k : k + 2]:
                    p, q = np.nonzero(_near(x, one, other))
                    # What is united already needs no further link.
                    p, q = root[p + a + one.start], root[q + a + other.start]
                    found[0].append(p[p != q])
                    found[1].append(q[p != q])
                    if len(found[0][-1]):
                        root = forest(found[0][-1], found[1][-1], len(root))[root]
        tied = root != np.arange(len(root))
        return pa.table({"a": pa.array(keys[tied], pa.int64()), "b": pa.array(keys[root[tied]], pa.int64())})

    return link


def _blocks(x: np.ndarray, at: np.ndarray, size: int) -> list[tuple[slice, np.ndarray, float]]:
    """Blocks of the neighbouring rows ``at`` of x: where, centre and radius."""
    if not len(at):
        return []
    cuts = [*range(int(at[0]), int(at[-1]) + 1, size), int(at[-1]) + 1]
    out = []
    for i, j in zip(cuts, cuts[1:]):  # noqa: B905
        centre = x[i:j].mean(0)
        out.append((slice(i, j), centre, float(np.sqrt(((x[i:j] - centre) ** 2).sum(1).max()))))
    return out


def _counter(size: int):
    def count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Links of the classes of two tiles, or of one with itself, inside components."""
        one, two = (k.as_py() for k in key)
        table = table.sort_by([("rank", "ascending")])
        n, tile = table.column("n").to_numpy(), table.column("tile").to_numpy()
        links = np.zeros(len(n), np.int64)
        for a, b, x in _runs(table, ["root"]):
            left, right = (_blocks(x, np.flatnonzero(tile[a:b] == t), size) for t in (one, two))
            own = links[a:b], n[a:b]
            for i, c, r in left:
                for j, d, s in right:
                    if j.start < i.start or np.sqrt(((c - d) ** 2).sum()) > r + s + REACH:
                        continue
                    near = _near(x, i, j)
                    own[0][i] += near @ own[1][j]
                    own[0][j] += own[1][i] @ near
        some = links > 0
        return pa.table({"key": table.column("key").filter(pa.array(some)).cast(pa.int64()), "links": pa.array(links[some])})

    return count


def united(classes: DataFrame) -> DataFrame:
    """(key, root) of the classes that the passes unite with another; root is a component's smallest key."""
    codes = classes.select("key", "label", "size", "vector").mapInArrow(_keyed, "key long, label long, size long, pass int, code long")
    order = ranked(codes, ["pass", "label", "size", "code", "key"], "rank")
    chunk, block = F.floor(F.col("rank") / (CHUNK * BLOCK)), F.floor(F.col("rank") / BLOCK)
    # The first block of a chunk goes to the chunk before as well, whose last block it follows.
    order = order.withColumn("chunk", F.explode(F.when((block % CHUNK == 0) & (chunk > 0), F.array(chunk, chunk - 1)).otherwise(F.array(chunk))))
    rows = order.join(classes.select("key", "vector"), "key").select("key", "label", "size", "pass", "rank", "chunk", "vector")
    links = written(rows.groupBy("chunk").applyInArrow(_passes(BLOCK), "a long, b long"), "links")
    return components(links).select(F.col("id").alias("key"), "root")


def counted(members: DataFrame) -> DataFrame:
    """(key, links) of the classes of components (key, root, n, code, vector): rows of other classes that each links with."""
    largest = members.groupBy("root").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    step = BLOCK * min(32, max(4, largest // (64 * BLOCK)))
    places = ranked(members, ["root", "code", "key"], "rank").withColumn("tile", F.floor(F.col("rank") / step))
    wide = kept(places.groupBy("root").agg(F.min("tile").alias("lo"), F.max("tile").alias("hi")).where("hi > lo"))  # fewer than there are tiles
    sent = places.join(wide, "root", "left").withColumn("other", F.explode(F.sequence(F.coalesce("lo", "tile"), F.coalesce("hi", "tile"))))
    sent = sent.select("key", "root", "n", "vector", "rank", "tile", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"))
    return sent.groupBy("one", "two").applyInArrow(_counter(BLOCK), "key long, links long").groupBy("key").agg(F.sum("links").alias("links"))


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row a vector: vec_id, n_links (others it links with), component_id (smallest id reached) and kept."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("embedding"))
    rows = written(rows.mapInArrow(_checked, "vec_id long, label long, vector binary").withColumn("same", F.sha2("vector", 256)), "vectors")
    able = rows.where("vector is not null and label is not null and vec_id is not null")
    classes = able.groupBy("label", "same").agg(F.min("vec_id").alias("cid"), F.count("*").alias("n"), F.first("vector").alias("vector"))
    classes = kept(classes.withColumns({"size": F.octet_length("vector").cast("long"), "key": F.monotonically_increasing_id()}))
    roots = kept(united(classes))
    members = classes.join(roots, "key")
    first = members.select("key", "label", "size", "vector").mapInArrow(_keyed, "key long, label long, size long, pass int, code long").where("pass = 0").select("key", "code")
    links = counted(members.select("key", "root", "n", "vector").join(first, "key"))
    least = members.groupBy("root").agg(F.min("cid").alias("component_id"))
    of = classes.select("key", "label", "same", "cid", "n").join(links, "key", "left").join(roots, "key", "left").join(least, "root", "left")
    of = kept(of.select("label", "same", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "cid").alias("component_id")))
    loose = rows.where("vector is null or label is null or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = able.select("vec_id", "label", "same").join(of, ["label", "same"]).select("vec_id", "n_links", "component_id").unionAll(loose)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
