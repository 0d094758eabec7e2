"""Packing documents into sequences by exact complements, then best fit.

Documents become token ids with an end id; those longer than a sequence are
cut into whole sequences and a rest. Packing needs only how many pieces there
are of each length, which is at most 2048 numbers however many documents
there are. The plan takes lengths from the longest down; a gap is filled
exactly by one length, a pair or a triple whose sum it is, looked up in
indexes of the available singles and pair sums, which follow the counts as
they run out, as often as the counts allow. What is left is packed by best
fit, again in whole groups of equal sequences.
A piece finds its place by its rank among pieces of its length; ranks come
from range partitions, so a length that a third of all pieces have is spread.

Defined cases: a null text is empty and is one piece, the end id alone. Rows
with equal or null ids are documents of their own; pieces of equal length are
placed by id, piece, start and checksum, and those that agree in all of them
are alike. Empty tables give empty results. Columns other than the two that are named aren't read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, pieces_of, ranked, tidy
from .encoding import AT_ONCE, encoder, tokenizer_path

ROOM = 2048
#: Bytes of chunks that a process remembers; fewer than elsewhere, as its memory stays in use by later stages.
REMEMBERED = 80 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(path: str, keeps_spaces: bool, end_id: int, room: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for every in batches for part in pieces_of(every, "text", AT_ONCE)):
            docs, done = batch.column(0).to_pylist(), 0
            for ids, counts in encoder(path, keeps_spaces, REMEMBERED)(batch.column(1).to_pylist()):
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id).astype("<u4")
                ends += np.arange(1, len(ends) + 1)
                rows = defaultdict(list)
                for k, (i, j) in enumerate(zip(np.concatenate([[0], ends]), ends)):  # noqa: B905
                    for piece, a in enumerate(range(i, j, room)):
                        own = ids[a : min(j, a + room)]
                        rows["doc_id"].append(docs[done + k])
                        rows["piece"].append(piece)
                        rows["start"].append(a - i)
                        rows["length"].append(len(own))
                        rows["ids_crc32"].append(zlib.crc32(own.tobytes()))
                        if with_ids:
                            rows["ids"].append(own)
                done += len(counts)
                types = {"piece": pa.int32(), "ids": pa.list_(pa.int32())}
                yield pa.RecordBatch.from_pydict({c: pa.array([x.astype(np.int32) for x in v] if c == "ids" else v, types.get(c, pa.int64())) for c, v in rows.items()})

    return cut


def pieces(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = "word_bpe_49k.json", keeps_spaces: bool = False, end_id: int = 0, room: int = ROOM, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: doc_id, piece, start, length, ids_crc32 and, if asked for, ids."""
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(tidy("encoding", _cutter(tokenizer_path(tokenizer), keeps_spaces, end_id, room, with_ids)), PIECES + (", ids array<int>" if with_ids else ""))


def _pair(count: np.ndarray, total: int) -> list[int] | None:
    """Two available lengths whose sum is ``total``, the longer one as long as can be."""
    some = np.flatnonzero(count[:total])
    fits = some[(count[total - some] > 0) & ((2 * some != total) | (count[some] >= 2))]
    return [int(fits[-1]), total - int(fits[-1])] if len(fits) else None


def _pair_sums(count: np.ndarray) -> np.ndarray:
    """The index of pair sums: whether each number is the sum of two available lengths."""
    have, size = count > 0, 2 * len(count)
    ways = np.rint(np.fft.irfft(np.fft.rfft(have.astype(float), size) ** 2, size)).astype(np.int64)
    ways[: 2 * len(count) : 2] -= have  # a length with itself
    sums = ways > 0
    sums[: 2 * len(count) : 2] |= count >= 2
    return sums


def fillers(count: np.ndarray, gap: int, most: int) -> list[int] | None:
    """At most ``most`` (three) available lengths whose sum is ``gap``; few and long ones first, None if there are none."""
    if most >= 1 and count[gap]:
        return [gap]
    if most >= 2 and (pair := _pair(count, gap)):
        return pair
    if most >= 3:
        some = np.flatnonzero(count[:gap])
        for a in some[_pair_sums(count)[gap - some]][::-1].tolist():
            count[a] -= 1
            pair = _pair(count, gap - a)
            count[a] += 1
            if pair:
                return [a, *pair]
    return None


def planned(counts: dict[int, int], room: int, most: int) -> list[tuple[list[int], int]]:
    """Patterns by exact fills of gaps with at most ``most`` lengths, then best fit for what is left."""
    count = np.zeros(room + 1, np.int64)
    for length, n in counts.items():
        count[length] = n
    patterns, left = [], {}

    def take(pattern: list[int]) -> None:
        times = min(int(count[x]) // pattern.count(x) for x in pattern)
        for x in pattern:
            count[x] -= times
        patterns.append((pattern, times))

    for length in range(room, 0, -1):
        while count[length]:
            count[length] -= 1
            more = [] if length == room else fillers(count, room - length, most)
            count[length] += 1
            if more is None:
                left[length], count[length] = int(count[length]), 0
            else:
                take([length, *more])
    bins: dict[int, list[tuple[list[int], int]]] = defaultdict(list)  # by gap: sequences with that gap
    for length, n in sorted(left.items(), reverse=True):
        while n:
            gap = next((g for g in range(length, room) if bins[g]), None)
            if gap is None:  # a new sequence takes as many as it holds
                each = min(room // length, n)
                times = n // each
                bins[room - each * length].append(([length] * each, times))
                n -= each * times
                continue
            pattern, times = bins[gap].pop()
            each = min(gap // length, n)
            used = min(times, n // each)
            bins[gap - each * length].append((pattern + [length] * each, used))
            if times > used:
                bins[gap].append((pattern, times - used))
            n -= each * used
    return patterns + [x for g in sorted(bins) for x in bins[g]]


def plan(counts: dict[int, int], room: int = ROOM) -> list[tuple[list[int], int]]:
    """Patterns (lengths of a sequence, how many such sequences) that use every piece once.

    Exact fills take short pieces that others may need more, so plans with
    three, two, one and no lengths in a fill are made and the one with the
    fewest sequences holds (of equal ones that with most in a fill): there are
    never more sequences than best fit decreasing makes.
    """
    return min((planned(counts, room, most) for most in (3, 2, 1, 0)), key=lambda patterns: sum(n for _, n in patterns))


def places(patterns: list[tuple[list[int], int]], room: int = ROOM) -> np.ndarray:
    """Rows (length, first rank, first sequence, lengths in a row, offset), in order: where pieces of a length go by rank."""
    rank, sequence, rows = defaultdict(int), 0, []
    for pattern, times in patterns:
        offset = 0
        for length in sorted(set(pattern), reverse=True):
            each = pattern.count(length)
            rows.append((length, rank[length], sequence, each, offset))
            rank[length] += each * times
            offset += each * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _placer(table: np.ndarray, before: np.ndarray):
    keys = table[:, 0] << 48 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() - before[length]
            row = table[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            own, inner = np.divmod(rank - row[:, 1], row[:, 3])
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(row[:, 2] + own), pa.array(row[:, 4] + inner * length)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return place


def packed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    rows = kept(pieces(df, id_col, text_col, room=room))
    counts = {r[0]: r[1] for r in rows.groupBy("length").count().collect()}  # a number a length: room numbers at most
    of = np.zeros(room + 2, np.int64)
    for length, n in counts.items():
        of[length + 1] = n
    before = np.cumsum(of)
    rows = ranked(rows, ["length", "doc_id", "piece", "ids_crc32"], "rank")
    return rows.mapInArrow(tidy("encoding", _placer(places(plan(counts, room), room), before)), f"{PIECES}, sequence_id long, offset long")


def sequences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", room: int = ROOM) -> DataFrame:
    """The packed sequences: sequence_id and ids. Ids of documents must be unique; a sequence holds ``room`` ids at most."""
    own = pieces(df, id_col, text_col, room=room, with_ids=True).select("doc_id", "piece", "ids")
    rows = packed(df, id_col, text_col, room).join(own, ["doc_id", "piece"])
    return rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("x")).select("sequence_id", F.flatten("x.ids").alias("ids"))
