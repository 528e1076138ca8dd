"""Packing of tokenised documents into sequences by matching large items first.

Documents become pieces of at most ``capacity`` tokens.  Which pieces share a
sequence depends on their lengths alone, and there are at most ``capacity``
different lengths, so the driver plans on the histogram of lengths, whatever
the number of documents:

* pieces over a third of the capacity are matched greedily, the longest first,
  each with the longest partner that still fits (so at most two in a bin);
* shorter pieces, the longest first, go to the bin with the smallest gap that
  holds them.

A plan is a list of segments: pieces of one length with ranks in a range go to
consecutive bins, so many in each.  The number of segments grows with the
number of lengths, not of pieces.  Ranks are counted within (length, bucket)
groups, so a length that most pieces have is spread over all tasks.

Defined cases: null text counts as empty, an empty text is one piece holding
the end id; null ids and repeated rows are pieces like any others; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import map_texts, stored
from .tokens import ENCODE_BYTES, encoder
from .words import slices, text_buffer

CAPACITY = 2048
_RANKS = 1 << 40


def plan_bins(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Segments ``(length, first rank, first bin, pieces in each bin, place in the bin)`` and the number of bins.

    A segment runs to the next one of its length; rank ``r`` goes to bin ``first bin + (r - first rank) // each``.
    """
    left = {n: c for n, c in counts.items() if c}
    ranks = dict.fromkeys(left, 0)
    segments: list[tuple[int, int, int, int, int]] = []
    gaps: list[int] = []                               # sorted, distinct
    open_bins: dict[int, list[tuple[int, int]]] = {}   # gap -> [(first bin, number of bins)]
    bins = 0

    def put(length: int, first_bin: int, n_bins: int, each: int, place: int, pieces: int) -> None:
        segments.append((length, ranks[length], first_bin, each, place))
        ranks[length] += pieces
        left[length] -= pieces
        gap = capacity - place - each * length
        if gap > 0 and n_bins:
            if gap not in open_bins:
                insort(gaps, gap)
                open_bins[gap] = []
            open_bins[gap].append((first_bin, n_bins))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        k = bisect_left(large, capacity - a + 1) - 1
        while k >= 0 and (not left[large[k]] or large[k] == a and left[a] < 2):
            if not left[large[k]]:
                large.pop(k)
            k -= 1
        if k < 0:
            put(a, bins, left[a], 1, 0, n := left[a])
        elif large[k] == a:
            put(a, bins, left[a] // 2, 2, 0, 2 * (n := left[a] // 2))
        else:
            b, n = large[k], min(left[a], left[large[k]])
            segments.append((a, ranks[a], bins, 1, 0))
            ranks[a] += n
            left[a] -= n
            put(b, bins, n, 1, a, n)
        bins += n
        large = [x for x in large if left[x]] if not left[a] else large
    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            k = bisect_left(gaps, length)
            if k == len(gaps):
                each = capacity // length
                n = -(-left[length] // each)
                insort(gaps, capacity)
                open_bins[capacity] = [(bins, n)]
                bins += n
                continue
            gap = gaps[k]
            first_bin, n = open_bins[gap].pop()
            if not open_bins[gap]:
                del open_bins[gap]
                gaps.pop(k)
            each = min(gap // length, left[length])
            use = min(n, left[length] // each)
            if use < n:
                if gap not in open_bins:
                    insort(gaps, gap)
                    open_bins[gap] = []
                open_bins[gap].append((first_bin + use, n - use))
            put(length, first_bin, use, each, capacity - gap, use * each)
    return segments, bins


def cut_pieces(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
               text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end, step = np.asarray([end_id], "<u4").tobytes(), 4 * capacity
        for part in slices(batches, "text", ENCODE_BYTES):
            raw, offsets = text_buffer(part.column("text"))
            whole = raw.tobytes()
            ids = [e + end for e in enc.encode([whole[a:b] for a, b in zip(offsets[:-1], offsets[1:])])]
            where = [(d, at) for d, x in enumerate(ids) for at in range(0, len(x), step)]
            doc = np.asarray([d for d, _ in where])
            at = np.asarray([a for _, a in where]) // 4
            cuts = [ids[d][a:a + step] for d, a in where]
            cols = [part.column("id").take(pa.array(doc)), pa.array(at // capacity, pa.int32()), pa.array(at, pa.int64()),
                    pa.array([len(c) // 4 for c in cuts], pa.int64()), pa.array([zlib.crc32(c) for c in cuts], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                cols.append(pa.array([np.frombuffer(c, "<u4").astype(np.int32) for c in cuts], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).transform(map_texts, cut, schema)


def _ranked(pieces: DataFrame) -> DataFrame:
    buckets = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = (dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    order = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    return (dealt.withColumn("nth", F.row_number().over(order)).join(bases, ["length", "bucket"])
            .withColumn("rank", F.col("base") + F.col("nth") - 1).drop("bucket", "base", "nth"))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``capacity``.

    ``pieces`` is read several times; hand over a stored frame."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}    # at most `capacity` rows
    segments, _ = plan_bins(counts, capacity)
    table = np.asarray(sorted(segments), np.int64).reshape(-1, 5)
    keys = table[:, 0] * _RANKS + table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            seg = table[np.searchsorted(keys, length * _RANKS + rank, "right") - 1]
            nth, each = rank - seg[:, 1], np.maximum(seg[:, 3], 1)
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(seg[:, 2] + nth // each), pa.array(seg[:, 4] + nth % each * length)],
                [*names, "sequence_id", "offset"])

    ranked = _ranked(pieces)
    names = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names) + ", sequence_id long, offset long"
    return ranked.transform(map_texts, place, schema)


def pack_documents(df: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document with their sequence and place in it."""
    pieces = stored(cut_pieces(df, tokenizer, capacity, end_id, id_col, text_col, with_ids), "pieces")
    return pack_pieces(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence (at most ``capacity`` of them), from pieces packed ``with_ids``."""
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
