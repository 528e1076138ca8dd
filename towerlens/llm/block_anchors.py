"""Repeated passages by fixed-block anchors.

Every document's non-overlapping blocks of ``block`` words are the index; each
rolling window of ``block`` words of every document probes it.  A passage of
``2 * block`` words that occurs twice holds a whole block of either document,
so no repeat of that length escapes.  Blocks found more than once are anchors;
only windows of ``2 * block`` words around anchors go further.  Of equal
windows the one in the smallest document stays, and runs of repeated windows
are the maximal exact repeats that are removed.

Nothing is done pair by pair.  What very many documents share would still meet
in a few buckets, so windows that a sample shows in more than HOT_SHARE of the
documents take another way: their probes count as anchored without being sent,
and the smallest document of each such window is found by an aggregation that
combines before its shuffle; the table of at most HOT_WINDOWS of them is then
broadcast.  The sample decides the way, never the result.

Probes travel as packed arrays: for each
document and bucket, four bytes per probe.  The bucket of a window follows from
the least hash of its FINE-word windows: equal windows have equal buckets, and
neighbouring windows mostly share one, so the number of (document, bucket)
pairs stays far below that of windows however many buckets there are.  Where a
sample shows such a least hash to be common, windows below it are dealt by the
hash of all their words, so a short phrase that very many texts share does not
fill one bucket.  Anchors
may be false now and then (31 bits within a bucket); windows decide by another
64-bit hash of all their words.

Defined cases: null text has no words; a text shorter than a window is kept
whole; a null id counts as larger than any other, and rows that repeat an id
never remove each other's words; an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import joined_small, map_texts, releasing, stored
from .words import SPACE_SEPARATED, WORD_BASES, mix, runs, sliding_least, slices, split, window_hashes, window_starts

BLOCK = 25
FINE = 5
PROBES_PER_BUCKET = 1_000_000
HOT_SAMPLE = 2000            # documents looked at
HOT_SHARE = 0.02
HOT_WINDOWS = 100_000
_HELD_BYTES = 24 << 20
_NO_ID = np.iinfo(np.int64).max

_ROWS = "bucket int, ids binary, keys binary, counts binary, hashes binary, places binary"
_ANSWER = "id long, key long, bucket int, found binary"


class _Dealer:
    """Collects values by bucket and document and hands them out as one row per bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.held = buckets, 0
        self.parts: dict[int, list[tuple[bytes, ...]]] = {}

    def add(self, bucket: np.ndarray, doc: np.ndarray, ids: np.ndarray, keys: np.ndarray, hashes: np.ndarray,
            places: np.ndarray | None = None) -> None:
        order = np.argsort(bucket.astype(np.uint16 if self.buckets <= 65536 else np.int64), kind="stable")
        b, d = bucket[order], doc[order]
        h, p = hashes[order], None if places is None else places[order]
        new = np.flatnonzero(np.concatenate(([True], (b[1:] != b[:-1]) | (d[1:] != d[:-1])))) if len(b) else np.zeros(0, np.int64)
        counts = np.diff(np.append(new, len(b))).astype(np.int32)
        gb, gd = b[new], d[new]
        cut = np.flatnonzero(np.concatenate(([True], gb[1:] != gb[:-1]))) if len(gb) else []
        for lo, hi in zip(cut, [*cut[1:], len(gb)]):
            first, last = new[lo], new[hi] if hi < len(new) else len(b)
            row = (ids[gd[lo:hi]].tobytes(), keys[gd[lo:hi]].tobytes(), counts[lo:hi].tobytes(), h[first:last].tobytes(),
                   b"" if p is None else p[first:last].tobytes())
            self.parts.setdefault(int(gb[lo]), []).append(row)
            self.held += sum(map(len, row))

    def rows(self, all_of_it: bool) -> Iterator[pa.RecordBatch]:
        if self.held and (all_of_it or self.held >= _HELD_BYTES):
            names = sorted(self.parts)
            for at in range(0, len(names), 64):
                some = names[at:at + 64]
                cols = [pa.array([b"".join(r[k] for r in self.parts[n]) for n in some], pa.binary()) for k in range(5)]
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), *cols],
                                                 ["bucket", "ids", "keys", "counts", "hashes", "places"])
            self.parts, self.held = {}, 0


def _column(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _answer(table: pa.Table, counts: np.ndarray, found: np.ndarray, lengths: np.ndarray) -> pa.Table:
    """One row per document with any find: ``found`` holds their bytes one after the other."""
    has = np.flatnonzero(lengths > 0)
    offsets = np.concatenate(([0], np.cumsum(lengths[has]))).astype(np.int32)
    ids, keys = _column(table, "ids", "<i8")[has], _column(table, "keys", "<i8")[has]
    blob = pa.Array.from_buffers(pa.binary(), len(has), [None, pa.py_buffer(offsets), pa.py_buffer(found.tobytes())])
    bucket = table.column("bucket")[0].as_py()
    return pa.table({"id": pa.array(ids), "key": pa.array(keys), "bucket": pa.array(np.full(len(has), bucket, np.int32)), "found": blob})


def _anchors(table: pa.Table) -> pa.Table:
    """For one bucket: which probes meet a block that occurs more than once, as bits in the order of the probes."""
    values, counts = _column(table, "hashes", "<u4"), _column(table, "counts", "<i4").astype(np.int64)
    probe = values >> 1
    blocks = np.unique(probe[(values & 1).astype(bool)])
    if len(blocks):
        at = np.searchsorted(blocks, probe)
        at[at == len(blocks)] = 0
        meets = blocks[at] == probe
        times = np.bincount(at[meets], minlength=len(blocks))
        meets &= times[at] > 1
    else:
        meets = np.zeros(len(probe), bool)
    first = np.concatenate(([0], np.cumsum(counts)))
    any_of = np.add.reduceat(meets, first[:-1]) > 0 if len(counts) else np.zeros(0, bool)
    size = np.where(any_of, -(-counts // 8), 0)
    base = np.concatenate(([0], np.cumsum(size)))[:-1] * 8
    doc = np.repeat(np.arange(len(counts)), counts)
    bits = np.zeros(int(size.sum()) * 8, np.uint8)
    mine = np.flatnonzero(meets)
    bits[base[doc[mine]] + mine - first[doc[mine]]] = 1
    return _answer(table, counts, np.packbits(bits), size)


def _repeats(table: pa.Table) -> pa.Table:
    """For one bucket of windows: the places of those that also occur in a smaller document."""
    counts = _column(table, "counts", "<i4").astype(np.int64)
    hashes, places = _column(table, "hashes", "<u8"), _column(table, "places", "<u4")
    doc = np.repeat(np.arange(len(counts)), counts)
    owner = _column(table, "ids", "<i8")[doc]
    order = np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(owner[order], new) if len(h) else owner
    smallest = np.empty(len(h), np.int64)
    smallest[order] = np.repeat(least, np.diff(np.append(new, len(h))))
    gone = np.flatnonzero(owner > smallest)
    lengths = np.bincount(doc[gone], minlength=len(counts)) * 4
    return _answer(table, counts, places[gone], lengths)


def _anchors_in(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < buckets:
            return _anchors(table)
        counts = _column(table, "counts", "<i4")
        return _answer(table, counts, np.ones(len(counts), np.uint8), np.ones(len(counts), np.int64))

    return run


def _repeats_in(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < buckets:
            return _repeats(table)
        counts = _column(table, "counts", "<i4").astype(np.int64)
        return _answer(table, counts, _column(table, "places", "<u4"), counts * 4)

    return run


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id (null: the largest), text, and a hash that tells texts of one id apart."""
    out = df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NO_ID)).alias("id"), F.col(f"`{text_col}`").alias("text"))
    return out.withColumn("key", F.xxhash64("id", "text"))


_NONE = np.zeros(0, np.uint64)


def _least_fine(word: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """The least hash of the FINE-word windows of each window of ``size`` words."""
    fine = min(FINE, size)
    return sliding_least(window_hashes(word, fine, WORD_BASES[2]), size - fine + 1)[at]


def _windows(word: np.ndarray, first: np.ndarray, size: int, base: int, buckets: int,
             spread: np.ndarray = _NONE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all rolling windows of ``size`` words: the first positions, the hashes, and the buckets.

    Windows whose least fine hash is in ``spread`` are dealt by all of their words instead; equal ones still meet."""
    at = np.flatnonzero(window_starts(first, size))
    least, whole = _least_fine(word, size, at), window_hashes(word, size, base)[at]
    by = np.where(_among(least, spread)[0], mix(whole, 2), mix(least, 1))
    return at, whole, (by % np.uint64(buckets)).astype(np.int64)


def _hot(rows: DataFrame, size: int, base: int, fine: bool = False) -> np.ndarray:
    """Hashes, in order, of the windows of ``size`` words that a sample shows to be common, or, with ``fine``, of the
    least FINE-word windows in them."""
    total = rows.count()
    share = min(1.0, HOT_SAMPLE / max(total, 1))

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = split(part.column("text"), SPACE_SEPARATED)
            h = words.hashes()
            at, w, _ = _windows(h, words.first, size, base, 1)
            w = _least_fine(h, size, at) if fine else w
            once = np.unique(np.stack((words.doc[at], w.view(np.int64)), axis=1), axis=0)[:, 1]
            yield pa.RecordBatch.from_arrays([pa.array(once)], ["window"])

    counts = rows.select("text").sample(share, 23).transform(map_texts, seen, "window long").groupBy("window").count()
    common = counts.filter(F.col("count") >= max(3, HOT_SHARE * total * share)).orderBy(F.desc("count"), "window").limit(HOT_WINDOWS)
    return np.sort(np.asarray([r["window"] for r in common.select("window").collect()], np.int64).view(np.uint64))


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are known, and their places in the sorted known ones."""
    if not len(known):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values, at


def _smallest(rows: DataFrame, size: int, known: np.ndarray) -> np.ndarray:
    """The smallest id that holds each of the known windows."""
    out = np.full(len(known), _NO_ID)
    if len(known):
        shared = rows.sparkSession.sparkContext.broadcast(known)

        def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, "text"):
                words = split(part.column("text"), SPACE_SEPARATED)
                at, w, _ = _windows(words.hashes(), words.first, size, WORD_BASES[1], 1)
                hot, place = _among(w, shared.value)
                best = np.full(len(shared.value), _NO_ID)
                np.minimum.at(best, place[hot], part.column("id").to_numpy()[words.doc[at[hot]]])
                some = np.unique(place[hot])
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(best[some])], ["place", "id"])

        for place, smallest in rows.transform(map_texts, least, "place long, id long").groupBy("place").agg(F.min("id")).collect():
            out[place] = smallest
    return out


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Documents with repeats: ``(id, key, text, spans)``; spans are maximal word ranges to remove, in order."""
    rows = _keyed(df, id_col, text_col)
    size = rows.select(F.sum(F.length("text"))).head()[0] or 0
    buckets = max(1, -(-size // (6 * PROBES_PER_BUCKET)))       # about six characters a word
    # buckets from `buckets` on hold no windows, but pass on what is known of a document
    hot_grams = df.sparkSession.sparkContext.broadcast(_hot(rows, block, WORD_BASES[0]))
    # a phrase too short for a common window may still be the least of very many different ones (a line at the end of
    # texts): those would all meet in its bucket.  The least of 2 * block words is the least of some block of them
    spread = df.sparkSession.sparkContext.broadcast(_hot(rows, block, WORD_BASES[0], fine=True))
    hot = _hot(rows, 2 * block, WORD_BASES[1]) if len(hot_grams.value) else np.zeros(0, np.uint64)

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(2 * buckets)
        for part in slices(batches, "text"):
            words = split(part.column("text"), SPACE_SEPARATED)
            at, g, bucket = _windows(words.hashes(), words.first, block, WORD_BASES[0], buckets, spread.value)
            common, _ = _among(g, hot_grams.value)
            ids, keys = part.column("id").to_numpy(), part.column("key").to_numpy()
            marked = np.unique(words.doc[at[common]])
            dealer.add(buckets + keys[marked] % buckets, marked, ids, keys, np.zeros(len(marked), np.uint32))
            at, g, bucket = at[~common], g[~common], bucket[~common]
            doc = words.doc[at]
            indexed = ((at - words.first[doc]) % block == 0).astype(np.uint32)
            value = ((g & np.uint64(0x7FFFFFFF)).astype(np.uint32) << np.uint32(1)) | indexed
            dealer.add(bucket, doc, ids, keys, value)
            yield from dealer.rows(False)
        yield from dealer.rows(True)

    anchors = (rows.transform(map_texts, probes, _ROWS).groupBy("bucket").applyInArrow(releasing(_anchors_in(buckets)), _ANSWER)
               .groupBy("id", "key").agg(F.collect_list(F.struct("bucket", "found")).alias("anchors")))
    anchored = stored(joined_small(rows, stored(anchors, "anchors"), ["id", "key"]), "anchored")
    smallest = df.sparkSession.sparkContext.broadcast((hot, _smallest(anchored, 2 * block, hot)))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealer = _Dealer(2 * buckets)
        for part in slices(batches, "text"):
            words = split(part.column("text"), SPACE_SEPARATED)
            h = words.hashes()
            at, g, bucket = _windows(h, words.first, block, WORD_BASES[0], buckets, spread.value)
            common, _ = _among(g, hot_grams.value)
            hit = np.zeros(len(words.start) + 1, np.int32)
            hit[at[common] + 1] = 1
            at, bucket = at[~common], bucket[~common]
            cell = words.doc[at] * buckets + bucket
            order = np.argsort(cell, kind="stable")
            cells = cell[order]
            lists = part.column("anchors")
            entries = lists.flatten()
            owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            asked = entries.field("bucket").to_numpy()
            entries, owner, asked = entries.filter(pa.array(asked < buckets)), owner[asked < buckets], asked[asked < buckets]
            asked = owner * buckets + asked
            first, last = np.searchsorted(cells, asked), np.searchsorted(cells, asked, "right")
            for bits, a, b in zip(entries.field("found").to_pylist(), first, last):
                found = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
                hit[at[order[a:b][found.astype(bool)]] + 1] = 1
            seen = np.cumsum(hit)
            full, w, bucket = _windows(h, words.first, 2 * block, WORD_BASES[1], buckets, spread.value)
            # a window is of interest if a probe inside it met an anchor
            near = seen[full + block] > seen[full]
            full, w, bucket = full[near], w[near], bucket[near]
            ids, keys = part.column("id").to_numpy(), part.column("key").to_numpy()
            known, least = smallest.value
            common, place = _among(w, known)
            for chosen, where in ((~common, None), (common, buckets)):
                d, p, v, b = words.doc[full[chosen]], full[chosen], w[chosen], bucket[chosen]
                if where is not None:
                    later = ids[d] > least[place[chosen]]
                    d, p, v = d[later], p[later], v[later]
                    b = buckets + keys[d] % buckets
                dealer.add(b, d, ids, keys, v, (p - words.first[d]).astype(np.uint32))
            yield from dealer.rows(False)
        yield from dealer.rows(True)

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for entries in batch.column("found").to_pylist():
                p = np.frombuffer(b"".join(entries), "<u4").astype(np.int64)
                cover = np.zeros(int(p.max()) + 2 * block + 1, np.int32)
                np.add.at(cover, p, 1)
                np.add.at(cover, p + 2 * block, -1)
                out.append([{"start": int(a), "end": int(b)} for a, b in zip(*runs(np.cumsum(cover) > 0))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("key"), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["id", "key", "spans"])

    removed = (anchored.transform(map_texts, windows, _ROWS).groupBy("bucket").applyInArrow(releasing(_repeats_in(buckets)), _ANSWER)
               .groupBy("id", "key").agg(F.collect_list("found").alias("found"))
               .transform(map_texts, spans, "id long, key long, spans array<struct<start:int,end:int>>"))
    return joined_small(anchored.select("id", "key", "text"), stored(removed, "spans"), ["id", "key"])


_KEPT = "id long, key long, n_words long, n_removed long, kept_sha256 string"


def _cleaned(with_text: bool):
    """Words outside the spans, joined by one space."""
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            n_words, n_removed, kept = [], [], []
            spans = part.column("spans").to_pylist() if "spans" in part.schema.names else [[]] * part.num_rows
            for text, cuts in zip(part.column("text").to_pylist(), spans):
                words = (text or "").encode().split()
                n_words.append(len(words))
                n_removed.append(sum(c["end"] - c["start"] for c in cuts))
                for c in reversed(cuts):
                    del words[c["start"]:c["end"]]
                kept.append(b" ".join(words))
            cols = [part.column("id"), part.column("key"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
            names = ["id", "key", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                cols.append(pa.array([k.decode("utf-8", "replace") for k in kept]))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names)

    return clean


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK,
                   with_text: bool = False) -> DataFrame:
    """One row per document: id, ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text``.

    Without texts, whole documents and cleaned ones meet as short rows, so that only documents with repeats
    are moved."""
    schema = _KEPT + ", kept_text string" * with_text
    rows = _keyed(df, id_col, text_col)
    found = repeated_spans(df, id_col, text_col, block)
    # rows that repeat an id and a text have the same answer; each gets it once
    cleaned = found.dropDuplicates(["id", "key"]).select("id", "key", "text", "spans").transform(map_texts, _cleaned(with_text), schema)
    whole = rows.transform(map_texts, _cleaned(with_text), schema)
    new = cleaned.select("id", "key", *[F.col(c).alias(f"new_{c}") for c in cleaned.columns[2:]])
    out = whole.join(new, ["id", "key"], "left")
    pick = [F.when(F.col("new_n_words").isNull(), F.col(c)).otherwise(F.col(f"new_{c}")).alias(c) for c in cleaned.columns[2:]]
    return out.select(F.when(F.col("id") != _NO_ID, F.col("id")).alias(id_col), *pick)
