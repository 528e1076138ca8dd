"""Benchmark phrases in documents by a distributed positional inverted index.

The index holds, for each slice of documents, the postings of every test term:
its sorted word positions.  It is stored once; the collection-wide frequency of
each term comes from it, and so does every match.  A phrase starts from the
postings of its rarest term, moved back by the term's place in the phrase, and
is intersected with the other terms' moved lists, the next rarest first.

Test terms and windows are handed to the tasks in blocks of at most about
``BLOCK_WORDS`` words, whatever the size of the benchmark: a longer benchmark
takes several passes.  Items are cut into overlapping parts for that, so one
very long item is no exception.

Words are compared by 64-bit hashes, so a window of ten words by 640 bits.

Defined cases: null texts have no words; an item without words has no window,
an item shorter than a window is one window; documents without words are
returned with zeros; repeated rows are returned as often as they occur;
repeated items count once each time their ``item_id`` differs; items without
an ``item_id`` count as one item, null, the last in ``items``; an empty
benchmark or document table gives zeros or no rows; further columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import broadcast_if_small, map_texts, stored
from .words import ALNUM_WORDS, runs, slices, split

WINDOW = 10
BLOCK_WORDS = 400_000
PART_WORDS = 4096
_CANDIDATES = 2_000_000

INDEX = "doc_ids array<long>, keys array<long>, n_words array<int>, terms array<int>, counts array<int>, positions binary"
HITS = "doc_id long, key long, n_words long, spans array<struct<start:int,end:int>>, items array<long>"


def _item_parts(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Rows ``(item_id, words)``: word hashes of at most PART_WORDS words; neighbours overlap by a window less one."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            words = split(part.column("text"), ALNUM_WORDS, lower=True)
            h = words.hashes().view(np.int64)
            ids, found = [], []
            for item, a, b in zip(part.column("id").to_pylist(), words.first[:-1], words.first[1:]):
                for at in range(a, max(b - window + 1, a + 1) if b > a else a, PART_WORDS - window + 1):
                    ids.append(item)
                    found.append(h[at:min(b, at + PART_WORDS)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             ["item_id", "words"])

    return benchmark.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).transform(map_texts, parts, "item_id long, words array<long>")


def _blocks(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> Iterator[tuple[np.ndarray, list]]:
    """Items' parts, a bounded block at a time: sorted test terms and ``[(item, term numbers)]``."""
    # rows that repeat an item are one; different items of one text are dealt apart by their ids
    parts = _item_parts(benchmark, window, id_col, text_col).distinct()
    total = parts.select(F.sum(F.size("words"))).head()[0] or 0
    if total > BLOCK_WORDS:
        parts = stored(parts, "benchmark")
    n = -(-total // BLOCK_WORDS)
    for k in range(n):
        mine = parts if n == 1 else parts.filter(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == k)
        rows = [(r["item_id"], np.asarray(r["words"], np.int64).view(np.uint64)) for r in mine.collect()]
        if rows:
            terms = np.unique(np.concatenate([w for _, w in rows]))
            yield terms, [(item, np.searchsorted(terms, w)) for item, w in rows]


def keyed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text of each row with a key that tells repeated rows apart."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"),
                     F.monotonically_increasing_id().alias("key"))


def build_index(rows: DataFrame, terms: np.ndarray) -> DataFrame:
    """Postings of the given terms (sorted word hashes), by slices of ``keyed_rows``.

    Positions count words over the slice and skip one between documents, so no window crosses over."""
    shared = rows.sparkSession.sparkContext.broadcast(terms)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for part in slices(batches, "text"):
            words = split(part.column("text"), ALNUM_WORDS, lower=True)
            h = words.hashes()
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            mine = np.flatnonzero(known[at] == h)
            term = at[mine]
            order = np.argsort(term, kind="stable")
            where = (mine + words.doc[mine])[order].astype("<i4")
            found, counts = np.unique(term, return_counts=True)
            lists = [pa.array([x], pa.list_(k)) for x, k in (
                (part.column("id").to_pylist(), pa.int64()), (part.column("key").to_pylist(), pa.int64()),
                (np.diff(words.first), pa.int32()), (found, pa.int32()), (counts, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*lists, pa.array([where.tobytes()], pa.binary())],
                                             ["doc_ids", "keys", "n_words", "terms", "counts", "positions"])

    return rows.transform(map_texts, postings, INDEX)


def term_counts(index: DataFrame, n_terms: int) -> np.ndarray:
    """How often each test term occurs in all documents (one number for each term of the block)."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("n"))
    out = np.zeros(n_terms, np.int64)
    for t, n in pairs.collect():
        out[t] = n
    return out


def _names(parts: list) -> list:
    """The distinct item ids in order, a null one last."""
    return sorted({item for item, _ in parts}, key=lambda item: (item is None, item or 0))


def _windows(parts: list, frequency: np.ndarray, size: int) -> list[tuple]:
    """Distinct windows by their length: terms, offsets by rarity, and the places in ``_names`` of the items that hold each."""
    out = []
    place = {item: k for k, item in enumerate(_names(parts))}
    by_length: dict[int, list] = {}
    for item, words in parts:
        n = min(size, len(words))
        w = np.lib.stride_tricks.sliding_window_view(words, n)
        by_length.setdefault(n, []).append((item, w))
    for n, found in by_length.items():
        every = np.concatenate([w for _, w in found])
        owner = np.repeat([place[item] for item, _ in found], [len(w) for _, w in found]).astype(np.int64)
        distinct, which = np.unique(every, axis=0, return_inverse=True)
        occurs = (frequency[distinct] > 0).all(axis=1)       # others cannot occur in any document
        pairs = np.unique(np.stack([which.ravel(), owner], axis=1), axis=0)
        pairs = pairs[occurs[pairs[:, 0]]]
        renumber = np.cumsum(occurs) - 1
        distinct = distinct[occurs]
        if len(distinct):
            rarity = np.argsort(frequency[distinct], axis=1, kind="stable")
            first = np.searchsorted(renumber[pairs[:, 0]], np.arange(len(distinct) + 1))
            out.append((n, distinct.astype(np.int32), rarity, first, pairs[:, 1]))
    return out


class _Slice:
    """One index row, opened."""

    def __init__(self, n_words: np.ndarray, terms: np.ndarray, counts: np.ndarray, positions: bytes, n_terms: int):
        self.size = np.zeros(n_terms, np.int64)
        self.size[terms] = counts
        self.at = np.concatenate(([0], np.cumsum(self.size)))
        self.positions = np.frombuffer(positions, "<i4").astype(np.int64)
        self.first = np.concatenate(([0], np.cumsum(n_words + 1)))          # a document's first position
        self.pad = 2 * WINDOW + 64
        self.term_at = np.full(int(self.first[-1]) + 2 * self.pad, -1, np.int32)
        self.term_at[self.positions + self.pad] = np.repeat(terms, counts)

    def list_of(self, term: int) -> np.ndarray:
        return self.positions[self.at[term]:self.at[term + 1]]

    def phrases(self, n: int, windows: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window numbers and first positions of all exact occurrences."""
        live = np.flatnonzero((self.size[windows] > 0).all(axis=1))
        rarest = windows[live, rarity[live, 0]]
        many = self.size[rarest]
        found_w, found_p = [], []
        edges = np.searchsorted(np.cumsum(many), np.arange(0, many.sum() + 1, _CANDIDATES)) if len(live) else []
        for a, b in zip(edges, [*edges[1:], len(live)]):
            part, c = live[a:b], many[a:b]
            if not len(part):
                continue
            w = np.repeat(part, c)
            inside = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
            p = self.positions[np.repeat(self.at[rarest[a:b]], c) + inside] - rarity[w, 0]
            for k in range(1, n):
                o = rarity[w, k]
                same = self.term_at[np.maximum(p + o + self.pad, 0)] == windows[w, o]
                w, p = w[same], p[same]
            found_w.append(w)
            found_p.append(p)
        if not found_w:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found_w), np.concatenate(found_p)


def _match_block(index: DataFrame, parts: list, frequency: np.ndarray, size: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast((_windows(parts, frequency, size), _names(parts), len(frequency)))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, names, n_terms = shared.value
        names = pa.array(names, pa.int64())
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda c: batch.column(c)[k].values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
                n_words = get("n_words").astype(np.int64)
                s = _Slice(n_words, get("terms"), get("counts"), batch.column("positions")[k].as_py(), n_terms)
                cover = np.zeros(int(s.first[-1]) + 1, np.int32)
                pairs = [np.zeros((0, 2), np.int64)]
                for n, terms, rarity, first, owners in windows:
                    w, p = s.phrases(n, terms, rarity)
                    np.add.at(cover, p, 1)
                    np.add.at(cover, p + n, -1)
                    doc = np.searchsorted(s.first, p, "right") - 1
                    dw = np.unique(np.stack([doc, w], axis=1), axis=0)
                    many = (first[1:] - first[:-1])[dw[:, 1]]
                    inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    pairs.append(np.stack([np.repeat(dw[:, 0], many), owners[np.repeat(first[dw[:, 1]], many) + inside]], axis=1))
                pairs = np.unique(np.concatenate(pairs), axis=0)
                lo, hi = runs(np.cumsum(cover[:-1]) > 0)
                doc = np.searchsorted(s.first, lo, "right") - 1
                n_docs = len(n_words)
                spans = pa.StructArray.from_arrays(
                    [pa.array((lo - s.first[doc]).astype(np.int32)), pa.array((hi - s.first[doc]).astype(np.int32))], ["start", "end"])
                cut = lambda keys: pa.array(np.searchsorted(keys, np.arange(n_docs + 1)).astype(np.int32))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values, batch.column("keys")[k].values, pa.array(n_words), pa.ListArray.from_arrays(cut(doc), spans),
                     pa.ListArray.from_arrays(cut(pairs[:, 0]), names.take(pa.array(pairs[:, 1])))],
                    ["doc_id", "key", "n_words", "spans", "items"])

    return index.transform(map_texts, match, HITS)


def drop_contaminated(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
                      item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The input's rows and columns without the documents that hold an occurring window.

    Rows are known by a hash of their text, so equal texts share their fate."""
    name = "__phrase_row"
    texts = df.select(F.xxhash64(F.col(f"`{text_col}`")).alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    hits = stored(phrase_matches(texts, benchmark, window, item_col=item_col, item_text=item_text)
                  .filter(F.size("spans") > 0).select("doc_id").distinct(), "contaminated")
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    return rows.join(broadcast_if_small(hits), F.xxhash64(F.col(name)[text_col]) == F.col("doc_id"), "left_anti").select(f"{name}.*")


def phrase_matches(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``spans`` (word ranges covered by occurring windows, apart from each
    other and in order) and ``items`` (sorted ids of the items they belong to)."""
    rows, found = keyed_rows(df, id_col, text_col), []
    for k, (terms, parts) in enumerate(_blocks(benchmark, window, item_col, item_text)):
        if k == 1:
            # keys must be the same for every block: the first block is done again over stored rows
            rows = stored(rows, "rows")
            found = [_match_block(stored(build_index(rows, t), "postings"), p, f, window) for t, p, f in first]
        index = stored(build_index(rows, terms), "postings")
        frequency = term_counts(index, len(terms))
        first = [(terms, parts, frequency)]
        found.append(_match_block(index, parts, frequency, window))
    if not found:
        found = [_match_block(build_index(rows, np.zeros(1, np.uint64)), [], np.zeros(1, np.int64), window)]
    out = found[0].drop("key") if len(found) == 1 else _joined_blocks(found)
    return out.withColumnRenamed("doc_id", id_col)


def _joined_blocks(found: list[DataFrame]) -> DataFrame:
    """Rows of the same document from several benchmark blocks as one."""
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    one = every.groupBy("key").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("every_span"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = F.expr("""
        aggregate(every_span, cast(array() as array<struct<start:int,end:int>>), (acc, s) ->
          if(size(acc) > 0 and element_at(acc, -1).end >= s.start,
             concat(slice(acc, 1, size(acc) - 1),
                    array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, s.end)))),
             concat(acc, array(s))))""")
    return one.select("doc_id", "n_words", merged.alias("spans"), "items")


def proximity_matches(df: DataFrame, benchmark: DataFrame, terms: int = 3, span: int = 20, id_col: str = "doc_id",
                      text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Places where the ``terms`` rarest distinct words of an item lie within ``span`` words around the rarest one.

    Rows ``(id, item_id, position)``: the word position of the rarest term.  Items with fewer distinct words are
    asked for all they have; an item with a word that no document holds has no match.
    """
    found = []
    for known, parts in _blocks(benchmark, WINDOW, item_col, item_text):
        index = stored(build_index(keyed_rows(df, id_col, text_col), known), "postings")
        frequency = term_counts(index, len(known))
        wanted = []
        for item, words in parts:
            distinct = np.unique(words)
            rare = distinct[np.argsort(frequency[distinct], kind="stable")][:terms]
            if len(rare) and (frequency[rare] > 0).all():
                wanted.append((item, rare))
        shared = df.sparkSession.sparkContext.broadcast((wanted, len(known)))

        def near(batches, shared=shared):
            asked, n_terms = shared.value
            for batch in batches:
                for k in range(batch.num_rows):
                    get = lambda c: batch.column(c)[k].values.to_numpy(zero_copy_only=False)  # noqa: E731, B023
                    s = _Slice(get("n_words").astype(np.int64), get("terms"), get("counts"), batch.column("positions")[k].as_py(), n_terms)
                    ids, items, places = [], [], []
                    names = batch.column("doc_ids")[k].as_py()
                    for item, rare in asked:
                        p = s.list_of(rare[0])
                        doc = np.searchsorted(s.first, p, "right") - 1
                        for t in rare[1:]:
                            other = s.list_of(t)
                            lo = np.maximum(p - span, s.first[doc])
                            hi = np.minimum(p + span, s.first[doc + 1] - 1)
                            ok = np.searchsorted(other, lo) < np.searchsorted(other, hi, "right")
                            p, doc = p[ok], doc[ok]
                        ids += [names[d] for d in doc]
                        items += [item] * len(p)
                        places += (p - s.first[doc]).tolist()
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(items, pa.int64()), pa.array(places, pa.int64())],
                                                     ["doc_id", "item_id", "position"])

        found.append(index.transform(map_texts, near, "doc_id long, item_id long, position long"))
    if not found:
        return df.sparkSession.createDataFrame([], "doc_id long, item_id long, position long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.distinct()
