"""Document likelihood under all subword segmentations.

The vocabulary of an existing subword tokenizer is taken as it is.  A text is
its lower-cased words, each opened by the word mark, and an end; it is drawn
piece by piece, and any segmentation of a word into pieces may have produced
it.  ``score`` is the log10 of the summed probability of all segmentations,
by a forward recursion in log space; byte pieces make every text possible.

Piece weights start from the vocabulary's own scores (log probabilities in a
unigram model; a merge rank otherwise, read as a Zipf rank).  Expectation
maximisation over the training words then fits them: some rounds over the
HEAD_WORDS most frequent words, to have a good start cheaply, and a last one
over every distinct training word, as a Spark job that returns one number per
piece.

``base_score`` is an add-0.1 unigram over whole words.  Counts of the HEAD_WORDS
most frequent words travel to the tasks; the other words of a document are
joined with the full table of counts, so no frequent word is ever a join key.

Defined cases: null text counts as empty; an empty text is the end alone; a
table without training rows leaves the vocabulary's own weights and counts of
zero; repeated rows are scored each; an empty table gives an empty result;
further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_texts, stored
from .words import BYTE_BASE, SPACE_SEPARATED, _LOWER, mix, powers, slices, split, text_buffer

HEAD_WORDS = 100_000
HEAD_ROUNDS = 3
PRIOR_PIECES = 1000.0        # weight of the vocabulary's own scores, in pieces
LONG_BYTES = 8192            # longer words (texts without spaces) are worked on in stretches of this length
HEAD_BYTES = 64              # longer words are never among the head, which so has a bounded size
_SLICE = 4_000_000      # fewer distinct words to score than in smaller slices
_MARK = "▁".encode()
_LOG10 = math.log(10.0)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass
class Pieces:
    """Pieces that can occur in lower-cased words, by a two-level table on their hashes."""

    hashes: np.ndarray
    tables: list[np.ndarray]
    lengths: np.ndarray          # distinct byte lengths of multi-byte pieces
    byte_piece: np.ndarray       # piece number of each single byte
    prior: np.ndarray            # probabilities from the vocabulary's own scores; the last one is the end

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes, -1 for none."""
        out = np.full(h.shape, -1, np.int32)
        for level, table in enumerate(self.tables):
            at = table[(h >> np.uint64(20 * level)) & np.uint64(len(table) - 1)]
            ok = (at >= 0) & (self.hashes[at] == h)
            out[ok] = at[ok]
        return out


def _piece_hash(data: np.ndarray) -> np.ndarray:
    """Hashes of equally long byte strings, one a row."""
    up, _ = powers(BYTE_BASE, 4096)
    return mix((data.astype(np.uint64) + np.uint64(1)) @ up[:data.shape[1]] + np.uint64(data.shape[1]))


@lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=path)
    mark = _MARK.decode()
    own, scores, bytes_of = [], [], {}
    ranked = False
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            bytes_of[int(piece[3:5], 16)] = model.get_score(k)
        elif not (model.is_control(k) or model.is_unknown(k) or model.is_unused(k)):
            text = piece.encode()
            # words have the mark in front only, no spaces and no capitals A-Z
            if mark not in piece[1:] and not any(65 <= c <= 90 or c in (32, 9, 10, 11, 12, 13) for c in text):
                own.append(text)
                scores.append(model.get_score(k))
                ranked |= model.get_score(k) < -1000
    seen = dict(zip(own, scores))
    singles = {t[0]: s for t, s in seen.items() if len(t) == 1}
    own = [t for t in seen if len(t) > 1]
    scores = np.asarray([seen[t] for t in own], float)
    lowest = scores.min() if len(scores) else -1.0
    by_byte = np.asarray([singles.get(b, lowest) for b in range(256)], float)
    every = np.concatenate((scores, by_byte))
    weight = 1.0 / (2.0 - every) if ranked else np.exp(every)
    prior = np.concatenate((weight / weight.sum(), [1e-3]))
    hashes = np.zeros(len(own), np.uint64)
    by_length: dict[int, list[int]] = {}
    for k, t in enumerate(own):
        by_length.setdefault(len(t), []).append(k)
    for n, ks in by_length.items():
        hashes[ks] = _piece_hash(np.frombuffer(b"".join(own[k] for k in ks), np.uint8).reshape(-1, n))
    tables, left = [], np.arange(len(own))
    for level in range(3):
        table = np.full(1 << 20, -1, np.int32)
        slot = ((hashes[left] >> np.uint64(20 * level)) & np.uint64(len(table) - 1)).astype(np.int64)
        table[slot] = left
        tables.append(table)
        left = left[table[slot] != left]
    if len(left):
        raise ValueError("piece hashes collide")
    return Pieces(hashes, tables, np.asarray(sorted(by_length), np.int64), (len(own) + np.arange(256)).astype(np.int32), prior / prior.sum())


def _groups(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length at a time: their numbers, and their bytes behind the mark as a matrix."""
    size = end - start
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for part in np.split(order, cuts):
        if not len(part):
            continue
        n = int(size[part[0]])
        step = max(1, (1 << 19) // (n + 3))
        for at in range(0, len(part), step):
            which = part[at:at + step]
            m = np.empty((len(which), n + len(_MARK)), np.uint8)
            m[:, :len(_MARK)] = np.frombuffer(_MARK, np.uint8)
            m[:, len(_MARK):] = data[start[which][:, None] + np.arange(n)]
            yield which, m


def _arcs(pieces: Pieces, m: np.ndarray) -> dict[int, list[tuple[int, np.ndarray, np.ndarray]]]:
    """For each end position: (length, rows, piece numbers) of the pieces that end there."""
    n = m.shape[1]
    up, down = powers(BYTE_BASE, max(n + 1, 64))
    total = np.zeros((len(m), n + 1), np.uint64)
    np.cumsum((m.astype(np.uint64) + np.uint64(1)) * up[:n], axis=1, out=total[:, 1:])
    out: dict[int, list] = {j: [] for j in range(1, n + 1)}
    for size in pieces.lengths[pieces.lengths <= n]:
        h = mix((total[:, size:] - total[:, :-size]) * down[:n - size + 1] + np.uint64(size))
        found = pieces.find(h)
        for i in np.flatnonzero((found >= 0).any(axis=0)):
            rows = np.flatnonzero(found[:, i] >= 0)
            out[int(i) + int(size)].append((int(size), rows, found[rows, i]))
    return out


def _forward(pieces: Pieces, m: np.ndarray, arcs: dict, logp: np.ndarray, begun: np.ndarray | None = None) -> np.ndarray:
    """Log probability of what lies before each position; ``begun`` has those of the first positions."""
    alpha = np.full((len(m), m.shape[1] + 1), -np.inf)
    alpha[:, 0] = 0.0
    known = 1
    if begun is not None:
        known = begun.shape[1]
        alpha[:, :known] = begun
    for j in range(known, m.shape[1] + 1):
        a = alpha[:, j - 1] + logp[pieces.byte_piece[m[:, j - 1]]]
        for size, rows, piece in arcs[j]:
            a[rows] = np.logaddexp(a[rows], alpha[rows, j - size] + logp[piece])
        alpha[:, j] = a
    return alpha


def _stretches(pieces: Pieces, n: int) -> list[tuple[int, int, int]]:
    """A long word in stretches ``(from, first new position, to)``: each begins one longest piece early, so that every
    piece that ends in it lies inside."""
    reach = int(pieces.lengths.max(initial=1))
    return [(max(0, at - reach), at, min(n, at + LONG_BYTES)) for at in range(0, n, LONG_BYTES)]


def _long_forward(pieces: Pieces, word: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """``_forward`` of one long word (a matrix of one row), with the pieces of one stretch in memory at a time."""
    alpha = np.full(word.shape[1] + 1, -np.inf)
    alpha[0] = 0.0
    for a, new, b in _stretches(pieces, word.shape[1]):
        m = word[:, a:b]
        alpha[a:b + 1] = _forward(pieces, m, _arcs(pieces, m), logp, alpha[None, a:new + 1])[0]
    return alpha


def _long_counts(pieces: Pieces, word: np.ndarray, logp: np.ndarray, times: float, out: np.ndarray) -> None:
    """Adds the expected pieces of one long word, from the last stretch back."""
    alpha = _long_forward(pieces, word, logp)
    beta = np.full(len(alpha), -np.inf)
    beta[-1] = 0.0
    for a, new, b in reversed(_stretches(pieces, word.shape[1])):
        m = word[:, a:b]
        arcs = _arcs(pieces, m)
        for j in range(b, new, -1):
            one = pieces.byte_piece[m[:, j - a - 1]]
            found = [(1, one), *((size, piece) for size, _, piece in arcs[j - a])]
            for size, piece in found:
                step = logp[piece[0]] + beta[j]
                out[piece[0]] += times * np.exp(alpha[j - size] + step - alpha[-1])
                beta[j - size] = np.logaddexp(beta[j - size], step)


def word_logs(pieces: Pieces, logp: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Natural log of each word's probability, summed over its segmentations."""
    out = np.empty(len(start))
    for which, m in _groups(data, start, end):
        if m.shape[1] > LONG_BYTES:
            out[which] = [_long_forward(pieces, m[k:k + 1], logp)[-1] for k in range(len(m))]
        else:
            out[which] = _forward(pieces, m, _arcs(pieces, m), logp)[:, -1]
    return out


def expected_counts(pieces: Pieces, logp: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray,
                    times: np.ndarray) -> np.ndarray:
    """How often each piece occurs, over all segmentations of the words by their probability."""
    out = np.zeros(len(logp))
    for which, m in _groups(data, start, end):
        if m.shape[1] > LONG_BYTES:
            for k, w in enumerate(which):
                _long_counts(pieces, m[k:k + 1], logp, times[w], out)
            continue
        arcs = _arcs(pieces, m)
        alpha = _forward(pieces, m, arcs, logp)
        beta = np.full(alpha.shape, -np.inf)
        beta[:, -1] = 0.0
        w = times[which]
        for j in range(m.shape[1], 0, -1):       # everything that starts at j is in beta[:, j] by now
            behind = beta[:, j] - alpha[:, -1]
            single = pieces.byte_piece[m[:, j - 1]]
            step = logp[single] + beta[:, j]
            out += np.bincount(single, w * np.exp(alpha[:, j - 1] + logp[single] + behind), len(out))
            beta[:, j - 1] = np.logaddexp(beta[:, j - 1], step)
            for size, rows, piece in arcs[j]:
                p = logp[piece]
                out += np.bincount(piece, w[rows] * np.exp(alpha[rows, j - size] + p + behind[rows]), len(out))
                beta[rows, j - size] = np.logaddexp(beta[rows, j - size], p + beta[rows, j])
    return out


def _refit(pieces: Pieces, counts: np.ndarray, ends: float) -> np.ndarray:
    counts = counts.copy()
    counts[-1] = ends
    total = counts + PRIOR_PIECES * pieces.prior
    return np.log(total / total.sum())


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = text_buffer(words)
    return data, offsets[:-1], offsets[1:]


def word_counts(rows: DataFrame) -> DataFrame:
    """``(word, n)``: each lower-cased word of all texts with its count."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", _SLICE):
            words = split(part.column("text"), SPACE_SEPARATED, lower=True)
            _, first, times = np.unique(words.hashes(), return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([words.texts(first).cast(pa.string()), pa.array(times, pa.int64())], ["word", "n"])

    return rows.select("text").transform(map_texts, count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    vocabulary: str
    logp: np.ndarray              # natural log of each piece's probability; the last is the end
    total: int                    # training tokens
    distinct: int                 # distinct ones
    ends: int
    head: np.ndarray              # hashes of the most frequent words, sorted
    head_n: np.ndarray            # their counts
    head_log: np.ndarray          # their log probability


def fit(rows: DataFrame, vocabulary: str) -> tuple[Model, DataFrame]:
    """The model of training rows ``(text)``, and the stored table of word counts."""
    counts = stored(word_counts(rows), "words")
    n_words, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).head()
    ends = rows.count()
    # without the bound very long words could fill the driver; they take the join like other rare words
    head = counts.filter(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("n"), "word").limit(HEAD_WORDS).toArrow()
    pieces = load_pieces(vocabulary)
    data, start, end = _flat(head.column("word"))
    times = head.column("n").to_numpy().astype(float)
    logp = np.log(pieces.prior)
    for _ in range(HEAD_ROUNDS if len(times) else 0):
        logp = _refit(pieces, expected_counts(pieces, logp, data, start, end, times), ends)
    if len(times):
        known = counts.sparkSession.sparkContext.broadcast(logp)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total = load_pieces(vocabulary), np.zeros(len(known.value))
            for batch in batches:
                total += expected_counts(own, known.value, *_flat(batch.column("word")), batch.column("n").to_numpy().astype(float))
            which = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(total[which])], ["piece", "n"])

        total = np.zeros(len(logp))
        for piece, n in counts.transform(map_texts, expect, "piece int, n double").groupBy("piece").agg(F.sum("n")).collect():
            total[piece] = n          # one row per piece of the vocabulary
        logp = _refit(pieces, total, ends)
    h = split(head.column("word"), SPACE_SEPARATED).hashes() if len(times) else np.zeros(0, np.uint64)
    order = np.argsort(h)
    logs = word_logs(pieces, logp, data, start, end) if len(times) else times
    return Model(vocabulary, logp, int(n_words) + ends, int(distinct) + (ends > 0), ends, h[order], times[order], logs[order]), counts


_SCORED = "id long, word string, n long, n_tokens long, head_known long, head_sum double, score double, row long"


def score(df: DataFrame, trains: Column, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``trains`` is a condition on the input's columns that marks the rows to learn from."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"), F.coalesce(trains, F.lit(False)).alias("trains"))
    model, counts = fit(rows.filter("trains"), vocabulary)
    known = df.sparkSession.sparkContext.broadcast(model)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, pieces = known.value, load_pieces(known.value.vocabulary)
        for part in slices(batches, "text", _SLICE):
            words = split(part.column("text"), SPACE_SEPARATED, lower=True)
            h, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(m.head, h), max(len(m.head) - 1, 0))
            common = (m.head[at] == h) if len(m.head) else np.zeros(len(h), bool)
            log, base = np.zeros(len(h)), np.zeros(len(h))
            log[common] = m.head_log[at[common]]
            base[common] = np.log10(m.head_n[at[common]] + 0.1)
            rare = np.flatnonzero(~common)
            log[rare] = word_logs(pieces, m.logp, words.data, words.start[first[rare]], words.end[first[rare]])
            n, doc = np.diff(words.first), words.doc
            sums = lambda v: np.bincount(doc, v[which], len(n))  # noqa: E731, B023
            total, head_sum, head_known = sums(log), sums(base), sums(common.astype(float))
            # rare words of each document with their counts; the document's own figures go with its first row
            pair, many = np.unique(doc[~common[which]] * max(len(h), 1) + which[~common[which]], return_counts=True)
            d, w = pair // max(len(h), 1), pair % max(len(h), 1)
            none = np.setdiff1d(np.arange(len(n)), d)
            names = pa.concat_arrays([words.texts(first[w]).cast(pa.string()),
                                      pa.array([f" {x}" for x in part.column("key").take(pa.array(none)).to_pylist()], pa.string())])
            d = np.concatenate((d, none))
            many = np.concatenate((many, np.zeros(len(none), np.int64)))
            lead = np.zeros(len(d), bool)
            lead[np.unique(d, return_index=True)[1]] = True
            only = lambda v, kind: pa.array(np.where(lead, v[d], 0), kind)  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(d)), names, pa.array(many, pa.int64()), only(n + 1, pa.int64()),
                 only(head_known.astype(np.int64), pa.int64()),
                 only(head_sum, pa.float64()), only((total + m.logp[-1]) / _LOG10, pa.float64()),
                 part.column("key").take(pa.array(d))],
                ["id", "word", "n", "n_tokens", "head_known", "head_sum", "score", "row"])

    scored = rows.withColumn("key", F.monotonically_increasing_id()).select("id", "text", "key").transform(map_texts, parts, _SCORED)
    c = F.coalesce("c", F.lit(0))
    per_doc = (scored.join(counts.select("word", F.col("n").alias("c")), "word", "left")
               .select("id", "row", "n_tokens", "score",
                       (F.col("head_known") + F.when(c > 0, F.col("n")).otherwise(0)).alias("known"),
                       (F.col("head_sum") + F.col("n") * F.log10(c + F.lit(0.1))).alias("logs"))
               .groupBy("id", "row").agg(*[F.sum(x).alias(x) for x in ("n_tokens", "score", "known", "logs")]))
    end_log = F.lit(math.log10(model.ends + 0.1))
    norm = F.lit(math.log10(model.total + 0.1 * (model.distinct + 1)))
    return per_doc.select(
        F.col("id").alias(id_col), "n_tokens", (F.col("known") + F.lit(int(model.ends > 0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("logs") + end_log - F.col("n_tokens") * norm).alias("base_score"), "score")
