"""Text quality by a sparse ensemble of rules.

Statistics of whole texts (shares of character classes, repetition, word
shapes) are the only inputs.  Shallow boosted trees are grown on a bounded
sample of labelled documents; every path from a root to a node is a
conjunctive rule over statistics.  A lasso logistic regression weights the
rules, most of them with zero; the remaining ones are compiled into one Spark
column expression, so a score can be read off, and explained by, its rules.

The sample is the ``sample_rows`` labelled rows of the smallest hash of their
id; it alone reaches the driver (as statistics, not texts).

Defined cases: null text counts as empty; empty texts have zero in every
statistic and are scored by the same rules; rows with a null label are not
learned from; with no labelled row every score is 0.5, with labels of one kind
only it is their smoothed share; a label that repeats counts as often as it
does; repeated documents are scored each; an empty table gives an empty
result; further columns are not read (``score_documents``) or left alone
(``drop_rejected``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import map_texts
from .linear import lasso_logistic, sigmoid
from .words import SPACE_SEPARATED, mix, slices, split, text_buffer

SAMPLE_ROWS = 10_000
TREES, DEPTH, RATE = 60, 3, 0.1
BINS = 32
KEEP_AT = 0.5

STATISTICS = ("log_bytes", "log_words", "mean_word", "capital_share", "capital_word_share", "digit_share", "mark_share",
              "symbol_share", "bar_share", "exclaim_share", "other_byte_share", "marked_word_share", "short_word_share",
              "long_word_share", "distinct_share", "repeat_share", "pair_repeat_share", "top_word_share", "lines_per_word",
              "line_repeat_share", "sentence_share")


def _class(text: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text)] = True
    return out


_CAPITAL = _class(bytes(range(65, 91)))
_SMALL = _class(bytes(range(97, 123)))
_DIGIT = _class(b"0123456789")
_MARK = _class(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
_SYMBOL = _class(b"#$%&*+<=>@\\^_`{}~")
_STOP = _class(b".?!")
_PLAIN_END = _class(b".,;:?\"')")


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text."""
    data, offsets = text_buffer(column)
    words = split(column, SPACE_SEPARATED)
    n_texts = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    n = np.diff(words.first).astype(float)
    doc = words.doc
    some_bytes, some_words = np.maximum(size, 1), np.maximum(n, 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flags)))
        return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)

    def per_word(flags: np.ndarray) -> np.ndarray:
        return np.bincount(doc, flags, n_texts)

    capitals, small = per_text(_CAPITAL[data]), per_text(_SMALL[data])
    length = (words.end - words.start).astype(float)
    first_byte, last_byte = (data[words.start], data[words.end - 1]) if len(doc) else (data[:0], data[:0])
    is_capital = np.concatenate(([0], np.cumsum(_CAPITAL[data])))
    all_capital = (is_capital[words.end] - is_capital[words.start] >= np.maximum(2, 0.6 * length)) if len(doc) else np.zeros(0, bool)
    h = words.hashes()
    mine = mix(h + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))       # words of different texts differ
    distinct, which, times = np.unique(mine, return_inverse=True, return_counts=True)
    kinds = np.bincount(np.bincount(which, doc, len(distinct)).astype(np.int64) // np.maximum(times, 1), minlength=n_texts) if len(doc) else np.zeros(n_texts)
    top = np.zeros(n_texts)
    np.maximum.at(top, doc, times[which].astype(float) if len(doc) else np.zeros(0))
    again = np.zeros(len(h), bool)
    again[1:] = mine[1:] == mine[:-1]
    pairs = np.zeros(n_texts)
    if len(h) > 1:
        both = np.flatnonzero(doc[1:] == doc[:-1])
        pair = mix(mine[both] * np.uint64(3) + mine[both + 1])
        _, at, count = np.unique(pair, return_inverse=True, return_counts=True)
        pairs = np.bincount(doc[both], count[at] > 1, n_texts)
    line_end = np.flatnonzero(data == 10)
    lines = per_text(data == 10)
    # a line is known by its words; what repeats within a text counts
    line_repeat = np.zeros(n_texts)
    if len(line_end) and len(doc):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h)))
        cuts = np.unique(np.concatenate((line_end, offsets[1:-1])))
        edge = np.unique(np.concatenate(([0], np.searchsorted(words.start, cuts), [len(h)])))
        lo, hi = edge[:-1], edge[1:]
        line = mix((total[hi] - total[lo]) + doc[lo].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, at, count = np.unique(line, return_inverse=True, return_counts=True)
        line_repeat = np.bincount(doc[lo], np.where(count[at] > 1, hi - lo, 0), n_texts)
    marked = ~(_PLAIN_END[last_byte] | ~_MARK[last_byte]) | ((length == 1) & _MARK[first_byte])
    columns = (
        np.log1p(size), np.log1p(n), per_word(length) / some_words, capitals / np.maximum(capitals + small, 1),
        per_word(all_capital) / some_words, per_text(_DIGIT[data]) / some_bytes, per_text(_MARK[data]) / some_bytes,
        per_text(_SYMBOL[data]) / some_bytes, per_text(data == 0x7C) / some_bytes, per_text(data == 0x21) / some_bytes,
        per_text(data >= 0x80) / some_bytes, per_word(marked) / some_words, per_word(length <= 3) / some_words,
        per_word(length >= 15) / some_words, kinds / some_words, per_word(again) / some_words, pairs / some_words,
        top / some_words, lines / some_words, line_repeat / some_words, per_word(_STOP[last_byte]) / some_words)
    return np.stack(columns, axis=1)


def with_statistics(df: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all, if not said otherwise) as one struct ``row``, and one column for each statistic."""
    carry = df.columns if carry is None else carry
    inside = text_col in carry
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), *[] if inside else [F.col(f"`{text_col}`").alias("text")])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (pa.RecordBatch.from_arrays([b.column("row"), pc.struct_field(b.column("row"), text_col) if inside else b.column("text")],
                                            ["row", "text"]) for b in batches)
        for part in slices(pairs, "text"):
            m = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("row"), *[pa.array(m[:, k]) for k in range(m.shape[1])]], ["row", *STATISTICS])

    return rows.transform(map_texts, compute, T.StructType([rows.schema["row"], *[T.StructField(s, T.DoubleType()) for s in STATISTICS]]))


@dataclass(frozen=True)
class Rule:
    """All of: statistic above ``low`` and at most ``high``."""

    bounds: tuple[tuple[int, float, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, low, high in self.bounds:
            out &= (x[:, k] > low) & (x[:, k] <= high)
        return out

    def column(self) -> Column:
        tests = []
        for k, low, high in self.bounds:
            if low > -np.inf:
                tests.append(F.col(STATISTICS[k]) > F.lit(float(low)))
            if high < np.inf:
                tests.append(F.col(STATISTICS[k]) <= F.lit(float(high)))
        out = tests[0]
        for t in tests[1:]:
            out &= t
        return out

    def __str__(self) -> str:
        return " and ".join(f"{low:.4g} < {STATISTICS[k]} <= {high:.4g}" for k, low, high in self.bounds)


def _grow(codes: np.ndarray, cuts: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int) -> tuple[list[Rule], np.ndarray]:
    """One regression tree: the rules of its nodes and each row's leaf value."""
    rules, value = [], np.zeros(len(gradient))
    stack = [(np.arange(len(gradient)), {}, 0)]
    while stack:
        rows, bounds, level = stack.pop()
        if bounds:
            rules.append(Rule(tuple((k, *b) for k, b in sorted(bounds.items()))))
        g, h = gradient[rows].sum(), hessian[rows].sum()
        best = (1e-6, None)
        if level < depth and len(rows) >= 40:
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                code = codes[rows, k]
                gl = np.cumsum(np.bincount(code, gradient[rows], len(c) + 1))[:-1]
                hl = np.cumsum(np.bincount(code, hessian[rows], len(c) + 1))[:-1]
                nl = np.cumsum(np.bincount(code, minlength=len(c) + 1))[:-1]
                gain = gl ** 2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g ** 2 / (h + 1)
                gain[(nl < 15) | (len(rows) - nl < 15)] = 0
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), (k, at))
        if best[1] is None:
            value[rows] = -g / (h + 1)
            continue
        k, at = best[1]
        low, high = bounds.get(k, (-np.inf, np.inf))
        below = codes[rows, k] <= at
        stack.append((rows[below], bounds | {k: (low, min(high, float(cuts[k][at])))}, level + 1))
        stack.append((rows[~below], bounds | {k: (max(low, float(cuts[k][at])), high)}, level + 1))
    return rules, value


def extract_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Distinct rules of boosted trees; each tree sees half of the rows."""
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)], axis=1)
    rng = np.random.default_rng(7)
    margin = np.full(len(y), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    found: dict[Rule, None] = {}
    for _ in range(TREES):
        p = sigmoid(margin)
        part = rng.random(len(y)) < 0.5
        rules, _ = _grow(codes[part], cuts, (p - y)[part], (p * (1 - p))[part], DEPTH)
        found.update(dict.fromkeys(rules))
        # leaves of the same tree on all rows
        leaves = [r for r in rules if not any(_inside(o, r) for o in rules if o is not r)]
        for r in leaves:
            rows = r.holds(x)
            g, h = (p - y)[rows].sum(), (p * (1 - p))[rows].sum()
            margin[rows] -= RATE * 5 * g / (h + 1)
    return list(found)


def _inside(a: Rule, b: Rule) -> bool:
    """Whether rule ``a`` is a narrower form of ``b``."""
    mine = {k: (lo, hi) for k, lo, hi in a.bounds}
    return a != b and all(k in mine and mine[k][0] >= lo and mine[k][1] <= hi for k, lo, hi in b.bounds)


@dataclass
class Ensemble:
    rules: list[tuple[Rule, float]]
    intercept: float

    def column(self) -> Column:
        """The score as a Spark expression over the statistics' columns."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.intercept + sum((r.holds(x) * w for r, w in self.rules), np.zeros(len(x))))


def fit_ensemble(x: np.ndarray, y: np.ndarray) -> Ensemble:
    """Rules and their lasso weights; the penalty is the largest within one standard error of the best held-out loss."""
    if len(y) < 100 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return Ensemble([], float(np.log(share / (1 - share))))
    rules = extract_rules(x, y)
    z = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float32)
    _, first = np.unique(z, axis=1, return_index=True)       # rules that hold for the same rows are one
    first.sort()
    rules, z = [rules[k] for k in first], z[:, first]
    scale = z.std(axis=0)
    keep = scale > 0
    rules, z, scale = [r for r, k in zip(rules, keep) if k], z[:, keep], scale[keep]
    centre = z.mean(axis=0)
    xs = ((z - centre) / scale).astype(np.float32)
    held = np.random.default_rng(11).random(len(y)) < 0.25
    top = float(np.abs(xs[~held].T @ (y[~held] - y[~held].mean())).max() / (~held).sum())
    penalties, w, losses = top * np.logspace(-0.5, -3, 9), None, []
    for p in penalties:
        w = lasso_logistic(xs[~held], y[~held], p, w, 80)
        q = np.clip(sigmoid(xs[held] @ w[:-1] + w[-1]), 1e-6, 1 - 1e-6)
        losses.append(-(y[held] * np.log(q) + (1 - y[held]) * np.log(1 - q)))
    means = np.asarray([v.mean() for v in losses])
    best = int(means.argmin())
    error = losses[best].std() / np.sqrt(len(losses[best]))
    chosen = penalties[int(np.flatnonzero(means <= means[best] + error)[0])]
    w = lasso_logistic(xs, y, chosen, w, 150)
    weights = w[:-1] / scale
    return Ensemble([(r, float(v)) for r, v in zip(rules, weights) if v], float(w[-1] - (weights * centre).sum()))


def fit(docs: DataFrame, labels: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Ensemble:
    """Learn from the labelled rows for which ``trains`` (a condition on the label table's columns) holds.

    The sample has at most ``sample_rows`` rows of the label table, with one text each: of documents that share an id, the
    one whose text has the least hash.  Spark picks it before anything comes to the driver."""
    mine = (labels.filter(trains & F.col(label_col).isNotNull())
            .select(F.col(id_col).alias("label_id"), F.col(label_col).cast("double").alias("label"))
            .orderBy(F.xxhash64("label_id"), "label_id", "label").limit(sample_rows))
    rows = docs.select(F.col(f"`{id_col}`").alias("label_id"), F.col(f"`{text_col}`").alias("text"))
    # at most `sample_rows` short rows are broadcast
    one = (rows.join(F.broadcast(mine.select("label_id").distinct()), "label_id").groupBy("label_id")
           .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")).select("label_id", "least.text")
           .join(F.broadcast(mine), "label_id"))
    some = with_statistics(one, carry=["label_id", "label"]).select("row.label_id", "row.label", *STATISTICS).toPandas()
    some = some.sort_values(["label_id", "label"], kind="stable")
    return fit_ensemble(some[list(STATISTICS)].to_numpy(float), (some["label"].to_numpy(float) > 0.5).astype(float))


def score_documents(docs: DataFrame, model: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``score`` (0 to 1) and ``predicted``."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    scored = with_statistics(rows, carry=["id"]).select(F.col("row.id").alias(id_col), model.column().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))


def drop_rejected(docs: DataFrame, model: Ensemble, text_col: str = "text") -> DataFrame:
    """The input's rows and columns without those scored below ``KEEP_AT``."""
    return with_statistics(docs, text_col).filter(model.column() >= KEEP_AT).select("row.*")
