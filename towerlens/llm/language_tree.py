"""Language identification in two steps: the family, then the language within it.

Features are hashed byte n-grams (1 to 3) of the lower-cased text with all
ASCII that is no letter read as a space, as square roots of shares.  Linear
support vector machines, one against the rest, pick the language family; within
it one machine for each pair of languages votes.  All weights are learned on
the driver from a bounded sample: at most ``SAMPLE_PER_LANGUAGE`` distinct texts
of each language, chosen by a hash of the text.  Predicting reads whole texts.

Families of known language codes are listed below; a language that is not
listed is a family of its own.

Defined cases: a text that is null or has no letter is ``und`` with score 0; if
there is nothing to learn from every text is ``und``; rows without a language
are predicted and not learned from; an empty table gives an empty result;
repeated rows are predicted each; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frames import map_texts
from .linear import linear_svm, sigmoid
from .words import slices, text_buffer

DIMENSIONS = 2048
SAMPLE_PER_LANGUAGE = 500
_DOCS = 1000          # of which feature rows are held at a time
_SHARPNESS = 4.0

# Language codes by family.
FAMILIES = {
    "germanic": "en de nl af fy lb da sv no nb nn is fo yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be bg mk sr hr bs sl cs sk pl",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "indo-aryan": "hi ur bn pa gu mr ne si",
    "iranian": "fa ps ku tg",
    "semitic": "ar he am mt",
    "turkic": "tr az kk ky uz tk tt",
    "dravidian": "ta te kn ml",
    "sinitic": "zh yue",
    "austronesian": "id ms tl jv mg",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

_LETTERS = np.full(256, 0x20, np.uint8)
_LETTERS[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTERS[0x80:] = np.arange(0x80, 0x100)


def features(texts: pa.Array) -> np.ndarray:
    """One row of unit length for each text (zeros for a text without letters)."""
    data, offsets = text_buffer(pc.utf8_lower(pc.fill_null(texts, "")))
    b = _LETTERS[data].astype(np.uint32)
    n_texts, n = len(offsets) - 1, len(data)
    out = np.zeros(n_texts * DIMENSIONS)
    doc = np.repeat(np.arange(n_texts) * DIMENSIONS, np.diff(offsets))
    last = np.repeat(offsets[1:], np.diff(offsets))
    code = np.zeros(n, np.uint32)
    for size in (1, 2, 3):
        if n < size:
            break
        code = code[:n - size + 1] * np.uint32(257) + b[size - 1:]
        letters = (b[:n - size + 1] != 0x20) | (b[size - 1:] != 0x20)
        ok = np.flatnonzero(letters & (np.arange(n - size + 1) + size <= last[:n - size + 1]))
        h = (code[ok] * np.uint32(0x9E3779B1) + np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(21)
        out += np.bincount(doc[ok] + h, minlength=len(out))
    x = np.sqrt(out.reshape(n_texts, DIMENSIONS)).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


@dataclass
class Tree:
    families: list[str] = field(default_factory=list)
    family_w: np.ndarray | None = None
    family_b: np.ndarray | None = None
    members: dict[str, list[str]] = field(default_factory=dict)
    pairs: dict[str, list[tuple[int, int, np.ndarray, float]]] = field(default_factory=dict)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        margins = x @ self.family_w + self.family_b
        p = np.exp(_SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
        p /= p.sum(axis=1, keepdims=True)
        pick = margins.argmax(axis=1)
        names, score = np.empty(len(x), object), p[np.arange(len(x)), pick].astype(float)
        for k, family in enumerate(self.families):
            mine, langs = np.flatnonzero(pick == k), self.members[family]
            if len(langs) == 1:
                names[mine] = langs[0]
                continue
            votes, sure = np.zeros((len(mine), len(langs))), np.zeros((len(mine), len(langs)))
            for a, b, w, c in self.pairs[family]:
                m = x[mine] @ w + c
                votes[np.arange(len(mine)), np.where(m > 0, a, b)] += 1
                sure[:, a] += sigmoid(_SHARPNESS * m)
                sure[:, b] += sigmoid(-_SHARPNESS * m)
            best = (votes + sure / (len(langs) * 2)).argmax(axis=1)       # ties go to the surer one
            names[mine] = np.asarray(langs, object)[best]
            score[mine] *= sure[np.arange(len(mine)), best] / (len(langs) - 1)
        return names.tolist(), np.clip(score, 0.0, 1.0)


def fit_tree(x: np.ndarray, langs: list[str]) -> Tree:
    langs = np.asarray(langs, object)
    tree = Tree()
    for lang in sorted(set(langs)):
        tree.members.setdefault(FAMILY_OF.get(lang.lower(), lang), []).append(lang)
    tree.families = sorted(tree.members)
    family = np.asarray([FAMILY_OF.get(x.lower(), x) for x in langs], object)
    w, c = np.zeros((x.shape[1], len(tree.families)), np.float32), np.zeros(len(tree.families), np.float32)
    if len(tree.families) > 1:
        for k, name in enumerate(tree.families):
            w[:, k], c[k] = linear_svm(x, np.where(family == name, 1.0, -1.0).astype(np.float32))
    tree.family_w, tree.family_b = w, c
    for name, members in tree.members.items():
        tree.pairs[name] = []
        for a, b in combinations(range(len(members)), 2):
            mine = (langs == members[a]) | (langs == members[b])
            tree.pairs[name].append((a, b, *linear_svm(x[mine], np.where(langs[mine] == members[a], 1.0, -1.0).astype(np.float32))))
    return tree


def _sample(rows: DataFrame) -> tuple[np.ndarray, list[str]]:
    """Features and languages of the training sample: of each language's distinct texts those of the least places."""
    place = F.pmod(F.xxhash64("text"), F.lit(1_000_003))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n")).collect()}   # one row a language
    if not counts:
        return np.zeros((0, DIMENSIONS), np.float32), []
    # about twice the wanted number by a threshold on a hash, so that no language needs a sort of all its rows
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, min(1.0, 2 * SAMPLE_PER_LANGUAGE / n))])
    some = rows.withColumn("place", place).filter(F.col("place") < F.element_at(share, F.col("lang")) * 1_000_003)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[str, int]] = set()       # copies go no further than their task
        for part in slices(batches, "text"):
            keys = list(zip(part.column("lang").to_pylist(), part.column("hash").to_pylist()))
            new = []
            for k, key in enumerate(keys):
                if key not in seen:
                    seen.add(key)
                    new.append(k)
            part = part.take(pa.array(new, pa.int64()))
            for at in range(0, part.num_rows, _DOCS):
                p = part.slice(at, _DOCS)
                x = (features(p.column("text")) * 255).round().astype(np.uint8)      # coarse, so that the sample stays small
                yield pa.RecordBatch.from_arrays([p.column("lang"), p.column("place"), p.column("hash"), pa.array([r.tobytes() for r in x], pa.binary())],
                                                 ["lang", "place", "hash", "x"])

    found = some.select("lang", "place", "hash", "text").transform(map_texts, vectors, "lang string, place long, hash long, x binary")
    found = found.groupBy("lang", "place", "hash").agg(F.first("x").alias("x"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("place", "hash"))
    found = found.withColumn("nth", nth).filter(F.col("nth") <= SAMPLE_PER_LANGUAGE)
    x, langs = [], []
    for r in sorted(found.select("lang", "nth", "x").collect(), key=lambda r: (r["lang"], r["nth"])):
        x.append(bytes(r["x"]))
        langs.append(r["lang"])
    m = np.frombuffer(b"".join(x), np.uint8).reshape(-1, DIMENSIONS).astype(np.float32)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-9), langs


def identify(df: DataFrame, trains: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score``.  ``trains`` marks the rows to learn from."""
    rows = df.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"), F.coalesce(trains, F.lit(False)).alias("trains"))
    x, langs = _sample(rows.filter(F.col("trains") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).drop("trains"))
    shared = df.sparkSession.sparkContext.broadcast(fit_tree(x, langs) if langs else None)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for part in slices(batches, "text"):
            for at in range(0, part.num_rows, _DOCS):
                p = part.slice(at, _DOCS)
                text = pc.fill_null(p.column("text"), "")
                known = pc.match_substring_regex(text, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
                names, score = ["und"] * len(text), np.zeros(len(text))
                if tree is not None and known.any():
                    names, score = tree.predict(features(text))
                    names = [n if k else "und" for n, k in zip(names, known)]
                    score[~known] = 0.0
                yield pa.RecordBatch.from_arrays([p.column("id"), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).transform(map_texts, predict, "id long, lang_pred string, score double").withColumnRenamed("id", id_col)
