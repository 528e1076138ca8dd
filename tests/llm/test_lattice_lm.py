import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm import brute
from towerlens.llm import lattice_lm as lm
from towerlens.llm import queries


def segmentations(word, weight):
    """Summed probability of all ways to cut bytes into pieces, by plain recursion over prefixes."""
    best = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(j):
            best[j] += best[i] * weight.get(word[i:j], 0.0)
    return best[-1]


def piece_weights(pieces, logp):
    import sentencepiece as sp

    model = sp.SentencePieceProcessor(model_file=lm.default_vocabulary())
    out = {bytes([b]): math.exp(logp[pieces.byte_piece[b]]) for b in range(256)}
    for k in range(model.get_piece_size()):
        t = model.id_to_piece(k).encode()
        if len(t) > 1 and not model.is_byte(k):
            n = pieces.find(lm._piece_hash(np.frombuffer(t, np.uint8)[None, :]))[0]
            if n >= 0:
                out[t] = math.exp(logp[n])
    return out


def flat(words):
    data = b"".join(words)
    at = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    return np.frombuffer(data, np.uint8), at[:-1], at[1:]


def test_forward_recursion_sums_all_segmentations():
    pieces = lm.load_pieces(lm.default_vocabulary())
    logp = np.log(pieces.prior)
    weight = piece_weights(pieces, logp)
    words = ["the", "tion", "a", "thanether,", "für", "日本語", "x" * 70, "%%%", "naïve"]
    got = lm.word_logs(pieces, logp, *flat([w.encode() for w in words]))
    want = [math.log(segmentations(("▁" + w).encode(), weight)) for w in words]
    assert np.allclose(got, want, rtol=1e-9)


def test_expected_counts_are_derivatives():
    pieces = lm.load_pieces(lm.default_vocabulary())
    logp = np.log(pieces.prior)
    words, times = flat([b"thanether", b"tion", "für".encode()]), np.asarray([3.0, 2.0, 5.0])
    got = lm.expected_counts(pieces, logp, *words, times)
    for k in np.flatnonzero(got)[:12]:
        up, down = logp.copy(), logp.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        slope = (times * (lm.word_logs(pieces, up, *words) - lm.word_logs(pieces, down, *words))).sum() / 2e-5
        assert slope == pytest.approx(got[k], rel=1e-4, abs=1e-7)


def rows_of(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    return rows + [(100_001, None), (100_002, ""), (100_003, " \n"), (100_004, "THE the The"), (100_004, "THE the The"),
                   (100_005, "é" * 5000), (None, "no id"), (100_007, "﷽qqxz " * 3)]


def test_whole_table(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(lm, "HEAD_WORDS", 300)
    rows = rows_of(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'w' as word").repartition(3)
    path = str(tmp_path / "documents.parquet")
    df.write.parquet(path)
    got = queries.op2_lattice_lm(spark, str(tmp_path)).collect()
    train = [t for d, t in rows if d is not None and zlib.crc32(str(d).encode()) % 10]
    count = Counter(w for t in train for w in brute.space_words(brute.lower_az(t)))
    total, distinct = sum(count.values()) + len(train), len(count) + 1
    want = {}
    for d, t in rows:
        w = brute.space_words(brute.lower_az(t))
        c = [count[x] for x in w] + [len(train)]
        want[d] = (len(c), sum(x > 0 for x in c), sum(math.log10((x + 0.1) / (total + 0.1 * (distinct + 1))) for x in c))
    assert len(got) == len(rows)
    for r in got:
        n, known, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0
        assert r["held_out"] == (d is not None and zlib.crc32(str(d).encode()) % 10 == 0 if (d := r["doc_id"]) is not None else None)


def test_training_helps_and_empty_table(spark):
    df = spark.createDataFrame(rows_of(spark), "doc_id long, text string")
    from pyspark.sql import functions as F
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    got = {r["doc_id"]: r for r in lm.score(df, ~held, lm.default_vocabulary()).collect()}
    plain = {r["doc_id"]: r for r in lm.score(df, F.lit(False), lm.default_vocabulary()).collect()}
    ids = [d for d in got if d is not None and d < 100_000]
    assert sum(got[d]["score"] for d in ids) > 0.9 * sum(plain[d]["score"] for d in ids)
    assert plain[ids[0]]["n_known"] == 0 and plain[ids[0]]["train_tokens"] == 0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.score(empty, F.lit(True), lm.default_vocabulary()).count() == 0
