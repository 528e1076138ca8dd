"""What is called bounded stays bounded: one id or text with very many rows, very long words, short phrases in all texts."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from towerlens.llm import block_anchors, content_sort, lattice_lm, phrase_index, quality_rules, words


# ------------------------------------------------------------------ quality classifier
def test_sample_is_bounded_in_rows_not_only_in_labels(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality_rules, "fit_ensemble", lambda x, y: seen.append((x, y)))
    docs = spark.range(200_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 50).alias("text"))
    docs = docs.union(spark.createDataFrame([(2, "other text"), (2, "other text"), (3, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (3, 1), (4, 1)], "doc_id long, quality int")
    quality_rules.fit(docs, labels, F.lit(True))
    x, y = seen[0]
    assert len(x) == len(y) == 5 and sorted(y) == [0, 0, 1, 1, 1]


# ------------------------------------------------------------------ exact duplicates
@pytest.mark.parametrize("ids", ["null", "one", "distinct"])
def test_equal_texts_spread_over_the_tasks(spark, ids):
    n = 20_000
    who = {"null": F.lit(None).cast("long"), "one": F.lit(7).cast("long"), "distinct": F.col("id")}[ids]
    df = spark.range(n).select(who.alias("doc_id"), F.lit("the same text").alias("text")).union(
        spark.createDataFrame([(7, "other"), (None, "other"), (8, "the  same\ttext")], "doc_id long, text string")).repartition(6)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        ranged, _ = content_sort._sorted_runs(df, "doc_id", "text")
        per_task = sorted((r["count"] for r in ranged.groupBy(F.spark_partition_id()).count().collect()), reverse=True)
    finally:
        spark.conf.unset(setting)
    assert per_task[0] < n / 2 and len(per_task) >= 4
    got = content_sort.exact_duplicates(df)
    kept = sorted(((r["doc_id"], r["keep_id"], r["group_size"]) for r in got.filter("kept").collect()), key=str)
    keep = {"null": 8, "one": 7, "distinct": 0}[ids]
    assert kept == sorted([(7, 7, 2), (keep, keep, n + 1)], key=str) and got.count() == n + 3
    assert content_sort.drop_exact_duplicates(df).count() == 2


def test_equal_texts_all_without_ids(spark):
    df = spark.range(5_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    got = content_sort.exact_duplicates(df)
    assert got.filter("kept").count() == 1 and got.filter("keep_id is null and group_size = 5000").count() == 5_000


# ------------------------------------------------------------------ substring dedup
def test_a_short_phrase_in_all_texts_does_not_fill_a_bucket():
    rng = np.random.default_rng(4)
    footer = " ".join(f"footer{i}" for i in range(20))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 60)) + " " + footer for _ in range(1500)]
    w = words.split(pa.array(texts))
    h, buckets = w.hashes(), 150

    def sizes(spread):
        _, _, bucket = block_anchors._windows(h, w.first, 25, words.WORD_BASES[0], buckets, spread)
        count = np.bincount(bucket, minlength=buckets)
        return count.max() / np.median(count)

    at = np.flatnonzero(words.window_starts(w.first, 25))
    value, times = np.unique(block_anchors._least_fine(h, 25, at), return_counts=True)
    common = value[times > 0.02 * len(texts)]
    assert sizes(np.zeros(0, np.uint64)) > 5 and sizes(common) < 5


def test_repeats_with_a_short_phrase_in_all_texts(spark, monkeypatch):
    monkeypatch.setattr(block_anchors, "PROBES_PER_BUCKET", 500)
    rng = np.random.default_rng(5)
    footer, passage = [f"footer{i}" for i in range(20)], [f"p{i}" for i in range(70)]
    rows = []
    for d in range(150):
        text = [f"w{x}" for x in rng.integers(0, 1 << 40, 60)]
        rows.append((d, " ".join(text[:30] + (passage if d % 9 == 0 else []) + text[30:] + footer)))
    got = block_anchors.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == sorted(brute.repeats(rows))


# ------------------------------------------------------------------ decontamination
def test_repeated_items_are_one_part(spark):
    same = spark.range(60_000).select(F.lit(5).cast("long").alias("item_id"), F.lit("one two three four five six seven eight nine ten eleven").alias("text"))
    blocks = list(phrase_index._blocks(same, 10, "item_id", "text"))
    assert len(blocks) == 1 and len(blocks[0][1]) == 1
    docs = spark.createDataFrame([(1, "a one two three four five six seven eight nine ten b"), (2, "none")], "doc_id long, text string")
    got = {r["doc_id"]: r["items"] for r in phrase_index.phrase_matches(docs, same).collect()}
    assert got == {1: [5], 2: []}


# ------------------------------------------------------------------ language model
def test_long_words_in_stretches_give_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    pieces = lattice_lm.load_pieces(lattice_lm.default_vocabulary())
    logp = np.log(pieces.prior)
    texts = ["".join(rng.choice(list("theandingéio"), n)) for n in (30, 200, 201, 399, 1000, 1000)]
    data, start, end = lattice_lm._flat(pa.array(texts))
    plain = lattice_lm.word_logs(pieces, logp, data, start, end)
    counts = lattice_lm.expected_counts(pieces, logp, data, start, end, np.arange(1.0, 7.0))
    monkeypatch.setattr(lattice_lm, "LONG_BYTES", 100)
    assert np.allclose(lattice_lm.word_logs(pieces, logp, data, start, end), plain, rtol=1e-12)
    assert np.allclose(lattice_lm.expected_counts(pieces, logp, data, start, end, np.arange(1.0, 7.0)), counts, rtol=1e-9, atol=1e-12)


def test_memory_for_a_long_word_grows_by_tens_of_bytes_a_byte():
    pieces = lattice_lm.load_pieces(lattice_lm.default_vocabulary())
    logp = np.log(pieces.prior)
    n = 200_000
    data = np.frombuffer((b"thereisnospaceinhere" * (n // 20)), np.uint8)
    tracemalloc.start()
    try:
        log = lattice_lm.word_logs(pieces, logp, data, np.asarray([0]), np.asarray([n]))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.isfinite(log[0]) and most < 60e6


# ------------------------------------------------------------------ word hashing
def test_hashing_long_texts_holds_a_slice_at_a_time(monkeypatch):
    texts = ["a bb  ccc", None, "é" * 50, " ".join(f"word{i}" for i in range(3000)), ""]
    plain = words.split(pa.array(texts)).hashes()
    monkeypatch.setattr(words, "SLICE_BYTES", 40)
    assert (words.split(pa.array(texts)).hashes() == plain).all()
    monkeypatch.undo()
    w = words.split(pa.array([" ".join(["abcdefgh"] * 2_000_000)]))          # 18 MB
    tracemalloc.start()
    try:
        h = w.hashes()
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(np.unique(h)) == 1 and most < 16e6 + 80e6
