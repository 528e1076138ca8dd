import random

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm import brute
from towerlens.llm import hyperminhash as hmh
from towerlens.llm.words import split


def family(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def planted(seed):
    rng = random.Random(seed)
    some = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    texts = family(rng, some(220), 60, 9) + family(rng, some(40), 40, 2) + family(rng, some(12), 30, 1) + family(rng, some(700), 25, 30)
    texts += [" ".join(some(rng.randint(0, 60))) for _ in range(80)]
    texts += ["", "  ", "one", "ONE", "one two", "One\ttwo", "one two three", "a a a a", "a a a", "É é", "x " * 30000]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [(1000, None), (3, dict(rows)[3]), (3, dict(rows)[3])]


def check(spark, rows, shingle=3, least=85, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as id", "'x' as node", "2 as key", "0 as component_id").repartition(4)
    got = hmh.near_duplicates(df, shingle=shingle, least=least, **more).collect()
    sets = {d: brute.shingles(t, shingle) for d, t in rows}
    want = brute.components(list(sets.items()), least)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    return df, want


@pytest.mark.parametrize("block", [4000, 7])
def test_components_in_one_and_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(hmh, "BLOCK_DOCS", block)
    check(spark, planted(block))


def test_five_words_and_dropping(spark):
    rows = planted(3)
    df, want = check(spark, rows, 5, 80, rows_in_band=6)
    left = hmh.drop_near_duplicates(df)
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(d for d, _ in rows if want[d] == d)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (None, "q r s"), (5, None)], "doc_id long, text string")
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in hmh.near_duplicates(df).collect()}
    assert got == {(None, 2, 4, False), (4, 2, 4, True), (None, 1, None, True), (5, 0, 5, True)}
    empty = df.limit(0)
    assert hmh.near_duplicates(empty).collect() == [] and hmh.drop_near_duplicates(empty).collect() == []


def test_near_copies_of_rows_without_id(spark):
    words = lambda c: [f"{c}{k}" for k in range(60)]
    near = lambda c, *at: " ".join("zz" if k in at else w for k, w in enumerate(words(c)))
    rows = [(1, near("a")), (None, near("a", 30)),                                      # a near copy without id
            (2, near("b")), (3, near("b", 0)), (None, near("b")),                       # a set shared with a row without id
            (4, near("c", 20)), (None, near("c")), (5, near("c", 40)),                  # joined only by a set of a row without id
            *[(None, near("d", k)) for k in (0, 0, 30, 59)], (None, "alone " * 9)]      # no id at all
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((str(r["doc_id"]), r["component_id"]) for r in hmh.near_duplicates(df).collect()), key=str)
    assert got == sorted([("1", 1), ("None", 1), ("2", 2), ("3", 2), ("None", 2), ("4", 4), ("None", 4), ("5", 4)] + 5 * [("None", None)], key=str)
    left = hmh.drop_near_duplicates(df, shingle=3, least=85).collect()
    assert sorted(r["doc_id"] for r in left if r["doc_id"] is not None) == [1, 2, 4]
    no_id = {r["text"] for r in left if r["doc_id"] is None}
    assert len(no_id) == 2 and "alone " * 9 in no_id and any("d1 " in t for t in no_id)


def test_estimate_is_close(spark):
    rng = random.Random(1)
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).collect()]
    pairs = [(t, " ".join(w if rng.random() < q else "zz" for w in t.split())) for t in texts for q in (0.99, 0.95, 0.8, 0.4) if len(t) > 600]
    import pyarrow as pa
    sketch = []
    for side in zip(*pairs):
        value, first = hmh.shingle_hashes(split(pa.array(side), lower=True), 3)
        sketch.append((hmh.registers(value, first), np.diff(first)))
    true = [len(a & b) / len(a | b) for a, b in ((brute.shingles(x), brute.shingles(y)) for x, y in pairs)]
    got = hmh.estimate(sketch[0][0], sketch[1][0], sketch[0][1], sketch[1][1])
    assert np.abs(got - true).mean() < 0.03 and np.abs(got - true).max() < 0.15
