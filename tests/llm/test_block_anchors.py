import random

import pytest

from tests.conftest import SF_CHECK
from tests.llm import brute
from towerlens.llm import block_anchors


def check(spark, rows, parts=4, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'k' as key", "0 as spans").repartition(parts)
    got = block_anchors.remove_repeats(df, with_text=True).collect()
    want = brute.repeats(rows)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got), key=key) == sorted(want, key=key)
    assert all(brute.sha(r["kept_text"]) == r["kept_sha256"] for r in got)


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows)


@pytest.mark.parametrize("hot_share", [0.02, 0.2, 2.0])
def test_planted_repeats_and_defined_cases(spark, monkeypatch, hot_share):
    monkeypatch.setattr(block_anchors, "HOT_SHARE", hot_share)
    monkeypatch.setattr(block_anchors, "PROBES_PER_BUCKET", 700)
    monkeypatch.setattr(block_anchors, "_HELD_BYTES", 3000)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6)))
    some = lambda n: [word() for _ in range(n)]
    passage, texts = some(90), []
    for k in range(40):
        w = some(rng.randint(0, 130))
        a, n = rng.randint(0, 40), rng.randint(47, 53)
        w[len(w) // 2:len(w) // 2] = passage[a:a + n]
        texts.append(rng.choice([" ", "\t", "\n  "]).join(w))
    texts += ["x " * 400, "x " * 49, "x " * 50, "y " * 120, "", " \t", "one", " ".join(passage[:49]), " ".join(passage[:50])]
    rows = list(enumerate(texts)) + [(900, None), (None, " ".join(passage)), (None, " ".join(passage)), (3, texts[3]),
                                     (5, " ".join(passage)), (901, texts[0]), (901, texts[0]), (-4, " ".join(some(20) + passage[30:85]))]
    check(spark, rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert block_anchors.remove_repeats(df).collect() == []
