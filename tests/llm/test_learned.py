"""Held-out accuracy and defined cases of the quality rules and the language tree."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_CHECK
from towerlens.llm import language_tree, queries, quality_rules
from towerlens.llm.linear import lasso_logistic, linear_svm, sigmoid

ODD = [(-1, None), (-2, ""), (-3, " \n"), (-4, "12 34 !!"), (-5, "É"), (-6, "a " * 60000), (-7, "x" * 50000), (-8, "same"), (-8, "same"), (None, "no id")]


def crc(d, m):
    return zlib.crc32(str(d).encode()) % m


def test_quality_on_held_out_labels(spark):
    got = {r["doc_id"]: r for r in queries.op1_rule_ensemble(spark, SF_CHECK).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    held = [d for d in labels if crc(d, 3) == 1]
    assert all(r["held_out"] == (crc(d, 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for d, r in got.items())
    assert len(held) > 80 and np.mean([got[d]["predicted"] == labels[d] for d in held]) >= 0.97


def test_statistics_are_plain_counts():
    texts = ["The cat, the CAT!! | 12\nThe cat, the CAT!! | 12\nend.", "", None, "été é", "aa aa aa bb"]
    m = quality_rules.statistics(pa.array(texts))
    get = dict(zip(quality_rules.STATISTICS, m.T))
    w = texts[0].split()
    assert get["mean_word"][0] == pytest.approx(sum(map(len, w)) / len(w))
    assert get["distinct_share"][0] == pytest.approx(len(set(w)) / len(w))
    assert get["top_word_share"][0] == pytest.approx(2 / len(w))
    assert get["line_repeat_share"][0] == pytest.approx(12 / 13)
    assert get["digit_share"][0] == pytest.approx(4 / len(texts[0]))
    assert get["repeat_share"][4] == pytest.approx(2 / 4) and get["pair_repeat_share"][4] == pytest.approx(2 / 4)
    assert (m[1] == 0).all() and (m[2] == 0).all() and np.isfinite(m).all()
    alone = np.concatenate([quality_rules.statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(alone, m)


def test_rules_compile_to_the_same_scores(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    model = quality_rules.fit(docs, spark.read.parquet(f"{SF_CHECK}/labels.parquet"), F.lit(True))
    assert model.rules and all(1 <= len(r.bounds) <= quality_rules.DEPTH for r, _ in model.rules)
    odd = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1.5 as score", "'x' as row", "2 as log_bytes").repartition(2)
    got = quality_rules.score_documents(odd, model).collect()
    x = quality_rules.statistics(pa.array([t for _, t in ODD], pa.string()))
    assert sorted((str(r["doc_id"]), round(r["score"], 9)) for r in got) == sorted((str(d), round(float(s), 9)) for (d, _), s in zip(ODD, model.score(x)))
    kept = quality_rules.drop_rejected(odd, model)
    assert kept.columns == odd.columns and kept.count() == int((model.score(x) >= 0.5).sum())


def test_few_or_single_labels(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    for rows, want in (([], 0.5), ([(-1, 1)] * 3, 3.5 / 4), ([(-1, None), (-2, 0)], 0.25)):
        model = quality_rules.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"), F.lit(True))
        assert {round(r["score"], 9) for r in quality_rules.score_documents(docs, model).collect()} == {round(want, 9)}
    assert quality_rules.score_documents(docs.limit(0), model).collect() == []


def test_language_on_held_out_documents(spark):
    got = {r["doc_id"]: r for r in queries.op9_language_tree(spark, SF_CHECK).collect()}
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    held = [d for d in docs if crc(d, 5) == 0]
    assert all(r["held_out"] == (crc(d, 5) == 0) and 0 <= r["score"] <= 1 for d, r in got.items()) and set(got) == set(docs)
    assert np.mean([got[d]["lang_pred"] == docs[d] for d in held]) >= 0.97


def test_language_defined_cases(spark):
    train = [(k, t, lang) for k in range(40) for t, lang in (
        ("the house and the garden of my father " * 3, "en"), ("das haus und der garten von meinem vater " * 3, "de"),
        ("la maison et le jardin de mon père " * 3, "fr"), ("kuća i vrt moga oca je lijepa " * 3, "hr"), ("klingon tlh ingan Hol " * 3, "tlh"))]
    rows = train + [(1000 + i, t, None) for i, (_, t) in enumerate(ODD)] + [(2000, "Le jardin et la maison", None), (2001, "Der Garten und das Haus", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as id", "'x' as lang_pred").repartition(3)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_tree.identify(df, F.col("doc_id") < 1000).collect()}
    assert [got[1000 + k][0] for k in (0, 1, 2, 3)] == ["und"] * 4 and got[1000][1] == 0
    assert all(got[1000 + k][0] in {"en", "de", "fr", "hr", "tlh"} for k in range(4, 10))
    assert got[2000][0] == "fr" and got[2001][0] == "de"
    assert {r["lang_pred"] for r in language_tree.identify(df, F.lit(False)).collect()} == {"und"}
    assert language_tree.identify(df.limit(0), F.lit(True)).collect() == []


def test_language_sample_is_of_distinct_texts(spark):
    hot = [(f"hot words of {w}", "en") for w in "abcdef" for _ in range(2000)]
    rare = [(f"{'xyz'[k % 3]}{k} rare words", "de") for k in range(3)] * 20_000
    spelt = lambda k: "".join("abcdefghij"[int(c)] for c in str(k))
    many = [(f"text number {spelt(k)}", "fr") for k in range(1500)] + [("copy copy", "fr")] * 5000
    df = spark.createDataFrame(hot + rare + many, "text string, lang string").repartition(4)
    x, langs = language_tree._sample(df)
    assert {k: langs.count(k) for k in set(langs)} == {"en": 6, "de": 3, "fr": language_tree.SAMPLE_PER_LANGUAGE}
    assert len(np.unique(x, axis=0)) >= len(x) - 5 and len(x) == len(langs)


def test_linear_models():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    y = np.where(x[:, 0] - 2 * x[:, 3] > 0.1, 1.0, -1.0).astype(np.float32)
    w, b = linear_svm(x, y)
    assert (np.sign(x @ w + b) == y).mean() > 0.98
    v = lasso_logistic(x, (y > 0).astype(float), 0.02)
    assert set(np.flatnonzero(np.abs(v[:-1]) > 0.05)) == {0, 3}
    assert ((sigmoid(x @ v[:-1] + v[-1]) > 0.5) == (y > 0)).mean() > 0.95


def plain_features(text):
    """Hashed n-gram counts of one text, byte by byte."""
    low = [c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in (text or "").lower().encode()]
    counts = [0] * language_tree.DIMENSIONS
    for n in (1, 2, 3):
        for i in range(len(low) - n + 1):
            gram = low[i:i + n]
            if gram[0] != 0x20 or gram[-1] != 0x20:
                code = 0
                for c in gram:
                    code = (code * 257 + c) & 0xFFFFFFFF
                counts[((code * 0x9E3779B1 + n * 0x85EBCA6B) & 0xFFFFFFFF) >> 21] += 1
    x = [c ** 0.5 for c in counts]
    norm = sum(v * v for v in x) ** 0.5
    return [v / max(norm, 1e-9) for v in x]


def plain_language(tree, text):
    """Family by the largest margin, language by the pairs' votes, the surer one on ties."""
    if not any(c.isalpha() for c in text or ""):
        return "und"
    x = plain_features(text)
    dot = lambda w: sum(a * float(b) for a, b in zip(x, w) if a)
    margins = [dot(tree.family_w[:, k]) + float(tree.family_b[k]) for k in range(len(tree.families))]
    family = tree.families[max(range(len(margins)), key=margins.__getitem__)]
    langs = tree.members[family]
    tally = [0.0] * len(langs)
    for a, b, w, c in tree.pairs.get(family, []):
        m = dot(w) + float(c)
        tally[a if m > 0 else b] += 1
        sure = 1 / (1 + np.exp(-4.0 * m))
        tally[a] += sure / (2 * len(langs))
        tally[b] += (1 - sure) / (2 * len(langs))
    return langs[max(range(len(langs)), key=tally.__getitem__)]


def test_language_against_plain_votes(spark):
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("doc_id", "text", "lang")
    tree = language_tree.fit_tree(*language_tree._sample(docs.filter(r"lang is not null").select("text", "lang").filter(F.col("text").rlike(r"\p{L}"))))
    assert any(len(m) > 1 for m in tree.members.values())
    rows = [r for r in docs.orderBy("doc_id").limit(120).collect()]
    got = tree.predict(language_tree.features(pa.array([r["text"] for r in rows], pa.string())))[0]
    want = [plain_language(tree, r["text"]) for r in rows]
    assert [a for a, b in zip(got, want) if b != "und"] == [b for b in want if b != "und"] and len(set(want)) > 2
