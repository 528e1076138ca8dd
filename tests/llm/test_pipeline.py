"""The pipeline's stages against plain versions on a small table with planted cases."""

import random
import re

import pytest

import corpus_pipeline
from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm import brute, test_phrase_index
from towerlens.llm.frames import shared_folder


def run_stages(spark, docs, sf_dir):
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        path = shared_folder(spark, "stage")
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(8)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    clean = [r for r in rows if len(r[1].split()) > 150][:20]
    for k, r in enumerate(clean):
        w = r[1].split(" ")
        rows.append((5000 + k, r[1].replace(" ", "  "), *r[2:]))
        near = list(w)
        near[len(w) // 2] = "different"
        rows.append((6000 + k, " ".join(near), *r[2:]))
        leak = w[:40] + bench[k % len(bench)].split(" ")[:30] + w[-60:]
        rng.shuffle(w)
        rows.append((7000 + k, " ".join(leak + w), *r[2:]))
    rows += [(8000, None, "en", None, None), (8001, "", None, "s", 0), (8000, None, "en", None, None), (8002, rows[3][1], None, None, 1), (3, *rows[3][1:])]
    return spark.createDataFrame(rows, spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema).repartition(3)


def test_stages(spark, planted):
    _, good, unique, apart, clean, packed = run_stages(spark, planted, SF_CHECK)
    assert [x.columns for x in (good, unique, apart, clean)] == [planted.columns] * 4
    rows = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    first, second, third, fourth = map(rows, (good, unique, apart, clean))
    kept = {}
    for d, t in first:
        n = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        kept[n] = min(kept.get(n, d), d)
    assert sorted(d for d, _ in second) == sorted(kept.values())
    want = brute.components([(d, brute.shingles(t, 5)) for d, t in second], 80)
    assert [d for d, _ in third] == [d for d, _ in second if want[d] == d]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()]
    hit = {d for d, _, n, _ in test_phrase_index.matches(third, items) if n}
    assert [d for d, _ in fourth] == [d for d, _ in third if d not in hit]
    ids = {d for d, _ in fourth}
    assert not ids & set(range(5000, 8000)) or not ids & set(range(7000, 8000))
    assert {r["doc_id"] for r in packed.collect()} == ids
    assert len(first) >= 0.8 * planted.count()


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    last = run_stages(spark, docs, SF_SMALL)[-1]
    pieces = lambda df: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in df.collect())
    assert pieces(corpus_pipeline.run(spark, SF_SMALL)) == pieces(last)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    assert [x.count() for x in run_stages(spark, docs, SF_SMALL)] == [0] * 6
