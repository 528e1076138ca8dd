"""Bit-packed ids and packing against the tokenizer run on whole texts."""

import zlib

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from towerlens.llm import bitpack, large_item_packing as packing
from towerlens.llm.frames import shared_folder
from towerlens.llm.tokens import WordEncoder, default_tokenizer

ODD = ["", "  ", "Hello WORLD", "a b c\x1cd", "it's <|endoftext|> x<|startoftext|>y", "é ́x", "İstanbul ΣΑΣ ǅ",
       "日本語 テスト 123 4.5", "x" * 3000, "ÉTÉ Größe, ÑANDÚ! ǅungla Łódź İIı ﬁn straße ŒUVRE ŋ ÿ ÀÉ", "ςίσυφος ΣΊΣΥΦΟΣ привет ПРИВЕТ", "e\u0301te\u0301, \u212bngstr\u00f6m x\u0338<",
       "tab\tnew\nline\x0bvt\x0cff\rcr", " line\u0085sep", "👍🏽 ok!!??"]


def whole_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_tokenizer())
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (None, "no id"), (7, "again"), (7, "again")]
    rows += [(1000 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    return rows


def test_word_cache_equals_whole_texts():
    enc = WordEncoder(default_tokenizer())
    assert enc.by_word
    got = enc.encode([t.encode() for t in ODD])
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == whole_ids(ODD)
    enc.by_word = False
    assert enc.encode([t.encode() for t in ODD]) == got


@pytest.mark.parametrize("bits", [1, 3, 13, 16, 17, 31, 32])
def test_pack_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2 ** bits, 1001, np.int64).astype(np.uint32)
    data = bitpack.pack(ids, bits)
    assert len(data) <= (1001 * bits + 7) // 8
    assert (bitpack.unpack(data, bits, 1001) == ids).all()


def test_image_random_access(monkeypatch):
    monkeypatch.setattr(bitpack, "BLOCK_IDS", 8)
    lengths = np.asarray([5, 0, 40, 1])
    ids = np.arange(46, dtype=np.uint32) * 7
    image = bitpack.Image(bitpack.encode_image(np.asarray([3, 4, 4, 9]), lengths, ids, bitpack.id_bits(500)))
    assert image.bits == 9 and image.n_ids == 46
    for a in range(46):
        for n in (0, 1, 9, 46 - a):
            assert (image.read_range(a, min(n, 46 - a)) == ids[a:a + min(n, 46 - a)]).all()
    assert (image.document(2) == ids[5:45]).all()


def test_files_round_trip(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string").selectExpr("*", "1 as start", "'x' as n_tokens").repartition(4)
    path = shared_folder(spark, "t")
    bitpack.write_ids(df, path, default_tokenizer(), end_id=1)
    got = bitpack.read_documents(spark, path, with_ids=True).collect()
    order = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    ids = [x + [1] for x in whole_ids([t for _, t in order])]
    got = sorted(got, key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [d for d, _ in order]
    assert [r["ids"] for r in got] == ids
    assert [r["start"] for r in got] == np.cumsum([0] + [len(x) for x in ids[:-1]]).tolist()
    assert all(r["ids_crc32"] == zlib.crc32(np.asarray(x, "<u4").tobytes()) and r["n_tokens"] == len(x) for r, x in zip(got, ids))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    path = shared_folder(spark, "t")
    bitpack.write_ids(df, path, default_tokenizer())
    assert bitpack.read_documents(spark, path).count() == 0
    assert packing.pack_documents(df, default_tokenizer()).count() == 0


def check_packed(rows, corpus_ids, capacity):
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
    bins = {}
    for r in rows:
        assert 0 < r["length"] <= capacity
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        b.sort()
        at = 0
        for offset, length in b:
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_every_token_once(spark, corpus):
    df = spark.createDataFrame(corpus, "doc_id long, text string").repartition(5)
    packed = packing.pack_documents(df, default_tokenizer(), with_ids=True)
    rows = packed.collect()
    n = check_packed(rows, None, 2048)
    total = sum(r["length"] for r in rows)
    assert n <= 1.02 * -(-total // 2048) + 1
    ids = sorted(x + [0] for x in whole_ids([t for _, t in corpus]))
    by = {}
    for r in rows:
        assert r["start"] == 2048 * r["piece"]
        assert r["ids_crc32"] == zlib.crc32(np.asarray(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
    one = [r for r in rows if r["doc_id"] not in (7,)]
    for r in sorted(one, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["piece"])):
        by.setdefault(r["doc_id"], []).extend(r["ids"])
    want = {d: x + [0] for (d, _), x in zip(corpus, whole_ids([t for _, t in corpus])) if d != 7}
    assert by == want
    assert sorted(r["ids"] for r in rows if r["doc_id"] == 7) == sorted(
        x + [0] for (d, _), x in zip(corpus, whole_ids([t for _, t in corpus])) if d == 7)
    seqs = packing.sequences(packing.pack_pieces(spark.createDataFrame(rows, packed.schema).drop("sequence_id", "offset"))).collect()
    assert sum(len(r["ids"]) for r in seqs) == total and len(seqs) == n and len(ids) == len(corpus)


@pytest.mark.parametrize("seed", range(6))
def test_plan_bins_is_a_packing_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = [rng.integers(1, 101, 5000), rng.integers(34, 101, 3000), rng.integers(30, 60, 999), np.full(777, 51),
               np.concatenate([rng.integers(60, 101, 500), rng.integers(1, 10, 4000)]), np.asarray([100, 1])][seed]
    found, counts = np.unique(lengths, return_counts=True)
    segments, bins = packing.plan_bins(dict(zip(found.tolist(), counts.tolist())), 100)
    fill, large = np.zeros(bins, int), np.zeros(bins, int)
    for length in found[::-1]:
        mine = sorted(s for s in segments if s[0] == length)
        total = int(counts[found == length][0])
        for s, nxt in zip(mine, [*mine[1:], (length, total)]):
            for r in range(s[1], nxt[1]):
                b, k = s[2] + (r - s[1]) // s[3], (r - s[1]) % s[3]
                assert fill[b] == s[4] + k * length
                fill[b] += length
                large[b] += 3 * length > 100
    assert fill.sum() == lengths.sum() and fill.max() <= 100 and (fill > 0).all() and large.max() <= 2
    if seed in (0, 4):
        assert bins <= 1.02 * lengths.sum() / 100 + 1
