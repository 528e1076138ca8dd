import random
import re

import pytest

from tests.llm import brute
from towerlens.llm import phrase_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(brute.lower_az(text))


def matches(docs, items, size=10):
    windows = {}
    for item, t in items:
        w = words(t)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        out.append((d, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def tables(spark, seed=2):
    rng = random.Random(seed)
    some = lambda n: [rng.choice("the of a in to and is re that on".split()) if rng.random() < 0.5 else f"w{rng.randrange(400)}" for _ in range(n)]
    items = [(k, " ".join(some(rng.randint(1, 45)))) for k in range(30)]
    items = [(k, t if len(t.split()) > 4 else "Rare" + t + " words here now") for k, t in items]
    items += [(100, None), (101, "!!"), (102, items[3][1]), (103, "Été, ça-va? 42"), (3, items[3][1]), (104, "the " * 14)]
    docs = []
    for k in range(120):
        w = some(rng.randint(0, 90))
        if k % 3 == 0:
            t = items[rng.randrange(30)][1].split()
            a = rng.randint(0, max(0, len(t) - 10))
            w[len(w) // 2:len(w) // 2] = t[a:a + rng.randint(8, 25)]
        docs.append((k, rng.choice([" ", ", ", "\n", "--"]).join(w).upper() if k % 5 == 0 else " ".join(w)))
    docs += [(500, None), (501, ""), (502, "the " * 300), (502, "the " * 300), (None, items[5][1]), (503, "x été ça va 42 y"), (504, "w1 " * 20000)]
    return docs, items


@pytest.mark.parametrize("block", [400_000, 120])
def test_phrases(spark, monkeypatch, block):
    monkeypatch.setattr(phrase_index, "BLOCK_WORDS", block)
    monkeypatch.setattr(phrase_index, "PART_WORDS", 4096 if block > 1000 else 20)
    monkeypatch.setattr(phrase_index, "_CANDIDATES", 2_000_000 if block > 1000 else 50)
    docs, items = tables(spark)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as key", "2 as id", "3 as spans").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' as words")
    got = phrase_index.phrase_matches(df, bench).collect()
    for r in got:
        assert all(a["end"] < b["start"] for a, b in zip(r["spans"], r["spans"][1:]))
    assert sorted(((r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), sorted(r["items"])) for r in got), key=repr) \
        == matches(docs, items)
    left = phrase_index.drop_contaminated(df, bench)
    assert left.columns == df.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((d for d, _, n, _ in matches(docs, items) if not n), key=repr)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert {(r["doc_id"], r["n_words"], len(r["spans"])) for r in phrase_index.phrase_matches(docs, bench.limit(0)).collect()} == {(1, 2, 0), (2, 0, 0)}
    assert phrase_index.phrase_matches(docs.limit(0), bench).collect() == []
    assert phrase_index.drop_contaminated(docs, bench.limit(0)).count() == 2


@pytest.mark.parametrize("block", [400_000, 12])
def test_items_without_id(spark, monkeypatch, block):
    monkeypatch.setattr(phrase_index, "BLOCK_WORDS", block)
    items = [(None, "one two three"), (None, "four five six"), (7, "one two three"), (-2, "seven eight nine"), (None, None)]
    docs = [(1, "x one two three x"), (2, "four five six one two three"), (3, "seven eight nine"), (4, "four five six"), (5, "x"), (6, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in phrase_index.phrase_matches(df, bench).collect()}
    assert got == {1: (3, [7, None]), 2: (6, [7, None]), 3: (3, [-2]), 4: (3, [None]), 5: (0, []), 6: (0, [])}
    assert sorted(r["doc_id"] for r in phrase_index.drop_contaminated(df, bench).collect()) == [5, 6]


def test_proximity(spark):
    docs = [(1, "alpha x x beta x x gamma"), (2, "gamma beta " + "x " * 50 + "alpha"), (3, "beta gamma alpha " + "x " * 40 + "alpha"), (4, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(7, "alpha beta gamma x"), (8, "alpha missing"), (9, "")], "item_id long, text string")
    got = sorted(tuple(r) for r in phrase_index.proximity_matches(df, bench, terms=3, span=6).collect())
    assert {(d, i) for d, i, _ in got} == {(1, 7), (3, 7)}
