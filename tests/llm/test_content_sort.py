import random
import re

from tests.conftest import SF_SMALL
from tests.llm import brute
from towerlens.llm import content_sort


def expected(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    keep = {t: min((d for d in g if d is not None), default=None) for t, g in groups.items()}
    return sorted(((d, keep[n], len(groups[n]), brute.sha(n)) for d, t in rows
                   for n in [re.sub(r"[\x20\x09-\x0D]+", " ", t or "")]), key=repr), len(groups)


def check(df, rows):
    got = content_sort.exact_duplicates(df).collect()
    want, n = expected(rows)
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=repr) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == n and all(r["doc_id"] == r["keep_id"] for r in kept)
    left = content_sort.drop_exact_duplicates(df)
    assert left.columns == df.columns
    assert sorted((r["doc_id"] for r in left.collect()), key=repr) == sorted((r["doc_id"] for r in kept), key=repr)


def rows_with_a_hot_text():
    rng = random.Random(3)
    rows = [(i, "the  same\ttext" if rng.random() < 0.4 else f"{'shared opening ' * 9}{rng.randint(0, 150)}") for i in range(900)]
    rows += [(5000, None), (5001, ""), (5002, " "), (5003, "\t\n"), (None, "no id"), (None, "no id"), (None, "the same text"),
             (7, "again"), (7, "again"), (8, "a b"), (9, "a b"), (10, "é" * 90000), (11, "é" * 90000 + "x")]
    rng.shuffle(rows)
    return rows


def test_defined_cases_and_hot_text(spark):
    rows = rows_with_a_hot_text()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as keep_id", "'k' as kept", "cast(null as string) as norm", "2 as salt", "3 as id").repartition(5)
    check(df, rows)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(df, [(r["doc_id"], r["text"]) for r in df.collect()])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert content_sort.exact_duplicates(df).count() == 0 and content_sort.drop_exact_duplicates(df).count() == 0


def test_one_exchange_of_the_texts_and_no_python(spark):
    for rows in (rows_with_a_hot_text(), [(i, str(i)) for i in range(200)]):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).checkpoint()
        plan = content_sort.exact_duplicates(df)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("rangepartitioning") == 1 and "Python" not in plan and "Arrow" not in plan
        hot = "BroadcastExchange" in plan
        assert hot == (len(rows) > 800) and plan.count("Exchange ") == (5 if hot else 1)
