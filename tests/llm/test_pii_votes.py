import random
import re

import numpy as np

from tests.conftest import SF_CHECK
from tests.llm import brute
from towerlens.llm import pii_votes, queries

FORMS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def base(text):
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        for m in form.finditer(text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            luhn = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end()))
    return [f"{list(FORMS)[k]}:{s}:{e}" for s, k, e in sorted(out)]


def fuzz(rng):
    bits = ["a@b.co", "x.y+z@ho-st.example.org", "@", ".", "@b.com@c.org", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "01.002.0003.4", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "4111111111111111", "1 2", "1  2", "+1 (555) 123-4567", "+49 30 1234567890123", "+1", "++4412345678901", "é", "日本", " ", "  ", "-",
            "12", "123", "(at)", "bob [at] host [dot] com", "555-123-4567", "(555) 123-4567", "call 555-123-4567", "x", "\n", "+12345678901.", "378282246310005", "0" * 14]
    return "".join(rng.choice(bits) + rng.choice(["", "", " ", "a"]) for _ in range(rng.randint(0, 12)))


def rows_of(spark):
    rng = random.Random(9)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    rows += [(10_000 + k, fuzz(rng)) for k in range(1500)]
    return rows + [(20_000, None), (20_001, ""), (None, "a@b.co"), (20_002, "1" * 60000 + "."), (20_003, "a" * 60000 + "@"), (20_004, "a@b.co"), (20_004, "a@b.co"),
                   (20_005, "a@" * 20000), (20_006, "1." * 20000), (20_007, "+1-" * 20000)]


def test_base_spans_equal_the_plain_forms(spark, tmp_path):
    rows = rows_of(spark)
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "'x' as spans").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op8_pii_votes(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    want = {d: base(t) for d, t in rows}
    for r in got:
        b = want[r["doc_id"]]
        assert r["base_sha256"] == brute.sha(",".join(b)), (r, b[:5])
        assert [r[f"n_{k}"] for k in FORMS] == [sum(x.startswith(k) for x in b) for k in FORMS]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(b) <= set(spans)
        order = [(int(s.split(":")[1]), list(FORMS).index(s.split(":")[0])) for s in spans]
        assert order == sorted(order)
    text = dict(rows)
    extra = [(text[r["doc_id"]][int(a):int(e)]) for r in got if r["spans"] for k, a, e in [x.split(":") for x in r["spans"].split(",")]
             if f"{k}:{a}:{e}" not in want[r["doc_id"]]]
    assert all(re.search(r"[0-9]{4}$|at", x) for x in extra)


def test_given_documents_get_no_false_spans(spark):
    got = queries.op8_pii_votes(spark, SF_CHECK).collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    assert all((r["spans"].split(",") if r["spans"] else []) == base(text[r["doc_id"]]) for r in got)


def test_masking_and_empty_table(spark):
    df = spark.createDataFrame([(1, "mail a@b.co now é +1 (555) 123-4567!"), (2, None)], "doc_id long, text string")
    assert {(r["doc_id"], r["text"]) for r in pii_votes.masked(df).collect()} == {(1, "mail [email] now é [phone]!"), (2, "")}
    assert pii_votes.find_spans(df.limit(0)).collect() == []


def test_reliabilities_find_the_good_labeler():
    rng = np.random.default_rng(4)
    truth = rng.random(4000) < 0.6
    votes = ["".join(("+" if t else "-") if rng.random() < q else ("-" if t else "+") for q in (0.95, 0.9, 0.55)) for t in truth]
    patterns, counts = np.unique(votes, return_counts=True)
    share, chance, post = pii_votes.reliabilities(list(patterns), counts.astype(float))
    assert abs(share - 0.6) < 0.06
    assert chance[1, 0, 0] > 0.9 > chance[1, 2, 0]
    sure = dict(zip(patterns, post))
    assert np.mean([(sure[v] > 0.5) == t for v, t in zip(votes, truth)]) > 0.93


def test_masking_of_rows_that_share_an_id(spark):
    rows = [(1, "mail a.b@example.com now"), (1, "nothing here to hide, c.d@example.com"), (None, "x e.f@example.com"), (None, "plain"), (None, None), (1, "mail a.b@example.com now")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(str, map(tuple, pii_votes.masked(df).collect())))
    want = [(1, "mail [email] now"), (1, "mail [email] now"), (1, "nothing here to hide, [email]"), (None, "x [email]"), (None, "plain"), (None, "")]
    assert got == sorted(map(str, want))
