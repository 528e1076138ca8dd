import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm import brute
from towerlens.llm import queries, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = {"u": "user", "a": "assistant"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """Cheapest, then least audit and its repaired rows, by a best-first search over (row, what was said)."""
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, said, lines = heapq.heappop(queue)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", said):
            return cost, audit, lines
        state = (i, "a" if said.endswith("a") else said)
        state = (i, said[-1:] if said else "")
        if state in done:
            continue
        done.add(state)

        def push(c, letter, j, initial, line):
            after = said + initial
            if re.fullmatch("s?(ua)*u?", after) and len(initial) == (letter != "D"):
                heapq.heappush(queue, (cost + c, audit + letter, j, after, lines + (line,) if line is not None else lines))

        for x, name in NAMES.items():
            push(3, "I", i, x, f"{name}:")
        if i < len(rows):
            role, text = rows[i][2], rows[i][3]
            push(4, "D", i + 1, "", None)
            if fault[i] not in ("blank", "duplicate"):
                more = 3 * (fault[i] == "truncated")
                push(more, "K", i + 1, role[:1], f"{role}:{text}")
                for x, name in NAMES.items():
                    push(3 + more, "R", i + 1, x, f"{name}:{text}")


def expected(conv, rows):
    turns = [t for _, t, _, _ in rows if t is not None]
    fault = faults(rows)
    cost, audit, lines = cheapest(rows, fault)
    initials = [r[2][:1] for r in rows]
    return (conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, brute.sha("\n".join(lines)))


def ordered(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))


def by_conversation(rows, given):
    return [expected(c, ordered([r for r in rows if r[0] == c])) for c in {r[0] for r in given}]


def made_up(seed, n, turns=9):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "Well?", "cut off", "  ", "", "More text here.", "again. "]
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", ""]), rng.choice(texts)))
    return rows


def answers(spark, rows, **options):
    """The query's columns for rows taken as they are."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = turn_repair.repair(turn_repair.prepared(df), **options)
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in found.whole.withColumn("repaired_sha256", F.sha2(lines.cast("binary"), 256)).select(names).collect()]
    if found.totals is not None:
        digests = turn_repair.long_digests(found.edits).withColumnRenamed("conv_id", "id")
        got += [tuple(r) for r in found.totals.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).select(names).collect()]
    return sorted(got, key=repr)


def test_cheapest_and_least_against_a_search(spark):
    rows = made_up(5, 250)
    assert answers(spark, rows) == sorted(by_conversation(rows, rows), key=repr)


@pytest.mark.parametrize("chunk", [4, 16])
def test_long_conversations_in_chunks_give_the_same(spark, chunk):
    rows = made_up(11, 30, turns=40) + [(None, t, "user", "Hm.") for t in range(12)]
    plain = answers(spark, rows)
    assert plain == sorted(by_conversation(rows, rows), key=repr)
    assert answers(spark, rows, long_rows=6, chunk_rows=chunk) == plain


def test_a_conversation_of_equal_rows_is_dealt_over_tasks(spark):
    rows = [(1, None, "user", "Same.")] * 3000 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Yes.")]
    plain = answers(spark, rows)
    assert answers(spark, rows, long_rows=100, chunk_rows=64) == plain
    one = next(r for r in plain if r[0] == 1)
    # the first stays with an answer inserted, the others are repeats
    assert one[:7] == (1, 0, 0, 2999, 0, 2999, 4 * 2999 + 3) and one[7] == "D" * 0 + min("K" + "D" * k + "I" + "D" * (2999 - k) for k in (0, 2999))


def test_a_million_bytes_and_one_long_conversation(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(2001)] + [(2, 0, "user", "x" * 1_000_000 + ".")]
    got = {r[0]: r for r in answers(spark, rows)}
    assert got[1][6:8] == (3, "K" * 2001 + "I") and got[2][6:8] == (3, "KI")


def test_query_on_damaged_rows(spark, tmp_path):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").collect()]
    rows += [(None, None, None, None), (None, 1, "user", "Hm."), (900, None, "user", "A."), (900, None, "assistant", None), (901, 5, None, "B."),
             (902, 3, "user", " "), (903, 2, "system", "S."), (904, 1, "tool", "T"), (904, 1, "user", "U!"), (905, -3, "user", "x. "), (905, 9, "assistant", "y.")]
    # a conversation of which nothing is left
    gone = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Gone."))
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("here", F.lit("x")).withColumn("mark", F.lit(1)).withColumn("kind", F.lit(0))
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted((tuple(r) for r in queries.op11_turn_repair(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(by_conversation(damage(rows), rows), key=repr)
    assert (gone, 0, 0, 0, 0, 0, 0, "", brute.sha("")) in got


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_turn_repair(spark, str(tmp_path))
    assert got.collect() == [] and got.columns[0] == "conv_id" and len(got.columns) == 9
