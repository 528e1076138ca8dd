"""Repair of the turn structure of conversations at least cost, by ranked paths.

A repaired conversation has turns whose role initials read ``(s?(ua)+)?``.
Rows are kept, given the role that the place needs, or deleted, and empty rows
are inserted.  Where a conversation stands is one of four states (nothing yet,
after system, after user, after assistant), so a conversation of n rows is a
graph of ``4 * (n + 1)`` nodes whose arcs are edits; each letter leads from a
node to at most one other.

1. *Cost.*  From the last row back, the least cost from every node on.
2. *Ranks.*  Arcs on cheapest paths are the nodes of a second graph; an arc
   points to the least arc that can follow it.  Ranked by their letter first,
   they are then ranked by 2, 4, 8, ... letters: a rank and the rank of what
   the pointer reaches make the next rank, and a pointer's pointer the next
   pointer.  The least-ranked arc out of the start begins the least audit, and
   the doubled pointers, read from the longest down, list its arcs.  As a
   letter leaves one choice of target, the least string of ``2 * m`` letters
   begins with the least string of ``m`` letters, which makes this exact.

Many conversations of like length are worked on at once with numpy.

A conversation of more than ``LONG_ROWS`` rows or ``LONG_BYTES`` bytes is cut:
its rows are range-partitioned in order and numbered, and every chunk of at
most ``CHUNK_ROWS`` rows gives the least cost from each state to each state (a
4 x 4 matrix of the min-plus algebra).  Matrices combine from the right into
the costs to go at every border, then chunks are ranked apart for each state in
which they may be entered, and the entries follow from the left.  What is
gathered for one conversation is a matrix a chunk: as an audit is one text cell
(below 2**31 letters), at most some 131,000 of them.  Texts are never grouped;
only the digest of a repaired conversation, which is sequential by definition,
streams them through one task, a batch at a time.

Defined cases: rows go by (turn, nulls first; role; hash of the text; text);
null role or text is one space; a role that begins with none of the letters
s, u, a, or an empty one, cannot be kept; null conversation ids are one
conversation; rows that are not ``present`` only name their conversation; a
conversation without rows has zeros and an empty audit; an empty table gives no
row; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import broadcast_if_small, joined_small, map_texts, stored

LONG_ROWS = 16_384
LONG_BYTES = 32 << 20
CHUNK_ROWS = 1 << 14
_WORK_ROWS = 4096            # rows of whole conversations worked on at a time

START, SYSTEM, USER, ASSISTANT = range(4)
S, U, A, OTHER = range(4)                        # role initials
OK, BLANK, DUPLICATE, TRUNCATED = range(4)       # first fault of a row
LETTERS = b"DIKR"                                # in ASCII order
_D, _I, _K, _R = range(4)
FAR = 1 << 40                                    # stands for an infinite cost
#: state after an inserted or re-roled row, by state; state after a kept row, by state and initial (4: not allowed)
_NEXT = np.asarray([USER, USER, ASSISTANT, USER])
_KEEP = np.asarray([[SYSTEM, USER, 4, 4], [4, USER, 4, 4], [4, 4, ASSISTANT, 4], [4, USER, 4, 4]])
_LEGAL = ((S, U), (U, A), (A, U))

ROWS = "conv_id long, turn long, role string, text string, initial int, fault int"
SOLVED = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired array<struct<role:string,text:string>>")


@dataclass(frozen=True)
class Costs:
    """Costs of edits; an insertion must cost something, or audits would have no end."""

    rerole: int = 3
    delete: int = 4
    insert: int = 3
    truncated: int = 3       # for every truncated row that is not deleted

    def closed(self) -> np.ndarray:
        """Cost to a legal end from each state, when no row is left."""
        return np.asarray([0, 2 * self.insert, self.insert, 0], np.int64)


# --- graph -----------------------------------------------------------------

def _before(after: np.ndarray, initial: np.ndarray, fault: np.ndarray, costs: Costs) -> np.ndarray:
    """Least costs on from the states in front of a row, given those behind it."""
    padded = np.concatenate([after, np.full((len(after), 1), FAR)], axis=1)
    kept = np.take_along_axis(padded, _KEEP[:, initial].T, axis=1)
    stays = np.minimum(kept, costs.rerole + after[:, _NEXT]) + np.where(fault == TRUNCATED, costs.truncated, 0)[:, None]
    go = np.where(((fault == BLANK) | (fault == DUPLICATE))[:, None], FAR, stays)
    go = np.minimum(go, costs.delete + after)
    user = np.minimum(go[:, USER], costs.insert + go[:, ASSISTANT])
    out = np.stack([np.minimum(go[:, START], costs.insert + user), np.minimum(go[:, SYSTEM], costs.insert + user), user,
                    np.minimum(go[:, ASSISTANT], costs.insert + go[:, USER])], axis=1)
    return np.minimum(out, FAR)


def costs_to_go(first: np.ndarray, initial: np.ndarray, fault: np.ndarray, right: np.ndarray, costs: Costs) -> np.ndarray:
    """Least cost from each node on.  Row ``r`` of conversation ``c`` lies between levels ``r + c`` and ``r + c + 1``;
    ``right`` has the costs at each conversation's last level."""
    lengths = np.diff(first)
    base = first[:-1] + np.arange(len(lengths))
    go = np.empty((int(first[-1]) + len(lengths), 4), np.int64)
    go[base + lengths] = right
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths = -lengths[order]
    for t in range(1, int(lengths.max(initial=0)) + 1):
        c = order[:np.searchsorted(sorted_lengths, -t, "right")]
        row = first[c] + lengths[c] - t
        go[row + c] = _before(go[row + c + 1], initial[row], fault[row], costs)
    return go


@dataclass
class Paths:
    """Least audits, one after the other: how many letters each has, and for each letter its code, row (-1: none)
    and the state it leads to."""

    count: np.ndarray
    letter: np.ndarray
    row: np.ndarray
    state: np.ndarray


def _arcs(first: np.ndarray, initial: np.ndarray, fault: np.ndarray, go: np.ndarray, closes: bool, costs: Costs):
    """Letter, node it leaves, node it leads to and row of every arc on a cheapest path."""
    lengths = np.diff(first)
    conv = np.repeat(np.arange(len(lengths)), lengths)
    rows = np.arange(len(conv))
    level = rows + conv
    flat, found = go.ravel(), []
    extra = np.where(fault == TRUNCATED, costs.truncated, 0)
    may_stay = (fault != BLANK) & (fault != DUPLICATE)

    def add(letter: int, at: np.ndarray, to: np.ndarray, cost, allowed, row: np.ndarray) -> None:
        some = np.flatnonzero(allowed & (flat[at] < FAR))
        on = some[(flat[to[some]] + np.broadcast_to(cost, at.shape)[some]) == flat[at[some]]]
        found.append((np.full(len(on), letter), at[on], to[on], row[on]))

    last = first[1:] + np.arange(len(lengths))
    inserts = np.concatenate([level, last]) if closes else level
    for s in range(4):
        at, behind = 4 * level + s, 4 * (level + 1)
        add(_D, at, behind + s, costs.delete, np.True_, rows)
        add(_I, 4 * inserts + s, 4 * inserts + _NEXT[s], costs.insert, np.True_, np.full(len(inserts), -1))
        state = _KEEP[s, initial]
        add(_K, at, behind + np.minimum(state, 3), extra, may_stay & (state < 4), rows)
        add(_R, at, behind + _NEXT[s], costs.rerole + extra, may_stay, rows)
    return (np.concatenate(x) for x in zip(*found))


def least_paths(first: np.ndarray, initial: np.ndarray, fault: np.ndarray, go: np.ndarray, entries: np.ndarray,
                closes: bool, costs: Costs) -> Paths:
    """The least audit of each conversation from each of its ``entries`` (states, one row a conversation), by
    prefix doubling over the arcs of cheapest paths."""
    letter, src, dst, row = _arcs(first, initial, fault, go, closes, costs)
    order = np.lexsort((letter, src))
    letter, src, dst, row = letter[order], src[order], dst[order], row[order]
    end = len(letter)                                     # an arc that follows last arcs, and itself
    rank = np.append(letter + 1, 0)
    out = np.full(go.size, end)
    nodes, lead = np.unique(src, return_index=True)       # arcs out of a node differ in their letter: the first is least
    out[nodes] = lead
    pointer = np.append(out[dst], end)
    base = first[:-1] + np.arange(len(first) - 1)
    starts = out[(4 * base[:, None] + entries)].ravel()
    doubled = []
    while (pointer[:-1] != end).any():
        doubled.append(pointer)
        _, rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)
        # ranks now tell 2, 4, 8, ... letters apart: of the arcs out of a node the least-ranked one is followed
        best = np.lexsort((rank[:-1], src))
        out[nodes] = best[lead]
        starts = out[(4 * base[:, None] + entries)].ravel()
        pointer = pointer[pointer]
    path = starts[:, None]
    for p in reversed(doubled):
        path = np.stack([path, p[path]], axis=2).reshape(len(starts), -1)
    on = path != end
    arcs = path[on]
    return Paths(on.sum(axis=1), letter[arcs], row[arcs], dst[arcs] % 4)


# --- whole conversations ------------------------------------------------------

def _classes(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Conversations of like length (within a factor of two)."""
    size = np.frexp(lengths.astype(float))[1]
    for s in np.unique(size):
        yield np.flatnonzero(size == s)


def _first_faults(codes: np.ndarray, fault: np.ndarray) -> np.ndarray:
    """``fault`` with what repeats an earlier row (equal codes) as DUPLICATE, unless blank."""
    _, at, which = np.unique(codes, return_index=True, return_inverse=True)
    return np.where((fault != BLANK) & (at[which] != np.arange(len(codes))), DUPLICATE, fault)


def _illegal(initial: np.ndarray) -> np.ndarray:
    """For each row but the first, whether it may not follow the one before."""
    a, b = initial[:-1], initial[1:]
    return ~np.logical_or.reduce([(a == x) & (b == y) for x, y in _LEGAL])


def solve_rows(table: pa.Table, costs: Costs = Costs()) -> pa.RecordBatch:
    """Repair whole conversations; ``table`` has ROWS in order, rows with a null initial only name a conversation."""
    table = table.combine_chunks()
    ids = table["conv_id"].combine_chunks() if table.num_rows else pa.array([], pa.int64())
    known, value = ids.is_valid().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy()
    new = np.ones(len(ids), bool)
    new[1:] = (value[1:] != value[:-1]) | (known[1:] != known[:-1])
    names = ids.take(pa.array(np.flatnonzero(new)))
    conv = np.cumsum(new) - 1
    present = table["initial"].is_valid().to_numpy()
    table, conv = table.filter(pa.array(present)).combine_chunks(), conv[present]
    roles, texts = ((table[c].combine_chunks() if table.num_rows else pa.array([], pa.string())) for c in ("role", "text"))
    n = len(names)
    first = np.searchsorted(conv, np.arange(n + 1))
    lengths = np.diff(first)
    initial, fault = (table[c].to_numpy().astype(np.int64) for c in ("initial", "fault"))
    # equal codes: same conversation, role and text
    code = np.unique(np.stack([conv, _codes(roles), _codes(texts)], axis=1), axis=0, return_inverse=True)[1].ravel() if len(conv) else conv
    fault = _first_faults(code, fault)
    wrong = np.zeros(len(conv), bool)
    wrong[1:] = _illegal(initial) & (conv[1:] == conv[:-1])

    cost, parts = np.zeros(n, np.int64), []
    for some in _classes(lengths):
        size = lengths[some]
        own = np.concatenate([[0], np.cumsum(size)])
        rows = np.repeat(first[some] - own[:-1], size) + np.arange(own[-1])
        go = costs_to_go(own, initial[rows], fault[rows], np.broadcast_to(costs.closed(), (len(some), 4)), costs)
        cost[some] = go[own[:-1] + np.arange(len(some)), START]
        p = least_paths(own, initial[rows], fault[rows], go, np.full((len(some), 1), START), True, costs)
        of = np.append(rows, -1)                          # -1, an inserted row, stays -1
        parts.append((np.repeat(some, p.count), p.letter, of[p.row], p.state))
    which, letter, row, state = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 4
    order = np.argsort(which, kind="stable")
    which, letter, row, state = which[order], letter[order], row[order], state[order]

    out = letter != _D
    role, text = edited(roles, texts, letter[out], row[out], state[out])
    pairs = pa.StructArray.from_arrays([role, text], ["role", "text"])

    def per(flags: np.ndarray) -> pa.Array:
        return pa.array(np.bincount(conv[flags], minlength=n).astype(np.int64))

    turn = table["turn"].combine_chunks() if table.num_rows else pa.array([], pa.int64())
    return pa.RecordBatch.from_arrays(
        [names, pa.array(_gaps(conv, turn, n)), *(per(fault == f) for f in (BLANK, DUPLICATE, TRUNCATED)), per(wrong), pa.array(cost),
         _strings(which, letter, n), pa.ListArray.from_arrays(_offsets(which[out], n), pairs)],
        ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"])


def _codes(column: pa.Array) -> np.ndarray:
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _offsets(which: np.ndarray, n: int) -> pa.Array:
    return pa.array(np.searchsorted(which, np.arange(n + 1)).astype(np.int32))


def _strings(which: np.ndarray, letter: np.ndarray, n: int) -> pa.Array:
    text = np.frombuffer(LETTERS, np.uint8)[letter]
    return pa.Array.from_buffers(pa.string(), n, [None, _offsets(which, n).buffers()[1], pa.py_buffer(text.tobytes())])


def edited(roles: pa.Array, texts: pa.Array, letter: np.ndarray, row: np.ndarray, state: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Roles and texts of the rows that edits leave or insert."""
    named = pa.concat_arrays([roles, pa.array(["user", "assistant"], roles.type)])
    own = np.where(letter == _K, row, len(roles) + (state == ASSISTANT))
    told = pa.concat_arrays([texts, pa.array([""], texts.type)])
    return named.take(pa.array(own)), told.take(pa.array(np.where(letter == _I, len(texts), row)))


def _gaps(conv: np.ndarray, turn: pa.Array, n: int) -> np.ndarray:
    known = turn.is_valid().to_numpy(zero_copy_only=False)
    c, t = conv[known], turn.filter(pa.array(known)).to_numpy()
    gaps = np.zeros(n, np.int64)
    if len(c):
        new = np.ones(len(c), bool)
        new[1:] = c[1:] != c[:-1]
        fresh = new.copy()
        fresh[1:] |= t[1:] != t[:-1]
        at = np.flatnonzero(new)
        end = np.append(at[1:], len(c)) - 1
        gaps[c[at]] = t[end] - t[at] + 1 - np.add.reduceat(fresh.astype(np.int64), at)
    return gaps


# --- jobs -------------------------------------------------------------------

def prepared(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
             present: Column | None = None) -> DataFrame:
    """ROWS and a hash of the text, with what shows in a row alone: its role's initial, and whether it is blank or
    truncated.  ``present`` is a condition on the columns of ``df``."""
    here = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    role, text = (F.when(F.col("here"), F.coalesce(F.col(c).cast("string"), F.lit(" "))).otherwise("") for c in ("role", "text"))
    letter = F.substring("role", 1, 1)
    initial = F.when(letter == "s", S).when(letter == "u", U).when(letter == "a", A).otherwise(OTHER)
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK)
             .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), TRUNCATED).otherwise(OK))
    return (df.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                      F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text"), here.alias("here"))
            .withColumns({"role": role, "text": text})
            .withColumns({"initial": F.when(F.col("here"), initial), "fault": F.when(F.col("here"), fault), "mark": F.xxhash64("text")})
            .drop("here"))


@dataclass
class Repaired:
    """``whole`` has SOLVED for every conversation worked on at once.  Of the long ones (None if there are none),
    ``totals`` has SOLVED without audit and repaired, and ``edits`` one row for each letter of the audit:
    ``conv_id, place, letter, role, text`` (the last two null where a row is deleted)."""

    whole: DataFrame
    totals: DataFrame | None = None
    edits: DataFrame | None = None


def repair(rows: DataFrame, costs: Costs = Costs(), long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES,
           chunk_rows: int = CHUNK_ROWS) -> Repaired:
    """Repair every conversation of ``prepared`` rows."""
    sizes = rows.groupBy("conv_id").agg(F.count("initial").alias("n"), F.sum(F.length("text")).alias("bytes"))
    long = stored(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes)).select(F.col("conv_id").alias("long_id")), "long")
    if long.isEmpty():
        return Repaired(_solve_whole(rows, costs))
    found = broadcast_if_small(long)
    is_long = rows["conv_id"].eqNullSafe(found["long_id"])
    whole = _solve_whole(rows.join(found, is_long, "left_anti"), costs)
    return Repaired(whole, *_solve_long(rows.join(found, is_long, "left_semi"), costs, chunk_rows))


def _solve_whole(rows: DataFrame, costs: Costs) -> DataFrame:
    order = ["conv_id", "turn", "role", "mark", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < _WORK_ROWS:
                continue
            table = pa.Table.from_batches(held)
            ids = table["conv_id"]
            # the last conversation may go on in the next batch
            last = ids[len(ids) - 1]
            rest = pc.fill_null(pc.equal(ids, last), False) if last.is_valid else ids.is_null()
            done = table.num_rows - pc.sum(rest).as_py()
            if done:
                yield solve_rows(table.slice(0, done), costs)
                held = table.slice(done).combine_chunks().to_batches()
        if sum(b.num_rows for b in held):
            yield solve_rows(pa.Table.from_batches(held), costs)

    dealt = rows.repartition("conv_id").sortWithinPartitions(*order).drop("mark")
    return dealt.transform(map_texts, run, SOLVED)


SUMMARY = ("conv_id long, chunk long, matrix array<long>, head int, tail int, n long, blank long, duplicate long, truncated long, "
           "illegal long, least long, most long, turns long")


def _solve_long(rows: DataFrame, costs: Costs, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Totals and edits of long conversations, whose rows are dealt by ranges of their order."""
    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 16))      # equal rows may go to several tasks
    order = ["conv_id", "turn", "role", "mark"]
    numbered = stored(rows.where(F.col("initial").isNotNull()).withColumn("salt", salt)
                      .repartitionByRange(*order, "salt").sortWithinPartitions(*order, "text")
                      .withColumn("pos", F.monotonically_increasing_id()).drop("salt", "mark"), "turns")
    same = F.when(F.col("fault") != BLANK, F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")),
                                                            F.length("role"), F.col("role"), F.col("text")), 256))
    keyed = numbered.select("conv_id", "pos", "turn", "initial", "fault", same.alias("same"))
    repeats = stored(keyed.where(F.col("same").isNotNull()).groupBy("same").agg(F.min("pos").alias("earliest"), F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > 1).select("same", "earliest"), "repeats")
    light = stored(joined_small(keyed, repeats, ["same"], "left").select(
        "conv_id", F.floor(F.col("pos") / chunk_rows).cast("long").alias("chunk"), "pos", "turn", "initial",
        F.when(F.col("pos") > F.col("earliest"), DUPLICATE).otherwise(F.col("fault")).alias("fault")), "light")
    chunks = stored(light.groupBy("conv_id", "chunk").applyInArrow(lambda t: _summary(t, costs), SUMMARY), "chunks")
    borders = stored(chunks.groupBy("conv_id").applyInArrow(lambda t: _borders(t, costs), "conv_id long, chunk long, back array<long>, closes boolean"), "borders")

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = broadcast_if_small(right).withColumnsRenamed({"conv_id": "c_", "chunk": "k_"})
        return left.join(right, F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("chunk") == F.col("k_"))).drop("c_", "k_")

    ready = joined(light, borders)
    exits = ready.groupBy("conv_id", "chunk").applyInArrow(lambda t: _exits(t, costs), "conv_id long, chunk long, letters array<long>, exits array<int>")
    entries = stored(exits.groupBy("conv_id").applyInArrow(_entries, "conv_id long, chunk long, entry int, place long"), "entries")
    letters = joined(ready, entries).groupBy("conv_id", "chunk").applyInArrow(
        lambda t: _letters(t, costs), "conv_id long, place long, pos long, letter string, state int")
    texts = numbered.select(F.col("pos").alias("at"), "role", "text")
    named = F.when(F.col("letter") == "K", F.col("role")).when(F.col("letter") == "D", None).when(F.col("state") == ASSISTANT, "assistant").otherwise("user")
    told = F.when(F.col("letter") == "I", "").when(F.col("letter") != "D", F.col("text"))
    edits = letters.join(texts, F.col("pos") == F.col("at"), "left").select("conv_id", "place", "letter", named.alias("role"), told.alias("text"))
    totals = chunks.groupBy("conv_id").applyInArrow(lambda t: _totals(t, costs), SOLVED.split(", audit")[0])
    return totals, edits


def _sorted(table: pa.Table, by: str) -> pa.Table:
    return table.sort_by(by).combine_chunks()


def _chunk(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.asarray([0, table.num_rows]), *(table[c].to_numpy().astype(np.int64) for c in ("initial", "fault"))


def _summary(table: pa.Table, costs: Costs) -> pa.Table:
    """What a chunk adds to its conversation."""
    table = _sorted(table, "pos")
    first, initial, fault = _chunk(table)
    far = np.where(np.eye(4, dtype=bool), 0, FAR)
    matrix = np.stack([costs_to_go(first, initial, fault, far[e:e + 1], costs)[0] for e in range(4)], axis=1)
    known = table["turn"].drop_null().to_numpy()
    counts = [int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)]
    span = [int(known[0]), int(known[-1]), int(1 + (known[1:] != known[:-1]).sum())] if len(known) else [None, None, 0]
    row = [table["conv_id"][0].as_py(), table["chunk"][0].as_py(), matrix.ravel().tolist(), int(initial[0]), int(initial[-1]),
           table.num_rows, *counts, int(_illegal(initial).sum()), *span]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int32(), *[pa.int64()] * 8]
    return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], [f.split()[0] for f in SUMMARY.split(", ")])


def _backwards(table: pa.Table, costs: Costs) -> tuple[pa.Table, list[np.ndarray]]:
    """Chunks in order, and the costs to go at the left of each and at the end."""
    table = _sorted(table, "chunk")
    at = [costs.closed()]
    for m in reversed(table["matrix"].to_pylist()):
        at.append(np.minimum((np.asarray(m).reshape(4, 4) + at[-1]).min(axis=1), FAR))
    return table, at[::-1]


def _borders(table: pa.Table, costs: Costs) -> pa.Table:
    table, at = _backwards(table, costs)
    return table.select(["conv_id", "chunk"]).append_column("back", pa.array([a.tolist() for a in at[1:]], pa.list_(pa.int64()))).append_column(
        "closes", pa.array([False] * (table.num_rows - 1) + [True]))


def _totals(table: pa.Table, costs: Costs) -> pa.Table:
    table, at = _backwards(table, costs)
    sums = [pc.sum(table[c]).as_py() for c in ("blank", "duplicate", "truncated", "illegal")]
    head, tail = table["head"].to_numpy()[1:], table["tail"].to_numpy()[:-1]
    sums[3] += sum((int(a), int(b)) not in _LEGAL for a, b in zip(tail, head))
    known = table.filter(table["least"].is_valid())
    gaps = 0
    if known.num_rows:
        least, most = known["least"].to_pylist(), known["most"].to_pylist()
        turns = pc.sum(known["turns"]).as_py() - sum(a == b for a, b in zip(most, least[1:]))
        gaps = most[-1] - least[0] + 1 - turns
    row = [table["conv_id"][0].as_py(), gaps, *sums, int(at[0][START])]
    return pa.table([pa.array([v], pa.int64()) for v in row], ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"])


def _ranked(table: pa.Table, entries: list[int], costs: Costs) -> tuple[pa.Table, Paths, np.ndarray]:
    table = _sorted(table, "pos")
    first, initial, fault = _chunk(table)
    back = np.asarray([table["back"][0].as_py()], np.int64)
    go = costs_to_go(first, initial, fault, back, costs)
    return table, least_paths(first, initial, fault, go, np.asarray([entries]), table["closes"][0].as_py(), costs), go


def _exits(table: pa.Table, costs: Costs) -> pa.Table:
    """For each state of entry, the letters of the chunk's least audit and the state it ends in."""
    table, p, _ = _ranked(table, [0, 1, 2, 3], costs)
    ends = np.cumsum(p.count) - 1
    exits = [int(p.state[e]) if c else s for s, (e, c) in enumerate(zip(ends, p.count))]
    return table.slice(0, 1).select(["conv_id", "chunk"]).append_column("letters", pa.array([p.count.tolist()], pa.list_(pa.int64()))).append_column(
        "exits", pa.array([exits], pa.list_(pa.int32())))


def _entries(table: pa.Table) -> pa.Table:
    """The state in which each chunk is entered, and how many letters come before it."""
    table = _sorted(table, "chunk")
    state, place, out = START, 0, []
    for letters, exits in zip(table["letters"].to_pylist(), table["exits"].to_pylist()):
        out.append((state, place))
        place += letters[state]
        state = exits[state]
    return table.select(["conv_id", "chunk"]).append_column("entry", pa.array([e for e, _ in out], pa.int32())).append_column(
        "place", pa.array([p for _, p in out], pa.int64()))


def _letters(table: pa.Table, costs: Costs) -> pa.Table:
    table, p, _ = _ranked(table, [table["entry"][0].as_py()], costs)
    pos = table["pos"].to_numpy()
    n = len(p.letter)
    return pa.table([pa.array([table["conv_id"][0].as_py()] * n, pa.int64()), pa.array(table["place"][0].as_py() + np.arange(n)),
                     pa.array(np.where(p.row < 0, -1, pos[np.maximum(p.row, 0)])), pa.array([chr(LETTERS[x]) for x in p.letter], pa.string()),
                     pa.array(p.state, pa.int32())], ["conv_id", "place", "pos", "letter", "state"])


def long_digests(edits: DataFrame) -> DataFrame:
    """``conv_id, audit, repaired_sha256`` from edits, streamed in order: of a conversation a task holds the running
    digest, the letters (which are the result) and one batch of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, letters, some = None, None, bytearray(), False

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([letters.decode()]), pa.array([digest.hexdigest()])],
                                              ["conv_id", "audit", "repaired_sha256"])

        for batch in batches:
            for conv, letter, role, text in zip(*(batch.column(c) for c in ("conv_id", "letter", "role", "text"))):
                conv, letter = conv.as_py(), letter.as_py()
                if digest is None or conv != now:
                    if digest is not None:
                        yield closed()
                    now, digest, letters, some = conv, hashlib.sha256(), bytearray(), False
                letters += letter.encode()
                if letter != "D":
                    digest.update(f"{chr(10) if some else ''}{role.as_py()}:{text.as_py()}".encode())
                    some = True
        if digest is not None:
            yield closed()

    dealt = edits.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return dealt.transform(map_texts, run, "conv_id long, audit string, repaired_sha256 string")
