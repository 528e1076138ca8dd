"""Near duplicates by HyperMinHash sketches.

A document's distinct word shingles are hashed once each.  The hash picks a
bucket and gives the bucket's register: the leading-zero count of the smallest
value in 6 bits and its next 10 bits as mantissa, 16 bits for each bucket.
Buckets that a short document leaves empty borrow the register of another
bucket, in an order fixed for every bucket, so registers of any two documents
stay comparable.

Bands of compressed registers give candidates.  Candidates whose estimated
similarity (share of equal registers, corrected for registers equal by chance)
lies far below the threshold are dropped; the others are confirmed on the full
shingle sets.  See ``linked_nodes`` for how large groups are handled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components_by_first
from .frames import broadcast_if_small, joined_small, map_texts, releasing, stored
from .words import WORD_BASES, Words, mix, slices, split, window_hashes, window_starts

BUCKETS = 224
ROWS = 7            # registers in a band, for a similarity of 0.85
BLOCK_DOCS = 4000
BLOCK_SHINGLES = 2_000_000
PIVOTS = 8
_AT_ONCE = 300_000       # shingles compared at a time
LZ_BITS, MANTISSA_BITS = 6, 10
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, sorted within the text, and the place of each text's first.

    A text with fewer words than ``size``, but not none, has its whole sequence as its one shingle."""
    h = words.hashes()
    n = np.diff(words.first)
    at = np.flatnonzero(window_starts(words.first, size))
    doc, value = words.doc[at], window_hashes(h, size, WORD_BASES[0])[at]
    for k in range(1, size):
        few = np.flatnonzero(n == k)
        if len(few):
            doc = np.concatenate((doc, few))
            value = np.concatenate((value, mix(window_hashes(h, k, WORD_BASES[0])[words.first[few]], k)))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    doc, value = doc[new], value[new]
    return value, np.searchsorted(doc, np.arange(len(n) + 1))


def set_hashes(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_hashes`` of the lower-cased texts of a longer column, slice by slice."""
    values, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for part in slices([pa.RecordBatch.from_arrays([column], ["text"])], "text"):
        value, first = shingle_hashes(split(part.column("text"), lower=True), size)
        values.append(value)
        counts.append(np.diff(first))
    return np.concatenate(values), np.cumsum(np.concatenate(counts))


_borrow: dict[int, np.ndarray] = {}


def _borrow_order(buckets: int) -> np.ndarray:
    """For each attempt, the bucket that each bucket borrows from; the last attempts go round all buckets."""
    if buckets not in _borrow:
        rng = np.random.default_rng(20_040)
        _borrow[buckets] = rng.integers(0, buckets, (4 * buckets, buckets))
    return _borrow[buckets]


def registers(value: np.ndarray, first: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """One row of 16-bit registers for each text; texts without shingles have zeros."""
    n = len(first) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    x = mix(value, 7)
    bucket = ((x >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)
    least = np.full(n * buckets, _EMPTY)
    np.minimum.at(least, doc * buckets + bucket, mix(x, 11))
    least = least.reshape(n, buckets)
    # leading zeros from the exponent of the value as a float; the mantissa is what follows the first one
    zeros = np.minimum(63 - np.floor(np.log2(np.maximum(least.astype(np.float64), 1.0))).astype(np.int64), 63)
    zeros = np.maximum(zeros, 0).astype(np.uint64)
    mantissa = ((least << zeros) << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    out = ((zeros << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    empty = least == _EMPTY
    some = ~empty.all(axis=1)
    left_d, left_b = np.nonzero(empty & some[:, None])
    filled = out.copy()
    for source in _borrow_order(buckets):
        if not len(left_d):
            break
        s = source[left_b]
        ok = ~empty[left_d, s]
        filled[left_d[ok], left_b[ok]] = out[left_d[ok], s[ok]]
        left_d, left_b = left_d[~ok], left_b[~ok]
    for d in np.unique(left_d):           # never reached in practice: the first register that is not empty
        filled[d, left_b[left_d == d]] = out[d, np.flatnonzero(~empty[d])[0]]
    filled[~some] = 0
    return filled


def bands(regs: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of ``rows`` registers."""
    n, buckets = regs.shape
    parts = regs[:, :buckets // rows * rows].reshape(n, -1, rows).astype(np.uint64)
    key = np.zeros(parts.shape[:2], np.uint64)
    for k in range(rows):
        key = mix(key + parts[:, :, k] + np.uint64(1), k + 1)
    return key


def chance_equal(n_a: np.ndarray, n_b: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Chance that a bucket's registers are equal although its smallest values differ.

    Two independent minima of about ``n / buckets`` values each agree in leading zeros with a chance below 1, and
    then in the mantissa about once in 2 ** MANTISSA_BITS."""
    a, b = np.maximum(n_a / buckets, 1.0), np.maximum(n_b / buckets, 1.0)
    i = np.arange(1, 64)[:, None]
    lo, hi = np.power(2.0, -i), np.power(2.0, 1 - i)
    part = lambda n: np.power(1 - lo, n) - np.power(1 - hi, n)
    return (part(a) * part(b)).sum(axis=0) / 2 ** MANTISSA_BITS


def estimate(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal registers, corrected for collisions."""
    equal = (regs_a == regs_b).mean(axis=1)
    c = chance_equal(np.asarray(n_a, float), np.asarray(n_b, float), regs_a.shape[1])
    return np.clip((equal - c) / (1 - c), 0.0, 1.0)


# --- on Spark -------------------------------------------------------------------------------------------------

_SKETCH = "id long, key long, n_shingles long, node binary, regs binary"
_TREE = "family binary, node binary, leader binary"


def sketches(rows: DataFrame, shingle: int) -> DataFrame:
    """Of each row ``(id, key, text)``: the set size, a 128-bit digest of the set (``node``) and the registers."""
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            value, first = shingle_hashes(split(part.column("text"), lower=True), shingle)
            n = np.diff(first)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("key"), pa.array(n, pa.int64()), _nodes(value, first),
                 _fixed(registers(value, first).tobytes(), len(n), 2 * BUCKETS)], ["id", "key", "n_shingles", "node", "regs"])

    return rows.transform(map_texts, sketch, _SKETCH)


def _fixed(data: bytes, n: int, size: int, mask: np.ndarray | None = None) -> pa.Array:
    """Binary values of one size."""
    plain = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * size), pa.py_buffer(data)])
    return plain if mask is None or not mask.any() else pc.if_else(pa.array(mask), pa.scalar(None, pa.binary()), plain)


def _nodes(value: np.ndarray, first: np.ndarray) -> pa.Array:
    """Two 64-bit sums over independent hashes of the set's members; null for an empty set."""
    n = len(first) - 1
    out = np.zeros((n, 2), ">u8")
    for k, seed in enumerate((101, 202)):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(value, seed))))
        out[:, k] = total[first[1:]] - total[first[:-1]]
    return _fixed(out.tobytes(), n, 16, np.diff(first) == 0)


def _band_rows(rows_in_band: int):
    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                keys = bands(regs, rows_in_band)
                keys = mix(keys + np.arange(keys.shape[1], dtype=np.uint64) * np.uint64(WORD_BASES[1]))
                node = batch.column("node").take(pa.array(np.repeat(np.arange(batch.num_rows), keys.shape[1])))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), node], ["band", "node"])

    return band


class _Forest:
    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def roots(self) -> np.ndarray:
        p = self.parent
        while True:
            up = p[p]
            if (up == p).all():
                return p
            self.parent = p = up


def _linked_in(left: np.ndarray, right: np.ndarray, forest: _Forest, value: np.ndarray, first: np.ndarray,
               regs: np.ndarray, least: int) -> None:
    """Join the trees of all linked pairs (one of ``left``, one of ``right``) that are in different trees so far.

    Estimates come first; those far below the threshold (by MARGIN) go, the others are confirmed on the full sets.
    Texts with few shingles are confirmed without an estimate."""
    n = np.diff(first)
    chance = 1.0 / 2 ** MANTISSA_BITS / 3       # the sum in chance_equal is about a third for sets of like size
    for i in left:
        root = forest.roots()
        other = right[(root[right] != root[i])]
        other = other[(100 * np.minimum(n[other], n[i]) >= least * np.maximum(n[other], n[i]))]
        if not len(other):
            continue
        equal = (regs[other] == regs[i]).mean(axis=1)
        guess = (equal - chance) / (1 - chance)
        small = np.minimum(n[other], n[i])
        margin = np.where(small < 64, 1.0, np.where(small < BUCKETS, 0.2, 0.135))
        other = other[guess >= least / 100 - margin]
        cuts = np.flatnonzero(np.diff(np.cumsum(n[other]) // _AT_ONCE)) + 1
        for part in np.split(other, cuts):
            size = n[part]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            theirs = value[np.repeat(first[part], size) + inside]
            mine = value[first[i]:first[i + 1]]
            k = np.searchsorted(mine, theirs)
            k[k == len(mine)] = 0
            both = np.add.reduceat((mine[k] == theirs).astype(np.int64), np.cumsum(size) - size)
            for j in part[100 * both >= least * (size + n[i] - both)]:
                a, b = forest.find(i), forest.find(j)
                if a != b:
                    forest.parent[max(a, b)] = min(a, b)


def _block_task(shingle: int, least: int):
    """For one block of a family (or a pair of blocks): each document with the first of its tree."""
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        text = table.column("text")
        value, first = set_hashes(text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text, shingle)
        node = np.asarray(_nodes(value, first).to_pylist(), object)
        side = table.column("side").to_numpy()
        # copies of one row and documents handed over for both sides are taken once
        _, once = np.unique([bytes([s]) + x for s, x in zip(side, node)], return_index=True)
        forest = _Forest(len(node))
        same: dict[bytes, int] = {}
        for k in once:
            have = same.setdefault(node[k], k)
            if have != k:
                forest.parent[max(forest.find(have), forest.find(k))] = min(forest.find(have), forest.find(k))
        trees: dict[bytes, int] = {}
        for k, t in zip(once, table.column("tree").take(pa.array(once)).to_pylist()):
            if t is not None:       # what earlier blocks have joined needs no test
                a, b = forest.find(trees.setdefault(t, k)), forest.find(k)
                forest.parent[max(a, b)] = min(a, b)
        left, right = once[side[once] == 0], once[side[once] == 1]
        regs = registers(value, first)
        _linked_in(left, right if len(right) else left, forest, value, first, regs, least)
        root = forest.roots()
        return pa.table({"family": pa.array([table.column("family")[0].as_py()] * len(once), pa.binary()),
                         "node": pa.array([node[k] for k in once], pa.binary()),
                         "leader": pa.array([node[root[k]] for k in once], pa.binary())})

    return run


def _dealt(texts: DataFrame, blocks: DataFrame, keys: list[str], task) -> DataFrame:
    return stored(texts.join(blocks, "node").repartition(*keys).groupBy(*keys).applyInArrow(releasing(task), _TREE), "trees")


def linked_nodes(rows: DataFrame, reps: DataFrame, shingle: int, least: int, rows_in_band: int) -> DataFrame:
    """``(node, label)`` for the nodes that are linked with others: all nodes of a component have one label.

    * Nodes that share a band with others point to the band's first node; what hangs together that way is a
      family.  No pair of the family's other members is formed.
    * A family's texts go to one task, or, if it is large, to blocks of at most about BLOCK_DOCS documents and
      BLOCK_SHINGLES shingles.  A block compares sketches of nodes not yet joined, and full sets of those
      that come near; it returns one row per document.  A few documents that all blocks of a family hold
      join the blocks' trees.
    * If a family in blocks is then still in several trees, the documents outside its largest tree, in blocks,
      are compared with the family's other trees, block by block.  So what hangs together is never compared
      again, and no link is lost.
    """
    keyed = reps.select("node", "regs").transform(map_texts, _band_rows(rows_in_band), "band long, node binary")
    shared = stored(keyed.groupBy("band").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                    .select("band", "leader"), "bands")
    family = components_by_first(joined_small(keyed, shared, ["band"]).select("node", "leader")).withColumnRenamed("label", "family")
    sized = family.join(reps.select("node", "id", "key", "n_shingles"), "node")
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    extent = stored(sized.groupBy("family").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("shingles"))
                    .select("family", blocks.alias("blocks")).filter("blocks > 1"), "large")
    members = stored(sized.join(broadcast_if_small(extent), "family", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
                     .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "members")
    # null-safe, as a set whose rows all have no id is known by one of them
    at = broadcast_if_small(members.select(F.col("id").alias("at_id"), F.col("key").alias("at_key"), "node"))
    texts = stored(rows.join(at, [rows["key"] == at["at_key"], rows["id"].eqNullSafe(at["at_id"])]).select("node", "text"), "texts")
    if texts.count() > members.count():     # repeated rows, or copies without id: one text of each set is enough
        texts = stored(texts.groupBy("node").agg(F.first("text").alias("text")), "texts")

    task = _block_task(shingle, least)
    none = F.lit(None).cast("binary").alias("tree")
    pivots = (members.filter("blocks > 1 and block = 0")
              .withColumn("nth", F.row_number().over(Window.partitionBy("family").orderBy("node"))).filter(F.col("nth") <= PIVOTS)
              .select("family", "node", F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("block")))
    first = members.select("family", "node", "block").unionByName(pivots).select("node", "family", "block", F.lit(0).alias("side"), none)
    trees = _dealt(texts, first, ["family", "block"], task)

    wide = members.filter("blocks > 1")
    if wide.limit(1).count() == 0:
        return trees.select("node", F.col("leader").alias("label"))
    in_blocks = stored(wide.select("family").distinct(), "wide")
    narrow = trees.join(in_blocks, "family", "left_anti").select("node", F.col("leader").alias("label"))
    trees = trees.join(in_blocks, "family", "left_semi").select("node", "leader")
    wide = stored(wide.select("family", "node", "block", "blocks").join(
        components_by_first(trees).withColumnRenamed("label", "tree"), "node"), "wide")
    sizes = wide.groupBy("family", "tree").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("family").agg(F.max(F.struct("n", "tree"))["tree"].alias("largest"), F.sum("n").alias("all"), F.max("n").alias("most"))
    outside = largest.filter("all > most").select(
        "family", "largest", F.ceil((F.col("all") - F.col("most")) / BLOCK_DOCS).cast("int").alias("outer"))
    wide = wide.join(outside, "family")
    left = wide.filter("tree <> largest").select(
        "node", "family", F.pmod(F.xxhash64("node", F.lit(2)), F.col("outer")).cast("int").alias("outer"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("side"), "tree")
    right = wide.select("node", "family", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)).alias("outer"), "block",
                        F.lit(1).alias("side"), "tree")
    more = _dealt(texts, left.unionByName(right), ["family", "outer", "block"], task)
    return narrow.union(components_by_first(trees.union(more.select("node", "leader"))))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, least: int = 85,
                    rows_in_band: int = ROWS) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (the smallest id of its component), ``kept``.

    Two rows are linked if 100 times the intersection of their shingle sets is at least ``least`` times the union.

    Defined cases: null and empty texts have no shingles and are components of their own, with their id; a null
    id is never the smallest unless a component has no other; rows with equal sets, repeated rows among them,
    are one component (``kept`` is true for each row with the component's id); an empty table gives an empty
    result; further columns are not read.
    """
    rows = _rows(df, id_col, text_col)
    found = stored(sketches(rows, shingle), "sketches")
    out = _components(rows, found, shingle, least, rows_in_band)
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id",
                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).withColumn(
        "key", F.xxhash64("id", "text"))


def _components(rows: DataFrame, found: DataFrame, shingle: int, least: int, rows_in_band: int) -> DataFrame:
    # one row for each distinct set (with an id if any has one), combined before the shuffle: copies go no further
    reps = (found.filter("node is not null").groupBy("node")
            .agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("at"), F.first("regs").alias("regs"), F.first("n_shingles").alias("n_shingles"))
            .select("node", F.col("at.id").alias("id"), F.col("at.key").alias("key"), "regs", "n_shingles"))
    reps = stored(reps, "sets")
    labels = linked_nodes(rows, reps, shingle, least, rows_in_band)
    # a set's representative has the set's smallest id
    of = reps.select("node", "id", "key").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = of.groupBy("label").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("at")).select(
        "label", F.col("at.id").alias("component_id"), F.col("at.key").alias("component_key"))
    by_node = of.join(smallest, "label").select("node", "component_id", "component_key")
    rest = found.select("id", "key", "n_shingles", "node")
    # texts without shingles have no node to join on, and would all meet in one task
    some = rest.filter("node is not null").join(by_node, "node").select("id", "key", "n_shingles", "component_id", "component_key")
    return some.unionByName(rest.filter("node is null").select(
        "id", "key", "n_shingles", F.col("id").alias("component_id"), F.col("key").alias("component_key")))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, least: int = 80,
                         rows_in_band: int = 6) -> DataFrame:
    """The input's rows and columns, with one row (of the smallest id) of each component.

    Of a component without any id the row whose text has the smallest hash stays."""
    rows = _rows(df, id_col, text_col)
    found = stored(sketches(rows, shingle), "sketches")
    out = _components(rows, found, shingle, least, rows_in_band)
    gone = out.filter(~F.col("id").eqNullSafe(F.col("component_id")) | F.col("id").isNull() & (F.col("key") != F.col("component_key")))
    gone = stored(gone.select("id", "key").distinct(), "dropped")
    name = "__near_duplicate_row"
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))
    packed = packed.withColumn("id", F.col(name)[id_col].cast("long")).withColumn("key", F.xxhash64("id", F.col(name)[text_col]))
    return packed.join(broadcast_if_small(gone), [packed["id"].eqNullSafe(gone["id"]), packed["key"] == gone["key"]], "left_anti").select(f"{name}.*")
