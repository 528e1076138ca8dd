"""The registered queries of this subpackage: each applies an operator to a whole table.

``ORACLE`` has DuckDB statements for those that SQL can express; the others
are tested against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bit_planes, bitpack, block_anchors, content_sort, hyperminhash, language_tree, large_item_packing, lattice_lm,
               phrase_index, pii_votes, quality_rules, turn_repair, warc_zst)
from .frames import shared_folder
from .tokens import default_tokenizer


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _crc(column: str) -> Column:
    """crc32 of a column as text, which decides what is held out."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, _table(spark, sf_dir, "labels"), _crc("doc_id") % 3 != 1)
    return quality_rules.score_documents(docs, model).withColumn("held_out", _crc("doc_id") % 3 == 1)


def op2_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = lattice_lm.score(docs, _crc("doc_id") % 10 != 0, lattice_lm.default_vocabulary())
    return scored.withColumn("held_out", _crc("doc_id") % 10 == 0)


def op3_block_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_anchors.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_duplicates(_table(spark, sf_dir, "documents"))


def op5_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark, "token-ids")
    bitpack.write_ids(_table(spark, sf_dir, "documents"), path, default_tokenizer(), end_id=1)
    return bitpack.read_documents(spark, path)


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return large_item_packing.pack_documents(_table(spark, sf_dir, "documents"), default_tokenizer())


def op8_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_votes.find_spans(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii_votes.KINDS), _sha256(pii_votes.listed(base)).alias("base_sha256"),
                        pii_votes.listed(F.col("spans")).alias("spans"))


def op9_language_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_tree.identify(_table(spark, sf_dir, "documents"), _crc("doc_id") % 5 != 0)
    return found.withColumn("held_out", _crc("doc_id") % 5 == 0)


def op10_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_index.phrase_matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        _sha256(names).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def damaged(df: DataFrame) -> DataFrame:
    """Conversations with faults set by crc32 of ``conv_id:turn``; rows that are dropped stay, with ``here`` false."""
    def text_of(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", text_of("conv_id"), text_of("turn")).cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text_of("text"), "[.!?]", "")).otherwise(text_of("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (df.select("conv_id", "turn", "role", "text", kind.alias("kind"))
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(text_of("role")).alias("role"), text.alias("text"),
                    (F.col("kind") != 0).alias("here"), F.explode(copies).alias("copy")).drop("copy"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turn_repair.prepared(damaged(_table(spark, sf_dir, "conversations")), present=F.col("here"))
    found = turn_repair.repair(rows)
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    out = found.whole.withColumn("repaired_sha256", _sha256(lines)).select(columns)
    if found.totals is None:
        return out
    digests = turn_repair.long_digests(found.edits).withColumnRenamed("conv_id", "id")
    return out.unionByName(found.totals.join(digests, F.col("conv_id").eqNullSafe(F.col("id"))).select(columns))


def op12_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bit_planes.cluster(_table(spark, sf_dir, "embeddings"))
    facts = [(c, i, sum(found.inertia), bit_planes.centroid_digest(v)) for c, (i, v) in enumerate(zip(found.inertia, found.centroids))]
    per = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")      # k rows
    return found.assigned.join(F.broadcast(per), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_warc_zst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zst.archived(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (
    op1_rule_ensemble, op2_lattice_lm, op3_block_anchors, op4_content_sort, op5_bit_packed_ids, op6_hyperminhash,
    op7_large_item_packing, op8_pii_votes, op9_language_tree, op10_phrase_index, op11_turn_repair, op12_bit_planes, op13_warc_zst)}

#: texts with every run of bytes 0x20, 0x09 to 0x0D as one space
_NORM = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"


def _add(x: str, cost: str, letter: str) -> str:
    """A path, nine digits of cost and then its letters, with one more edit; a path that does not exist stays so."""
    return f"CASE WHEN {x} >= '9' THEN {x} ELSE printf('%09d%s{letter}', CAST(substr({x}, 1, 9) AS BIGINT) + {cost}, substr({x}, 10)) END"


def _repair_sql() -> str:
    """Damage, cost and least audit: forward, row by row, the least (cost, letters) by which each state is reached."""
    none = "'999999999'"
    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"
    keep = {0: [], 1: [(0, "s")], 2: [(0, "u"), (1, "u"), (3, "u")], 3: [(2, "a")]}
    rerole = {0: [], 1: [], 2: [0, 1, 3], 3: [2]}

    def reached(state: int) -> str:
        ways = [f"CASE WHEN initial = '{i}' THEN {_add(f's{s}', extra, 'K')} ELSE {none} END" for s, i in keep[state]]
        ways += [_add(f"s{s}", f"3 + {extra}", "R") for s in rerole[state]]
        stays = f"CASE WHEN fault IN ('blank', 'duplicate') THEN {none} ELSE least({none}, {', '.join(ways)}) END" if ways else none
        return f"least({stays}, {_add(f's{state}', '4', 'D')}) AS s{state}"

    # states and inserted rows: one more user, then one more assistant
    inserted = f"""SELECT conv_id, p, s0, s1, u AS s2, least(s3, {_add('u', '3', 'I')}) AS s3 FROM (
            SELECT *, least(s2, {_add('s0', '3', 'I')}, {_add('s1', '3', 'I')}, {_add('s3', '3', 'I')}) AS u FROM"""
    return rf"""
        WITH RECURSIVE bits AS (SELECT unnest(range(256)) AS i),
        entries AS (SELECT i, list_reduce([CAST(i AS BIGINT)] || [0, 0, 0, 0, 0, 0, 0, 0],
                                           lambda e, z: CASE WHEN e & 1 = 1 THEN xor(e >> 1, 3988292384) ELSE e >> 1 END) AS e FROM bits),
        crc_table AS MATERIALIZED (SELECT list(e ORDER BY i) AS t FROM entries),
        keys AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                                  lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
            FROM conversations),
        kinds AS (
            SELECT *, xor(list_reduce([4294967295] || bytes, lambda crc, b: xor(t[(xor(crc, b) & 255) + 1], crc >> 8)), 4294967295) % 20 AS kind
            FROM keys, crc_table),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM kinds WHERE kind <> 0)),
        placed AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS BIGINT) AS p, substr(role, 1, 1) AS initial
            FROM damaged),
        faults AS MATERIALIZED (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-]') THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][ 	-]*$') THEN 'truncated' ELSE 'none' END AS fault,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY p) || initial AS pair
            FROM placed),
        facts AS (
            SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count_if(fault = 'blank') AS blank,
                   count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
                   count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal, max(p) AS n
            FROM faults GROUP BY conv_id),
        paths AS (
            {inserted} (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS p, '000000000' AS s0, {none} AS s1, {none} AS s2, {none} AS s3 FROM conversations))
            UNION ALL
            {inserted} (SELECT f.conv_id, f.p, {', '.join(reached(s) for s in range(4))}
                FROM paths JOIN faults f ON f.conv_id IS NOT DISTINCT FROM paths.conv_id AND f.p = paths.p + 1))),
        best AS (
            SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
                   coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, least(s0, s3) AS path
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
            JOIN paths q ON q.conv_id IS NOT DISTINCT FROM c.conv_id AND q.p = coalesce(n, 0)),
        letters AS (SELECT conv_id, unnest(string_split(substr(path, 10), '')) AS letter, unnest(range(1, len(path) - 8)) AS j FROM best WHERE len(path) > 9),
        counted AS (
            SELECT *, sum(CASE WHEN letter = 'I' THEN 0 ELSE 1 END) OVER w AS p, sum(CASE WHEN letter = 'D' THEN 0 ELSE 1 END) OVER w AS o
            FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY j)),
        edited AS (
            SELECT l.conv_id, o, letter, f.role, f.text, max(CASE WHEN o = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY l.conv_id) AS s
            FROM counted l LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.p = l.p AND letter <> 'I'
            WHERE letter <> 'D'),
        repaired AS (
            SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
                                       chr(10) ORDER BY o) AS lines
            FROM edited GROUP BY conv_id)
        SELECT b.conv_id, gaps, blank, duplicate, truncated, illegal, CAST(substr(path, 1, 9) AS BIGINT) AS cost, substr(path, 10) AS audit,
               sha256(coalesce(lines, '')) AS repaired_sha256
        FROM best b LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM b.conv_id"""


def _cluster_sql(k: int = 40, rounds: int = 5) -> str:
    """Rounds one after the other; nearest by the least of distance * 1024 + number."""
    def near(r: int) -> str:
        return f"""
        near{r} AS MATERIALIZED (
            SELECT vec_id, any_value(v) AS v, min(1024 * list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) + c) AS best
            FROM kept, means{r} GROUP BY vec_id)"""

    def means(r: int) -> str:
        return f"""
        means{r + 1} AS MATERIALIZED (
            SELECT c, coalesce(moved, m) AS m
            FROM means{r} LEFT JOIN (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i) AS moved
                FROM (SELECT best % 1024 AS c, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n FROM near{r}, range(1, 65) t(i) GROUP BY ALL) GROUP BY c) USING (c))"""

    steps = ",".join(near(r) + "," + means(r) for r in range(rounds))
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
        means0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY place) - 1 AS c, v AS m
            FROM (SELECT sha256('2:' || CAST(vec_id AS VARCHAR)) AS place, v FROM kept ORDER BY place LIMIT {k})),{steps},{near(rounds)},
        facts AS (SELECT c, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM means{rounds}),
        found AS (SELECT vec_id, best % 1024 AS c, CAST(best // 1024 AS BIGINT) AS distance FROM near{rounds})
        SELECT vec_id, CAST(c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM found JOIN facts USING (c)"""


ORACLE = {
    "op11_turn_repair": _repair_sql(),
    "op12_bit_planes": _cluster_sql(),
    "op13_warc_zst": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
        r AS (SELECT *, CAST(strlen(payload) AS BIGINT) AS payload_bytes, strlen(payload) >= 1000 AND page_id IS DISTINCT FROM first AS again FROM p)
        SELECT page_id, payload_bytes, sha1(payload) AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first END AS refers_to
        FROM r""",
    "op4_content_sort": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY norm)""",
    "op3_block_anchors": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        windows AS (
            SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS phrase
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
        repeats AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY phrase) AS first FROM windows) WHERE doc_id > first),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM repeats),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
        kept AS (
            SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY q) AS kept
            FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)""",
    "op6_hyperminhash": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS MATERIALIZED (
            SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS x
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
        n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS MATERIALIZED (
            SELECT a, b
            FROM (SELECT l.doc_id AS a, r.doc_id AS b, count(*) AS common FROM s l JOIN s r ON l.x = r.x AND l.doc_id <> r.doc_id GROUP BY ALL)
            JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 100 * common >= 85 * (na.n + nb.n - common)),
        reach AS (
            SELECT doc_id AS node, doc_id AS root FROM d
            UNION
            SELECT b, root FROM reach JOIN links ON a = node)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY node) ON node = doc_id""",
    "op10_phrase_index": r"""
        WITH docs AS (
            SELECT doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM documents)),
        items AS (
            SELECT item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az FROM benchmark)),
        item_windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS phrase
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM item_windows),
        doc_windows AS (
            SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS phrase
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, sizes WHERE len(w) >= n)),
        hits AS (SELECT DISTINCT doc_id, d.n, p, item_id FROM doc_windows d JOIN item_windows i USING (n, phrase)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT q) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, n, p FROM hits)) GROUP BY doc_id),
        hit_items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)""",
}
