"""Merkle manifest of a dataset (operator 13): stored node rows, climbed by a recursive query.

A tree joins two nodes a level. Levels are built by blocks of ``2**stride`` nodes,
and a node row links to the top of its block with the siblings on the way, so that
one step of the recursive query ascends ``stride`` levels; with a stride of 1 each
row is linked to its parent.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import stored, whole_groups
from tierflow.session import settings

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STRIDE = 10
CLIMBERS = 65_536  # leaves that climb through one copy of a node row
TOP = -1  # the tree of the subroots
ROW_BITS = 33  # of monotonically increasing ids that count rows of a partition
NODE = "tree long, hop int, key long, idx long, n long, weight long, hash string"
BLOCK = NODE + ", siblings array<binary>, block long, block_weight long"

# The hash ``h`` of a row's node, folded with the row's siblings from the lowest level up.
FOLD = """aggregate(transform({n}.siblings, (e, i) -> struct(shiftright({n}.idx, i) % 2 = 1 AS on_left, lower(hex(e)) AS h)),
  {h}, (h, x) -> sha2(CASE WHEN x.on_left THEN concat(x.h, h) ELSE concat(h, x.h) END, 256))"""

# Ascends per leaf, from its own row's link: appends siblings and folds the hash with them.
CLIMB = f"""
WITH RECURSIVE climb(leaf_id, doc_id, leaf, tree, hop, key, slices, folded, proof, home) AS (
  SELECT leaf_id, doc_id, hash, next_tree, next_hop, next_key, next_slices, {FOLD.format(n="s", h="s.found")},
         aggregate(s.siblings, CAST('' AS BINARY), (p, x) -> concat(p, x)), tree
  FROM {{start}} s
  UNION ALL
  SELECT c.leaf_id, c.doc_id, c.leaf, n.next_tree, n.next_hop, n.next_key, n.next_slices,
         {FOLD.format(n="n", h="c.folded")}, aggregate(n.siblings, c.proof, (p, x) -> concat(p, x)), c.home
  FROM climb c JOIN {{nodes}} n
    ON c.tree = n.tree AND c.hop = n.hop AND c.key = n.key AND c.leaf_id % c.slices = n.slice)
SELECT leaf_id, doc_id, leaf, home AS tree, folded AS folded_root, lower(hex(proof)) AS proof
FROM climb WHERE tree IS NULL
"""


def leaf_hash(changed: dict[str, Column] | None = None) -> Column:
    """Hash of a row's fields, each as ``-`` if null, else byte count, colon and value."""
    texts = [(changed or {}).get(f, F.col(f).cast("string")) for f in FIELDS]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*coded).cast("binary"), 256)


def ranked(df: DataFrame, group: str, order: list[str], label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with ``leaf_id``, ``tree`` (one number per group, in group order), ``idx`` and ``n``.

    Rows are sorted by ranges over group and order, so a large group spans many
    tasks; only row counts per partition and group are added up to find ranks. The
    second table holds (part, group, tree): one row per partition and group.
    """
    keys = [group, *order]
    placed = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                    .withColumn("leaf_id", F.monotonically_increasing_id()), label)
    placed = placed.withColumn("part", F.shiftright("leaf_id", ROW_BITS))
    everywhere = Window.partitionBy(group)
    parts = (placed.groupBy("part", group).agg(F.min("leaf_id").alias("first"), F.count(F.lit(1)).alias("rows"))
             .select("part", group, "first", F.min("first").over(everywhere).alias("tree"),
                     F.sum("rows").over(everywhere).alias("n"),
                     F.coalesce(F.sum("rows").over(everywhere.orderBy("part").rowsBetween(
                         Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    parts = stored(parts, f"{label}-parts")  # small, which the planner then knows
    own = parts.withColumnRenamed(group, "_group")
    numbered = (placed.join(own, (placed["part"] == own["part"]) & placed[group].eqNullSafe(F.col("_group")))
                .drop(own["part"]).withColumn("idx", F.col("before") + F.col("leaf_id") - F.col("first"))
                .drop("_group", "first", "before"))
    return numbered, parts.select("part", group, "tree")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _blocks(stride: int, hop: int, carried: list[tuple[str, str]]):
    """Builds the levels of whole blocks: a row per node, and one per block for the next hop."""
    fields = [tuple(f.split(" ", 1)) for f in BLOCK.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<binary>": pa.list_(pa.binary())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, cuts in whole_groups(batches, ["tree", "block"]):
            out, tops = [], []
            columns = [rows.column(c).to_pylist() for c in ("tree", "key", "idx", "n", "weight", "hash", "block")]
            for begin, end in zip(cuts[:-1], cuts[1:]):
                tree, key, idx, n, weight, hashes, block = (c[begin:end] for c in columns)
                levels = [hashes]
                for _ in range(min(stride, (n[0] - 1).bit_length())):
                    low = levels[-1]
                    levels.append([_digest("".join(low[i:i + 2])) for i in range(0, len(low), 2)])
                heavy, binary = sum(weight), [[bytes.fromhex(h) for h in low] for low in levels[:-1]]
                for i in range(end - begin):
                    places = [(low, (i >> at) ^ 1) for at, low in enumerate(binary)]
                    siblings = [low[p] if p < len(low) else b"" for low, p in places]
                    out.append((tree[i], hop, key[i], idx[i], n[i], weight[i], hashes[i], siblings, block[i], heavy))
                after = -(-n[0] // (1 << stride))
                tops.append((tree[0], hop + 1, block[0], block[0], after, heavy, levels[-1][0], None, None, None))
            if out:
                none = pa.nulls(len(tops))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*out, *tops), fields)]
                    + [pa.chunked_array([*rows.column(c).chunks, none.cast(rows.schema.field(c).type)]).combine_chunks()
                       for c, _ in carried],
                    [f for f, _ in fields] + [c for c, _ in carried])

    return run


def build_trees(leaves: DataFrame, stride: int, label: str,
                carried: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """(node rows of every hop, roots) of trees given by their leaves (tree, key, idx, n, weight, hash).

    Each hop groups the nodes of a tree by blocks, bounded by ``2**stride`` rows, and
    is written. There are as many hops as the largest tree is high, by the stride.
    Rows of leaves keep the ``carried`` columns.
    """
    rows, nodes, roots, hop = leaves, [], [], 0
    extra = [(c, leaves.schema[c].dataType.simpleString()) for c in carried]
    while True:
        roots.append(rows.where("n = 1").select("tree", F.col("hash").alias("root"), "weight"))
        rows = rows.where("n > 1").withColumn("block", F.shiftright("idx", stride))
        if hop and rows.isEmpty():
            return nodes, reduce(DataFrame.unionAll, roots)
        built = stored(
            rows.select("tree", "key", "idx", "n", "weight", "hash", "block", *[c for c, _ in extra])
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
            .mapInArrow(_blocks(stride, hop, extra), ", ".join([BLOCK, *[f"{c} {k}" for c, k in extra]])),
            f"{label}-{hop}")
        nodes.append(built.where("siblings is not null"))
        rows = built.where("siblings is null").select("tree", "key", "idx", "n", "weight", "hash")
        hop, extra = hop + 1, []


def _linked(nodes: DataFrame, stride: int, last: Column) -> DataFrame:
    """Node rows with their links; ``last`` is the tree that the top block of a tree links to."""
    ends = F.col("n") <= F.lit(1 << stride)
    return nodes.select(
        "*", F.when(ends, last).otherwise(F.col("tree")).alias("next_tree"),
        F.when(ends, 0).otherwise(F.col("hop") + 1).alias("next_hop"),
        F.when(ends, F.col("tree")).otherwise(F.col("block")).alias("next_key"),
        _slices("block_weight").alias("next_slices"))


def _copied(nodes: DataFrame) -> DataFrame:
    """Node rows once for each slice of the leaves that climb through them."""
    return (nodes.withColumn("slice", F.explode(F.sequence(F.lit(0), _slices("weight") - 1)))
            .select("tree", "hop", "key", "slice", "idx", "siblings", "next_tree", "next_hop", "next_key",
                    "next_slices"))


def _slices(weight: str) -> Column:
    """Copies of a node row: as many as keep a copy's climbers bounded."""
    return F.ceil(F.col(weight) / F.lit(CLIMBERS)).cast("long")


def manifest(docs: DataFrame, changed: dict[str, Column] | None = None, stride: int = STRIDE) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) of every row of ``docs``.

    Rows are leaves: hashes of doc_id, source, lang, n_chars and text. The leaves of
    a lang, by doc_id, are joined two by two (a last single one alone) until one is
    left, the subroot; subroots, by lang, are joined likewise to the root. ``proof``
    holds the siblings, lowest level first, as hexadecimal text. The hash that is
    folded up with them is that of the row with the ``changed`` fields (texts; null
    leaves a null field null), so ``verified`` tells whether it still leads to the root.

    Null values of any field, null langs (a group of their own, the first) and null
    doc_ids (first in their lang) are leaves like others. Rows that repeat a doc_id are
    ordered by their hash; repeated rows are leaves each. An empty table gives no rows.
    Other columns are ignored, whatever their names.
    """
    hashed = docs.select(*FIELDS).select(
        F.col("doc_id"), F.col("lang"), leaf_hash().alias("leaf"), leaf_hash(changed).alias("found"))
    leaves, parts = ranked(stored(hashed, "merkle-leaves"), "lang", ["doc_id", "leaf"], "merkle-ranked")
    leaves = leaves.select("leaf_id", "doc_id", "found", "tree", F.col("idx").alias("key"), "idx", "n",
                           F.lit(1).cast("long").alias("weight"), F.col("leaf").alias("hash"))
    carried = ("leaf_id", "doc_id", "found")
    (low, *higher), subroots = build_trees(leaves, stride, "merkle-trees", carried)
    subroots = stored(subroots.withColumnRenamed("tree", "key"), "merkle-subroots")
    top, _ = ranked(subroots.withColumn("all", F.lit(0)), "all", ["key"], "merkle-top")
    top_nodes, roots = build_trees(top.select(
        F.lit(TOP).cast("long").alias("tree"), "key", "idx", "n", "weight", F.col("root").alias("hash")),
        stride, "merkle-top")
    several = F.lit(subroots.limit(2).count() == 2)
    root = roots.first()  # one hash, or none for an empty table
    over, end = F.when(several, F.lit(TOP).cast("long")), F.lit(None).cast("long")
    nodes = reduce(DataFrame.unionAll, [_copied(_linked(n, stride, over)) for n in higher]
                   + [_copied(_linked(n, stride, end)) for n in top_nodes])
    # A leaf that is a tree by itself has no row of siblings: it links to the top at once.
    alone = (leaves.where("n = 1").withColumn("hop", F.lit(0)).withColumn("block", F.lit(0).cast("long"))
             .withColumn("siblings", F.array().cast("array<binary>")).withColumn("block_weight", F.col("weight")))
    start = _linked(low.unionByName(alone.select(*low.columns)), stride, over)
    spark = docs.sparkSession
    with settings(spark, {"spark.sql.cteRecursionRowLimit": "-1"}):  # as many rows as there are leaves
        climbed = stored(spark.sql(CLIMB, start=start, nodes=stored(nodes, "merkle-nodes")), "merkle-climbed")
    homes = stored(parts.join(subroots.select(F.col("key").alias("tree"), F.col("root").alias("subroot")), "tree")
                   .drop("lang"), "merkle-homes")
    return (climbed.withColumn("part", F.shiftright("leaf_id", ROW_BITS)).join(homes, ["part", "tree"])
            .select("doc_id", "leaf", "subroot", F.lit(root.root if root else None).cast("string").alias("root"),
                    "proof", "folded_root").withColumn("verified", F.col("folded_root") == F.col("root")))


def tampered_count() -> dict[str, Column]:
    """The change of the contract: where 7 divides the checksum of doc_id, n_chars is one more."""
    named = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    return {"n_chars": F.when(named, more).otherwise(F.col("n_chars").cast("string"))}


def manifest_rows(docs: DataFrame) -> DataFrame:
    """Contract columns of the query, from the operator's manifest."""
    return manifest(docs, tampered_count()).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", "verified")


# All levels as rows, then each leaf's siblings by level and a recursive fold of them.
SQL = """WITH RECURSIVE coded AS (
  SELECT doc_id, source, lang, n_chars, text,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') AS a,
    coalesce(strlen(source) || ':' || source, '-') AS b, coalesce(strlen(lang) || ':' || lang, '-') AS c,
    coalesce(strlen(text) || ':' || text, '-') AS e FROM documents),
bits AS (  -- the checksum, one byte of the decimal number after the other
  SELECT doc_id, 1 AS place, 4294967295::UBIGINT AS crc FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL SELECT doc_id, place + 1, list_reduce([xor(crc, ascii(substr(CAST(doc_id AS VARCHAR), place, 1))::UBIGINT)]
      || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
        CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)
  FROM bits WHERE place <= strlen(CAST(doc_id AS VARCHAR))),
named AS (SELECT doc_id FROM bits WHERE place > strlen(CAST(doc_id AS VARCHAR)) AND xor(crc, 4294967295::UBIGINT) % 7 = 0),
leaves AS (
  SELECT doc_id, lang, sha256(a || b || c || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || e) AS leaf,
    sha256(a || b || c || coalesce(strlen(CAST(n AS VARCHAR)) || ':' || n, '-') || e) AS found
  FROM (SELECT *, n_chars::HUGEINT + (doc_id IS NOT NULL AND doc_id IN (SELECT doc_id FROM named))::INT AS n FROM coded)),
numbered AS (
  SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST, doc_id NULLS FIRST, leaf) AS id,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, count(*) OVER (PARTITION BY lang) AS n FROM leaves),
low AS (
  SELECT tree, 0 AS level, i, leaf AS h, n FROM numbered
  UNION ALL SELECT tree, level + 1, i // 2, sha256(h || other), (n + 1) // 2
  FROM (SELECT *, coalesce(lead(h) OVER (PARTITION BY tree ORDER BY i), '') AS other FROM low WHERE n > 1)
  WHERE i % 2 = 0),
subroots AS (SELECT tree, h AS subroot, level AS height FROM low WHERE n = 1),
high AS (
  SELECT 0 AS level, tree - 1 AS i, subroot AS h, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL SELECT level + 1, i // 2, sha256(h || other), (n + 1) // 2
  FROM (SELECT *, coalesce(lead(h) OVER (ORDER BY i), '') AS other FROM high WHERE n > 1) WHERE i % 2 = 0),
steps AS (
  SELECT id, l.level AS step, coalesce(s.h, '') AS h, l.i % 2 = 1 AS on_left
  FROM numbered d JOIN low l ON l.tree = d.tree AND l.n > 1 AND l.i = d.i >> l.level
  LEFT JOIN low s ON s.tree = l.tree AND s.level = l.level AND s.i = xor(l.i, 1)
  UNION ALL
  SELECT id, r.height + l.level, coalesce(s.h, ''), l.i % 2 = 1
  FROM numbered d JOIN subroots r ON r.tree = d.tree JOIN high l ON l.n > 1 AND l.i = (d.tree - 1) >> l.level
  LEFT JOIN high s ON s.level = l.level AND s.i = xor(l.i, 1)),
proofs AS (SELECT id, sha256(string_agg(h, '' ORDER BY step)) AS proof, count(*) AS n FROM steps GROUP BY id),
fold AS (
  SELECT id, 0 AS step, found AS h FROM numbered
  UNION ALL SELECT f.id, f.step + 1, sha256(CASE WHEN on_left THEN s.h || f.h ELSE f.h || s.h END)
  FROM fold f JOIN steps s ON s.id = f.id AND s.step = f.step)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM numbered d JOIN subroots USING (tree) CROSS JOIN (SELECT h AS root FROM high WHERE n = 1)
LEFT JOIN proofs p USING (id) JOIN fold f ON f.id = d.id AND f.step = coalesce(p.n, 0)"""
