"""Merkle manifest of a table: one hash tree per group of rows and one over the
groups' roots, with a proof for every row.

Nodes are lower-case hexadecimal SHA-256 digests, ``RUN`` to a parent. A tree
is stored by aligned blocks of ``RUN ** LEVELS`` nodes: each block keeps a level
as one string of concatenated digests, cut by fixed-width substrings into runs
(hashed to the parents) and into the parts before and after a node (its
siblings). The blocks' own roots are the nodes of the same procedure one storey
up, until every tree fits in a block. Everything is built-in functions; only
digests and keys are shuffled, never the hashed values.

Defined results: nulls hash as ``-`` and a null group is a group of its own,
before all others; null order keys come first; an empty text hashes as ``0:``;
texts of any length are hashed where they lie; rows that tie in the order are
ordered by leaf, and wholly equal rows share a leaf and take neighbouring
places; a group of one row has its leaf for root; an empty table has no rows.
Extra columns are ignored unless asked for, and carried columns cannot clash
with the operator's own, which are in a struct of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import cut, table

RUN = 8                       # children of a node
LEVELS = 3                    # levels that one block spans
BLOCK = RUN ** LEVELS         # nodes of a block's lowest level
HEX = 64                      # characters of a digest
BROADCAST_ROWS = 1 << 20      # of (key, number) tables; beyond that Spark shuffles both sides
_PATH = "array<struct<left: string, right: string>>"


def leaf_hash(*values: Column) -> Column:
    """Digest of values, each as ``<UTF-8 bytes>:<value>`` or ``-`` if null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def folded(node: Column, path: Column) -> Column:
    """The root that ``node`` and the siblings on ``path`` lead to."""
    return F.aggregate(path, node, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_hash(path: Column) -> Column:
    """Digest of all siblings on ``path``, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _counted(small: DataFrame) -> DataFrame:
    small = cut(small)
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small


def _placed(rows: DataFrame) -> DataFrame:
    """rows(tree, order, node, row) with ``rank``, the place in the tree, and
    ``n``, the tree's size. Rows are range partitioned by (tree, order, node);
    only one count for each partition and tree is summed up across tasks."""
    keys = ["tree", "order", "node", "_tie"]              # the tie lets equal rows lie in several ranges
    laid = cut(rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
               .sortWithinPartitions(*keys).drop("order", "_tie")
               .withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    pieces = laid.groupBy("_pid", "tree").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    tree = W.partitionBy("tree")
    pieces = pieces.select("_pid", "tree", "_first", F.sum("_n").over(tree).alias("n"),
                           (F.sum("_n").over(tree.orderBy("_pid")) - F.col("_n")).alias("_before"))
    return (laid.join(_counted(pieces), ["_pid", "tree"])
            .select("tree", (F.col("_before") + F.col("_at") - F.col("_first")).alias("rank"), "n", "node", "row"))


def _runs(level: str) -> Column:
    """A level's string cut into strings of one run each."""
    return F.expr(f"transform(sequence(0, (length({level}) - 1) div {RUN * HEX}), "
                  f"j -> substring({level}, int(j * {RUN * HEX} + 1), {RUN * HEX}))")


def _storey(nodes: DataFrame) -> DataFrame:
    """nodes(tree, rank, n, node, row) -> one row per block: members, the runs
    of its levels, and ``top``, the only node left on its highest level."""
    blocks = (nodes.groupBy("tree", "n", F.expr(f"rank div {BLOCK}").alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("rank", "node", "row"))).alias("members")))
    levels = F.lit(0)
    for k in range(LEVELS):
        levels = levels + (F.col("n") > RUN ** k).cast("int")
    blocks = blocks.withColumn("levels", levels).withColumn("level0", F.array_join("members.node", ""))
    top = F.col("level0")
    for k in range(LEVELS):
        blocks = blocks.withColumn(f"runs{k}", F.when(F.col("levels") > k, _runs(f"level{k}")))
        parents = F.array_join(F.transform(f"runs{k}", lambda run: F.sha2(run, 256)), "")
        blocks = blocks.withColumn(f"level{k + 1}", parents)
        top = F.when(F.col("levels") > k, F.col(f"level{k + 1}")).otherwise(top)
    return cut(blocks.select("tree", "n", "block", "members", "levels", *[f"runs{k}" for k in range(LEVELS)],
                             top.alias("top")))


def _grown(nodes: DataFrame, most: int) -> DataFrame:
    """Blocks of the lowest storey with ``above``, the path from the block's
    top to its tree's root, and that ``root``. ``most``: size of the largest tree."""
    blocks = _storey(nodes)
    alone = F.col("n") <= BLOCK
    none = F.array().cast(_PATH)
    if most <= BLOCK:
        return blocks.select("*", none.alias("above"), F.col("top").alias("root"))
    tops = blocks.filter(~alone).select("tree", F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).alias("n"),
                                        F.col("top").alias("node"), F.struct().alias("row"))
    upper = _members(_grown(tops, -(-most // BLOCK))).select("tree", F.col("rank").alias("block"), "path", "root")
    return (blocks.join(upper, ["tree", "block"], "left")
            .select(*[blocks[c] for c in blocks.columns], F.coalesce("path", none).alias("above"),
                    F.coalesce("root", "top").alias("root")))


def _members(blocks: DataFrame) -> DataFrame:
    """The nodes of blocks, each with its path to the root."""
    each = blocks.select("*", F.explode("members").alias("m")).withColumn("_i", F.expr(f"int(m.rank % {BLOCK})"))
    steps = []
    for k in range(LEVELS):
        run = f"element_at(runs{k}, int(_i div {RUN ** (k + 1)}) + 1)"
        child = f"int(_i div {RUN ** k} % {RUN})"
        steps.append(F.struct(F.expr(f"substring({run}, 1, {child} * {HEX})").alias("left"),
                              F.expr(f"substring({run}, {child} * {HEX} + {HEX + 1}, {RUN * HEX})").alias("right")))
    local = F.slice(F.array(*steps), 1, F.col("levels"))
    return each.select("tree", "m.rank", "m.node", "m.row", F.concat(local, "above").alias("path"), "root")


def merkle_manifest(rows: DataFrame, leaf: Column, tree: Column, order: Column, carry: list[Column]) -> DataFrame:
    """One row per input row: ``row`` (struct of the carried columns), leaf,
    rank (place in its tree), subroot (root of its tree), root, and path, the
    siblings (left, right) on each level from the leaf up to the root.

    tree: a string column that names the row's tree; order: orders a tree's
    leaves. Trees are ordered by name, null first."""
    named = F.coalesce(F.concat(F.lit("1"), tree), F.lit("0"))     # never null, and "0" sorts first
    nodes = _placed(rows.select(named.alias("tree"), order.alias("order"), leaf.alias("node"), F.struct(*carry).alias("row")))
    most = nodes.agg(F.max("n")).first()[0] or 0
    blocks = _grown(nodes, most)
    roots = (blocks.filter("block = 0")
             .select(F.lit("").alias("tree"), F.col("tree").alias("order"), F.col("root").alias("node"), F.struct("tree").alias("row")))
    roots = _placed(roots)
    whole = _members(_grown(roots, roots.count()))
    whole = whole.select(F.col("row.tree").alias("tree"), F.col("path").alias("last"), F.col("root").alias("whole"))
    joined = blocks.join(_counted(whole), "tree")
    out = _members(joined.withColumn("above", F.concat("above", "last")).withColumn("root", F.struct("root", "whole")))
    return out.select("row", F.col("node").alias("leaf"), "rank", F.col("root.root").alias("subroot"),
                      F.col("root.whole").alias("root"), "path")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of documents with a tree per lang; the proofs are checked
    against documents of which a third (by crc32 of doc_id) has been lower-cased."""
    docs = table(spark, sf_dir, "documents")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    forged = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0,
                    leaf_hash(*head, F.translate("text", upper, upper.lower())))
    found = merkle_manifest(docs, leaf_hash(*head, F.col("text")), F.col("lang"), F.col("doc_id"),
                            [F.col("doc_id"), forged.alias("forged")])
    return (found.select(F.col("row.doc_id").alias("doc_id"), "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"),
                         folded(F.coalesce("row.forged", "leaf"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


OP12_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
d AS (
  SELECT *, xor(4294967295, list_reduce(
      list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
      lambda a, b: xor(a // 256, t[CAST(xor(a, b) & 255 AS BIGINT) + 1]))) % 3 = 0 AS forge
  FROM documents, crc_table),
h AS (
  SELECT doc_id, lang, text,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
    CASE WHEN coalesce(forge, false) THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS seen
  FROM d),
leaves AS (
  SELECT doc_id, lang, sha256(head || CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END) AS leaf,
    sha256(head || CASE WHEN seen IS NULL THEN '-' ELSE strlen(seen) || ':' || seen END) AS seen_leaf
  FROM h),
places AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM leaves),
up AS (
  SELECT coalesce('1' || lang, '0') AS tree, 0 AS lvl, place AS i, leaf AS node, count(*) OVER (PARTITION BY lang) AS n FROM places
  UNION ALL
  SELECT tree, lvl + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8 FROM up WHERE n > 1 GROUP BY tree, lvl, i // 8, n),
subroots AS (
  SELECT tree, node, lvl AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS place FROM up WHERE n = 1),
top AS (
  SELECT 0 AS lvl, place AS i, node, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT lvl + 1, i // 8, sha256(string_agg(node, '' ORDER BY i)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY lvl, i // 8, n),
steps AS (
  SELECT tree, lvl, i,
    coalesce(string_agg(node, '' ) OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM (SELECT tree, lvl, i, node FROM up WHERE n > 1 UNION ALL SELECT NULL, lvl, i, node FROM top WHERE n > 1)
  WINDOW run AS (PARTITION BY tree, lvl, i // 8 ORDER BY i)),
fold AS (
  SELECT p.doc_id, p.leaf, coalesce('1' || lang, '0') AS tree, place AS own, 0 AS k, seen_leaf AS node, '' AS proof FROM places p
  UNION ALL
  SELECT f.doc_id, f.leaf, f.tree, f.own, k + 1, sha256(s.l || f.node || s.r), proof || s.l || s.r
  FROM fold f JOIN subroots b ON b.tree = f.tree
  JOIN steps s ON (k < height AND s.tree = f.tree AND s.lvl = k AND s.i = f.own // CAST(power(8, k) AS BIGINT))
    OR (k >= height AND s.tree IS NULL AND s.lvl = k - height AND s.i = b.place // CAST(power(8, k - height) AS BIGINT)))
SELECT f.doc_id, f.leaf, b.node AS subroot, t.node AS root, sha256(proof) AS proof_sha256, f.node AS folded_root, f.node = t.node AS verified
FROM fold f JOIN subroots b ON b.tree = f.tree JOIN top t ON t.n = 1
WHERE f.k = b.height + t.lvl
"""
