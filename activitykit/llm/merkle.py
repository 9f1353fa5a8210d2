"""A Merkle manifest of a dataset: one tree a group, and a tree over the groups' roots.

A leaf is the hash of a row's fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and value.
In each tree two consecutive nodes become their parent, the hash of their digests as hex text; a last
node without a sibling is hashed alone; the one node that remains is the tree's root.

*Places.* Rows are range-partitioned by (group, key, leaf) and sorted within partitions; a row's place
is its place within its partition plus the rows of its group in the partitions before. So a group of
any size is spread over many tasks.
*Up.* Every level is joined with itself by shifting to the sibling's index: ``(tree, idx)`` equals
``(tree, idx XOR 1)``. The row of slot zero of each pair emits the parent at ``idx >> 1``. All trees
rise together; a tree whose level has one node is done. Each level is cut off by a checkpoint and
has half the nodes of the one below, so all levels together cost twice the first. Once all
unfinished trees together have at most ``TOP_NODES`` nodes, one task takes them to their roots by
the same sibling rule: a job for each of these small levels would only fill the driver with plans.
*Top.* The groups' roots, ordered by group (null first, bytewise), are the leaves of one more tree.
*Down.* A node's proof is its sibling and then its parent's proof; it is handed down level by level
with a join on ``idx >> 1``, and each leaf ends with all siblings on its way to the root.

A proof is an array of strings: ``>`` and the digest of a sibling to the right, ``<`` and one to the
left, ``-`` where the node was hashed alone.

Edge cases: null fields hash as ``-``, an empty text as ``0:``; texts of any length are hashed whole;
null groups make one tree, before all others; null keys come first in their group; rows with the same
key follow each other by leaf digest, and repeated rows are leaves of their own with equal digests
and places side by side; a table of one row has its leaf as root and an empty proof; an empty table
gives none; columns that are not named take no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from activitykit.llm.common import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP_NODES = 1 << 14  # nodes of all unfinished trees that one task finishes
MOST_LEVELS = 48
CUT_LEVELS = 3
REACHED = "tree string, height int, idx long, subroot string, proof array<string>"
BROADCAST_ROWS = 100_000  # partitions and trees; about 100 bytes each


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(col: Column) -> Column:
    """A value's part of a leaf."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: list[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def _ranked(leaves: DataFrame) -> DataFrame:
    """``leaves`` (tree, key, digest and others) with ``idx``, the place in its tree, and ``n``, the leaves of it."""
    order = [F.col("tree"), F.col("key").asc_nulls_first(), F.col("digest"), F.col("_row")]
    leaves = cut_lineage(leaves.withColumn("_row", F.monotonically_increasing_id()))  # ranges are drawn from a sample: hash once
    dealt = cut_lineage(leaves.repartitionByRange(*order).sortWithinPartitions(*order).drop("_row"))
    # the rows lie as they were written, so a number by partition and row is a place in the order
    dealt = dealt.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33))
    counts = dealt.groupBy("tree", "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    earlier = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    offsets = cut_lineage(counts.select("tree", "_part", "_first", before, F.sum("_rows").over(Window.partitionBy("tree")).alias("n")))
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    joined = dealt.join(offsets, ["tree", "_part"])
    return cut_lineage(joined.withColumn("idx", F.col("_before") + F.col("_row") - F.col("_first")).drop("_row", "_part", "_first", "_before"))


def _top(height: int):
    """The rest of all trees, from their nodes at one level: each node's proof and its tree's root."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        for tree, rows in pd.concat(held).groupby("tree", sort=False) if held else ():
            level = rows.sort_values("idx")["digest"].tolist()
            at, proofs = list(range(len(level))), [[] for _ in level]
            while len(level) > 1:
                for proof, i in zip(proofs, at):
                    sib = i ^ 1
                    proof.append("-" if sib >= len(level) else ("<" if sib < i else ">") + level[sib])
                at = [i >> 1 for i in at]
                level = [hashlib.sha256("".join(level[k : k + 2]).encode()).hexdigest() for k in range(0, len(level), 2)]
            yield pd.DataFrame({"tree": tree, "height": height, "idx": range(len(proofs)), "subroot": level[0], "proof": proofs})

    return run


def _climb(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(levels, reached). A level: (tree, idx, n, digest, sib), at level 0 with the leaves' other columns.
    ``reached``: (tree, height, idx, subroot, proof) of the nodes whose way to their root is known: the roots
    that levels ended at, and all nodes of the level at which ``TOP_NODES`` or fewer were left."""
    nodes_at = [F.sum(F.when(F.ceil(F.col("n") / (1 << h)) > 1, F.ceil(F.col("n") / (1 << h))).otherwise(0)) for h in range(MOST_LEVELS)]
    left = leaves.filter("idx = 0").agg(*nodes_at).first()
    levels, ends, nodes = [], [], leaves
    nothing = F.array().cast("array<string>")
    for height in range(MOST_LEVELS):
        ends.append(nodes.filter("n = 1").select("tree", F.lit(height).alias("height"), "idx", F.col("digest").alias("subroot"), nothing.alias("proof")))
        if (left[height] or 0) <= TOP_NODES:
            break
        live = nodes.filter("n > 1")
        shifted = live.select("tree", F.col("idx").bitwiseXOR(F.lit(1).cast("long")).alias("idx"), F.col("digest").alias("sib"))
        levels.append(cut_lineage(live.join(shifted, ["tree", "idx"], "left")))
        up = digest(F.col("digest"), F.coalesce("sib", F.lit("")))
        nodes = levels[-1].filter("idx % 2 = 0").select("tree", F.shiftright("idx", 1).alias("idx"), F.shiftright(F.col("n") + 1, 1).alias("n"), up.alias("digest"))
    rest = nodes.filter("n > 1").select("tree", "idx", "digest").repartition(1).mapInPandas(_top(len(levels)), REACHED)
    for end in ends:
        rest = rest.unionByName(end)
    return levels, cut_lineage(rest)


def _descend(leaves: DataFrame, levels: list[DataFrame], reached: DataFrame, kept: list[str]) -> DataFrame:
    """(kept columns, subroot, proof) of all leaves."""
    handed = ["subroot", "proof"]
    alone = leaves.filter("n = 1") if levels else leaves
    out = alone.select("tree", "idx", *kept).join(reached.filter("height = 0").drop("height"), ["tree", "idx"]).select(*kept, *handed)
    above = reached.filter(F.col("height") == len(levels)).drop("height")
    for height in range(len(levels) - 1, -1, -1):
        right = F.concat(F.lit(">"), F.col("sib"))
        own = F.when(F.col("sib").isNull(), F.lit("-")).when(F.col("idx") % 2 == 0, right).otherwise(F.concat(F.lit("<"), F.col("sib")))
        held = ["tree", "idx", *(kept if height == 0 else [])]
        level = levels[height].select(*held, own.alias("_own"), F.shiftright("idx", 1).alias("_up"))
        parents = above.select("tree", F.col("idx").alias("_up"), *handed)
        proof = F.concat(F.array("_own"), F.col("proof")).alias("proof")
        above = level.join(parents, ["tree", "_up"]).select(*held, "subroot", proof)
        if height:
            above = above.unionByName(reached.filter(F.col("height") == height).drop("height"))
            if height % CUT_LEVELS == 0:
                above = cut_lineage(above)  # a plan of few joins; an eighth of the proofs below at most
    return out.unionByName(above.select(*kept, *handed)) if levels else out


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", key: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """(key, leaf, subroot, root, proof) of every row, and the ``carry`` columns taken along."""
    carry = carry or {}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))  # null before all, else bytewise
    taken = [c.alias(f"carry_{name}") for name, c in carry.items()]
    rows = docs.select(tree.alias("tree"), F.col(key).alias("key"), leaf([F.col(f) for f in fields]).alias("digest"), *taken)
    leaves = _ranked(rows).withColumn("leaf", F.col("digest"))
    levels, reached = _climb(leaves)

    subroots = reached.groupBy("tree").agg(F.min("subroot").alias("subroot"))  # one value a tree
    top = _ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("subroot").alias("digest")))
    above = _descend(top, *_climb(top), ["key"])
    above = cut_lineage(above.select(F.col("key").alias("tree"), F.col("subroot").alias("_root"), F.col("proof").alias("_above")))
    row = above.select("_root").first()
    root = F.lit(row[0] if row else None).cast("string")

    known = reached.join(above.drop("_root"), "tree").select("tree", "height", "idx", "subroot", F.concat("proof", "_above").alias("proof"))
    kept = ["key", "leaf", *[f"carry_{name}" for name in carry]]
    found = _descend(leaves, levels, cut_lineage(known), kept)
    return found.select(F.col("key").alias(key), "leaf", "subroot", root.alias("root"), "proof", *[F.col(f"carry_{name}").alias(name) for name in carry])


def siblings(proof: Column) -> Column:
    """The hash of a proof's sibling digests, one after another."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda p: F.substring(p, 2, 64))), 256)


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and a proof lead to."""

    def step(acc: Column, p: Column) -> Column:
        sib = F.substring(p, 2, 64)
        return F.sha2(F.when(p.startswith("<"), F.concat(sib, acc)).otherwise(F.concat(acc, sib)), 256)

    return F.aggregate(proof, start, step)


def checked(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents`` verified against a tampered copy.

    Tampering adds 1 to n_chars (a null stays) where 7 divides the CRC-32 of the decimal doc_id (a
    null doc_id: never). ``folded_root`` folds the tampered leaf with the original proof.
    """
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")
    changed = leaf([more if f == "n_chars" else F.col(f) for f in FIELDS])
    found = manifest(docs, carry={"changed": F.when(hit, changed)})
    fold = folded(F.coalesce("changed", "leaf"), F.col("proof"))
    done = found.select("doc_id", "leaf", "subroot", "root", siblings(F.col("proof")).alias("proof_sha256"), fold.alias("folded_root"))
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))


CHECKED_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, lang, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
           || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         n_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail,
         list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
           lambda a, b: list_reduce(list_concat([xor(a, b)], [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))) AS crc
  FROM documents),
leaves AS (
  SELECT doc_id, tree, sha256(head || coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS changed,
         coalesce(xor(crc, 4294967295) % 7 = 0, false) AS hit
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves),
nodes AS (
  SELECT tree, CAST(0 AS BIGINT) AS lvl, CAST(idx AS BIGINT) AS idx, CAST(n AS BIGINT) AS n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY tree, lvl, idx // 2, n),
subroots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT CAST(0 AS BIGINT) AS lvl, CAST(idx AS BIGINT) AS idx, CAST(n AS BIGINT) AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY lvl, idx // 2, n),
steps AS (
  SELECT p.doc_id, p.tree, p.idx, 0 AS stage, a.lvl, CASE WHEN b.digest IS NULL THEN '-' WHEN a.idx % 2 = 0 THEN '>' || b.digest ELSE '<' || b.digest END AS step
  FROM placed p JOIN nodes a ON a.tree = p.tree AND a.n > 1 AND a.idx = p.idx >> a.lvl
  LEFT JOIN nodes b ON b.tree = a.tree AND b.lvl = a.lvl AND b.idx = xor(a.idx, 1)
  UNION ALL
  SELECT p.doc_id, p.tree, p.idx, 1, a.lvl, CASE WHEN b.digest IS NULL THEN '-' WHEN a.idx % 2 = 0 THEN '>' || b.digest ELSE '<' || b.digest END
  FROM placed p JOIN subroots s ON s.tree = p.tree JOIN tops a ON a.n > 1 AND a.idx = s.idx >> a.lvl
  LEFT JOIN tops b ON b.lvl = a.lvl AND b.idx = xor(a.idx, 1)),
proofs AS (SELECT tree, idx, list(step ORDER BY stage, lvl) AS proof FROM steps GROUP BY tree, idx),
whole AS (
  SELECT p.doc_id, p.leaf, s.subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
         coalesce(proof, CAST([] AS VARCHAR[])) AS proof, CASE WHEN p.hit THEN p.changed ELSE p.leaf END AS start
  FROM placed p JOIN subroots s USING (tree) LEFT JOIN proofs q ON q.tree = p.tree AND q.idx = p.idx),
done AS (
  SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(proof, lambda x: x[2:]), '')) AS proof_sha256,
         list_reduce(list_concat([start], proof), lambda a, x: sha256(CASE WHEN x[1] = '<' THEN x[2:] || a ELSE a || x[2:] END)) AS folded_root
  FROM whole)
SELECT *, folded_root = root AS verified FROM done
"""
