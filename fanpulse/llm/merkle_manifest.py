"""Merkle dataset manifest: cogrouped subtree exchange.

A row's leaf is the hash of its columns; per source, leaves in id order are folded sixteen by sixteen until one node, the
subroot, is left; the subroots, in source order, are folded likewise to the root. Steps:

1. Leaves are hashed by DataFrame expressions. Narrow rows (ids and digests) are range-sorted and numbered, so a source
   that holds a third of all rows spreads over many tasks.
2. Upward: a superblock is ``16**3`` neighbouring nodes of one tree. A group per superblock folds three levels at once; its
   node goes up. Three levels shrink a table 4096 times, so few rounds reach one node per tree, however large.
3. Downward: the nodes of a superblock and the one row of outer nodes it needs (its own proof up to the root, which the
   level above has worked out the same way) are cogrouped by superblock in ``applyInPandas``. The function finishes the
   local reduction, joins the inner siblings with the outer proof and folds every row's claimed leaf up to the root.

A group holds at most 4096 nodes and one proof of ``15`` digests a level. No tree, source or level passes one task.

Nulls: a null field is hashed as ``-``, so it differs from any text; a null source is a tree of its own and comes first; null
ids come first in their tree. Rows of equal id in a source stand in the order of their leaves, so repeated rows each are a
leaf and get the same results whatever the partitions. Texts are hashed whole, empty ones as ``0:``. An empty table gives
an empty result. Columns that are not named are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, stored, table

FAN = 16
LEVELS = 3  # that a superblock folds
BLOCK = FAN**LEVELS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree long, place long, of long, node string"


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels that a superblock folds in a tree of ``n`` nodes: until one node is left, three at most."""
    return next((k for k in range(LEVELS) if n <= FAN**k), LEVELS)


def fold(leaf: str, lefts: list[str], rights: list[str]) -> str:
    """The root that a leaf leads to, from the siblings before and after it on every level."""
    for left, right in zip(lefts, rights):
        leaf = _hash(left + leaf + right)
    return leaf


def paths(nodes: list[str], levels: int) -> list[tuple[list[str], list[str]]]:
    """(siblings before, siblings after), a text of joined digests per level, of every node of one superblock."""
    out: list[tuple[list[str], list[str]]] = [([], []) for _ in nodes]
    row = nodes
    for level in range(levels):
        runs = [row[i : i + FAN] for i in range(0, len(row), FAN)]
        beside = [("".join(run[:k]), "".join(run[k + 1 :])) for run in runs for k in range(len(run))]
        for i, (lefts, rights) in enumerate(out):
            left, right = beside[i // FAN**level]
            lefts.append(left)
            rights.append(right)
        row = [_hash("".join(run)) for run in runs]
    return out


def upward(nodes: DataFrame) -> DataFrame:
    """One round: tree, place, of (nodes of the tree), node -> the same of the superblocks' nodes."""
    row = F.transform(F.array_sort(F.collect_list(F.struct("place", "node"))), lambda x: x["node"])
    up = nodes.groupBy("tree", "of", F.floor(F.col("place") / BLOCK).alias("place")).agg(row.alias("row"))
    for level in range(LEVELS):
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("row") - 1) / FAN).cast("int")), lambda i: F.sha2(F.array_join(F.slice("row", i * FAN + 1, FAN), ""), 256))
        up = up.withColumn("row", F.when(F.col("of") > FAN**level, runs).otherwise(F.col("row")))
    left = F.when(F.col("of") > BLOCK, F.ceil(F.col("of") / BLOCK)).otherwise(1)
    return up.select("tree", "place", left.cast("long").alias("of"), F.get("row", F.lit(0)).alias("node"))


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes from the leaves to one node per tree."""
    out, most = [nodes], nodes.agg(F.max("of")).first()[0] or 0
    while most > 1:
        out.append(stored(upward(out[-1]), "nodes"))
        most = -(-most // BLOCK)
    return out


PROOF = "tree long, place long, subroot string, root string, lefts array<string>, rights array<string>"


def downward(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """``outer``: a proof row per superblock (tree, place). The proof row of every node."""

    def run(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner, up = inner.sort_values("place"), above.iloc[0]
        found = paths(inner["node"].tolist(), levels_of(int(inner["of"].iloc[0])))
        return pd.DataFrame({
            "tree": inner["tree"].to_numpy(), "place": inner["place"].to_numpy(), "subroot": up["subroot"], "root": up["root"],
            "lefts": [left + list(up["lefts"]) for left, _ in found], "rights": [right + list(up["rights"]) for _, right in found],
        })

    return _cogrouped(nodes, outer).applyInPandas(run, PROOF)


def _cogrouped(nodes: DataFrame, outer: DataFrame):
    inner = nodes.withColumn("block", F.floor(F.col("place") / BLOCK)).groupBy("tree", "block")
    return inner.cogroup(outer.withColumn("block", F.col("place")).groupBy("tree", "block"))


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", source_col: str = "source", claims: dict[str, Column] | None = None, proofs: bool = True) -> DataFrame:
    """id (as long), leaf, subroot, root, proof_sha256, folded_root, verified; with ``proofs``, lefts and rights (the proof itself).

    ``claims`` replaces columns by what somebody claims they hold: the leaf of the claimed row is folded with the true
    siblings, and ``verified`` tells whether it leads to the root. Without claims every row is verified.
    """
    values = {c: F.col(c) for c in columns}
    claimed = leaf_of([(claims or {}).get(c, v) for c, v in values.items()]) if claims else F.lit(None).cast("string")
    leaves = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"), leaf_of(list(values.values())).alias("node"), claimed.alias("claim"))
    leaves = stored(numbered(stored(leaves, "leaves"), ["source"], ["id", "node"], "place", "of"), "placed")
    trees = numbered(leaves.groupBy("source").agg(F.first("of").alias("n")), [], ["source"], "tree", "trees").drop("n")
    trees = stored(trees, "trees")
    leaves = leaves.join(trees.select(F.col("source").alias("t_source"), "tree"), F.col("source").eqNullSafe(F.col("t_source"))).drop("source", "t_source")
    tables = rounds(leaves.select("tree", "place", "of", "node"))
    subroots = tables[-1].select(F.col("tree").alias("t"), "node").join(trees, F.col("t") == F.col("tree"))
    tops = rounds(stored(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("trees").alias("of"), "node"), "subroots"))
    none = F.array().cast("array<string>")
    outer = tops[-1].select("tree", "place", F.lit("").alias("subroot"), F.col("node").alias("root"), none.alias("lefts"), none.alias("rights"))
    for nodes in reversed(tops[:-1]):
        outer = downward(nodes, outer)
    outer = tops[0].join(outer.drop("tree", "subroot"), "place").select(F.col("place").alias("tree"), F.lit(0).cast("long").alias("place"), F.col("node").alias("subroot"), "root", "lefts", "rights")
    for nodes in reversed(tables[1:-1]):
        outer = downward(nodes, stored(outer, "outer"))

    def run(inner: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        inner, up = inner.sort_values("place"), above.iloc[0]
        rows, lefts, rights = [], [], []
        for leaf, claim, (left, right) in zip(inner["node"], inner["claim"], paths(inner["node"].tolist(), levels_of(int(inner["of"].iloc[0])))):
            left, right = left + list(up["lefts"]), right + list(up["rights"])
            reached = fold(claim if isinstance(claim, str) else leaf, left, right)
            rows.append((leaf, up["subroot"], up["root"], _hash("".join(a + b for a, b in zip(left, right))), reached, reached == up["root"]))
            lefts.append(left)
            rights.append(right)
        out = pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
        out.insert(0, "id", inner["id"].to_numpy())
        return out.assign(lefts=lefts, rights=rights) if proofs else out

    inner = leaves.withColumn("id", F.col("id").cast("string"))  # pandas has no plain integer column with nulls
    schema = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean" + (", lefts array<string>, rights array<string>" if proofs else "")
    out = _cogrouped(inner, stored(outer, "outer")).applyInPandas(run, schema)
    return out.withColumn("id", F.col("id").cast("long"))


def tampered(id_col: str = "doc_id") -> Column:
    """Rows whose text is tampered with: 5 divides the crc32 of the decimal id. A null id is left alone."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    claims = {"text": F.when(tampered(), F.translate("text", *LOWER)).otherwise(F.col("text"))}
    return manifest(table(spark, sf_dir, "documents"), claims=claims, proofs=False).withColumnRenamed("id", "doc_id")


def _oracle(levels: int = 8) -> str:
    """Levels one by one; a tree that is down to one node keeps it, so ``levels`` bounds trees at 16**levels nodes."""
    enc = lambda c: f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(enc(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = f"translate(text, '{LOWER[0]}', '{LOWER[1]}')"
    byte = "list_reduce(list_concat([xor(c, ascii(x)::BIGINT)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    step = byte.replace("ascii(x)", "x")
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, x: {step}), 4294967295)"
    parts = [f"""
l0 AS (SELECT doc_id, source, {leaf("text")} AS leaf, {leaf(f"CASE WHEN {crc} % 5 = 0 THEN {lower} ELSE text END")} AS claim FROM documents),
n0 AS (SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM l0
  WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
a0 AS (SELECT 0 AS t, source, pos AS i, n, leaf AS h FROM n0)"""]
    for k in range(1, levels + 1):
        parts.append(f"""a{k} AS (SELECT t, source, i // 16 AS i, (any_value(n) + 15) // 16 AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM a{k - 1} GROUP BY t, source, i // 16)""")
    parts.append(f"""subs AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees FROM a{levels}),
b0 AS (SELECT tree AS i, trees AS n, subroot AS h FROM subs)""")
    for k in range(1, levels + 1):
        parts.append(f"b{k} AS (SELECT i // 16 AS i, (any_value(n) + 15) // 16 AS n, CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM b{k - 1} GROUP BY i // 16)")
    # siblings: joined digests before and after a node in its run
    run = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING", "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING"
    for name, key in (("a", "source, "), ("b", "")):
        for k in range(levels):
            sides = ", ".join(f"CASE WHEN n > 1 THEN coalesce(string_agg(h, '') OVER (PARTITION BY {key}i // 16 ORDER BY i {frame}), '') END AS {side}" for frame, side in zip(run, ("lo", "hi")))
            parts.append(f"{name}s{k} AS (SELECT {key}i, {sides} FROM {name}{k})")
    prev, cols = "n0", "doc_id, source, leaf, pos, claim AS f, '' AS p"
    parts.append(f"f0 AS (SELECT {cols}, 0 AS tree FROM {prev})")
    step_ = lambda k, new, old, place: f"""{new} AS (SELECT f.doc_id, f.source, f.leaf, f.pos, f.tree, CASE WHEN s.lo IS NULL THEN f.f ELSE sha256(s.lo || f.f || s.hi) END AS f,
  f.p || coalesce(s.lo || s.hi, '') AS p FROM {old} f JOIN {place})"""  # noqa: E731
    for k in range(levels):
        parts.append(step_(k, f"f{k + 1}", f"f{k}", f"as{k} s ON s.source IS NOT DISTINCT FROM f.source AND s.i = f.pos // {16**k}"))
    parts.append(f"g0 AS (SELECT f.* EXCLUDE (tree), u.tree, u.subroot FROM f{levels} f JOIN subs u ON u.source IS NOT DISTINCT FROM f.source)")
    for k in range(levels):
        parts.append(step_(k, f"g{k + 1}", f"g{k}", f"bs{k} s ON s.i = f.tree // {16**k}").replace("f.tree,", "f.tree, f.subroot,", 1))
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, r.h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = r.h AS verified FROM g{levels} CROSS JOIN b{levels} r"""


ORACLE = _oracle()
