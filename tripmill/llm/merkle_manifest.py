"""A Merkle manifest of a documents table, with proofs by an octopus multiproof.

*Trees.* Each row is a leaf: the digest of its fields, each with its length in
front. The leaves of a language, in rising order of id, are folded in runs of
eight until one node remains, the language's subroot; the subroots, in order of
language, are folded alike into the root. A level is one grouped aggregation over
runs of at most eight nodes, stored before the next one reads it.

*Places.* A leaf's place is its rank within its language: rows are sorted by
range, numbered within their partition, and shifted by the counts of the
partitions before, so no language has to fit one task.

*Proofs.* Leaves are proved in partitions of ``8 ** BLOCK_LEVELS`` neighbours.
Each partition computes the coordinates of the nodes that no leaf of its own
derives - level by level the members of the touched runs that it does not know -
and fetches the union of them once by a join. It derives the shared interior
nodes, and expands the proof of each leaf from these: siblings from the leaf's run
up to the root, left to right.

Nulls are fields of their own ("-"); a null language comes first, as null ids do
within a language; a null id is never tampered with. Rows of equal id stand in the
order of their digests; equal rows are leaves of their own, in any order, as they
are exchangeable. An empty table has no leaf, no root and no proof. Columns that
are not fields take no part and are dropped.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import require, table
from tripmill.session import settle, shared_dir

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
#: Levels of the subtree whose leaves are proved together.
BLOCK_LEVELS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Name of the tree over the subroots; the trees of languages begin with another letter.
TOP = "top"
NODE_SCHEMA = "tree string, idx bigint, n bigint, digest string"


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's fields; ``changed`` has other values for some of them."""

    def part(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(part, FIELDS)), 256)


def ranked(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """Stored rows with idx, the rank from 0 within ``tree`` in the given order, and n, the rows of the tree."""
    keys = ["tree", *order, "_row"]
    spread = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    stored = settle(spread.drop("_row").withColumn("_at", F.monotonically_increasing_id()), purpose)  # partition and number within it
    placed = stored.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy("_part", "tree").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))  # partitions plus trees at most
    before = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tree")
    runs = runs.select(
        "_part", "tree", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_rows").over(whole).alias("n")
    )
    indexed = placed.join(runs, ["_part", "tree"]).withColumn("idx", F.col("_at") + F.col("_shift"))
    return settle(indexed.drop("_part", "_at", "_shift"), f"{purpose}-ranked")


def fold_levels(leaves: DataFrame, purpose: str) -> DataFrame:
    """Nodes of all levels above the leaves (level, tree, idx, n, digest); n is the number of nodes of the tree on that level."""
    spark, path, level = leaves.sparkSession, shared_dir(leaves.sparkSession, purpose), 0
    nodes = leaves.select("tree", "idx", "n", "digest")
    spark.createDataFrame([], NODE_SCHEMA).write.parquet(f"{path}/level=0")
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        level, most = level + 1, -(-most // ARITY)
        members = F.transform(F.sort_array(F.collect_list(F.struct("idx", "digest"))), lambda m: m["digest"])  # eight at most
        parents = (
            nodes.where("n > 1")
            .groupBy("tree", F.floor(F.col("idx") / ARITY).alias("parent"))
            .agg(F.ceil(F.max("n") / ARITY).alias("n"), F.sha2(F.concat_ws("", members), 256).alias("digest"))
        )
        parents.select("tree", F.col("parent").alias("idx"), "n", "digest").write.parquet(f"{path}/level={level}")
        nodes = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/level={level}")
    return spark.read.schema(f"{NODE_SCHEMA}, level int").parquet(path)


@dataclass(frozen=True)
class Manifest:
    """Stored leaves (tree, idx, n, digest, doc_id, tampered, place and number of the tree), and nodes (tree, level, idx, digest)."""

    leaves: DataFrame
    nodes: DataFrame

    def root(self) -> str | None:
        """The root's digest; None for an empty table."""
        row = self.nodes.where((F.col("tree") == TOP) & (F.col("n") == 1)).select("digest").first()
        return row["digest"] if row else None


def build(docs: DataFrame) -> Manifest:
    """Leaves and nodes of the manifest of ``docs``."""
    require(docs, *FIELDS)
    lowered = F.translate("text", UPPER, LOWER)
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.when(lowered != F.col("text"), leaf_digest(text=lowered)))
    tree = F.concat(F.lit("in"), F.coalesce(F.concat(F.lit(":"), F.col("lang").cast("string")), F.lit("")))
    hashed = settle(docs.select("doc_id", tree.alias("tree"), leaf_digest().alias("digest"), tampered.alias("tampered")), "leaves")
    leaves = ranked(hashed, ["doc_id", "digest"], "order")
    inner = fold_levels(leaves, "nodes")
    subroots = leaves.where("n = 1").select("tree", "digest").unionByName(inner.where("n = 1").select("tree", "digest"))
    tops = ranked(subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("own"), "digest"), ["own"], "subroots")
    upper = fold_levels(tops, "top")
    places = tops.select(F.col("own").alias("tree"), F.col("idx").alias("place"), F.col("n").alias("trees"))
    columns = ("tree", "level", "idx", "n", "digest")
    at_top = tops.withColumn("level", F.lit(0)).select(*columns).unionByName(upper.select(*columns))
    # few trees or many: the engine chooses the join; splitting a large tree's rows is left to it as well
    return Manifest(settle(leaves.join(places, "tree"), "placed"), inner.select(*columns).unionByName(at_top))


def height(n: int) -> int:
    """Levels above the leaves of a tree of n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def missing(indices: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The fewest nodes (level, idx) with which the leaves at ``indices`` derive a tree's root and all their proofs."""
    found, known, level = [], np.unique(indices), 0
    while n > 1:
        runs = np.unique(known // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        found.extend((level, int(i)) for i in np.setdiff1d(members[members < n], known, assume_unique=True))
        known, n, level = runs, -(-n // ARITY), level + 1
    return found


class Branch:
    """The nodes of one tree that some of its leaves know: fetched ones and those derived from them."""

    def __init__(self, leaves: dict[int, str], fetched: dict[int, dict[int, str]], n: int):
        self.levels = [{**fetched.get(0, {}), **leaves}]
        touched = set(leaves)
        for level in range(height(n)):
            nodes, touched = self.levels[-1], {i // ARITY for i in touched}
            size = -(-n // ARITY**level)
            derived = {run: digest(nodes[i] for i in range(run * ARITY, min(size, (run + 1) * ARITY))) for run in touched}
            self.levels.append({**fetched.get(level + 1, {}), **derived})
        self.n = n

    def steps(self, index: int) -> list[tuple[list[str], list[str]]]:
        """From a leaf up to the root: the siblings left and right of the path."""
        found, n = [], self.n
        for nodes in self.levels[:-1]:
            first = index // ARITY * ARITY
            found.append(([nodes[i] for i in range(first, index)], [nodes[i] for i in range(index + 1, min(n, first + ARITY))]))
            index, n = index // ARITY, -(-n // ARITY)
        return found


def fold(leaf: str, steps: Iterable[tuple[str, str]]) -> str:
    """The root that a leaf and its joined siblings on the left and right of each level lead to."""
    for left, right in steps:
        leaf = hashlib.sha256(f"{left}{leaf}{right}".encode()).hexdigest()
    return leaf


def prove(manifest: Manifest, wanted: DataFrame | None = None, with_proofs: bool = False) -> DataFrame:
    """Proofs of all leaves, or of those whose doc_id is in ``wanted``.

    Columns: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; with
    ``with_proofs`` also proof, the siblings' digests themselves.
    """
    leaves, nodes = manifest.leaves, manifest.nodes
    if wanted is not None:
        nodes = nodes.unionByName(leaves.select("tree", F.lit(0).alias("level"), "idx", "n", "digest"))
        leaves = leaves.join(wanted.select("doc_id").distinct(), "doc_id", "left_semi")
    leaves = leaves.withColumn("block", F.floor(F.col("idx") / ARITY**BLOCK_LEVELS))

    @F.arrow_udf("array<struct<of:string,level:int,idx:bigint>>")
    def coordinates(tree: pa.Array, indices: pa.Array, n: pa.Array, place: pa.Array, trees: pa.Array) -> pa.Array:
        rows = []
        for own, held, size, at, number in zip(tree.to_pylist(), indices, n.to_pylist(), place.to_pylist(), trees.to_pylist()):
            below, above = missing(np.array(held.as_py()), size), missing(np.array([at]), number)
            # the published subroot and root come too, to be compared with
            below, above = [*below, (height(size), 0)] if size > 1 else below, [*above, (height(number), 0)]
            rows.append([{"of": own, "level": a, "idx": b} for a, b in below] + [{"of": TOP, "level": a, "idx": b} for a, b in above])
        return pa.array(rows, pa.list_(pa.struct([("of", pa.string()), ("level", pa.int32()), ("idx", pa.int64())])))

    blocks = leaves.groupBy("tree", "block").agg(F.collect_list("idx").alias("held"), *[F.max(c).alias(c) for c in ("n", "place", "trees")])
    asked = blocks.select("tree", "block", F.explode(coordinates("tree", "held", "n", "place", "trees")).alias("_at")).select(F.col("tree").alias("by"), F.col("block").alias("part"), "_at.*")
    fetched = asked.join(nodes.select(F.col("tree").alias("of"), "level", "idx", "digest"), ["of", "level", "idx"])
    schema = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if with_proofs:
        schema += ", proof array<string>"

    def expand(own: pa.Table, came: pa.Table) -> pa.Table:
        rows = {name: own.column(name).to_pylist() for name in ("doc_id", "idx", "digest", "tampered")}
        if not rows["idx"]:
            return arrow.empty_table()
        tree, n, place, trees = (own.column(name)[0].as_py() for name in ("tree", "n", "place", "trees"))
        known: dict[str, dict[int, dict[int, str]]] = {tree: defaultdict(dict), TOP: defaultdict(dict)}
        for of, level, idx, value in zip(*(came.column(c).to_pylist() for c in ("of", "level", "idx", "digest"))):
            known[of][level][idx] = value
        below = Branch(dict(zip(rows["idx"], rows["digest"])), known[tree], n)
        above = Branch({place: below.levels[-1][0]}, known[TOP], trees)
        subroot = known[tree][height(n)].get(0, below.levels[-1][0])
        root, upper = known[TOP][height(trees)][0], above.steps(place)
        out = []
        for doc_id, idx, leaf, tampered in zip(rows["doc_id"], rows["idx"], rows["digest"], rows["tampered"]):
            steps = [*below.steps(idx), *upper]
            joined = [("".join(left), "".join(right)) for left, right in steps]
            proof = hashlib.sha256("".join([x for step in joined for x in step]).encode()).hexdigest()
            folded = fold(tampered or leaf, joined)
            row = {"doc_id": doc_id, "leaf": leaf, "subroot": subroot, "root": root, "proof_sha256": proof, "folded_root": folded, "verified": folded == root}
            out.append(row | {"proof": [x for left, right in steps for x in (*left, *right)]} if with_proofs else row)
        return pa.Table.from_pylist(out, arrow)

    arrow = _arrow_schema(leaves.sparkSession, schema)
    return leaves.groupBy("tree", "block").cogroup(fetched.groupBy("by", "part")).applyInArrow(expand, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prove(build(table(spark, sf_dir, "documents")))


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}

_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in FIELDS[:-1]) + " || {text})"

SQL = {
    "op13_merkle_manifest": f"""
WITH RECURSIVE
crc_table AS (
  SELECT list(v ORDER BY i) AS t
  FROM (SELECT i, list_reduce([i::UBIGINT] || list_transform(range(8), lambda b: 0::UBIGINT),
                              lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) AS v
        FROM range(256) r(i))
),
rows AS (
  SELECT doc_id, lang, {_LEAF.format(text=_FIELD.format("text"))} AS leaf,
    {_LEAF.format(text=_FIELD.format(f"translate(text, '{UPPER}', '{LOWER}')"))} AS changed,
    xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
                    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::BIGINT + 1])), 4294967295::UBIGINT) AS crc
  FROM documents, crc_table
),
leaves AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce('in:' || lang, 'in') AS tree, leaf, CASE WHEN crc % 3 = 0 THEN changed ELSE leaf END AS tampered,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM rows
),
below(level, tree, idx, n, digest) AS (
  SELECT 0, tree, idx, n, leaf FROM leaves
  UNION ALL
  SELECT level + 1, tree, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM below WHERE n > 1 GROUP BY level, tree, idx // 8, n
),
subroots AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, level AS height FROM below WHERE n = 1
),
above(level, idx, n, digest) AS (
  SELECT 0, idx, n, digest FROM subroots
  UNION ALL
  SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM above WHERE n > 1 GROUP BY level, idx // 8, n
),
-- every node under one number of levels: a language's levels first, those over the subroots after them
nodes AS (
  SELECT b.tree, b.level, b.idx, b.digest FROM below b WHERE b.n > 1
  UNION ALL
  SELECT s.tree, s.height + a.level, a.idx, a.digest FROM subroots s, above a WHERE a.n > 1
),
path(id, tree, level, idx, own) AS (
  SELECT l.id, l.tree, 0, CASE WHEN s.height = 0 THEN s.idx ELSE l.idx END, l.tampered FROM leaves l JOIN subroots s USING (tree)
  UNION ALL
  SELECT p.id, p.tree, p.level + 1, CASE WHEN p.level + 1 = s.height THEN s.idx ELSE p.idx // 8 END,
    sha256(string_agg(CASE WHEN n.idx = p.idx THEN p.own ELSE n.digest END, '' ORDER BY n.idx))
  FROM path p JOIN nodes n ON n.tree = p.tree AND n.level = p.level AND n.idx // 8 = p.idx // 8 JOIN subroots s ON s.tree = p.tree
  GROUP BY p.id, p.tree, p.level, p.idx, s.height, s.idx
),
proofs AS (
  SELECT p.id, string_agg(n.digest, '' ORDER BY n.level, n.idx) AS proof
  FROM path p JOIN nodes n ON n.tree = p.tree AND n.level = p.level AND n.idx // 8 = p.idx // 8 AND n.idx <> p.idx GROUP BY p.id
),
folded AS (SELECT id, arg_max(own, level) AS own FROM path GROUP BY id)
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(coalesce(p.proof, '')) AS proof_sha256,
  f.own AS folded_root, f.own = r.digest AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN folded f USING (id) LEFT JOIN proofs p USING (id) CROSS JOIN (SELECT digest FROM above WHERE n = 1) r
""",
}
