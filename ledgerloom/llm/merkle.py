"""Merkle manifest of a dataset: a digest per document, a root, and proofs that fold back to it.

Every document is a leaf. Per source, leaves ascend by doc_id and every
``ARITY`` consecutive nodes become the digest of their concatenation, until one
node, the source's subroot, remains; the subroots, ordered by source, are
reduced likewise to the root.

The trees are cut into superblocks of ``SPAN`` = ``ARITY ** HEIGHT`` consecutive
nodes, so that each is a whole subtree and one small group:

* up: a superblock's nodes are reduced to one node of the next level of
  superblocks, until each source has one, and so on over the sources;
* down: the exchange. A superblock's nodes and the outer nodes that its proofs
  need (the siblings between it and the root) are cogrouped by superblock in
  ``applyInArrow``, which reduces the nodes again, joins each node's inner
  siblings to the outer ones and, at the leaves, folds the proofs.

No group holds more than ``SPAN`` nodes and one path of about
log(documents) siblings, whatever share of the documents a source has; places
within a source are numbered over sorted ranges. Texts are hashed in the JVM
and never shuffled.

Cases: nulls in any column are leaves' ``-``; a null source is a source and
comes first; null ids come first within theirs and are never tampered with;
rows with the same id are ordered by their digests, so equal rows are equal
leaves side by side; an empty text is ``0:``; an empty table has no rows; one
document alone is its own subroot and root, with the digest of nothing as its
proof. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import number_rows

from .common import shared_dir, stored, track

ARITY, HEIGHT = 3, 5
#: Nodes of a superblock.
SPAN = ARITY**HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "lefts array<string>, rights array<string>, subroot string, root string"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column | None = None) -> Column:
    """A document's digest, with another text if one is given."""
    return F.sha2(F.concat(*[_field(text if c == "text" and text is not None else F.col(c)) for c in FIELDS]), 256)


def tampered_leaf() -> Column:
    """The digest after tampering: documents whose crc32(doc_id) is even lose the line feeds of their text."""
    changed = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains(F.col("text"), F.lit("\n"))
    return F.when(changed, leaf(F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf())


def _levels(nodes: list[str], first: bool) -> list[list[str]]:
    """The nodes and the levels above them: up to one node in a tree's first
    superblock, which may be the whole tree, and ``HEIGHT`` levels in the others."""
    out = [nodes]
    while len(out[-1]) > 1 or (not first and len(out) <= HEIGHT):
        below = out[-1]
        out.append([digest("".join(below[i : i + ARITY])) for i in range(0, len(below), ARITY)])
    return out


def _siblings(levels: list[list[str]], k: int) -> tuple[list[str], list[str]]:
    """Per level, the digests left and right of node ``k``'s ancestor in its run."""
    lefts, rights = [], []
    for level in levels[:-1]:
        start = k - k % ARITY
        lefts.append("".join(level[start:k]))
        rights.append("".join(level[k + 1 : start + ARITY]))
        k //= ARITY
    return lefts, rights


def _reduced(key: tuple, nodes: pa.Table) -> pa.Table:
    tree, block = (x.as_py() for x in key)
    top = _levels(nodes.sort_by("pos")["node"].to_pylist(), block == 0)[-1][0]
    return pa.table({"tree": [tree], "pos": pa.array([block], pa.int64()), "node": [top]})


def _paths(nodes: pa.Table, outer: pa.Table, block: int) -> Iterator[tuple[list[str], list[str], str, str]]:
    """Of each node in order: siblings up to the root, subroot and root. Outer
    nodes that don't know the root yet stand at the top, which is the root."""
    levels, above = _levels(nodes["node"].to_pylist(), block == 0), outer.slice(0, 1).to_pylist()[0]
    root = above["root"] or levels[-1][0]
    for k in range(nodes.num_rows):
        lefts, rights = _siblings(levels, k)
        yield [*lefts, *above["lefts"]], [*rights, *above["rights"]], above["subroot"], root


PATHS = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())])


def _passed_on(key: tuple, nodes: pa.Table, outer: pa.Table) -> pa.Table:
    """The outer nodes of the superblocks below: a row for each node of this one."""
    if not nodes.num_rows:  # the top of an empty table
        return PATHS.empty_table()
    nodes = nodes.sort_by("pos")
    lefts, rights, subroots, roots = zip(*_paths(nodes, outer, key[1].as_py()))
    # among the subroots, the node is the subroot; below, it has come from above
    subroots = [above or node for above, node in zip(subroots, nodes["node"].to_pylist())]
    return pa.table([nodes["below"], nodes["below_block"], list(lefts), list(rights), subroots, list(roots)], schema=PATHS)


FOLDED = pa.schema([*((x, pa.string()) for x in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])


def _folded(key: tuple, leaves: pa.Table, outer: pa.Table) -> pa.Table:
    """A row for each leaf: its proof's digest, and what folding the tampered leaf over the proof gives."""
    leaves, proofs, ends, subroots, roots = leaves.sort_by("pos"), [], [], [], []
    for (lefts, rights, subroot, root), node in zip(_paths(leaves, outer, key[1].as_py()), leaves["tampered"].to_pylist()):
        proofs.append(digest("".join(left + right for left, right in zip(lefts, rights))))
        for left, right in zip(lefts, rights):
            node = digest(left + node + right)
        ends.append(node)
        subroots.append(subroot)
        roots.append(root)
    verified = [a == b for a, b in zip(ends, roots)]
    return pa.table([leaves["doc_id"], leaves["node"], subroots, roots, proofs, ends, verified], schema=FOLDED)


def _blocks(level: DataFrame) -> DataFrame:
    return level.withColumn("block", F.expr(f"pos div {SPAN}"))


def _climb(level: DataFrame, name: str) -> list[DataFrame]:
    """The level and those above it, each a row per superblock of the one below, up to one node a tree."""
    out, most = [level], level.agg(F.max("pos")).first()[0]  # one number
    k = 0
    while most is not None and most > 0:
        k, most = k + 1, most // SPAN
        nodes = _blocks(out[-1].select("tree", "pos", "node"))
        out.append(stored(nodes.groupBy("tree", "block").applyInArrow(_reduced, "tree string, pos long, node string"), f"{name}{k}"))
    return out


def _descend(level: DataFrame, outer: DataFrame, below: Column, below_block: Column) -> DataFrame:
    """The outer nodes for the superblocks below ``level``."""
    nodes = _blocks(level.withColumn("below", below).withColumn("below_block", below_block))
    return nodes.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInArrow(_passed_on, f"tree string, block long, {PATH}")


def _numbered(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    folder = track(f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}", "numbered")
    return number_rows(df, groups, order, "place", folder).withColumn("pos", F.col("place") - 1).drop("place")


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every document."""
    # '' for no source sorts before any other, which all begin with '+'
    tree = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), F.col("source")))
    # written first: numbering samples its input before it deals it, and texts are read once
    leaves = stored(docs.select(tree.alias("tree"), F.col("doc_id"), leaf().alias("node"), tampered_leaf().alias("tampered")), "leaves")
    leaves = _numbered(leaves, ["tree"], ["doc_id", "node"]).withColumn("doc_id", F.col("doc_id").cast("string"))
    sources = _climb(leaves, "nodes")
    subroots = sources[-1].select(F.col("tree").alias("below"), "node")
    subroots = _numbered(subroots, [], ["below"]).withColumn("tree", F.lit(""))
    tops = _climb(subroots, "tops")
    # above the top superblock there is nothing
    outer = docs.sparkSession.createDataFrame([("", 0, [], [], None, None)], f"tree string, block long, {PATH}")
    for level in reversed(tops[1:-1]):
        outer = _descend(level, outer, F.col("tree"), F.col("pos")).withColumn("subroot", F.lit(None).cast("string"))
    outer = stored(_descend(tops[0], outer, F.col("below"), F.lit(0).cast("long")), "outer")
    for level in reversed(sources[1:-1]):
        outer = stored(_descend(level, outer, F.col("tree"), F.col("pos")), "outer")
    schema = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    out = _blocks(leaves).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInArrow(_folded, schema)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
