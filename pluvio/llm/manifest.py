"""A Merkle manifest of a dataset: one tree for each value of a column, and a tree over their roots.

A fragment is a sparse forest: nodes keyed by tree, level and index whose sibling run is not complete in it. Fragments form a monoid: their union,
with every run that is now complete, and whose arity is known from the tree's size, replaced by its parent. It does not matter how leaves
are dealt to fragments nor in which order these are merged. Blocks of ``fanout ** depth`` consecutive leaves are dealt to tasks as a whole, so that a task's
fragment is one node a block, and ``treeReduce`` merges the fragments; ``depth`` grows with the rows, so that the nodes above the blocks stay few.
They go back to the tasks, which build their blocks once more and give every leaf its proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..workers import portable
from .common import buckets_for, mapped, materialize, partitions

FANOUT = 8
#: Blocks that the trees are cut into at most, besides one a tree; their nodes and those above go to the driver and to the tasks.
BLOCKS, DEPTH = 1 << 16, 3
OVER = ""  # the tree over the roots; the others' names begin with a sign

Key = tuple[str, int, int]


def join_hash(parts: list[bytes]) -> bytes:
    """Of hexadecimal digests, or any bytes, strung together."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf_hash(*columns: Column) -> Column:
    """The digest of a row's values: ``-`` for null, else the length in UTF-8 bytes, a colon and the value."""
    parts = []
    for c in columns:
        value = c.cast("string")
        parts.append(F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


def tree_name(value: Column) -> Column:
    """Names that sort as values do, null first."""
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), value.cast("string")))


@dataclass
class Fragment:
    """open: nodes whose run is not complete. closed: the nodes from a level on whose run is."""

    open: dict[Key, bytes] = field(default_factory=dict)
    closed: dict[Key, bytes] = field(default_factory=dict)


class Forest:
    """The trees' sizes, from which every run's arity follows, and the merging of fragments."""

    def __init__(self, sizes: dict[str, int], keep: int = 0, fanout: int = FANOUT) -> None:
        self.sizes, self.keep, self.fanout = sizes, keep, fanout

    def width(self, tree: str, level: int) -> int:
        return -(-self.sizes[tree] // self.fanout**level)

    def run(self, key: Key) -> list[Key]:
        """A node and its siblings; the node alone at the top."""
        tree, level, index = key
        first = index - index % self.fanout
        return [(tree, level, k) for k in range(first, min(first + self.fanout, self.width(tree, level)))]

    def merge(self, a: Fragment, b: Fragment) -> Fragment:
        """Neither is changed; the order does not matter. A run that the union completes has a node of either, so the lesser's are looked at."""
        return self._settled(Fragment(a.open | b.open, a.closed | b.closed), list(a.open if len(a.open) < len(b.open) else b.open))

    def of(self, nodes: dict[Key, bytes]) -> Fragment:
        """The fragment of some nodes, merged as far as they go."""
        return self._settled(Fragment(dict(nodes)), list(nodes))

    def _settled(self, out: Fragment, todo: list[Key]) -> Fragment:
        while todo:
            key = todo.pop()
            tree, level, index = key
            if key not in out.open or self.width(tree, level) == 1:
                continue
            run = self.run(key)
            if not all(k in out.open for k in run):
                continue
            digests = [out.open.pop(k) for k in run]
            if level >= self.keep:
                out.closed.update(zip(run, digests))
            parent = (tree, level + 1, index // self.fanout)
            out.open[parent] = join_hash(digests)
            todo.append(parent)
        return out

    def above(self, key: Key, nodes: dict[Key, bytes]) -> list[tuple[bytes, bytes]]:
        """For each level from a node up to its tree's top: its siblings before and after it, strung together."""
        out = []
        while self.width(key[0], key[1]) > 1:
            run = self.run(key)
            at = run.index(key)
            out.append((b"".join(nodes[k] for k in run[:at]), b"".join(nodes[k] for k in run[at + 1 :])))
            key = (key[0], key[1] + 1, key[2] // self.fanout)
        return out


@dataclass
class Manifest:
    """sizes of the trees, their roots, the root over these, and the nodes from level ``depth`` on whose siblings proofs need."""

    sizes: dict[str, int]
    depth: int
    roots: dict[str, bytes]
    root: bytes
    nodes: dict[Key, bytes]
    fanout: int = FANOUT

    def proof(self, tree: str, block: int) -> list[tuple[bytes, bytes]]:
        """The siblings from a block's node up to its tree's root and from there to the root over all."""
        forest = Forest(self.sizes | {OVER: len(self.roots)}, self.depth, self.fanout)
        own = forest.above((tree, self.depth, block), self.nodes) if self.sizes[tree] > self.fanout**self.depth else []
        return own + forest.above((OVER, 0, sorted(self.roots).index(tree)), self.nodes)


def place(leaves: DataFrame, ranges: int | None = None) -> DataFrame:
    """``leaves`` (tree, doc_id, leaf and more) with ``position``, from 0 on in each tree by doc_id (nulls first), then leaf, then the rest.

    Rows are cut into ranges by tree and order, the ranges are written, so that they stay as they are, and counted; then each range of a tree is
    numbered by itself. Equal rows are interchangeable and lie in one range."""
    order = ["doc_id", "leaf", *sorted(set(leaves.columns) - {"tree", "doc_id", "leaf"})]
    n = ranges or buckets_for(leaves, partitions(leaves.sparkSession), 1 << 30, 1 << 20)
    cut = materialize(leaves.repartitionByRange(n, "tree", *order).withColumn("range", F.spark_partition_id()), "leaves")
    sizes = cut.groupBy("tree", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("tree").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("tree", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))  # a row a range and one a tree at most
    number = F.row_number().over(Window.partitionBy("tree", "range").orderBy(*[F.col(c).asc_nulls_first() for c in order]))
    return cut.join(F.broadcast(starts), ["tree", "range"]).withColumn("position", F.col("start") + number - 1).drop("range", "start")


def tree_sizes(leaves: DataFrame) -> dict[str, int]:
    """Leaves of each tree: a row a tree reaches the driver."""
    return {r[0]: r[1] for r in leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}


def block_depth(sizes: dict[str, int], blocks: int = BLOCKS, fanout: int = FANOUT) -> int:
    """The least depth, from ``DEPTH`` on, at which there are so many blocks besides one a tree at most."""
    depth = DEPTH
    while sum(n // fanout**depth for n in sizes.values()) > blocks:
        depth += 1
    return depth


def _dealt(placed: DataFrame, rows: int, depth: int, fanout: int, *columns: str) -> DataFrame:
    n = max(partitions(placed.sparkSession), rows >> 20)
    block = F.floor(F.col("position") / fanout**depth).cast("long").alias("block")
    return placed.select("tree", block, "position", *columns).repartition(n, "tree", "block").sortWithinPartitions("tree", "position")


def _blocks(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Table]]:
    """The blocks of a partition that is sorted by them, whatever its batches."""
    held: list[pa.RecordBatch] = []

    def done() -> tuple[str, int, pa.Table]:
        table = pa.Table.from_batches(held)
        return table.column("tree")[0].as_py(), table.column("block")[0].as_py(), table

    for batch in it:
        if not batch.num_rows:
            continue
        tree = batch.column(0).dictionary_encode().indices.to_numpy()
        block = batch.column(1).to_numpy()
        cuts = [0, *(np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            if held and (held[0].column(0)[0] != part.column(0)[0] or held[0].column(1)[0] != part.column(1)[0]):
                yield done()
                held = []
            held.append(part)
    if held:
        yield done()


def _levels(leaves: list[bytes], most: int, fanout: int) -> list[list[bytes]]:
    """A block's nodes, level by level, up to ``most`` levels above the leaves."""
    out = [leaves]
    while len(out) <= most and len(out[-1]) > 1:
        last = out[-1]
        out.append([join_hash(last[k : k + fanout]) for k in range(0, len(last), fanout)])
    return out


def _block_leaves(tree: str, block: int, table: pa.Table, sizes: dict[str, int], depth: int, fanout: int) -> list[list[bytes]]:
    """The block's levels up to its node; missing or repeated leaves are an error."""
    first = block * fanout**depth
    want = min(fanout**depth, sizes[tree] - first)
    at = table.column("position").to_numpy()
    if len(at) != want or at[0] != first or at[-1] != first + want - 1:
        raise ValueError(f"block {block} of {tree!r} has {len(at)} leaves where {want} are due")
    levels = _levels([x.encode() for x in table.column("leaf").to_pylist()], depth, fanout)
    whole = sizes[tree] > fanout**depth
    while whole and len(levels) <= depth:  # the last block may be short: a run of one is hashed as well
        levels.append([join_hash(levels[-1])])
    return levels


def build(placed: DataFrame, sizes: dict[str, int] | None = None, depth: int | None = None, fanout: int = FANOUT) -> Manifest:
    """The manifest of leaves that have ``tree``, ``position`` and ``leaf``. Without any the root is that of nothing."""
    sizes = tree_sizes(placed) if sizes is None else sizes
    depth = block_depth(sizes, fanout=fanout) if depth is None else depth
    if not sizes:
        return Manifest({}, depth, {}, join_hash([]), {}, fanout)
    forest = Forest(sizes, depth, fanout)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, digests = [], []
        for tree, block, table in _blocks(it):
            levels = _block_leaves(tree, block, table, sizes, depth, fanout)
            keys.append((tree, len(levels) - 1, block))
            digests.append(levels[-1][0])
        merged = forest.of(dict(zip(keys, digests)))
        nodes = [(*k, d, is_open) for is_open, held in ((True, merged.open), (False, merged.closed)) for k, d in held.items()]
        yield pa.RecordBatch.from_arrays([pa.array([[dict(zip(("tree", "level", "index", "digest", "open"), x)) for x in nodes]], pa.list_(pa.struct([("tree", pa.string()), ("level", pa.int32()), ("index", pa.int64()), ("digest", pa.binary()), ("open", pa.bool_())])))], names=["nodes"])

    fragments = _dealt(placed, sum(sizes.values()), depth, fanout, "leaf").transform(mapped, run, "nodes array<struct<tree: string, level: int, index: long, digest: binary, open: boolean>>")

    def of_row(row) -> Fragment:
        open_, closed = ({(x["tree"], x["level"], x["index"]): bytes(x["digest"]) for x in row.nodes if x["open"] == want} for want in (True, False))
        return Fragment(open_, closed)

    whole = fragments.rdd.map(portable(of_row)).treeReduce(portable(forest.merge))
    roots = {tree: digest for (tree, _, _), digest in whole.open.items()}
    if sorted(roots) != sorted(sizes) or len(whole.open) != len(sizes):
        raise ValueError("some runs have not been completed: leaves are missing")
    over = Forest({OVER: len(roots)}, 0, fanout)
    top = over.of({(OVER, 0, i): roots[tree] for i, tree in enumerate(sorted(roots))})
    (root,) = top.open.values()
    return Manifest(sizes, depth, roots, root, whole.closed | top.closed, fanout)


def prove(placed: DataFrame, manifest: Manifest, claimed: str = "leaf") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every leaf.

    proof_sha256 is that of all siblings on the leaf's way to the root, level by level, left to right; folded_root comes from the column
    ``claimed`` and these siblings. The manifest's upper nodes, a bounded number, go to every task."""
    m = manifest
    sent = placed.sparkSession.sparkContext.broadcast(m)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for tree, block, table in _blocks(it):
            levels = _block_leaves(tree, block, table, m.sizes, m.depth, m.fanout)
            outside = m.proof(tree, block)
            ids, told = table.column("doc_id").to_pylist(), table.column("claimed").to_pylist()
            cols: list[list] = [[] for _ in range(3)]
            for first in range(0, len(levels[0]), m.fanout):
                inside, at = [], first // m.fanout
                for level in levels[1:-1]:
                    a = at - at % m.fanout
                    inside.append((b"".join(level[a:at]), b"".join(level[at + 1 : a + m.fanout])))
                    at //= m.fanout
                way = inside + outside
                rest = b"".join(x for pair in way for x in pair)
                run_ = levels[0][first : first + m.fanout] if len(levels) > 1 else levels[0]
                for k in range(len(run_)):
                    before, after = b"".join(run_[:k]), b"".join(run_[k + 1 :])
                    digest = told[first + k].encode()
                    if len(levels) > 1:
                        digest = join_hash([before, digest, after])
                    for left, right in way:
                        digest = join_hash([left, digest, right])
                    cols[0].append(hashlib.sha256(before + after + rest).hexdigest())
                    cols[1].append(digest.decode())
                    cols[2].append(digest == m.root)
            n, root, subroot = len(ids), m.root.decode(), m.roots[tree].decode()
            rows = [ids, table.column("leaf").to_pylist(), [subroot] * n, [root] * n, *cols]
            for a in range(0, n, 1 << 15):
                yield pa.RecordBatch.from_arrays([pa.array(c[a : a + (1 << 15)], t) for c, t in zip(rows, kinds)], names=names)

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _dealt(placed, sum(m.sizes.values()), m.depth, m.fanout, F.col("doc_id").cast("long").alias("doc_id"), "leaf", F.col(claimed).alias("claimed")).transform(mapped, run, schema)


def tampered(docs: DataFrame, condition: Column) -> DataFrame:
    """tree, doc_id, leaf and ``claimed``: the leaf of the row whose text has been lower-cased (A-Z) where the condition holds, else the same."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    fixed = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.when(F.coalesce(condition, F.lit(False)), F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    return docs.select(tree_name(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(*fixed, F.col("text")).alias("leaf"), leaf_hash(*fixed, lower).alias("claimed"))


def audit_documents(docs: DataFrame) -> DataFrame:
    """``prove`` over whole documents: trees by lang, tampered where three divides the CRC-32 of the decimal doc_id.

    Null ids come first in their tree, null langs' tree first; equal ids are in order of their leaves; an empty table gives an empty result. Languages are
    taken to be few: a row for each reaches the driver."""
    leaves = tampered(docs.select("doc_id", "source", "lang", "n_chars", "text"), F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0)
    placed = place(leaves)
    return prove(placed, build(placed), "claimed")
