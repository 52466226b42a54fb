"""A Merkle manifest of a table: a tree of digests per group, and one over the groups' roots.

A row's leaf is the SHA-256 of its fields. In a group, leaves are ordered by key; while several
nodes remain, each two consecutive ones (the last may stand alone) become the SHA-256 of their hex
digests. The groups' roots, in the order of the groups, become the root in the same way.

Storage is a van Emde Boas layout in two scales. A tree is cut in aligned subtrees of ``height``
levels, which are the stored blocks; the roots of a tier of blocks are the leaves of the next tier,
until one block is left. Inside a block the nodes lie in van Emde Boas order: the upper half of the
levels first, then the subtrees below it, each laid out likewise. ``address`` gives a node's
place from its depth and index; blocks are built, and siblings looked up, by that arithmetic alone.

A block is built by one task from its own leaves, so a group with a third of all rows is many
blocks. Proofs go down from the last tier: every block learns the siblings above its root by a join
on its number, and a first-tier block then gives the proofs of its rows.

Cases: null fields are written as ``-``, and a null key comes first, as does a null group. Rows with
equal keys are ordered by their leaves; equal leaves may swap places, which changes nothing but
which of the equal rows has which proof. A table with one row has its leaf as subroot and root and
an empty proof. An empty table gives no rows. Texts are hashed whole. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored
from ledgerline.operators.keys import dense_key

HEIGHT = 11  # levels of nodes below a block's root: 2,048 leaves
DIGEST = 32
RIGHT, LEFT, NONE = 0, 1, 2  # where the sibling of a step stands
STEP = DIGEST + 1


def address(depth: int, index: np.ndarray, levels: int) -> np.ndarray:
    """Places, in van Emde Boas order, of nodes of a full binary tree of ``levels`` levels.

    ``index`` counts the nodes of one ``depth`` from the left; the root has depth 0.
    """
    index = np.asarray(index, "int64")
    place = np.zeros(len(index), "int64")
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        levels -= upper
        depth -= upper
        place += (1 << upper) - 1 + (index >> depth) * ((1 << levels) - 1)
        index = index & ((1 << depth) - 1)
    return place


def digest(*parts: bytes) -> bytes:
    """SHA-256 of digests as hex text, end to end."""
    return hashlib.sha256(b"".join([p.hex().encode() for p in parts])).digest()


def built(leaves: list[bytes], height: int) -> bytes:
    """The nodes over ``leaves``, up to a root ``height`` levels above them, in van Emde Boas order.

    Places to the right of the last node of a level stay zero.
    """
    nodes = bytearray(((2 << height) - 1) * DIGEST)
    level = leaves
    for depth in range(height, -1, -1):
        for place, node in zip(address(depth, np.arange(len(level)), height + 1).tolist(), level):
            nodes[place * DIGEST : (place + 1) * DIGEST] = node
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return bytes(nodes)


def node(nodes: bytes, place: int) -> bytes:
    return nodes[place * DIGEST : (place + 1) * DIGEST]


def block_paths(nodes: bytes, count: int, height: int) -> list[bytes]:
    """For each of a block's leaves, the steps up to the block's root: side and digest of siblings."""
    steps = []
    for depth in range(height, 0, -1):
        at = np.arange(count) >> (height - depth)
        size = -(-count // (1 << (height - depth)))
        places = address(depth, np.minimum(at ^ 1, size - 1), height + 1).tolist()
        steps.append([
            bytes([NONE]) + bytes(DIGEST) if i ^ 1 >= size else bytes([LEFT if i & 1 else RIGHT]) + node(nodes, p)
            for i, p in zip(at.tolist(), places)
        ])
    return [b"".join(s) for s in zip(*steps)] if steps else [b""] * count


def siblings(path: bytes) -> bytes:
    """The digests of a path as hex text, without the steps that have none."""
    return b"".join([path[i + 1 : i + STEP].hex().encode() for i in range(0, len(path), STEP) if path[i] != NONE])


def folded(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and the siblings of a path lead to."""
    for i in range(0, len(path), STEP):
        side, other = path[i], path[i + 1 : i + STEP]
        leaf = digest(leaf) if side == NONE else digest(other, leaf) if side == LEFT else digest(leaf, other)
    return leaf


BLOCK = "tree long, block long, levels int, count int, height int, root binary, nodes binary, keys array<{key}>, claims array<binary>"


def tier_blocks(leaves: DataFrame, key_type: str, height: int, name: str) -> DataFrame:
    """Blocks over leaves (tree, levels, place, hash, key, claim), stored.

    ``levels`` says how many levels the tree has above these leaves. Keys and claimed leaves of the
    rows stay with their block, a claim only where it differs from the leaf.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        order = np.argsort(table.column("place").to_numpy(), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        tree, block, levels = (table.column(c)[0].as_py() for c in ("tree", "block", "levels"))
        own, hashes = min(levels, height), table.column("hash").to_pylist()
        nodes = built(hashes, own)
        lists = [pa.ListArray.from_arrays(pa.array([0, table.num_rows], pa.int32()), table.column(c).chunk(0)) for c in ("key", "claim")]
        numbers = [pa.array([n], t) for n, t in ((tree, pa.int64()), (block, pa.int64()), (levels, pa.int32()), (len(hashes), pa.int32()), (own, pa.int32()))]
        row = [*numbers, pa.array([node(nodes, 0)], pa.binary()), pa.array([nodes], pa.binary()), *lists]
        return pa.table(row, ["tree", "block", "levels", "count", "height", "root", "nodes", "keys", "claims"])

    grouped = leaves.withColumn("block", F.shiftright("place", height)).groupBy("tree", "block")
    return stored(grouped.applyInArrow(run, BLOCK.format(key=key_type)), name)


def tiers(leaves: DataFrame, key_type: str, most_levels: int, height: int, name: str) -> list[DataFrame]:
    """All tiers of blocks of all trees, the lowest first. ``most_levels`` is the highest tree's."""
    found = [tier_blocks(leaves, key_type, height, f"{name}-0")]
    for t in range(1, -(-most_levels // height)):
        below = found[-1].filter(F.col("levels") > height)
        up = below.select(
            "tree", (F.col("levels") - height).alias("levels"), F.col("block").alias("place"), F.col("root").alias("hash"),
            F.lit(None).cast(key_type).alias("key"), F.lit(None).cast("binary").alias("claim"),
        )
        found.append(tier_blocks(up, key_type, height, f"{name}-{t}"))
    return found


def with_paths(found: list[DataFrame], above: DataFrame, height: int, name: str) -> list[DataFrame]:
    """The tiers, the lowest first, with the steps from every block's root to the last root.

    ``above`` has the steps (tree, path) over each tree's root, and ``over``, what they lead to.
    ``peak`` is the root of the block's own tree.
    """
    out, paths = [], None
    tops = above.select(F.col("tree").alias("_tree"), "path", "over")
    for t in range(len(found) - 1, -1, -1):
        own = found[t]
        last = own.filter(F.col("levels") <= height).withColumn("peak", F.col("root"))
        last = last.join(tops, F.col("tree") == F.col("_tree")).drop("_tree")
        if paths is not None:
            inner = own.filter(F.col("levels") > height)
            inner = inner.join(paths, (F.col("tree") == F.col("_tree")) & (F.col("block") == F.col("_place")))
            last = last.unionByName(inner.drop("_tree", "_place"))
        out.append(stored(last, f"{name}-paths-{t}"))
        paths = leaf_paths(out[-1])
    return out[::-1]


def _by_block(batches: Iterable[pa.RecordBatch], row: Callable[[dict], Iterator[tuple]], kind: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in range(batch.num_rows):
            found = list(row(batch.slice(block, 1).to_pylist()[0]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), kind)], schema=kind)


def leaf_paths(blocks: DataFrame) -> DataFrame:
    """(_tree, _place, path, peak, over): the steps from every leaf of a tier to the last root."""
    names = [("_tree", pa.int64()), ("_place", pa.int64()), ("path", pa.binary()), ("peak", pa.binary()), ("over", pa.binary())]
    kind = pa.schema(names)

    def paths(block: dict) -> Iterator[tuple]:
        first = block["block"] << block["height"]  # a block with a number over zero is of full height
        for i, path in enumerate(block_paths(block["nodes"], block["count"], block["height"])):
            yield block["tree"], first + i, path + block["path"], block["peak"], block["over"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_block(batches, paths, kind)

    shown = blocks.select("tree", "block", "count", "height", "nodes", "path", "peak", "over")
    return shown.mapInArrow(run, "_tree long, _place long, path binary, peak binary, over binary")


def levels_over(n: Column) -> Column:
    """Levels of a tree above n leaves."""
    return F.when(n <= 1, 0).otherwise(F.length(F.bin(n - 1))).cast("int")


def field_text(column: str) -> Column:
    """A value with its length in UTF-8 bytes before it, ``-`` for a null."""
    text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(fields: Iterable[str], changed: dict[str, Column] | None = None) -> Column:
    """The leaf of a row's fields as hex, some of them replaced."""
    texts = []
    for name in fields:
        text = field_text(name)
        if changed and name in changed:
            new = changed[name].cast("string")
            text = F.coalesce(F.concat(F.octet_length(new).cast("string"), F.lit(":"), new), F.lit("-"))
        texts.append(text)
    return F.sha2(F.concat(*texts).cast("binary"), 256)


def manifest(
    docs: DataFrame, fields: Iterable[str], *, key: str = "doc_id", group: str = "lang",
    claimed: dict[str, Column] | None = None, height: int = HEIGHT,
) -> DataFrame:
    """The Merkle trees of a table, and a check of claimed rows against their proofs.

    ``claimed`` replaces fields by what somebody says they are; a row's folded_root comes from its
    claimed leaf and its recorded siblings. Returns key, leaf, subroot, root, proof_sha256 (of the
    siblings from leaf to root), folded_root, and verified (folded_root is the root); hex digests.
    """
    fields = list(fields)
    key_type = docs.schema[key].dataType.simpleString()
    leaf, claim = leaf_of(fields), leaf_of(fields, claimed)
    rows = docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("grp"), F.unhex(leaf).alias("hash"), F.unhex(claim).alias("_claim"))
    rows = rows.select("key", "grp", "hash", F.when(F.col("_claim") != F.col("hash"), F.col("_claim")).alias("claim"))
    numbered = dense_key(rows, ["grp", "key", "hash"], "_n")
    groups = stored(numbered.groupBy("grp").agg(F.min("_n").alias("_first"), F.count("*").alias("n")), "merkle-groups")
    trees = stored(dense_key(groups, ["grp"], "_t", bare=True).select("grp", (F.col("_t") - 1).alias("tree"), "_first", levels_over(F.col("n")).alias("levels")), "merkle-trees")
    n_trees, most = trees.agg(F.count("*"), F.coalesce(F.max("levels"), F.lit(0))).first()
    # Spark's size check decides on a broadcast of the groups; otherwise a hot group's rows are split.
    joined = numbered.alias("r").join(trees.alias("t"), F.col("r.grp").eqNullSafe(F.col("t.grp")))
    leaves = joined.select("tree", "levels", (F.col("_n") - F.col("_first")).alias("place"), "hash", "key", "claim")
    lower = tiers(leaves, key_type, most, height, "merkle")

    subroots = None
    for tier in lower:
        own = tier.filter(F.col("levels") <= height).select("tree", "root")
        subroots = own if subroots is None else subroots.unionByName(own)
    upper_levels = max(n_trees - 1, 0).bit_length()
    tops = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(upper_levels).alias("levels"), F.col("tree").alias("place"), F.col("root").alias("hash"),
        F.col("tree").alias("key"), F.lit(None).cast("binary").alias("claim"),
    )
    upper = tiers(tops, "bigint", upper_levels, height, "merkle-top")
    alone = docs.sparkSession.range(1).select(F.col("id").alias("tree"), F.lit(b"").alias("path"), F.lit(b"").alias("over"))
    above = leaf_paths(with_paths(upper, alone, height, "merkle-top")[0]).select(F.col("_place").alias("tree"), "path", F.col("peak").alias("over"))
    blocks = with_paths(lower, stored(above, "merkle-above"), height, "merkle")[0]

    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    kind = pa.schema([("key", _arrow(key_type))] + [(n, pa.string()) for n in names] + [("verified", pa.bool_())])

    def prove(block: dict) -> Iterator[tuple]:
        nodes, count, height, root = block["nodes"], block["count"], block["height"], block["over"]
        at = address(height, np.arange(count), height + 1).tolist()
        for place, key, claim, path in zip(at, block["keys"], block["claims"], block_paths(nodes, count, height)):
            leaf, path = node(nodes, place), path + block["path"]
            found = folded(leaf if claim is None else claim, path)
            proof = hashlib.sha256(siblings(path)).hexdigest()
            yield key, leaf.hex(), block["peak"].hex(), root.hex(), proof, found.hex(), found == root

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _by_block(batches, prove, kind)

    shown = blocks.select("keys", "claims", "count", "height", "nodes", "path", "peak", "over")
    schema = f"key {key_type}, {', '.join(f'{n} string' for n in names)}, verified boolean"
    return shown.mapInArrow(run, schema).withColumnRenamed("key", key)


def _arrow(key_type: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[key_type]
