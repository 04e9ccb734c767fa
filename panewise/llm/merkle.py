"""Merkle manifest of a dataset: a root over all rows, and for every row a witness that leads to it.

Every row is a leaf. The leaves of one group (``tree``), in order of their key, make one tree, and
the roots of those trees, in order of the group, make the tree above them. In a tree, while
several nodes remain, every two neighbours become one; a last one without a neighbour is hashed
by itself.

Witnesses are made incrementally, by appending. A task appends the leaves of an aligned block of
``BLOCK`` one by one: the subtrees that are still open keep a partial witness for each of their
leaves, and when a sibling is complete, its digest extends the witnesses on the other side. The
roots of the blocks are appended in the same way, block by block, until each tree is one node, so
no task sees more than ``BLOCK`` nodes and a tree of n rows takes log_BLOCK(n) rounds. A witness
grows by one step of 33 bytes per level.

Rows with equal keys are ordered by their leaf, so a repeated row has a leaf and a witness of its
own. A null key comes first, a null group is a group and comes first, a null field is hashed as
``-``, unlike an empty text. A long text is hashed where it lies; only its digest travels. An
empty table gives no rows. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panewise.llm.tables import stored
from panewise.operators.numbering import with_rank

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10
BLOCK = 1 << LEVELS  # nodes that one call appends

#: Kinds of steps of a witness: no sibling, a sibling on the left, one on the right.
LONE, LEFT, RIGHT = b"\0", b"\1", b"\2"
STEP = 33  # bytes: the kind, then the digest of the sibling (zeros if there is none)


def row_digest(fields: Iterable[Column]) -> Column:
    """The leaf of a row: each field by its byte count and its value, ``-`` if it is null."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


class Appending:
    """A tree that grows by appended nodes, and the witnesses of those nodes so far.

    Digests are hexadecimal text, as they enter a hash.
    """

    def __init__(self) -> None:
        self.steps: list[list[bytes]] = []  # the partial witness of every node
        self.open: list[tuple[int, int, bytes]] = []  # open subtrees: height, first node, digest

    def append(self, digest: bytes) -> None:
        self.steps.append([])
        self._settle(0, len(self.steps) - 1, digest)

    def close(self, height: int = 0) -> bytes:
        """The root, ``height`` levels up or as many as the nodes need."""
        while len(self.open) > 1 or self.open[0][0] < height:
            level, first, digest = self.open.pop()
            self._extend(first, len(self.steps), LONE + bytes(32))
            self._settle(level + 1, first, sha256(digest).hexdigest().encode())
        return self.open[0][2]

    def _extend(self, first: int, end: int, step: bytes) -> None:
        for steps in self.steps[first:end]:
            steps.append(step)

    def _settle(self, height: int, first: int, digest: bytes) -> None:
        """Add a complete subtree, and complete those on its left that waited for it."""
        while self.open and self.open[-1][0] == height:
            _, start, left = self.open.pop()
            self._extend(start, first, RIGHT + bytes.fromhex(digest.decode()))
            self._extend(first, len(self.steps), LEFT + bytes.fromhex(left.decode()))
            height, first, digest = height + 1, start, sha256(left + digest).hexdigest().encode()
        self.open.append((height, first, digest))


def _append_block(levels: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position", ignore_index=True)
        tree = Appending()
        for digest in block["digest"]:
            tree.append(digest.encode())
        several = block["size"].iat[0] > 1 << levels  # blocks: each then ends at the same height
        root = tree.close(levels if several else 0).decode()
        return pd.DataFrame(
            {
                "tree": block["tree"],
                "position": block["position"],
                "size": block["size"],
                "steps": [b"".join(steps) for steps in tree.steps],
                "root": [root, *[None] * (len(block) - 1)],  # once per block
            }
        )

    return run


def witnesses(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(tree, position, steps, root): the witness of each node, and the root of its tree.

    ``nodes`` has (tree, position, size, digest): positions run from 0 to ``size`` - 1 in each
    tree. It is read twice and should be stored.
    """
    most = nodes.agg(F.max("size")).first()[0] or 0
    rounds = []
    while True:
        blocks = nodes.withColumn("block", F.shiftright("position", levels)).groupBy("tree", "block")
        schema = "tree bigint, position bigint, size bigint, steps binary, root string"
        done = stored(blocks.applyInPandas(_append_block(levels), schema), "witnesses")
        rounds.append(done)
        # The roots of blocks are the nodes of the next round.
        nodes = done.where("root is not null").select(
            "tree",
            F.shiftright("position", levels).alias("position"),
            F.shiftright(F.col("size") + ((1 << levels) - 1), levels).alias("size"),
            F.col("root").alias("digest"),
        )
        most = (most + (1 << levels) - 1) >> levels
        if most <= 1:
            break
    # From the top down: what a block's root has to go on with extends all nodes of the block.
    whole = nodes.select("tree", "position", F.lit(b"").alias("steps"), F.col("digest").alias("root"))
    for done in reversed(rounds):
        above = whole.select("tree", F.col("position").alias("_block"), F.col("steps").alias("_further"), "root")
        whole = (
            done.drop("root")
            .withColumn("_block", F.shiftright("position", levels))
            .join(above, ["tree", "_block"])
            .select("tree", "position", F.concat("steps", "_further").alias("steps"), "root")
        )
    return whole


def _steps(steps: Column) -> Column:
    """The steps of a witness as an array of (kind, digest)."""
    count = F.octet_length(steps) / STEP
    at = F.when(count > 0, F.sequence(F.lit(0), count.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        at,
        lambda k: F.struct(
            F.substring(steps, k * STEP + 1, F.lit(1)).alias("kind"),
            F.lower(F.hex(F.substring(steps, k * STEP + 2, F.lit(32)))).alias("digest"),
        ),
    )


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness lead to."""
    return F.aggregate(
        _steps(steps),
        leaf,
        lambda node, step: F.sha2(
            F.when(step["kind"] == F.lit(LEFT), F.concat(step["digest"], node))
            .when(step["kind"] == F.lit(RIGHT), F.concat(node, step["digest"]))
            .otherwise(node),
            256,
        ),
    )


def proof_digest(steps: Column) -> Column:
    """One digest over the siblings of a witness, from the leaf to the root."""
    siblings = F.filter(_steps(steps), lambda step: step["kind"] != F.lit(LONE))
    return F.sha2(F.array_join(F.transform(siblings, lambda step: step["digest"]), ""), 256)


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    tree: str = "lang",
    columns: tuple[str, ...] = COLUMNS,
    changed: dict[str, Column] | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """(key, leaf, changed_leaf, subroot, root, steps): the witness of every row.

    ``changed`` replaces fields by expressions over the row; ``changed_leaf`` is the leaf that
    the row would then have, for a check against the manifest.
    """
    fields = [F.col(name) for name in columns]
    others = [(changed or {}).get(name, F.col(name)) for name in columns]
    leaves = docs.select(
        F.col(tree).alias("name"),
        F.col(key).alias("key"),
        row_digest(fields).alias("leaf"),
        row_digest(others).alias("changed_leaf"),
    )
    order = [F.asc_nulls_first("name"), F.asc_nulls_first("key"), F.asc("leaf"), F.asc("changed_leaf")]
    ranked = stored(with_rank(leaves, order, "rank"), "leaves")
    # The rank of its first leaf numbers a tree, in the order of the groups.
    trees = stored(
        ranked.groupBy("name").agg(F.min("rank").alias("tree"), F.count(F.lit(1)).alias("size")), "trees"
    )
    placed = (
        ranked.alias("r")
        .join(trees.alias("t"), F.col("r.name").eqNullSafe(F.col("t.name")))
        .select("key", "leaf", "changed_leaf", "tree", (F.col("rank") - F.col("tree")).alias("position"), "size")
    )
    placed = stored(placed, "placed")
    own = witnesses(placed.select("tree", "position", "size", F.col("leaf").alias("digest")), levels)
    own = stored(own.withColumnRenamed("root", "subroot"), "own")
    roots = own.where("position = 0").select("tree", "subroot")
    above = stored(with_rank(roots, [F.asc("tree")], "rank"), "subroots")
    count = trees.count()
    top = witnesses(
        above.select(
            F.lit(0).cast("bigint").alias("tree"),
            (F.col("rank") - 1).alias("position"),
            F.lit(count).cast("bigint").alias("size"),
            F.col("subroot").alias("digest"),
        ),
        levels,
    )
    top = top.join(above.withColumn("position", F.col("rank") - 1).drop("subroot", "rank").withColumnRenamed("tree", "own_tree"), "position")
    top = top.select(F.col("own_tree").alias("tree"), F.col("steps").alias("top_steps"), "root")
    return (
        placed.drop("size")
        .join(own, ["tree", "position"])
        .join(top, "tree")
        .select(
            F.col("key").alias(key),
            "leaf",
            "changed_leaf",
            "subroot",
            "root",
            F.concat("steps", "top_steps").alias("steps"),
        )
    )
