"""A Merkle manifest of a dataset, with a witness for every row.

Each row has a leaf, a digest of its fields. Per group, leaves in order make a tree: every two
consecutive nodes become the digest of the two, a last one left over the digest of itself,
until one remains, the group's subroot; the subroots in order of their groups make the tree
above, likewise. A row's witness holds what stood beside it on every level up to the root.

Witnesses are made incrementally. Nodes are appended from left to right; the open subtrees of
complete pairs are kept, and every node has the partial witness up to its open subtree. When a
sibling is complete, two subtrees become one, and the witnesses below extend by a digest.
What is appended is aligned: a group's leaves are numbered and cut into blocks of 2**HEIGHT,
so that each block is a subtree, made by one task. The roots of the blocks are further appends
to the tree above them, in blocks again, until a group has one root left. Each level has a
2**HEIGHTth of the nodes of the one below.

Rows are numbered by a range partitioning and one count per partition and group, so that a
group with most of the rows is dealt to many tasks. Only digests and order columns are moved,
never texts; no row reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from userflow.llm.tables import stored

HEIGHT = 12  # of a block: a task holds 2**12 nodes at once, with their witnesses

# The first byte of a witness's step: the sibling stands left or right, or there is none.
LEFT, RIGHT, NONE = b"L", b"R", b"N"


def field(value: Column) -> Column:
    """A field as it enters a digest: - for null, else its UTF-8 bytes' number, :, and it."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields, lower-case hex."""
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def joined(*digests: bytes) -> bytes:
    """The digest of nodes, whose digests enter as hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


class Frontier:
    """Open subtrees of an append-only tree, and the witnesses of all nodes up to them."""

    def __init__(self) -> None:
        self.open: list[tuple[int, bytes, int, int]] = []  # height, digest, first node, past the last
        self.witnesses: list[list[bytes]] = []

    def append(self, digest: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self.open.append((0, digest, at, at + 1))
        while self._complete():
            self._join()

    def _complete(self) -> bool:
        return len(self.open) > 1 and self.open[-1][0] == self.open[-2][0]

    def _join(self) -> None:
        height, right, middle, past = self.open.pop()
        _, left, first, _ = self.open.pop()
        for i in range(first, middle):
            self.witnesses[i].append(RIGHT + right)
        for i in range(middle, past):
            self.witnesses[i].append(LEFT + left)
        self.open.append((height + 1, joined(left, right), first, past))

    def close(self, height: int) -> bytes:
        """The root of one subtree of the height, with no more nodes to come."""
        while len(self.open) > 1 or self.open[0][0] < height:
            if self._complete():
                self._join()
                continue
            own, digest, first, past = self.open.pop()
            for i in range(first, past):
                self.witnesses[i].append(NONE)
            self.open.append((own + 1, joined(digest), first, past))
        return self.open[0][1]


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Written ``rows`` with __position (from 0, by ``order`` within ``group``) and __n (rows
    of the group). Rows alike in all of them are numbered in any order."""
    ranged = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    laid = stored(ranged.withColumn("__at", F.monotonically_increasing_id()), "merkle-ordered")
    part = F.shiftright("__at", 33)
    runs = laid.groupBy(group, part.alias("__part")).agg(F.count("*").alias("__held"), F.min("__at").alias("__first"))
    own = Window.partitionBy(group)
    before = F.sum("__held").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select(
        F.col(group).alias("__in"), "__part", (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"), F.sum("__held").over(own).alias("__n")
    )
    starts = stored(starts, "merkle-starts")  # a row per partition and group: Spark's size check may broadcast it
    same = F.col(group).eqNullSafe(F.col("__in")) & (part == F.col("__part"))
    return laid.join(starts, same).withColumn("__position", F.col("__at") + F.col("__shift")).drop("__at", "__in", "__part", "__shift")


def _block(height: int):
    """One block's nodes with their witnesses and the block's root."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("__position")
        frontier = Frontier()
        for digest in table["__node"].to_pylist():
            frontier.append(digest)
        n = table["__n"][0].as_py()
        root = frontier.close(min(height, (n - 1).bit_length()))
        table = table.append_column("__path", pa.array(frontier.witnesses, pa.list_(pa.binary())))
        return table.append_column("__top", pa.array([root] * len(table), pa.binary()))

    return run


def _level(nodes: DataFrame, group: str, height: int) -> DataFrame:
    """``nodes`` (__node, __position, __n, and others) with __block, __path, the steps up to
    the block's root, and __top, that root."""
    blocked = nodes.withColumn("__block", F.shiftright("__position", height))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in blocked.schema]
    schema = ", ".join([*kinds, "`__path` array<binary>", "`__top` binary"])
    return stored(blocked.groupBy(group, "__block").applyInArrow(_block(height), schema), "merkle-level")


def _above(level: DataFrame, group: str, height: int) -> DataFrame:
    """Per block of a written level: __of (its group), __block, __up (steps from its root to
    the group's) and __root (the group's)."""
    blocks = level.where(F.col("__position") % (1 << height) == 0).select(
        F.col(group).alias("__of"), "__block", F.col("__top").alias("__node"), F.shiftright(F.col("__n") + ((1 << height) - 1), height).alias("__n")
    )
    alone = blocks.where("__n = 1").select("__of", "__block", F.array().cast("array<binary>").alias("__up"), F.col("__node").alias("__root"))
    more = blocks.where("__n > 1").withColumn("__position", F.col("__block"))
    if more.isEmpty():
        return alone
    next_level = _level(more.drop("__block").withColumnRenamed("__of", "__group"), "__group", height)
    above = _above(next_level, "__group", height).withColumnRenamed("__block", "__above")
    same = F.col("__group").eqNullSafe(F.col("__of")) & (F.col("__block") == F.col("__above"))
    rest = next_level.select("__group", "__position", "__path", "__block").join(above, same)
    rest = rest.select("__of", F.col("__position").alias("__block"), F.concat("__path", "__up").alias("__up"), "__root")
    return alone.union(rest)


def witnessed(rows: DataFrame, node: str, group: str, order: Sequence[str], height: int = HEIGHT) -> DataFrame:
    """``rows`` with path (steps of the witness from the row's node to the root, each a side
    byte and the sibling's digest), subroot and root, all binary.

    ``node`` is a binary digest. Groups are in order, null first; strings by their UTF-8
    bytes. Rows are by ``order``, null first. Rows alike in ``order`` should differ in nothing
    but what the tree may not tell apart. An empty table gives no rows.
    """
    with_node = rows.withColumn("__node", F.col(node))
    level = _level(numbered(with_node, group, order), group, height)
    blocks = stored(_above(level, group, height), "merkle-blocks")
    # The subroots are the leaves of the tree over the groups.
    tops = blocks.where("__block = 0").select(F.lit(0).alias("__all"), F.col("__of").alias("__group"), F.col("__root").alias("__node"))
    top_level = _level(numbered(tops, "__all", ["__group"]), "__all", height)
    top = _above(top_level, "__all", height).select(F.col("__block").alias("__above"), F.col("__up").alias("__last"), F.col("__root").alias("__whole"))
    groups = top_level.join(top, F.col("__block") == F.col("__above")).select("__group", F.concat("__path", "__last").alias("__over"), "__whole")
    full = blocks.join(groups, F.col("__of").eqNullSafe(F.col("__group"))).select(
        "__of", F.col("__block").alias("__own"), F.concat("__up", "__over").alias("__rest"), "__root", "__whole"
    )
    full = stored(full, "merkle-paths")
    same = F.col(group).eqNullSafe(F.col("__of")) & (F.col("__block") == F.col("__own"))
    return level.join(full, same).select(
        *[F.col(f"`{c}`") for c in rows.columns], F.concat("__path", "__rest").alias("path"), F.col("__root").alias("subroot"), F.col("__whole").alias("root")
    )


def _text(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _side(step: Column) -> Column:
    return F.substring(step, 1, 1)


def _sibling(step: Column) -> Column:
    return _text(F.substring(step, 2, 32))


def folded(node: Column, path: Column) -> Column:
    """The root that a node (hex) and its witness give, hex."""

    def up(digest: Column, step: Column) -> Column:
        other = _sibling(step)
        left, right = _side(step) == F.lit(LEFT), _side(step) == F.lit(RIGHT)
        return F.sha2(F.when(left, F.concat(other, digest)).when(right, F.concat(digest, other)).otherwise(digest), 256)

    return F.aggregate(path, node, up)


def proof(path: Column) -> Column:
    """The digest of a witness: of its siblings from the lowest level up."""
    held = F.filter(path, lambda step: _side(step) != F.lit(NONE))
    return F.sha2(F.array_join(F.transform(held, _sibling), ""), 256)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(
    docs: DataFrame, tampered: Column | None = None, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", group: str = "lang",
    counted: str = "n_chars", height: int = HEIGHT,
) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, path, proof_sha256, folded_root and
    verified.

    The leaf is of ``fields`` in order. Rows of a group ascend by id, null first; of one id, by
    leaf. Where ``tampered`` holds, one is added to ``counted`` before the row is checked
    against the witness made from what it was: folded_root is the root that comes out, verified
    whether it is the manifest's. A null stays null, so that such a row verifies.

    Repeated rows are leaves each. A null group is a group, and comes first. Other columns are
    not looked at; no rows give no manifest. A task holds 2**``height`` digests at once.
    Digests are lower-case hex, but in path.
    """
    id_, hot = F.col(doc_id), F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    more = (F.col(counted).cast("decimal(38,0)") + 1).cast("string")
    changed = [more if f == counted else F.col(f) for f in fields]
    rows = docs.select(
        id_.alias("doc_id"),
        F.col(group).alias("lang"),
        F.unhex(leaf([F.col(f) for f in fields])).alias("leaf"),
        F.when(hot, F.unhex(leaf(changed))).alias("checked"),
    )
    # Rows alike in everything are dealt to any of their places: a number for each splits them.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    found = witnessed(rows, "leaf", "lang", ["doc_id", "leaf", "checked", "row"], height)
    out = found.select(
        "doc_id",
        _text(F.col("leaf")).alias("leaf"),
        _text(F.col("subroot")).alias("subroot"),
        _text(F.col("root")).alias("root"),
        "path",
        proof(F.col("path")).alias("proof_sha256"),
        folded(_text(F.coalesce("checked", "leaf")), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
