"""A Merkle manifest of a table: one digest per row, per group and for the whole table.

A tree has runs of 16 siblings.  An aligned block of 256 leaves keeps each of its two levels
as one text of hexadecimal digests, so a parent is the hash of a substring of fixed width and
the siblings of a node are the substrings beside it in its run.  A block's last digest is a
leaf of the next round, in which 256 blocks are a block; rounds go on until every group has
one digest, and the groups' digests are the leaves of a last tree.  On the way back each
block hands its members the siblings above it.

Everything is SQL expressions; a task holds blocks, never a group.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalguard.llm.base import stored
from signalguard.llm.ordering import numbered

#: Siblings of a run; runs of a block; characters of a digest.
RUN, RUNS, DIGEST = 16, 16, 64
BLOCK = RUN * RUNS
WIDTH = RUN * DIGEST


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: a lambda's argument is a name, not a copy."""
    return F.element_at(F.transform(F.array(value), body), 1)


def field(column: Column) -> Column:
    """A value so that no two rows read alike: ``-`` for NULL, else its bytes, ``:``, itself."""

    def told(text: Column) -> Column:
        size = F.octet_length(text).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(size, F.lit(":"), text))

    return told(column.cast("string"))


def row_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 of a row, as lowercase hexadecimal text."""
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def _cut(level: Column, first: Column, size: Column | int) -> Column:
    """``size`` digests of a level from the ``first`` on, fewer at its end."""
    size = size if isinstance(size, Column) else F.lit(size)
    return level.substr((first * DIGEST + 1).cast("int"), (size * DIGEST).cast("int"))


def _parents(level: Column) -> Column:
    """The level above: the hash of every run."""

    def hashed(digests: Column) -> Column:
        runs = F.ceil(F.length(digests) / WIDTH).cast("int")
        each = F.transform(
            F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_cut(digests, i * RUN, RUN), 256)
        )
        return F.array_join(each, "").cast("binary")

    return _let(level, hashed)


def _blocks(nodes: DataFrame, label: str) -> DataFrame:
    """Blocks of nodes (tree, pos, n, digest, carried): members, both levels, and the top.

    Levels are binary: bytes are cut out by place, characters of a text would be counted.
    """
    member = F.struct("pos", "digest", "carried")
    blocks = nodes.groupBy("tree", F.expr(f"pos DIV {BLOCK}").alias("block")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(member)).alias("members")
    )

    def levels(lowest: Column) -> Column:
        def both(upper: Column) -> Column:
            top = F.when(F.col("n") > RUN, _parents(upper)).otherwise(
                F.when(F.col("n") > 1, upper).otherwise(lowest)
            )
            return F.struct(
                lowest.alias("lowest"), upper.alias("upper"), top.cast("string").alias("top")
            )

        return _let(F.when(F.col("n") > 1, _parents(lowest)), both)

    joined = F.array_join(F.transform("members", lambda m: m["digest"]), "").cast("binary")
    return stored(blocks.select("*", _let(joined, levels).alias("levels")), label)


def _fold(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks, and (tree, digest) of each tree."""
    rounds = []
    while True:
        blocks = _blocks(nodes, f"{label}-{len(rounds)}")
        rounds.append(blocks)
        tops = blocks.select(
            "tree",
            F.col("block").alias("pos"),
            F.ceil(F.col("n") / BLOCK).alias("n"),
            F.col("levels.top").alias("digest"),
            F.lit(None).cast("int").alias("carried"),
        )
        if blocks.where(F.col("n") > BLOCK).isEmpty():
            return rounds, tops.select("tree", "digest")
        nodes = tops


def _beside(level: Column, place: Column, first: Column) -> Column:
    """The digests left and right of a place in the run that starts at ``first``."""
    left = _cut(level, first, place - first)
    right = _cut(level, place + 1, first + (RUN - 1) - place)
    return F.struct(left.cast("string").alias("left"), right.cast("string").alias("right"))


def _descend(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Every leaf of the first round with its path; ``above`` has (tree, path, facts)."""
    above = above.withColumn("pos", F.lit(0).cast("bigint"))
    none = F.expr("array()").cast("array<struct<left:string,right:string>>")
    for blocks in reversed(rounds):
        joined = blocks.join(
            above.select("tree", F.col("pos").alias("block"), "path", "facts"), ["tree", "block"]
        )

        def told(member: Column) -> Column:
            place = (member["pos"] % BLOCK).cast("int")
            run = F.floor(place / RUN).cast("int")
            low = F.array(_beside(F.col("levels.lowest"), place, run * RUN))
            high = F.array(_beside(F.col("levels.upper"), run, F.lit(0)))
            return F.struct(
                member["pos"].alias("pos"),
                member["digest"].alias("digest"),
                member["carried"].alias("carried"),
                F.concat(
                    F.when(F.col("n") > 1, low).otherwise(none),
                    F.when(F.col("n") > RUN, high).otherwise(none),
                    F.col("path"),
                ).alias("path"),
            )

        above = joined.select("tree", "facts", F.inline(F.transform("members", told)))
    return above


def manifest(
    df: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    order: str = "doc_id",
    group: str = "source",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per row: its order and group, leaf, subroot, root, path, and ``carry``.

    A leaf is the digest of the row's ``fields``.  Per group the leaves ascend by ``order``
    (NULL first, equal ones by their digest; equal rows are alike in every result) and are
    hashed in runs of 16, the last run shorter, level by level until one is left, the
    ``subroot``; a lone leaf is its own.  The subroots ascend by group (NULL, which is a
    group, first; texts by their bytes) and are hashed likewise to the ``root``.  ``path``
    has, level by level from the leaf to the root, the digests ``left`` and ``right`` of the
    node within its run, joined as hexadecimal text.

    ``carry`` names further columns to compute from the row and keep beside its leaf; their
    types must be sortable.  Other columns of the table are not read, whatever their names.
    Texts are hashed where they are read, however long; only digests are shuffled.  An empty
    table gives no row.
    """
    carry = carry or {}
    clash = {order, group, "leaf", "subroot", "root", "path"} & set(carry)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results; name them differently")
    quoted = lambda name: F.col(f"`{name}`")
    carried = [c.alias(f"c{i}") for i, c in enumerate(carry.values())]
    leaves = stored(
        df.select(
            F.struct(quoted(group).alias("group")).alias("tree"),
            quoted(order).alias("rank"),
            row_digest([quoted(c) for c in fields]).alias("digest"),
            F.struct(quoted(order).alias("rank"), *carried).alias("carried"),
        ),
        "merkle-leaves",
    )
    nodes = numbered(leaves, "tree", ["rank", "digest"], "merkle-order").drop("rank")
    rounds, tops = _fold(nodes, "merkle-blocks")

    # Every group is a leaf of one more tree.
    whole = F.struct(F.lit(0).alias("group"))
    groups = tops.select(
        whole.alias("tree"),
        F.col("tree.group").alias("rank"),
        "digest",
        F.struct("tree").alias("carried"),
    )
    groups = numbered(groups, "tree", ["rank"], "merkle-groups").drop("rank")
    last, root = _fold(groups, "merkle-roots")
    start = root.select(
        "tree",
        F.expr("array()").cast("array<struct<left:string,right:string>>").alias("path"),
        F.struct(F.col("digest").alias("root")).alias("facts"),
    )
    above = _descend(last, start).select(
        F.col("carried.tree").alias("tree"),
        "path",
        F.struct(F.col("digest").alias("subroot"), F.col("facts.root").alias("root")).alias(
            "facts"
        ),
    )
    return _descend(rounds, stored(above, "merkle-groups-path")).select(
        F.col("carried.rank").alias(order),
        F.col("tree.group").alias(group),
        F.col("digest").alias("leaf"),
        F.col("facts.subroot").alias("subroot"),
        F.col("facts.root").alias("root"),
        "path",
        *[F.col(f"carried.c{i}").alias(name) for i, name in enumerate(carry)],
    )


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(
        path, leaf, lambda node, beside: F.sha2(
            F.concat(beside["left"], node, beside["right"]), 256
        )
    )


def path_digest(path: Column) -> Column:
    """SHA-256 of all siblings, from the leaf to the root, left to right."""
    return F.sha2(
        F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256
    )
