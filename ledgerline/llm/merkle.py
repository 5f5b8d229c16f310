"""Merkle manifest of a dataset: a digest for every row, a tree of digests for every group, one root over all groups.

A leaf is the digest of a row's fields. Rows of a group are its leaves, in order; three consecutive nodes become
the digest of their concatenation, level by level, until one is left, the subroot. The subroots, in order of their
groups, likewise give the root. A proof is what a holder of one row needs to recompute the root: at each level the
other nodes of its run.

Exchange of subtrees: a superblock is a run of 3 ** 7 nodes of one tree. On the way up every superblock
is reduced by itself to one node of the next table, so a tree of any size is a few tables, each 2,187
times smaller. On the way down every superblock's leaves are cogrouped with the outer nodes that its proofs need (one
row); that task reduces the leaves once more, joins inner and outer parts of the proofs and folds them. A task holds one
superblock, whatever a group's size.

Null fields count as ``-``. A null group is a group and comes first; null order values come first; rows of equal order are
ordered by their leaves. Very long texts are digested by the engine and leave the plan right there. A lone leaf is its
group's subroot, and a lone subroot the root; their proofs are empty. An empty table gives an empty table. Columns that
aren't named don't count.
"""

from __future__ import annotations

from hashlib import sha256
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import staged
from ledgerline.llm.positions import numbered

class Shape(NamedTuple):
    """Nodes of a run, and levels of a superblock."""

    fanout: int = 3
    height: int = 7

    @property
    def size(self) -> int:
        """Leaves of a superblock: 2,187."""
        return self.fanout**self.height


NODE = "tree string, pos long, n long, h string"
OUTER = "tree string, pos long, subroot string, root string, steps string"
FINISHED = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(*fields: Column) -> Column:
    """Digest of a row: each field as ``-`` if null, else its number of bytes, a colon and its text."""
    cells = []
    for field in fields:
        text = field.cast("string")
        cells.append(F.when(field.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*cells), 256)


def _levels(nodes: pd.DataFrame, shape: Shape) -> list[list[str]]:
    """The nodes of each level over a superblock: all levels for a part of a larger tree, else up to the last node."""
    levels = [nodes["h"].tolist()]
    whole = nodes["n"].iloc[0] <= shape.size
    while len(levels[-1]) > 1 if whole else len(levels) <= shape.height:
        now = levels[-1]
        levels.append([digest("".join(now[at : at + shape.fanout])) for at in range(0, len(now), shape.fanout)])
    return levels


def _steps(levels: list[list[str]], leaf: int, fanout: int) -> list[tuple[int, list[str]]]:
    """For each level the place of the leaf's node in its run, and the run's other nodes."""
    out = []
    for nodes in levels[:-1]:
        begin = leaf - leaf % fanout
        run = nodes[begin : begin + fanout]
        place = leaf - begin
        out.append((place, run[:place] + run[place + 1 :]))
        leaf //= fanout
    return out


def _written(steps: list[tuple[int, list[str]]]) -> str:
    return ",".join(f"{place}:{''.join(others)}" for place, others in steps)


def _read(steps: str) -> list[tuple[int, list[str]]]:
    out = []
    for step in steps.split(",") if steps else ():
        place, _, others = step.partition(":")
        out.append((int(place), [others[at : at + 64] for at in range(0, len(others), 64)]))
    return out


def _fold(leaf: str, steps: list[tuple[int, list[str]]]) -> str:
    for place, others in steps:
        leaf = digest("".join(others[:place]) + leaf + "".join(others[place:]))
    return leaf


def _block(shape: Shape) -> Column:
    return F.floor(F.col("pos") / shape.size).cast("long").alias("block")


def _climb(nodes: DataFrame, shape: Shape) -> list[DataFrame]:
    """The tables of nodes from ``nodes`` up to the one that holds a node for each tree."""

    def reduce(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        levels = _levels(nodes.sort_values("pos"), shape)
        return pd.DataFrame({"tree": [key[0]], "pos": [key[1]], "n": [-(-int(nodes["n"].iloc[0]) // shape.size)], "h": levels[-1]})

    tables = [nodes]
    while (tables[-1].agg(F.max("n")).first()[0] or 1) > 1:
        tables.append(staged(tables[-1].groupBy("tree", _block(shape)).applyInPandas(reduce, NODE), "nodes"))
    return tables


def _beside(nodes: DataFrame, above: DataFrame, shape: Shape):
    """Superblocks of ``nodes``, each with the row of its outer nodes."""
    return nodes.groupBy("tree", _block(shape)).cogroup(above.groupBy("tree", F.col("pos").alias("block")))


def _descend(tables: list[DataFrame], above: DataFrame, shape: Shape) -> DataFrame:
    """Outer nodes of the superblocks of each table, from the highest down; ``above`` has those of the trees."""

    def outer(key: tuple, nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes, row = nodes.sort_values("pos"), above.iloc[0]
        levels = _levels(nodes, shape)
        steps = [",".join(filter(None, [_written(_steps(levels, at, shape.fanout)), row["steps"]])) for at in range(len(nodes))]
        return pd.DataFrame({"tree": key[0], "pos": nodes["pos"].to_numpy(), "subroot": row["subroot"], "root": row["root"], "steps": steps})

    for table in reversed(tables):
        above = staged(_beside(table, above, shape).applyInPandas(outer, OUTER), "outer")
    return above


def manifest(rows: DataFrame, id: str, group: str, leaf: Column, given: Column, shape: Shape = Shape()) -> DataFrame:  # noqa: B008
    """``(id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    ``leaf`` is the digest at the time of the manifest, ``given`` the one of the row as it is now; a row is verified
    if its own proof leads from ``given`` to the root.
    """
    kind = rows.schema[id].dataType
    tree = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = rows.select(tree.alias("tree"), F.col(id).alias("id"), leaf.alias("h"), given.alias("given"))
    leaves = numbered(leaves, "tree", ["id", "h"], "leaves").withColumn("id", F.col("id").cast("string"))
    leaves = staged(leaves, "leaves")
    own = _climb(leaves.select("tree", "pos", "n", "h"), shape)

    subroots = own[-1].select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h")
    subroots = staged(numbered(subroots, "tree", ["of"], "subroots"), "subroots")
    top = _climb(subroots.select("tree", "pos", "n", "h"), shape)
    above = top[-1].select("tree", "pos", F.lit("").alias("subroot"), F.col("h").alias("root"), F.lit("").alias("steps"))
    above = _descend(top[:-1], above, shape)

    above = above.select("pos", "root", "steps").join(subroots.select("pos", F.col("of").alias("tree"), F.col("h").alias("subroot")), "pos")
    above = above.select("tree", F.lit(0).cast("long").alias("pos"), "subroot", "root", "steps")
    above = _descend(own[1:-1], above, shape)

    def finish(key: tuple, leaves: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        leaves, row = leaves.sort_values("pos"), above.iloc[0]
        outer = _read(row["steps"])
        tail = "".join("".join(others) for _, others in outer)
        levels = _levels(leaves, shape)
        proofs, folded = [], []
        for at, one in enumerate(leaves["given"].tolist()):
            inner = _steps(levels, at, shape.fanout)
            proofs.append(digest("".join("".join(others) for _, others in inner) + tail))
            folded.append(_fold(one, inner + outer))
        out = leaves[["id", "h"]].rename(columns={"h": "leaf"})
        out = out.assign(subroot=row["subroot"], root=row["root"], proof_sha256=proofs, folded_root=folded)
        return out.assign(verified=out["folded_root"] == out["root"])

    out = _beside(leaves, above, shape).applyInPandas(finish, FINISHED)
    return out.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id)
