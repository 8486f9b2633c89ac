"""Merkle manifest of a dataset: one tree per group over its ordered rows, one tree over the groups.

A leaf is the digest of a row's fields.  Every ``fanout`` consecutive nodes (the
last run may have fewer, even one) become the digest of their hexadecimal
digests, until one node is left.

The tree is built without a downward pass.  Leaves lie in aligned blocks, one
small subtree each, built in one task.  Blocks then go through a butterfly: in
round r, the ``fanout`` blocks whose numbers differ only in their r-th digit
swap the roots of the subtrees that they know.  All of them hash the same
parent, so each block ends with the siblings of its whole way up and with the
root, and the work of a round is a shuffle in which every block gets exactly
``fanout`` short rows.  Places without a block in the last aligned run take part
as empty ones, so that each block finds its partner.  A last pass puts the
siblings inside the block and above it together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import distributed_row_number
from ..runtime import durable

#: Leaves of a block; the largest power of the fanout up to it is used.
BLOCK_ROWS = 4096
#: Rounds between two written states.
ROUNDS_PER_WRITE = 8

STEP = "struct<left: string, right: string>"


def row_digest(*fields: Column | str) -> Column:
    """Hexadecimal sha256 of the fields: each ``-`` if null, else its length in bytes, a colon and its value."""
    parts = []
    for field in fields:
        text = (F.col(field) if isinstance(field, str) else field).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and the digests left and right of its way up give."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]).cast("binary"), 256))


def proof_text(proof: Column) -> Column:
    """All digests of a proof, level by level and left to right, as one text."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels_of(n: int, fanout: int) -> int:
    """Levels until one node is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def _subtree(leaves: Sequence[str], fanout: int, levels: int) -> tuple[str, list[tuple[list[str], list[str]]]]:
    """Root after so many levels, and for each level the digests left and right of each of its nodes."""
    nodes, steps = list(leaves), []
    for _ in range(levels):
        left, right, above = [], [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for i in range(len(run)):
                left.append("".join(run[:i]))
                right.append("".join(run[i + 1 :]))
            above.append(_digest("".join(run)))
        steps.append((left, right))
        nodes = above
    return nodes[0], steps


def _levels_in_block(block: int, rows: int, fanout: int, levels: int) -> int:
    """A block that is its whole tree may be lower than the others."""
    return levels if block else _levels_of(rows, fanout)


def _block_roots(placed: DataFrame, fanout: int, levels: int) -> DataFrame:
    def root(leaves: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("place")
        block = leaves["block"][0].as_py()
        node, _ = _subtree(leaves["leaf"].to_pylist(), fanout, _levels_in_block(block, len(leaves), fanout, levels))
        return leaves.select(["g", "block"]).slice(0, 1).append_column("node", pa.array([node]))

    kind = placed.schema["g"].dataType.simpleString()
    return placed.select("g", "block", "place", "leaf").groupBy("g", "block").applyInArrow(
        root, f"g {kind}, block bigint, node string"
    )


def _butterfly(roots: DataFrame, fanout: int) -> DataFrame:
    """Each (g, block) with the root ``node`` of its g, and its ``proof`` from the block's root up."""
    roots = durable(roots, "roots")
    sizes = roots.groupBy("g").agg((F.max("block") + 1).alias("blocks"))
    most = sizes.agg(F.max("blocks")).first()[0] or 0
    rounds = _levels_of(most, fanout)
    needed = sum(((F.col("blocks") > fanout**i).cast("int") for i in range(rounds)), F.lit(0))
    sizes = sizes.withColumn("rounds", needed)
    width = F.lit(1).cast("bigint")
    for i in range(rounds):
        width = F.when(F.col("rounds") > i, F.lit(fanout ** (i + 1))).otherwise(width)
    empty = sizes.filter(width > F.col("blocks")).select(
        "g", F.explode(F.sequence(F.col("blocks"), width - 1)).alias("block"), F.lit(None).cast("string").alias("node")
    )
    state = roots.unionByName(empty).alias("a").join(sizes.alias("b"), F.col("a.g").eqNullSafe(F.col("b.g"))).select(
        "a.g", "block", "node", "blocks", "rounds", F.array().cast(f"array<{STEP}>").alias("proof")
    )
    for r in range(rounds):
        stride = fanout**r
        lowest = F.col("block") - F.floor(F.col("block") / stride) % fanout * stride
        group = F.sequence(lowest, lowest + (fanout - 1) * stride, F.lit(stride).cast("bigint"))
        to = F.explode(F.when(F.col("rounds") > r, group).otherwise(F.array("block")))
        sent = state.select("*", to.alias("to")).withColumn("proof", F.when(F.col("to") == F.col("block"), F.col("proof")))
        got = sent.groupBy("g", "to", "blocks", "rounds").agg(
            F.sort_array(F.collect_list(F.struct("block", "node"))).alias("seen"),
            F.first("proof", ignorenulls=True).alias("proof"),
        )

        def side(keep):
            kept = F.filter("seen", lambda s: s["node"].isNotNull() & keep(s["block"]))
            return F.array_join(F.transform(kept, lambda s: s["node"]), "")

        text = side(lambda b: F.lit(True))
        step = F.struct(side(lambda b: b < F.col("to")).alias("left"), side(lambda b: b > F.col("to")).alias("right"))
        swapped = F.col("rounds") > r
        state = got.select(
            "g", F.col("to").alias("block"),
            F.when(swapped, F.when(text != "", F.sha2(text.cast("binary"), 256)))
            .otherwise(F.when(text != "", text)).alias("node"),
            "blocks", "rounds",
            F.when(swapped & (F.col("to") < F.col("blocks")), F.concat("proof", F.array(step)))
            .otherwise(F.col("proof")).alias("proof"),
        )
        if r % ROUNDS_PER_WRITE == ROUNDS_PER_WRITE - 1:
            state = durable(state, "butterfly")
    return durable(state.filter(F.col("block") < F.col("blocks")).select("g", "block", "node", "proof"), "proofs")


def _with_proofs(placed: DataFrame, upper: DataFrame, fanout: int, levels: int) -> DataFrame:
    kept = [f.name for f in placed.schema if f.name == "row"]
    row = placed.schema["row"].dataType.simpleString()

    def join(leaves: pa.Table, above: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("place")
        n, block = len(leaves), leaves["block"][0].as_py()
        height = _levels_in_block(block, n, fanout, levels)
        _, steps = _subtree(leaves["leaf"].to_pylist(), fanout, height)
        rest = above["proof"][0].as_py()
        texts = {side: [t for step in steps for t in step[k]] + [s[side] for s in rest] for k, side in enumerate(("left", "right"))}
        sizes = [len(step[0]) for step in steps]
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        at = np.arange(n)
        picks = [starts[k] + at // fanout**k for k in range(height)]
        picks += [np.full(n, starts[-1] + k) for k in range(len(rest))]
        flat = pa.array(np.stack(picks, 1).ravel() if picks else np.zeros(0, np.int64))
        steps_of = pa.StructArray.from_arrays([pa.array(texts[s], pa.string()).take(flat) for s in ("left", "right")], ["left", "right"])
        proof = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(picks), pa.int32()), steps_of)
        same = {c: pa.array(above[c].to_pylist() * n, pa.string()) for c in ("subroot", "root")}
        return pa.table({**{c: leaves[c] for c in kept}, "leaf": leaves["leaf"], **same, "proof": proof})

    return placed.groupBy("g", "block").cogroup(upper.groupBy("g", "block")).applyInArrow(
        join, f"row {row}, leaf string, subroot string, root string, proof array<{STEP}>"
    )


def manifest(rows: DataFrame, leaf: Column, group: str, order: str, carry: Sequence[str], fanout: int = 2) -> DataFrame:
    """The columns ``carry`` of every row with ``leaf``, ``subroot``, ``root`` and ``proof``.

    ``leaf`` is the row's digest, see :func:`row_digest`.  Rows of a group ascend
    by ``order``, null first; rows with the same value ascend by their leaf, so
    the trees do not depend on the layout of the input, and equal rows are leaves
    of their own next to each other.  Groups ascend by ``group``, bytewise, null
    first; all rows with a null group are one group.  A group of one row has its
    leaf as subroot, a single group's subroot is the root.  ``proof`` holds for
    each level the digests to the left and right of the way up, first inside the
    group and then over the groups; both are empty where a node is alone.  An
    empty table gives no rows.  Other columns are left out.

    No group is held by one task: rows are ordered by ranges and numbered by
    counts, a block holds at most ``BLOCK_ROWS`` leaves, and a round sends each
    block ``fanout`` digests.
    """
    if fanout < 2:
        raise ValueError("fanout must be at least 2")
    made = {"leaf", "subroot", "root", "proof"}
    if made & set(carry):
        raise ValueError(f"carried columns may not be named {sorted(made & set(carry))}")
    levels = 0
    while fanout ** (levels + 1) <= BLOCK_ROWS:
        levels += 1
    leaves = rows.select(
        F.col(group).alias("g"), F.col(order).alias("o"), leaf.alias("leaf"), F.struct(*carry).alias("row"),
        F.monotonically_increasing_id().alias("tie"),
    )
    numbered = distributed_row_number(leaves, ["o", "leaf", "tie"], ["g"], "number")
    size = fanout**levels
    placed = numbered.select(
        "g", F.expr(f"(number - 1) div {size}").alias("block"), (F.col("number") - 1).alias("place"), "leaf", "row"
    )
    states = _butterfly(_block_roots(placed, fanout, levels), fanout)
    tops = distributed_row_number(states.filter("block = 0").select(F.col("g").alias("of"), "node"), ["of"], name="number")
    tops = durable(tops, "tops")
    over = _butterfly(tops.select(F.lit(0).alias("g"), (F.col("number") - 1).cast("bigint").alias("block"), "node"), fanout)
    tops = tops.join(over.select((F.col("block") + 1).alias("number"), F.col("node").alias("root"), "proof"), "number")
    tops = tops.select("of", F.col("node").alias("subroot"), "root", F.col("proof").alias("over"))
    upper = states.join(tops, F.col("g").eqNullSafe(F.col("of"))).select(
        "g", "block", "subroot", "root", F.concat("proof", "over").alias("proof")
    )
    found = _with_proofs(placed, upper, fanout, levels)
    return found.select(*[F.col("row")[c].alias(c) for c in carry], "leaf", "subroot", "root", "proof")
