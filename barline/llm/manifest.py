"""Merkle manifest of a dataset, its upper levels by a butterfly exchange.

Every row is a leaf.  The leaves of a group (one language) are cut into blocks of
``fanout ** levels`` consecutive leaves, the block being what one task holds at a time.
Every block hashes its own leaves to one block root.  Above that, blocks work in rounds: in
round ``r`` the ``fanout`` blocks whose numbers differ only in digit ``r`` (base ``fanout``)
swap their subtree roots.  Each of them keeps the others' roots as its next proof step and
hashes the common parent by itself, so after the last round every block holds the root of its
group and its own upper proof; nothing is sent down the tree again.  Where the number of blocks
is no power of the fanout, blocks also play the missing ones, with empty subtrees, so every
round is a one-to-one exchange and no block is read by many.  The group roots, in the order of
their groups, form the top tree, which the same functions build.

Positions come from one range shuffle: a row's place in its partition plus the number of rows
of its group in the partitions before.  Only digests and keys are shuffled, never texts.  No
step holds more than one block or ``fanout`` proofs together; a group of any size is spread
over its blocks, and rows of one repeated id are parted by their place in the input.

Defined cases: a null column is ``-`` in the leaf; null ids come first in their group; equal
ids are ordered by leaf; equal rows are leaves of their own; a null group comes before all
others, the empty one next; an empty table gives no rows; a group of one leaf has that leaf
as its root; columns that are not listed play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barline.llm.common import staged

FANOUT = 2
#: Levels inside a block: 2 ** 12 = 4096 leaves.
LEVELS = 12
#: Rounds after which the exchanged state is written, so a lost executor repeats these at most.
ROUNDS_STAGED = 8
#: Copies of a group's row when it is joined to the blocks of the group.
SALT = 16

STEP = "struct<left: string, right: string>"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def field(c: Column) -> Column:
    """UTF-8 byte count, ``:``, value; ``-`` for null."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


# ---- inside a block -----------------------------------------------------------

def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """The nodes of each level, leaves first: ``levels`` times upwards, or until one is left."""
    tree = [nodes]
    while len(tree) - 1 < levels if levels is not None else len(nodes) > 1:
        nodes = [_h("".join(nodes[k:k + fanout])) for k in range(0, len(nodes), fanout)]
        tree.append(nodes)
    return tree


def sides(tree: list[list[str]], k: int, fanout: int) -> list[tuple[str, str]]:
    """Joined siblings to the left and to the right of leaf ``k``, level by level."""
    out = []
    for nodes in tree[:-1]:
        lo = k - k % fanout
        out.append(("".join(nodes[lo:k]), "".join(nodes[k + 1:lo + fanout])))
        k //= fanout
    return out


def fold(leaf: str, steps: Iterable[tuple[str, str]]) -> str:
    for left, right in steps:
        leaf = _h(left + leaf + right)
    return leaf


# ---- positions and blocks -------------------------------------------------------

def _positions(leaves: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """``leaves`` (with ``grp``) plus ``n`` (leaves of the group), ``block`` and ``at`` (place in
    the block), in the shared folder."""
    # equal keys are parted by their place in the input, so a hot one spreads over tasks
    df = leaves.withColumn("_tie", F.monotonically_increasing_id())
    df = df.repartitionByRange("grp", *order, "digest", "_tie").sortWithinPartitions("grp", *order, "digest", "_tie").drop("_tie")
    df = staged(df.withColumn("_row", F.monotonically_increasing_id()), "leaves")
    df = df.withColumn("_part", F.shiftrightunsigned("_row", 33))
    # one row per partition and group
    w = Window.partitionBy("grp").orderBy("_part")
    runs = df.groupBy("grp", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    runs = runs.select("grp", "_part", (F.sum("_n").over(w) - F.col("_n") - F.col("_first")).alias("_shift"),
                       F.sum("_n").over(Window.partitionBy("grp")).alias("n"))
    df = df.join(runs, ["grp", "_part"]).withColumn("_at", F.col("_row") + F.col("_shift"))
    df = df.withColumns({"block": F.floor(F.col("_at") / size).cast("bigint"), "at": F.pmod("_at", F.lit(size)).cast("int")})
    return staged(df.drop("_row", "_part", "_shift", "_at"), "blocks")


def _block_roots(rows: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``grp, block, blocks, root`` of each block."""
    size = fanout ** levels

    def root(table: pa.Table) -> pa.Table:
        digests = table.sort_by("at")["digest"].to_pylist()
        many = table["n"][0].as_py() > size
        return pa.table({"grp": table["grp"][:1].cast("string"), "block": table["block"][:1], "blocks": pa.array([-(-table["n"][0].as_py() // size)], "int64"),
                         "root": [climb(digests, fanout, levels if many else None)[-1][0]]})

    return (rows.select("grp", "block", "n", "at", "digest").groupBy("grp", "block")
            .applyInArrow(root, "grp string, block long, blocks long, root string"))


# ---- the exchange -----------------------------------------------------------------

def exchange(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``blocks``: ``grp, block, blocks`` (number of the group's), ``root``.  Returns
    ``grp, block, root`` (now the group's) and ``proof`` (the steps from the block upwards)."""
    blocks = staged(blocks, "block-roots")
    # digits of the largest block number of the group
    rounds = F.when(F.col("blocks") > 1, F.length(F.conv((F.col("blocks") - 1).cast("string"), 10, fanout))).otherwise(0)
    state = blocks.withColumn("rounds", rounds.cast("int"))
    last = state.agg(F.max("rounds")).first()[0] or 0
    whole = F.pow(F.lit(fanout), F.col("rounds")).cast("bigint")
    # block p also plays p + blocks, p + 2 * blocks, ... below the next power, with an empty subtree
    state = state.withColumn("at", F.explode(F.sequence("block", whole - 1, "blocks")))
    state = state.select("grp", "at", "blocks", "rounds", F.when(F.col("at") < F.col("blocks"), F.col("root")).alias("root"),
                         F.expr(f"CAST(array() AS array<{STEP}>)").alias("proof"))
    for r in range(last):
        step = fanout ** r
        digit = F.when(F.col("rounds") > r, F.pmod(F.floor(F.col("at") / step), F.lit(fanout))).otherwise(0).cast("int")
        state = state.withColumn("digit", digit).withColumn("first", F.col("at") - F.col("digit") * step)
        # at most `fanout` members; each takes what the others hold and hashes the parent itself
        group = state.groupBy("grp", "first").agg(F.sort_array(F.collect_list(F.struct("digit", "at", "blocks", "rounds", "root", "proof"))).alias("members"))
        own = group.select("grp", F.expr("transform(members, m -> named_struct('digit', m.digit, 'root', coalesce(m.root, '')))").alias("roots"),
                           F.explode("members").alias("m")).select("grp", "roots", "m.*")
        joined = "array_join(transform(filter(roots, x -> x.digit {} digit), x -> x.root), '')"
        parent = F.expr("array_join(transform(roots, x -> x.root), '')")
        active = F.col("rounds") > r
        state = own.select(
            "grp", "at", "blocks", "rounds",
            F.when(~active, F.col("root")).when(parent != "", F.sha2(parent.cast("binary"), 256)).alias("root"),
            F.when(active, F.concat("proof", F.array(F.struct(F.expr(joined.format("<")).alias("left"), F.expr(joined.format(">")).alias("right")))))
            .otherwise(F.col("proof")).alias("proof"))
        if r % ROUNDS_STAGED == ROUNDS_STAGED - 1:
            state = staged(state, "exchange")
    return state.filter("at < blocks").select("grp", F.col("at").alias("block"), "root", "proof")


def _tree(leaves: DataFrame, order: Sequence[str], fanout: int, levels: int) -> tuple[DataFrame, DataFrame]:
    rows = _positions(leaves, order, fanout ** levels)
    return rows, staged(exchange(_block_roots(rows, fanout, levels), fanout), "proofs")


# ---- the manifest -------------------------------------------------------------------

def manifest(docs: DataFrame, *, group_col: str = "lang", id_col: str = "doc_id", columns: Sequence[str] = COLUMNS,
             claims: dict[str, Column] | None = None, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Per row: ``doc_id, leaf, subroot, root, proof`` (array of ``left`` and ``right`` siblings,
    joined, from the leaf to the root), ``proof_sha256`` and ``folded_root``.

    ``folded_root`` is what the proof gives for the row as claimed: ``claims`` maps columns to
    expressions over ``docs`` that stand for them when the claimed leaf is hashed.  A claim that
    differs from what the manifest was made of gives another root."""
    claims = claims or {}
    leaf = leaf_digest([F.col(f"`{c}`") for c in columns])
    claimed = leaf_digest([claims.get(c, F.col(f"`{c}`")) for c in columns])
    group = F.col(f"`{group_col}`").cast("string")
    rows = docs.select(F.coalesce(F.concat(F.lit("1"), group), F.lit("0")).alias("grp"), F.col(f"`{id_col}`").alias("doc_id"),
                       leaf.alias("digest"), F.when(claimed != leaf, claimed).alias("claimed"))
    rows, proofs = _tree(rows, ["doc_id"], fanout, levels)

    tops = proofs.filter("block = 0").select(F.lit("").alias("grp"), F.col("grp").alias("lang"), F.col("root").alias("digest"))
    tops, top_proofs = _tree(tops, ["lang"], fanout, levels)
    top = _leaf_proofs(tops.withColumn("claimed", F.lit(None).cast("string")), top_proofs, "lang string", fanout, levels)
    top = top.select(F.col("lang").alias("grp"), F.col("root").alias("top_root"), F.col("proof").alias("top_proof"))
    top = staged(top, "top").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    proofs = (proofs.withColumn("salt", F.pmod("block", F.lit(SALT)).cast("int")).join(top, ["grp", "salt"])
              .select("grp", "block", F.col("root").alias("subroot"), F.col("top_root").alias("root"), F.concat("proof", "top_proof").alias("proof")))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return _leaf_proofs(rows, proofs, f"doc_id {id_type}", fanout, levels)


def _leaf_proofs(rows: DataFrame, proofs: DataFrame, key: str, fanout: int, levels: int) -> DataFrame:
    """Joins each block's leaves with the block's upper proof; per leaf ``<key>, leaf, subroot, root,
    proof, proof_sha256, folded_root``."""
    size, name = fanout ** levels, key.split(" ")[0]
    if "subroot" not in proofs.columns:
        proofs = proofs.withColumn("subroot", F.col("root"))
    step = pa.struct([("left", pa.string()), ("right", pa.string())])

    def block(leaves: pa.Table, upper: pa.Table) -> pa.Table:
        leaves = leaves.sort_by("at")
        digests, many = leaves["digest"].to_pylist(), leaves["n"][0].as_py() > size
        tree = climb(digests, fanout, levels if many else None)
        above = [(s["left"], s["right"]) for s in upper["proof"][0].as_py()]
        subroot, root = upper["subroot"][0].as_py(), upper["root"][0].as_py()
        proofs, shas, folded = [], [], []
        for k, (leaf, claim) in enumerate(zip(digests, leaves["claimed"].to_pylist())):
            steps = sides(tree, k, fanout) + above
            proofs.append([{"left": a, "right": b} for a, b in steps])
            shas.append(_h("".join(a + b for a, b in steps)))
            folded.append(fold(claim or leaf, steps))
        n = len(digests)
        return pa.table({name: leaves[name], "leaf": digests, "subroot": [subroot] * n, "root": [root] * n,
                         "proof": pa.array(proofs, pa.list_(step)), "proof_sha256": shas, "folded_root": folded})

    left = rows.select("grp", "block", "n", "at", name, "digest", "claimed").groupBy("grp", "block")
    right = proofs.select("grp", "block", "subroot", "root", "proof").groupBy("grp", "block")
    return left.cogroup(right).applyInArrow(
        block, f"{key}, leaf string, subroot string, root string, proof array<{STEP}>, proof_sha256 string, folded_root string")
