"""Merkle dataset manifest: hash trees over a dataset's rows, kept as postorder append logs.

A row's leaf is the SHA-256 of its fields, each as ``byte count:value`` (``-``
for NULL).  The leaves of each tree (one a language) ascend by id; every
``FAN`` consecutive nodes become their hash, level by level, until one node is
left, the subroot; the subroots form one more tree, whose root stands for the
dataset.  Digests are hashed as hex text.

Logs: an aligned builder takes ``FAN ** HEIGHT`` consecutive leaves and appends
nodes as they are completed, a node right after its last child, which is
postorder.  Blocks are built on their own, their roots are the leaves of the
next round, so no task sees more than ``FAN ** HEIGHT`` leaves, whatever the
size of a tree, and a tree of n leaves takes log(n) rounds.  Where a node lies
follows from subtree sizes alone (``position``), which is how proofs find
siblings, within a block and, through ``log_rows``, in a whole tree's log.

Defined results: rows that share an id are in the order of their leaves; NULL
ids come first, NULL languages first; a NULL id is never tampered with; a
language of one row has its leaf as subroot; an empty table gives no rows;
long texts are hashed whole in the JVM and never reach Python; repeated rows
each get a leaf of their own; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .order import PIECES, IdSlices
from .scratch import written

FAN, HEIGHT = 8, 4
#: Slices of the id range whose counts are added up together.
SLICES = 128
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _hash(hexes: list[str]) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def height(leaves: int, fan: int = FAN) -> int:
    """Levels above the leaves until one node is left."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // fan), levels + 1
    return levels


def position(level: int, index: int, leaves: int, levels: int, fan: int = FAN) -> int:
    """Place of a node in the postorder log of a tree of ``leaves`` leaves and ``levels`` levels above them.

    The node follows its last leaf e and the ``level`` - 1 nodes that e completes below it;
    before e lie, on each level t, the e div fan**t subtrees that were full by then.
    """
    e = min((index + 1) * fan**level, leaves) - 1
    return sum(e // fan**t for t in range(levels + 1)) + level


def append(leaves: list[str], levels: int, fan: int = FAN) -> list[str]:
    """The log of one builder: its leaves and the nodes above them, in completion order."""
    log: list[str] = []
    open_: list[list[str]] = [[] for _ in range(levels + 1)]
    for e, leaf in enumerate(leaves):
        log.append(leaf)
        open_[0].append(leaf)
        for t in range(levels):
            if len(open_[t]) < fan and e < len(leaves) - 1:
                break
            node = _hash(open_[t])
            open_[t] = []
            log.append(node)
            open_[t + 1].append(node)
    return log


def paths(log: list[str], leaves: int, levels: int, fan: int = FAN) -> Iterator[list[tuple[str, str]]]:
    """For each leaf of a log, the siblings before and after it on each level, as hex text, found by ``position``."""
    above: list[list[tuple[str, str]]] = [[]]
    for t in reversed(range(levels)):
        count, below = -(-leaves // fan**t), []
        for first in range(0, count, fan):
            run = [log[position(t, j, leaves, levels, fan)] for j in range(first, min(first + fan, count))]
            for k in range(len(run)):
                below.append([("".join(run[:k]), "".join(run[k + 1:])), *above[first // fan]])
        above = below
    yield from above


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        leaf = hashlib.sha256((before + leaf + after).encode()).hexdigest()
    return leaf


def _pack(path: list[tuple[str, str]]) -> str:
    return ";".join(f"{a},{b}" for a, b in path)


def _unpack(text: str | None) -> list[tuple[str, str]]:
    return [tuple(level.split(",")) for level in text.split(";")] if text else []


def leaf(fields: list[Column]) -> Column:
    """Hex SHA-256 of the fields, each its UTF-8 byte count, a colon and its text, or ``-`` for NULL."""
    texts = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*(F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c)) for c in texts)), 256)


def numbered(rows: DataFrame, id_col: str, tree_col: str, ties: list[str], piece: Column) -> DataFrame:
    """``rows`` with ``idx``, the place by ascending id within the row's tree, and ``n``, the tree's number of leaves.

    Ids are cut into slices, a tree's rows are counted by slice, and a row's
    place is its slice's offset plus its rank there.  Offsets are added up in
    two steps (runs of slices, slices of a run), so a tree that holds most
    rows gives no task more than a few hundred counts.  ``piece`` (0 to
    ``PIECES`` - 1, never falling as the ``ties`` ascend) cuts the slice of an
    id, or of NULL, that holds much of the table.
    """
    slices = IdSlices(rows, id_col)
    of, hot = slices.of(id_col).cast("long"), slices.hot()
    cut = rows.withColumn("slice", of * PIECES + (F.when(of.isin(hot), piece).otherwise(0) if hot else F.lit(0)))
    counts = cut.groupBy(tree_col, "slice").agg(F.count("*").alias("rows")).withColumn("run", F.expr(f"slice div {SLICES * PIECES}"))
    whole, before = Window.partitionBy(tree_col), lambda w: F.coalesce(F.sum("rows").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = counts.groupBy(tree_col, "run").agg(F.sum("rows").alias("rows")).select(tree_col, "run", before(whole.orderBy("run")).alias("begin"), F.sum("rows").over(whole).alias("n"))
    inside = counts.withColumn("offset", before(Window.partitionBy(tree_col, "run").orderBy("slice"))).drop("rows")
    offsets = inside.join(runs, [tree_col, "run"]).select(tree_col, "slice", (F.col("begin") + F.col("offset")).alias("offset"), "n")
    rank = F.row_number().over(Window.partitionBy(tree_col, "slice").orderBy(F.col(id_col).asc_nulls_first(), *ties))
    return cut.join(offsets, [tree_col, "slice"]).withColumn("idx", F.col("offset") + rank - 1).drop("slice", "offset")


def build(leaves: DataFrame, at_once: int = HEIGHT) -> tuple[list[DataFrame], DataFrame]:
    """Logs of all trees, one table of blocks a round, and the trees' roots, from (tree, idx, n, digest).

    A builder takes ``FAN ** at_once`` leaves, and ends at the tree's last node.
    A block is (tree, block, n, leaves, log): n counts the round's leaves of
    the whole tree, ``log`` is the block's nodes as joined hex text.  Every
    table is written, so that lost executors cost no earlier round.
    """
    rounds: list[DataFrame] = []
    nodes = leaves
    largest = leaves.agg(F.max("n")).first()[0] or 0

    def block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        n = int(pdf["n"].iloc[0])
        log = append(pdf["digest"].tolist(), min(height(n), at_once))
        return pd.DataFrame({"tree": pdf["tree"].iloc[:1], "block": pdf["block"].iloc[:1], "n": [n], "leaves": [len(pdf)], "log": ["".join(log)]})

    for _ in range(max(1, -(-height(largest) // at_once))):
        dealt = nodes.select("tree", "idx", "n", "digest", F.expr(f"idx div {FAN**at_once}").alias("block"))
        rounds.append(written(dealt.groupBy("tree", "block").applyInPandas(block, "tree string, block long, n long, leaves long, log string")))
        nodes = rounds[-1].select("tree", F.col("block").alias("idx"), F.expr(f"(n + {FAN**at_once - 1}) div {FAN**at_once}").alias("n"), F.expr("right(log, 64)").alias("digest"))
    return rounds, nodes.select("tree", F.col("digest").alias("root"))


def log_rows(rounds: list[DataFrame], at_once: int = HEIGHT) -> DataFrame:
    """Every node of the logs: tree, position in the tree's whole postorder log, level, idx within the level, digest."""
    first = rounds[0].groupBy("tree").agg(F.max("n").alias("whole"))
    out = None
    for r, blocks in enumerate(rounds):
        def explode(batches: Iterator[pd.DataFrame], r: int = r) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for tree, block, n, count, whole, log in pdf.itertuples(index=False):
                    levels, found = min(height(n), at_once), []
                    for t in range(1 if r else 0, levels + 1):  # a later round's leaves are nodes of the round before
                        for j in range(-(-count // FAN**t)):
                            at = position(t, j, count, levels)
                            level, index = r * at_once + t, block * FAN**(at_once - t) + j
                            found.append((tree, position(level, index, whole, height(whole)), level, index, log[64 * at:64 * at + 64]))
                    yield pd.DataFrame(found, columns=["tree", "position", "level", "idx", "digest"])

        rows = blocks.join(first, "tree").select("tree", "block", "n", "leaves", "whole", "log").mapInPandas(explode, "tree string, position long, level int, idx long, digest string")
        out = rows if out is None else out.unionByName(rows)
    return out


def _descend(rounds: list[DataFrame], tops: DataFrame, at_once: int) -> DataFrame:
    """(tree, block, above): the path from each first-round block's root to the dataset's root, from ``tops`` (tree, above)."""
    above = tops.withColumn("block", F.lit(0).cast("long"))

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for tree, block, n, count, log, up in pdf.itertuples(index=False):
                levels = min(height(n), at_once)
                nodes = [log[k:k + 64] for k in range(0, len(log), 64)]
                found = [";".join(filter(None, (_pack(p), up))) for p in paths(nodes, count, levels)]
                yield pd.DataFrame({"tree": tree, "block": range(block * FAN**at_once, block * FAN**at_once + count), "above": found})

    for blocks in reversed(rounds[1:]):
        met = blocks.join(above, ["tree", "block"]).select("tree", "block", "n", "leaves", "log", "above")
        above = met.mapInPandas(explode, "tree string, block long, above string")
    return above.select("tree", "block", "above")


def manifest(docs: DataFrame, id_col: str = "doc_id", tree_col: str = "lang", text_col: str = "text", fields: tuple[str, ...] = FIELDS, proofs: bool = False, at_once: int = HEIGHT) -> DataFrame:
    """Leaf, subroot, root, proof hash and a check of a tampered copy, for every row.

    ``log_position`` is the leaf's place in its tree's log; with ``proofs``,
    ``proof`` is the packed path (siblings before and after it, level by level).
    """
    id_ = F.col(id_col).cast("long")
    hit = F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = F.translate(F.col(text_col), _UPPER, _UPPER.lower())
    rows = docs.select(
        id_.alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit("")).alias("tree"),  # NULL first, then bytewise
        leaf([F.col(f) for f in fields]).alias("digest"),
        F.when(hit, leaf([lowered if f == text_col else F.col(f) for f in fields])).alias("tampered"),
    )
    leaves = written(numbered(written(rows), "doc_id", "tree", ["digest"], F.conv(F.left("digest", F.lit(2)), 16, 10).cast("int")))
    rounds, subroots = build(leaves, at_once)
    of_all = Window.orderBy("tree")  # one row a language
    tops = subroots.select(F.lit("").alias("tree"), (F.row_number().over(of_all) - 1).cast("long").alias("idx"), F.col("root").alias("digest"), F.col("tree").alias("of"))
    tops = tops.withColumn("n", F.count("*").over(Window.partitionBy("tree")))
    upper, root = build(tops.select("tree", "idx", "n", "digest"), at_once)
    ends = _descend([None, *upper], root.select("tree", F.lit("").alias("above")), at_once).select(F.col("block").alias("idx"), "above")
    ends = tops.join(ends, "idx").join(root, "tree").select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "above", "root")
    blocks = rounds[0].join(_descend(rounds, ends.select("tree", "above"), at_once), ["tree", "block"]).join(ends.select("tree", "subroot", "root"), "tree")

    def prove(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "tree", "log_position", "proof"]
        if not len(left):
            return pd.DataFrame(columns=names)
        left, b = left.sort_values("idx"), right.iloc[0]
        nodes = [b["log"][k:k + 64] for k in range(0, len(b["log"]), 64)]
        up, n, out = _unpack(b["above"]), int(b["n"]), []
        whole = height(n)
        for (doc, digest, tampered, idx), path in zip(left[["doc_id", "digest", "tampered", "idx"]].itertuples(index=False), paths(nodes, len(left), min(height(n), at_once))):
            path = path + up
            folded = fold(tampered if isinstance(tampered, str) else digest, path)
            proof = hashlib.sha256("".join(a + c for a, c in path).encode()).hexdigest()
            out.append((doc, digest, b["subroot"], b["root"], proof, folded, folded == b["root"], b["tree"], position(0, int(idx), n, whole), _pack(path) if proofs else None))
        return pd.DataFrame(out, columns=names)

    dealt = leaves.select(F.col("doc_id").cast("string").alias("doc_id"), "tree", "idx", "digest", "tampered", F.expr(f"idx div {FAN**at_once}").alias("block"))
    out = dealt.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInPandas(
        prove, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, tree string, log_position long, proof string")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


__all__ = ["FAN", "FIELDS", "HEIGHT", "append", "build", "fold", "height", "leaf", "log_rows", "manifest", "numbered", "paths", "position"]
