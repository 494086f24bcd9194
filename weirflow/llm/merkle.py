"""Merkle manifest of a dataset as a persistent tree with path copying.

Rows are leaves, ordered inside their part (a language) by key. A run of ``FAN`` nodes becomes one parent until one node is left, the
part's subroot; the subroots are joined in the same way to the root. Leaves are stored in aligned blocks of ``FAN ** HEIGHT``, one row
each, and so are the blocks' roots one storey higher: no task holds more than a block, however large a part is. Towards the leaves a
block hands each child the siblings above it, so every leaf's proof is complete without any join of leaf rows.

A tampered leaf starts a version of the tree. The version shares every node with the original but the copied ancestors of that leaf:
first those inside its block, then those of the storeys above, which the block's own way up continues.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import written

FAN = 8
HEIGHT = 4  # levels of a storey
BLOCK = FAN**HEIGHT
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SORT_ROWS = 1_000_000  # of one task of the sort


def hashed(*values: Column) -> Column:
    """Lowercase hex sha256 of the values as ``length:text`` one after the other; a null is ``-``."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in text)).cast("binary"), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _storey(digests: list[str]) -> list[list[str]]:
    """The levels of one block from its children to its root; the caller says by their number how far up it goes."""
    return [_hash(digests[i : i + FAN]) for i in range(0, len(digests), FAN)]


def _levels(digests: list[str], total: int) -> list[list[str]]:
    """All levels of a block: ``HEIGHT`` of them, or fewer if the whole tree of ``total`` children ends earlier."""
    out = [digests]
    while total > 1 and len(out) <= HEIGHT:
        out.append(_storey(out[-1]))
        total = -(-total // FAN)
    return out


def _around(levels: list[list[str]], at: int) -> tuple[list[str], list[int]]:
    """The siblings of a child level by level, left to right, and how many stand left and right of it."""
    siblings, places = [], []
    for level in levels[:-1]:
        start = at - at % FAN
        run = level[start : start + FAN]
        mine = at - start
        siblings += run[:mine] + run[mine + 1 :]
        places += [mine, len(run) - mine - 1]
        at //= FAN
    return siblings, places


def copied_path(leaf: str, siblings: list[str], places: list[int]) -> list[str]:
    """The nodes that a version copies for another leaf: its ancestors, from the leaf's parent to the root."""
    out, at = [], 0
    for left, right in zip(places[::2], places[1::2]):
        leaf = _hash([*siblings[at : at + left], leaf, *siblings[at + left : at + left + right]])
        at += left + right
        out.append(leaf)
    return out


def _positions(nodes: DataFrame, order: list[str], rows: int) -> DataFrame:
    """Adds ``pos``, the place inside ``part`` by ``order``, and ``total``, the part's size. A part may hold all rows: the sort is
    by range of all columns, and only row numbers per task and part are counted."""
    spark = nodes.sparkSession
    tasks = max(1, -(-rows // SORT_ROWS), min(spark.sparkContext.defaultParallelism, rows // BLOCK))
    keys = ["part", *order]
    placed = nodes.repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    placed = written(placed.withColumns({"_task": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}), "sorted")
    counted = placed.groupBy("part", "_task").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("part")
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counted = counted.withColumns({"_before": before, "total": F.sum("_n").over(whole)})
    placed = placed.join(counted.drop("_n"), ["part", "_task"])
    return placed.withColumn("pos", F.col("_before") + F.col("_row") - F.col("_first")).drop("_task", "_row", "_first", "_before")


_BLOCKS = "part string, block long, size long, total long, root string, digests string"


def _blocks(nodes: DataFrame, label: str, held: str = "") -> DataFrame:
    """(part, pos, total, digest, ...) to one row per aligned block with its children's digests as one text. ``held`` names further
    columns that the block keeps as arrays."""
    keep = [x.split()[0] for x in held.split(", ")] if held else []
    schema = _BLOCKS + "".join(f", {name} array<{kind}>" for name, kind in (x.split() for x in held.split(", ") if x))

    def pack(key, table):
        order = np.argsort(table["pos"].to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        digests, total = table["digest"].to_pylist(), table["total"][0].as_py()
        row = {"part": [key[0].as_py()], "block": [key[1].as_py()], "size": [len(digests)], "total": [total],
               "root": [_levels(digests, total)[-1][0]], "digests": ["".join(digests)]}
        return pa.table({**{k: pa.array(v, pa.string() if isinstance(v[0], str) else pa.int64()) for k, v in row.items()},
                         **{c: pa.array([table[c].to_pylist()], pa.list_(table.schema.field(c).type)) for c in keep}})

    named = nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
    return written(named.select("part", "block", "pos", "total", "digest", *keep).groupBy("part", "block").applyInArrow(pack, schema), label)


def _split(digests: str) -> list[str]:
    return [digests[i : i + 64] for i in range(0, len(digests), 64)]


_WAYS = "part string, pos long, siblings string, places array<int>, subroot string, top string"


def _down(blocks: DataFrame, ways: DataFrame | None, label: str) -> DataFrame:
    """For each child of the blocks its way up: the siblings of its own storey, then those of its block's own way."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                levels = _levels(_split(row["digests"]), row["total"])
                out = []
                for i in range(row["size"]):
                    siblings, places = _around(levels, i)
                    out.append((row["part"], row["block"] * BLOCK + i, "".join(siblings) + (row["siblings"] or ""), places + list(row["places"] or []), row["subroot"] or row["root"], row["top"] or row["root"]))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.string(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.string(), pa.string()])], [x.split()[0] for x in _WAYS.split(", ")])

    return written(_joined(blocks.select("part", "block", "size", "total", "root", "digests"), ways).mapInArrow(run, _WAYS), label)


def _joined(blocks: DataFrame, ways: DataFrame | None) -> DataFrame:
    if ways is None:  # one block is the whole part: nothing is above it
        none = {"siblings": F.lit(None).cast("string"), "places": F.lit(None).cast("array<int>"), "subroot": F.lit(None).cast("string"), "top": F.lit(None).cast("string")}
        return blocks.withColumns(none)
    return blocks.join(ways.withColumnRenamed("pos", "block"), ["part", "block"])


def _storeys(nodes: DataFrame, held: str = "") -> list[DataFrame]:
    """Blocks of every storey of all parts, the lowest first. The number of storeys is the logarithm of the largest part to the
    base ``BLOCK``. A part whose storey is one block repeats that root above, as a tree of one node."""
    out = [_blocks(nodes, "blocks0", held)]
    while out[-1].where("block > 0").limit(1).count():
        above = out[-1].select("part", F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).cast("long").alias("total"), F.col("root").alias("digest"))
        out.append(_blocks(above, f"blocks{len(out)}"))
    return out


class Manifest:
    """The stored tree: ``blocks`` of leaves with keys, and ``ways``, the way up of every block."""

    def __init__(self, blocks: DataFrame, ways: DataFrame):
        self.blocks, self.ways = blocks, ways

    def leaves(self) -> DataFrame:
        """One row per leaf: key, part, pos, leaf, subroot, root, its proof ``siblings`` (digests one after the other, level by
        level), ``places`` (how many of them stand left and right on each level), and of a tampered leaf ``tampered`` and
        ``version``, the copied nodes from its parent to the version's root."""
        schema = "key long, part string, pos long, leaf string, subroot string, root string, siblings string, places array<int>, tampered string, version array<string>"
        kinds = [pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4, pa.list_(pa.int32()), pa.string(), pa.list_(pa.string())]

        def run(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    digests = _split(row["digests"])
                    levels = _levels(digests, row["total"])
                    above, steps = _split(row["siblings"]), list(row["places"])
                    out = []
                    for i, (key, leaf, other) in enumerate(zip(row["keys"], digests, row["tampered"])):
                        inside, places = _around(levels, i)
                        # The version's copies inside the block, then those of the storeys above.
                        version = None if other is None else copied_path(other, inside + above, places + steps)
                        out.append((key, row["part"], row["block"] * BLOCK + i, leaf, row["subroot"], row["top"], "".join(inside) + row["siblings"], places + steps, other, version))
                    for at in range(0, len(out), 512):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 512]), kinds)], [x.split()[0] for x in schema.split(", ")])

        return _joined(self.blocks, self.ways).mapInArrow(run, schema)


def build(leaves: DataFrame) -> Manifest:
    """The tree over (key long, part string, leaf string, tampered string). Parts are ordered by name, null first; leaves by key,
    null first, then by digest, so repeated rows have their place. An empty table gives an empty tree."""
    # A name that sorts like the part and is never null.
    named = leaves.select("key", F.when(F.col("part").isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), "part")).alias("part"), F.col("leaf").alias("digest"), "tampered")
    named = written(named, "leaves")
    placed = _positions(named, ["key", "digest"], named.count()).withColumnRenamed("key", "keys")
    storeys = _storeys(placed, "keys long, tampered string")
    top = storeys[-1].select("part", F.col("root").alias("digest"))  # one block of each part
    # The tree of the subroots, with one part of its own.
    roots = top.select(F.lit("").alias("part"), F.col("part").alias("name"), "digest")
    placed = written(_positions(roots, ["name"], roots.count()), "subroots")
    joined = _ways(_storeys(placed.select("part", "pos", "total", "digest")))
    ways = placed.join(joined.drop("part", "subroot"), "pos").select(F.col("name").alias("part"), F.lit(0).cast("long").alias("pos"), "siblings", "places", F.col("digest").alias("subroot"), "top")
    for level in range(len(storeys) - 1, 0, -1):
        ways = _down(storeys[level], ways, f"ways{level}")
    return Manifest(storeys[0], ways)


def _ways(storeys: list[DataFrame]) -> DataFrame:
    ways = None
    for level in range(len(storeys) - 1, -1, -1):
        ways = _down(storeys[level], ways, f"top{level}")
    return ways


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(df: DataFrame, tampered: Column | None = None) -> Manifest:
    """The manifest of a documents table: a leaf hashes doc_id, source, lang, n_chars and text, and parts are languages.
    ``tampered`` marks rows whose text had its capitals A-Z lowered after the manifest was made.

    A null in any column is hashed as ``-``, an empty text as ``0:``. Rows with one id, or none, are leaves of their own; a null id
    stands first. Texts of any length are hashed where they are read, and only digests are shuffled. Extra columns are not read.
    """
    cells = [df[f"`{c}`"] for c in COLUMNS]
    other = F.when(F.lit(False) if tampered is None else tampered, hashed(*cells[:4], lower_ascii(df["text"].cast("string"))))
    return build(df.select(df["doc_id"].cast("long").alias("key"), df["lang"].cast("string").alias("part"), hashed(*cells).alias("leaf"), other.alias("tampered")))


def third(doc_id: Column) -> Column:
    """Is the id's checksum divisible by three? A null id's is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0, F.lit(False))


def audit(df: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Documents whose id's crc32 is divisible by 3 are tampered with; their folded root is that of their version. The others' is
    folded from their own leaf and proof. An empty table gives no rows.
    """
    rows = manifest(df, third(df["doc_id"])).leaves()
    fold = F.when(F.col("tampered").isNotNull(), F.coalesce(F.element_at("version", F.when(F.size("version") > 0, -1)), "tampered")).otherwise(folded(F.col("leaf"), F.col("siblings"), F.col("places")))
    rows = rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.col("siblings").cast("binary"), 256).alias("proof_sha256"), fold.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


def folded(leaf: Column, siblings: Column, places: Column) -> Column:
    """The root that a leaf and its proof lead to, level by level."""
    start = F.struct(leaf.alias("digest"), F.lit(0).alias("at"))

    def step(acc, level):
        left, right = F.get(places, 2 * level), F.get(places, 2 * level + 1)
        text = F.concat(F.substr(siblings, acc["at"] * 64 + 1, left * 64), acc["digest"], F.substr(siblings, (acc["at"] + left) * 64 + 1, right * 64))
        return F.struct(F.sha2(text.cast("binary"), 256).alias("digest"), (acc["at"] + left + right).alias("at"))

    levels = F.floor(F.size(places) / 2).cast("int")
    return F.aggregate(F.when(levels > 0, F.sequence(F.lit(0), levels - 1)).otherwise(F.array().cast("array<int>")), start, step, lambda acc: acc["digest"])
