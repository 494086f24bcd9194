"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks of documents by hash. A source's target says how many of its blocks are drawn; blocks stand in a
permuted order, and the last one is taken in part. The quotas of all sources are split over the output shards by a
binary tree: a node deals its counts to its two halves by one multivariate hypergeometric draw, so quotas stay exact and shards get
disjoint runs of each source's permuted blocks. Rows are shuffled inside their shard by hash.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import SPACE_RUN, documents, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 200_000
MOST_BLOCKS = 1 << 16  # of one source; beyond, blocks get larger
SHARD_WORDS = 1_000_000
TOP_NODES = 256  # of the tree that the driver splits; below them tasks go on


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> list[float]:
    """Words to take of each source (given in order): total share by weight, held at ``most`` times its size, excess dealt again."""
    left, open_, out = share * sum(s for _, s in sizes), set(range(len(sizes))), [0.0] * len(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    while open_:
        total = sum(weight[i] for i in open_)
        full = {i for i in open_ if left * weight[i] / total > most * sizes[i][1]}
        for i in full or open_:
            out[i] = most * sizes[i][1] if full else left * weight[i] / total
        if not full:
            break
        left -= sum(out[i] for i in full)
        open_ -= full
    return out


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACE_RUN.replace("[", "[^"))).cast("long")


def _split(node: tuple[int, int, np.ndarray, np.ndarray], seed: int):
    """(first shard, end, counts, offsets) in two halves."""
    lo, hi, counts, offsets = node
    mid = (lo + hi) // 2
    rng = np.random.default_rng([seed, lo, hi])
    total = int(counts.sum())
    left = np.zeros_like(counts)
    want = round(total * (mid - lo) / (hi - lo))
    for i, c in enumerate(counts):  # one multivariate draw, source by source
        if want and c:
            rest = total - int(c)
            take = _hypergeometric(rng, int(c), rest, want)
            left[i] = take
            want -= take
            total = rest
        else:
            total -= int(c)
    return (lo, mid, left, offsets), (mid, hi, counts - left, offsets + left)


def _hypergeometric(rng, good: int, bad: int, n: int) -> int:
    return n if bad == 0 else int(rng.hypergeometric(good, bad, n))


def shard_runs(spark, quotas: list[int], shards: int, seed: int) -> DataFrame:
    """(shard, src, first, count): the run of each source's permuted draws that a shard gets."""
    nodes = [(0, shards, np.array(quotas, np.int64), np.zeros(len(quotas), np.int64))]
    while len(nodes) < TOP_NODES and any(hi - lo > 1 for lo, hi, _, _ in nodes):
        nodes = [x for n in nodes for x in (_split(n, seed) if n[1] - n[0] > 1 else (n,))]

    def expand(frames):
        for frame in frames:
            for lo, hi, counts, offsets in frame.itertuples(index=False):
                todo = [(lo, hi, np.array(counts, np.int64), np.array(offsets, np.int64))]
                while todo:
                    node = todo.pop()
                    if node[1] - node[0] > 1:
                        todo += _split(node, seed)
                    else:
                        src = np.flatnonzero(node[2])
                        yield pd.DataFrame({"shard": node[0], "src": src, "first": node[3][src], "count": node[2][src]})

    rows = [(int(lo), int(hi), c.tolist(), o.tolist()) for lo, hi, c, o in nodes]
    top = spark.createDataFrame(rows, "lo long, hi long, counts array<long>, offsets array<long>")
    return top.mapInPandas(expand, "shard long, src long, first long, count long")


def plan_mix(df: DataFrame, seed: int = 7, block_words: int = BLOCK_WORDS, carry: bool = False, weights=WEIGHTS, share: float = SHARE, most: float = MOST):
    """(documents with size, source size, target, block, draws ``taken_times``), and the drawn blocks.

    A document is taken 0, 1 or 2 times (``most`` times at most). Blocks are drawn whole; in the source's last block documents are taken
    by hash order up to the middle of the one that crosses the target.
    """
    docs = documents(df, carry=carry, extra=("source",))
    row = ["row"] if carry else []
    docs = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), *row)
    found = docs.groupBy("source").agg(F.sum("size").alias("s")).collect()  # one row per source
    found.sort(key=lambda r: (r.source is None, (r.source or "").encode("utf-32-be")))
    sizes = [(r.source, int(r.s or 0)) for r in found]
    goal = targets(sizes, weights, share, most)
    blocks = [max(1, min(MOST_BLOCKS, math.ceil(s / block_words))) for _, s in sizes]
    table = df.sparkSession.createDataFrame(
        [(i, src, s, float(t), b) for i, ((src, s), t, b) in enumerate(zip(sizes, goal, blocks))],
        "src long, source string, source_size long, target double, n_blocks long",
    )
    docs = docs.join(F.broadcast(table), docs["source"].eqNullSafe(table["source"])).drop(table["source"])
    return docs.withColumn("block", F.pmod(F.col("h"), F.col("n_blocks"))), table


def draws(docs: DataFrame) -> DataFrame:
    """Per source and block: how often it is drawn whole, and the words still wanted from it when it is the last one."""
    block = docs.groupBy("src", "block").agg(F.sum("size").alias("words"), F.first("source_size").alias("source_size"), F.first("target").alias("target"))
    order = Window.partitionBy("src").orderBy(F.xxhash64("src", "block"), "block")  # block rows only, at most MOST_BLOCKS of a source
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    block = block.withColumns({"place": F.row_number().over(order) - 1, "before": F.sum("words").over(order) - F.col("words"), "whole": whole.cast("int")})
    wanted = F.col("target") - F.col("whole") * F.col("source_size") - F.col("before")
    return block.select("src", "block", "place", (F.col("whole") + F.when(wanted >= F.col("words"), 1).otherwise(0)).alias("times"),
                        F.when((wanted > 0) & (wanted < F.col("words")), wanted).alias("part"))


def taken(docs: DataFrame, small: DataFrame, drawn: DataFrame) -> DataFrame:
    """The documents with ``times``: how often the mix takes each. ``small``: the same documents without texts."""
    # Only the one boundary block of each source is ordered document by document.
    order = Window.partitionBy("src").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = small.join(drawn.where("part is not null"), ["src", "block"]).withColumn("upto", F.sum("size").over(order))
    cut = edge.where(F.col("upto") - F.col("size") / 2 <= F.col("part")).groupBy("src").agg(F.max(F.struct("h", "doc_id")).alias("cut"))
    inside = F.col("part").isNotNull() & F.coalesce(F.struct("h", "doc_id") <= F.col("cut"), F.lit(False))
    rows = docs.join(drawn.join(cut, "src", "left"), ["src", "block"])
    return rows.withColumn("times", F.col("times") + inside.cast("int")).drop("part", "cut")


def dealt(docs: DataFrame, small: DataFrame, drawn: DataFrame, sources: DataFrame, seed: int, shard_words: int) -> DataFrame:
    """The documents once for each copy that the tree deals to a shard, with ``copy`` and ``shard``. ``small``: the same documents
    without texts."""
    spark = docs.sparkSession
    copies = F.col("times") + F.col("part").isNotNull().cast("int")
    units = drawn.where(copies > 0).select("src", "block", "place", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    # A unit is one draw of a block; its rank in the source's permuted order: first copies first.
    rank = F.row_number().over(Window.partitionBy("src").orderBy("copy", "place")) - 1
    units = units.withColumn("rank", rank)
    quotas = {r.src: r.n for r in units.groupBy("src").agg(F.count(F.lit(1)).alias("n")).collect()}
    known = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("t")).first()
    shards = max(1, math.ceil((known.t or 0) / shard_words))
    runs = shard_runs(spark, [quotas.get(i, 0) for i in range(known.n)], shards, seed)
    runs = runs.select("shard", "src", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("count") - 1)).alias("rank"))
    where = units.join(runs, ["src", "rank"]).select("src", "block", "copy", "shard")
    rows = taken(docs, small, drawn).where("times > 0 and size > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return rows.join(where, ["src", "block", "copy"])


def mix_report(df: DataFrame, seed: int = 7, shard_words: int = SHARD_WORDS, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken. ``taken`` counts the copies that the tree dealt to shards.

    Null text has size 0; null sources are one source, last in order. Repeated rows and null ids each keep their row. Sources without
    words have target 0. An empty table gives no rows. The same input gives the same mix, whatever the partitions.
    """
    docs, sources = plan_mix(df, seed, **options)
    docs = written(docs.withColumn("row_no", F.monotonically_increasing_id()), "mix")  # rows of equal id and text stay apart
    copies = dealt(docs, docs, draws(docs), sources, seed, shard_words).groupBy("row_no").agg(F.count(F.lit(1)).alias("copies"))
    return docs.join(copies, "row_no", "left").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.coalesce("copies", F.lit(0))).cast("long").alias("taken"))


def mix(df: DataFrame, seed: int = 7, shard_words: int = SHARD_WORDS, **options) -> DataFrame:
    """The mixed corpus: every input column, with ``mix_copy``, ``mix_shard`` and ``mix_place`` (order inside the shard).

    Input columns of those names are replaced. Documents without words are not taken.
    """
    docs, sources = plan_mix(df, seed, carry=True, **options)
    small = written(docs.drop("row"), "mix")
    rows = dealt(docs, small, draws(small), sources, seed, shard_words)
    place = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("h", "copy", "shard"), "doc_id", "copy")) - 1
    rows = rows.select("row", F.col("copy").alias("mix_copy"), F.col("shard").alias("mix_shard"), place.alias("mix_place"))
    keep = [F.col(f"row.`{c}`").alias(c) for c in df.columns if c.lower() not in ("mix_copy", "mix_shard", "mix_place")]
    return rows.select(*keep, "mix_copy", "mix_shard", "mix_place")
