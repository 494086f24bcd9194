"""From candidate groups to components without listing the pairs of a group: stars, exact verification in blocks, contraction.

Candidates are rows (sig, rep, n): members with a common ``sig`` may be similar, ``n`` is the size of a member's set. A set is the
sorted array of its 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import written

BLOCK = 1_000  # members of one side of a comparison in one task
BLOCK_VALUES = 1 << 19  # and values of their sets


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, label): for every vertex of the (a, b) edges the smallest one it is joined to.

    Every round contracts each vertex to the neighbour of the smallest hash, hashed anew by round: at least half of the vertices are
    expected to go, in whatever order the ids stand, so rounds grow with the logarithm of the number of vertices.
    """
    edges = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = written(edges.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct().withColumn("label", F.col("doc_id")), "labels")
    turn = 0
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))  # noqa: E731, B023
        around = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = around.groupBy("a").agg(F.min(order("b")).alias("best")).select("a", F.least(order("a"), F.col("best"))["v"].alias("to"))
        to = written(to, "to")
        labels = written(labels.join(to.select(F.col("a").alias("label"), "to"), "label", "left").select("doc_id", F.coalesce("to", "label").alias("label")), "labels")
        moved = edges.join(to.withColumnRenamed("to", "x"), "a").select("x", "b").join(to.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
        edges = written(moved.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        turn += 1
    least = labels.groupBy("label").agg(F.min("doc_id").alias("least"))
    return labels.join(least, "label").select("doc_id", F.col("least").alias("label"))


def centred(rows: DataFrame) -> DataFrame:
    """Adds each group's ``centre``, the member that shares most with others (then the smallest), and its size ``centre_n``."""
    size = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    rows = rows.join(size, "sig")
    rows = written(rows.join(rows.groupBy("rep").agg(F.sum("freq").alias("weight")), "rep"), "weighted")
    centre = rows.groupBy("sig").agg(F.max(F.struct("weight", (-F.col("rep")).alias("r"), "n")).alias("c"))
    return rows.select("sig", "rep", "n").join(centre.select("sig", (-F.col("c.r")).alias("centre"), F.col("c.n").alias("centre_n")), "sig")


def star(rows: DataFrame, need: int, of: int) -> DataFrame:
    """(a, b): every group's centre with each other member whose size allows a similarity of need/of."""
    near = of * F.least("n", "centre_n") >= need * F.greatest("n", "centre_n")
    return rows.where((F.col("rep") != F.col("centre")) & near).select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()


def similar(pairs: DataFrame, sets: DataFrame, need: int, of: int, sieve=None) -> DataFrame:
    """The (a, b) pairs whose sets have a Jaccard similarity of need/of at least. ``sieve(x, y)`` may rule a pair out before."""
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("y")), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if sieve is not None and not sieve(x, y):
                    keep.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(common > 0 and of * common >= need * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


class Members:
    """The sets of one comparison as one array of dense numbers, so that one set meets all others in a gather and a sum."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(self.n)[:-1]))
        values, self.ids = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(values), bool)

    def common(self, x: int, others: np.ndarray) -> np.ndarray:
        """How many values set ``x`` shares with each of the others."""
        mine = self.ids[self.starts[x] : self.starts[x] + self.n[x]]
        self.mark[mine] = True
        size = self.n[others]
        ends = np.cumsum(size)
        at = np.arange(int(ends[-1])) + np.repeat(self.starts[others] - (ends - size), size)
        out = np.add.reduceat(self.mark[self.ids[at]], ends - size, dtype=np.int64)
        self.mark[mine] = False
        return out


def unite(reps: np.ndarray, labels: np.ndarray, lead: np.ndarray, sets: list[np.ndarray], need: int, of: int, sieve=None) -> list[tuple[int, int]]:
    """Links that join the labels of similar members: every member of ``lead`` against all whose label differs.

    Members united on the way are not compared again, so at most one link less than labels comes out. ``sieve(sets)`` gives a function
    (x, others) that tells which of the others may be similar.
    """
    members, label, links = Members(sets), labels.copy(), []
    may = sieve(sets) if sieve else None
    for x in np.flatnonzero(lead).tolist():
        n = members.n[x]
        y = np.flatnonzero((label != label[x]) & (of * np.minimum(members.n, n) >= need * np.maximum(members.n, n)))
        if may is not None and len(y):
            y = y[may(x, y)]
        if not len(y):
            continue
        common = members.common(x, y)
        y = y[of * common >= need * (members.n[y] + n - common)]
        for i in y.tolist():
            if label[i] != label[x]:
                links.append((int(reps[x]), int(reps[i])))
                label[label == label[i]] = label[x]
    return links


def apart(rows: DataFrame, label: DataFrame, sets: DataFrame, need: int, of: int, sieve=None) -> DataFrame:
    """(a, b): the links that the stars left out, from groups whose members are in several components.

    Groups with one centre are compared together. Members of the largest component of such a hub are compared with the others only,
    so rows follow the members that stay apart. Both sides are cut into blocks of bounded size that meet in tasks of their own, and a
    task puts out no more links than it joins components.
    """
    placed = rows.join(label.withColumnRenamed("doc_id", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    open_ = placed.groupBy("sig").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("sig")
    hubs = written(placed.join(open_, "sig").select(F.col("centre").alias("hub"), "rep", "n", "label").distinct(), "hubs")
    sized = hubs.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("v"))
    largest = sized.withColumn("place", F.row_number().over(Window.partitionBy("hub").orderBy(F.desc("v"), "label"))).withColumn("main", F.col("place") == 1)
    blocks = lambda flag: F.greatest(F.ceil(F.sum(F.when(flag, F.col("m"))) / BLOCK), F.ceil(F.sum(F.when(flag, F.col("v"))) / BLOCK_VALUES), F.lit(1)).cast("long")
    cut = largest.groupBy("hub").agg(F.max(F.when(F.col("main"), F.col("label"))).alias("main"), blocks(~F.col("main")).alias("lead_blocks"), blocks(F.lit(True)).alias("all_blocks"))
    hubs = hubs.join(cut, "hub").withColumn("h", F.xxhash64("rep"))
    numbers = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    leads = hubs.where(F.col("label") != F.col("main")).withColumn("i", F.pmod("h", "lead_blocks")).withColumn("j", numbers("all_blocks")).withColumn("lead", F.lit(True))
    rest = hubs.withColumn("j", F.pmod("h", "all_blocks")).withColumn("i", numbers("lead_blocks")).withColumn("lead", F.lit(False))
    columns = ["hub", "i", "j", "rep", "label"]
    # A leading member also stands in the other role of one block; it is told to a task once.
    told = leads.select(*columns, "lead").unionByName(rest.select(*columns, "lead")).groupBy(*columns).agg(F.max("lead").alias("lead"))
    told = told.join(sets.select(F.col("doc_id").alias("rep"), "set"), "rep")

    def look(table):
        raw = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
        reps, labels = table["rep"].to_numpy(), table["label"].to_numpy()
        order = np.argsort(reps)
        found = unite(reps[order], labels[order], table["lead"].to_numpy(zero_copy_only=False)[order], [raw[i] for i in order.tolist()], need, of, sieve)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return told.groupBy("hub", "i", "j").applyInArrow(look, "a long, b long").distinct()


def linked(rows: DataFrame, sets, need: int, of: int, pair_sieve=None, group_sieve=None) -> DataFrame:
    """(a, b): verified links that join all similar members of the candidate groups. ``sets(ids)`` gives (doc_id, set) of some ids."""
    rows = written(centred(rows), "centred")
    held = written(sets(rows.select(F.col("rep").alias("doc_id")).distinct()), "sets")
    links = written(similar(star(rows, need, of), held, need, of, pair_sieve), "links")
    return links.unionByName(apart(rows, components(links), held, need, of, group_sieve))
