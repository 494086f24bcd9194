"""Near-duplicates by bottom-k MinHash sketches.

A document's set is that of its distinct 4-word shingles under one hash function. Its sketch keeps the ``SKETCH`` smallest hashes; of a
smaller set that is all of it. The smallest hashes of a union are a uniform sample of it, and those that both sets have estimate the
Jaccard similarity.

Inverted lists of retained values give the documents that overlap. A pair at the threshold of 4/5 shares at least ``OVERLAP`` of
``SKETCH`` values but with probability 2e-18 (small sets: surely), so ordered by rarity, all but the last ``OVERLAP - 1`` values of a sketch
are looked up, and values that no other sketch retains are not looked up at all. Frequent passages so lead nowhere by themselves. Pairs
whose union sketch estimates too little are left, the rest are verified on the full sets. Links that a star over each list misses are
found in blocks of bounded size (``linking``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import documents, from_planes, mix64, planes, slices, small_batches, written
from weirflow.llm.jaccard import WordHashes, shingle_sets
from weirflow.llm.linking import components, linked

WIDTH = 4
NEED, OF = 4, 5
SKETCH = 128
OVERLAP = 56
RANGE_VALUES = 1 << 19  # retained values of one range, at most on average
FLUSH = 1 << 18  # values gathered in a task before they are sent
SLICE_BYTES = 1 << 20

_SENT = "r long, data binary, doc_id long, n long, set_hash long, set_check long"
_NAMES, _KINDS = [x.split()[0] for x in _SENT.split(", ")], [pa.int64(), pa.binary(), *[pa.int64()] * 4]


def _sent(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_NAMES, _KINDS)], _NAMES)


def _emit(ranges: int):
    """One row about each document, and the retained values with their documents, packed by range of the value."""

    def run(batches):
        cache, known, values, owners, size = WordHashes(), set(), [], [], 0

        def flush():
            v, o = np.concatenate(values), np.concatenate(owners)
            r = ((mix64(v) >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)  # retained values are small: spread anew
            order = np.lexsort((v, r))
            v, o, r = v[order], o[order], r[order]
            cuts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1], [True])))
            return _sent(r=r[cuts[:-1]].astype(np.int64), data=[planes(v[a:b]) + planes(o[a:b]) for a, b in zip(cuts[:-1], cuts[1:])])

        for ids, texts in slices(batches, SLICE_BYTES):
            about = []
            for doc, s in zip(ids, shingle_sets(texts, cache, WIDTH)):
                key = (int(s.sum(dtype=np.uint64)), int(mix64(s).sum(dtype=np.uint64))) if len(s) else (0, 0)
                about.append((doc, len(s), *(x - (1 << 63) for x in key)))
                if doc is not None and len(s) and key not in known:  # a task sends equal sets once
                    known.add(key)
                    values.append(s[:SKETCH])
                    owners.append(np.full(len(values[-1]), doc, np.int64))
                    size += len(values[-1])
            yield _sent(**dict(zip(_NAMES[2:], zip(*about))))
            if size >= FLUSH:
                yield flush()
                values, owners, size = [], [], 0
        if size:
            yield flush()

    return run


def _retained_twice(table):
    """One range: the values that two or more documents retain."""
    values, owners = [], []
    for data in table["data"].to_pylist():
        half = len(data) // 2
        values.append(from_planes(data[:half], np.uint64))
        owners.append(from_planes(data[half:], np.int64))
    v, o = np.concatenate(values), np.concatenate(owners)
    order = np.argsort(v, kind="stable")
    v, o = v[order], o[order]
    same = v[1:] == v[:-1]
    shared = np.append(same, False) | np.insert(same, 0, False)
    return pa.table({"sig": v[shared].view(np.int64), "doc_id": o[shared]})


def union_estimate(x: np.ndarray, y: np.ndarray, k: int = SKETCH) -> tuple[int, int]:
    """(common, sampled): of the k smallest hashes of the union of two sorted sets, how many both have."""
    union = np.union1d(x[:k], y[:k])[:k]
    return len(np.intersect1d(np.intersect1d(x[:k], y[:k], assume_unique=True), union, assume_unique=True)), len(union)


def plausible(x: np.ndarray, y: np.ndarray) -> bool:
    common, sampled = union_estimate(x, y)
    return SKETCH * common >= OVERLAP * sampled


def plausible_among(sets: list[np.ndarray]):
    """The same for one member against many others of a group at once."""
    size = np.array([min(len(s), SKETCH) for s in sets], np.int64)
    starts = np.concatenate(([0], np.cumsum(size)[:-1]))
    values, ids = np.unique(np.concatenate([s[:SKETCH] for s in sets]), return_inverse=True)  # numbers in the order of hashes
    mark = np.zeros(len(values), np.int64)

    def may(x: int, others: np.ndarray) -> np.ndarray:
        mine = ids[starts[x] : starts[x] + size[x]]
        mark[mine] = 1
        smaller = np.cumsum(mark)  # how many of x are not above a value
        n = size[others]
        ends = np.cumsum(n)
        first = ends - n
        inside = np.arange(int(ends[-1])) - np.repeat(first, n)
        at = ids[np.repeat(starts[others], n) + inside]
        both = mark[at]
        run = np.cumsum(both)
        run -= np.repeat(run[first] - both[first], n)
        rank = inside + 1 + smaller[at] - run  # of the value in the union
        common = np.add.reduceat(both * (rank <= SKETCH), first)
        sampled = np.minimum(SKETCH, size[x] + n - np.add.reduceat(both, first))
        mark[mine] = 0
        return SKETCH * common >= OVERLAP * sampled

    return may


def _sets(df: DataFrame) -> DataFrame:
    def run(batches):
        cache = WordHashes()
        for ids, texts in slices(batches, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([s.tobytes() for s in shingle_sets(texts, cache, WIDTH)], pa.binary())], ["doc_id", "set"])

    return df.mapInArrow(run, "doc_id long, set binary")


def _looked_up(retained: DataFrame, about: DataFrame) -> DataFrame:
    """(sig, rep, n): the shared values that each distinct set looks up, its rarest ones. A set is named by its smallest document."""
    key = ["set_hash", "set_check", "n"]
    classes = about.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    rep = about.join(classes, key).select("doc_id", "rep", "n").distinct()
    rows = retained.join(rep, "doc_id").select("sig", "rep", "n").distinct()
    rows = written(rows.join(rows.groupBy("sig").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1"), "sig"), "shared")
    rarest = Window.partitionBy("rep", "n").orderBy("freq", "sig")  # a sketch at most
    needed = F.least(F.lit(OVERLAP), F.ceil(F.col("n") * NEED / OF))
    rows = rows.withColumns({"place": F.row_number().over(rarest), "all": F.count(F.lit(1)).over(Window.partitionBy("rep", "n"))})
    return written(rows.where(F.col("place") <= F.col("all") - needed + 1).select("sig", "rep", "n"), "looked_up")


def near_duplicates(df: DataFrame, range_values: int = RANGE_VALUES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id linked to it), kept (is it that document itself?).

    Null and empty texts have no set, link with nothing and are kept. A text of fewer than four words is one shingle. Rows with one id
    are one document with several texts: each row is returned with its own size, and links of any of them count. Rows with a null id
    link with nothing, have a null component and are kept. Texts of any length are read whole. An empty table gives no rows; extra
    columns are not read. Shingles are compared by 64-bit hashes.
    """
    small_batches(df.sparkSession)
    docs = documents(df)
    ranges = max(1, docs.count() * SKETCH // range_values)
    sent = written(docs.mapInArrow(_emit(ranges), _SENT), "sketches")
    about = sent.where("data is null").select("doc_id", "n", "set_hash", "set_check")
    known = about.where("doc_id is not null and n > 0")
    retained = sent.where("data is not null").select("r", "data").groupBy("r").applyInArrow(_retained_twice, "sig long, doc_id long")
    links = linked(_looked_up(retained, known), lambda ids: _sets(docs.join(ids, "doc_id")), NEED, OF, plausible, plausible_among)
    # Documents of one set are linked through the smallest of them.
    key = ["set_hash", "set_check", "n"]
    first = known.groupBy(*key).agg(F.min("doc_id").alias("a"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    label = components(links.unionByName(known.join(first, key).select("a", F.col("doc_id").alias("b"))))
    rows = about.join(label, "doc_id", "left").withColumn("component_id", F.coalesce("label", "doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"))
