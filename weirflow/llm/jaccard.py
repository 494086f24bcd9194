"""N-gram Jaccard join by PartEnum signatures.

A document's set is that of its distinct 5-word shingles. Sets are taken in size bands: band j holds pairs whose smaller set has
2^j to 2^(j+1)-1 shingles. Within a band the feature domain is split into a fixed number of parts, and each non-empty part of a set
gives one signature: band, part and the hash of what the set has there. Two sets that differ in k shingles differ in k parts
at most, so with more than k parts one part is equal. Signatures that only one set has cannot join anything; of the others a set
needs only its rarest k+1, counting the unique ones (any pair within the bound shares one of these).
Sets with a common signature are linked through the member with most in common, pairs are verified exactly, and what stays
apart inside a signature's group is compared once more inside the task that holds it, so no link is lost while a large group never
lists its pairs.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import documents, from_planes, mix64, planes, slices, small_batches, text_bytes, written
from weirflow.llm.linking import components, linked

WIDTH = 5
NEED, OF = 3, 4  # Jaccard similarity of at least 3/4
RANGE_BYTES = 12 << 20  # of text for one signature range
FLUSH = 1 << 20  # signatures gathered in a task before they are sent


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_sets(texts: list[bytes], cache: WordHashes, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    split = [t.lower().split() for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    h = np.fromiter(map(cache.__getitem__, chain.from_iterable(split)), np.uint64, int(counts.sum()))
    mult = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - width + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(width):
        rolled = mix64(rolled + h[k : k + n] * mult[k])
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(rolled[at : at + c - width + 1]))
        elif c:
            short = np.zeros(1, np.uint64)
            for k in range(c):
                short = mix64(short + h[at + k : at + k + 1] * mult[k])
            out.append(mix64(short + np.uint64(c)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out


def bands(size: int) -> list[tuple[int, int, int]]:
    """(band, parts, most differing shingles with a partner there) for a set of that size."""
    out = []
    j = size.bit_length() - 1
    for b in (j, j - 1):
        if b < 0:
            continue
        low, high = 1 << b, (2 << b) - 1  # sizes of the smaller set
        if b == j:
            partner = size * OF // NEED  # the largest
        elif size * NEED <= high * OF:
            partner = high
        else:
            continue
        # |A| + |B| - 2 I with I >= NEED (|A| + |B|) / (NEED + OF)
        k = (size + partner) * (OF - NEED) // (OF + NEED)
        parts = low * 2 if b < 4 else low if b < 8 else low * 3 // 4
        out.append((b, max(parts, 1), k))
    return out


def signatures(s: np.ndarray) -> list[tuple[int, int, np.ndarray]]:
    """(band, unique signatures that may be spared, signatures) of a set. A set with few non-empty parts also signs its empty ones."""
    out = []
    for band, parts, k in bands(len(s)) if len(s) else []:
        part = ((s >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # s is sorted, so parts are runs
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        held = part[starts]
        content = np.add.reduceat(mix64(s), starts)
        spare = len(held) - k - 1
        if spare < 0:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), held)
            held, content, spare = np.concatenate((held, empty)), np.concatenate((content, np.zeros(len(empty), np.uint64))), 0
        sig = mix64(content ^ mix64(held + (np.uint64(band) << np.uint64(48)) + np.uint64(1)))
        out.append((band, spare, (sig & ~np.uint64(63)) | np.uint64(band)))  # the low bits tell the band
    return out


_SENT = "r long, data binary, doc_id long, n long, set_hash long, set_check long, spare0 long, spare1 long"


def _emit(ranges: int):
    """Documents to packed (signature, document) arrays by signature range, and one row about each document."""
    names = [x.split()[0] for x in _SENT.split(", ")]
    kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 6]

    def run(batches):
        cache, sent, sigs, owners, size = WordHashes(), set(), [], [], 0

        def flush():
            s, o = np.concatenate(sigs), np.concatenate(owners)
            order = np.argsort(s)
            s, o = s[order], o[order]
            r = ((s >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            cuts = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1], [True])))
            rows = [(int(r[a]), planes(s[a:b]) + planes(o[a:b])) for a, b in zip(cuts[:-1], cuts[1:])]
            none = [None] * len(rows)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([[x[0] for x in rows], [x[1] for x in rows], *[none] * 6], kinds)], names)

        for ids, texts in slices(batches):
            info = []
            for doc, s in zip(ids, shingle_sets(texts, cache)):
                signed = signatures(s)
                key = (int(s.sum(dtype=np.uint64)), int(mix64(s).sum(dtype=np.uint64))) if len(s) else (0, 0)
                spare = {b: x for b, x, _ in signed}
                top = len(s).bit_length() - 1
                first = doc is not None and len(s) and key not in sent
                info.append((ranges + (key[0] % ranges), None, doc, len(s), *(x - (1 << 63) for x in key), spare.get(top), spare.get(top - 1)))
                if first:  # equal sets are sent once by each task
                    sent.add(key)
                    for _, _, sig in signed:
                        sigs.append(sig)
                        owners.append(np.full(len(sig), doc, np.int64))
                        size += len(sig)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*info), kinds)], names)
            if size >= FLUSH:
                yield flush()
                sigs, owners, size = [], [], 0
        if size:
            yield flush()

    return run


_MET = "kind int, sig long, doc_id long, n long, set_hash long, set_check long, spare0 long, spare1 long"


def _meet(table):
    """One range: the signatures that two or more documents have, and the rows about documents passed on."""
    packed = table.filter(pc.is_valid(table["data"]))
    about = table.filter(pc.is_null(table["data"]))
    sigs, owners = [], []
    for data in packed["data"].to_pylist():
        half = len(data) // 2
        sigs.append(from_planes(data[:half], np.uint64))
        owners.append(from_planes(data[half:], np.int64))
    s, o = (np.concatenate(sigs), np.concatenate(owners)) if sigs else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(s)
    s, o = s[order], o[order]
    same = s[1:] == s[:-1]
    shared = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(s) else np.zeros(0, bool)
    s, o = s[shared].view(np.int64), o[shared]
    null = pa.nulls
    met = pa.table([pa.array(np.ones(len(s), np.int32)), pa.array(s), pa.array(o), *(null(len(s), pa.int64()) for _ in range(5))], names=[x.split()[0] for x in _MET.split(", ")])
    rows = len(about)
    kept = pa.table([pa.array(np.zeros(rows, np.int32)), null(rows, pa.int64()), *(about[c] for c in ("doc_id", "n", "set_hash", "set_check", "spare0", "spare1"))], names=met.column_names)
    return pa.concat_tables([met, kept])


def _sets(df: DataFrame) -> DataFrame:
    def run(batches):
        cache = WordHashes()
        for ids, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([s.tobytes() for s in shingle_sets(texts, cache)], pa.binary())], ["doc_id", "set"])

    return df.mapInArrow(run, "doc_id long, set binary")


def _links(met: DataFrame, about: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): verified links that join all similar classes; a class is a set, named by its smallest document."""
    classes = about.where("doc_id is not null and n > 0").groupBy("set_hash", "set_check", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("spare0").alias("spare0"), F.first("spare1").alias("spare1"))
    member = about.where("n > 0").select("doc_id", "set_hash", "set_check", "n").join(classes, ["set_hash", "set_check", "n"]).select("doc_id", "rep", "n", "spare0", "spare1").distinct()
    # Signatures by class; those of one class only join nothing.
    rows = met.select("sig", "doc_id").join(member, "doc_id").select("sig", "rep", "n", "spare0", "spare1").distinct()
    freq = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    rows = written(rows.join(freq, "sig"), "shared")
    band = F.col("sig").bitwiseAND(F.lit(63))
    rows = rows.withColumn("band", band)
    own = Window.partitionBy("rep", "band").orderBy("freq", "sig")  # at most the parts of one set
    spare = F.when(2 * F.pow(F.lit(2.0), F.col("band")) > F.col("n"), F.col("spare0")).otherwise(F.col("spare1"))
    spare = F.coalesce(spare, F.lit(0))
    count = F.count(F.lit(1)).over(Window.partitionBy("rep", "band"))
    rows = rows.withColumns({"place": F.row_number().over(own), "all": count}).where(F.col("place") <= F.col("all") - spare)
    rows = written(rows.select("sig", "rep", "n"), "prefix")
    return linked(rows, lambda ids: _sets(docs.join(ids, "doc_id")), NEED, OF)


def near_duplicates(df: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Null and empty texts have no set and link with nothing. A text of fewer words is one shingle. Rows with one id are one
    document with several texts: each row is returned with its own size, and links of any of them count. Rows with a null id link
    with nothing and have a null component. An empty table gives no rows. Shingles are compared by 64-bit hashes.
    """
    about, label = _joined(df, range_bytes)
    rows = about.join(label, "doc_id", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "doc_id").alias("component_id"))


def _joined(df: DataFrame, range_bytes: int) -> tuple[DataFrame, DataFrame]:
    small_batches(df.sparkSession)
    docs = documents(df)
    ranges = max(1, text_bytes(docs) // range_bytes)
    met = written(docs.mapInArrow(_emit(ranges), _SENT).groupBy("r").applyInArrow(_meet, _MET), "met")
    about = met.where("kind = 0").drop("kind", "sig")
    links = _links(met.where("kind = 1"), about, docs)
    # Documents of one set are linked through the smallest of them.
    same = about.where("doc_id is not null and n > 0").select("doc_id", "set_hash", "set_check", "n")
    rep = same.groupBy("set_hash", "set_check", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    copies = same.join(rep, ["set_hash", "set_check", "n"]).select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    return about, components(links.unionByName(copies))


def keep_one(df: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row of each group of similar documents: that with the smallest id.

    Rows without id are told apart by their text and stand behind all ids, so copies among them, or of a document with an id, go as well.
    Rows with one id are one document: of those with the same text one stays, different texts of an id that is kept all stay.
    Documents without words are similar to nothing.
    """
    text = F.coalesce(df["text"].cast("string"), F.lit(""))
    key = F.coalesce(df["doc_id"].cast("long"), F.xxhash64(text).bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62)))
    about, label = _joined(df.select(key.alias("doc_id"), text.alias("text")), range_bytes)
    many = about.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id", F.lit(True).alias("many"))
    told = label.select("doc_id", (F.col("label") != F.col("doc_id")).alias("later")).join(many, "doc_id", "full_outer")
    told = written(told.where("later or many").select(F.col("doc_id").alias("_key"), F.coalesce("later", F.lit(False)).alias("_later")), "told")
    # The frame may have columns of the same names: these are meant by frame, and the place gets a name that is free.
    later, mine = told["_later"], [df[f"`{c}`"] for c in df.columns]
    kept = df.join(told, key == told["_key"], "left").where(later.isNull() | ~later)
    if told.where("not _later").isEmpty():
        return kept.select(*mine)
    place = "_place"
    while place in df.columns:
        place += "_"
    one = Window.partitionBy(told["_key"], F.xxhash64(text)).orderBy(F.xxhash64(*mine))
    again = kept.where(told["_key"].isNotNull()).select(*mine, F.row_number().over(one).alias(place)).where(F.col(place) == 1)
    return kept.where(told["_key"].isNull()).select(*mine).unionByName(again.drop(place))
