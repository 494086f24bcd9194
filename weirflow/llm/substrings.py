"""Suffix-array deduplication: bytes covered by a long string that also starts elsewhere in the corpus.

Every window of ``length`` bytes is owned by its anchor, the 32-byte string in it with the smallest hash; equal windows have
equal anchors. Stretches of text whose anchor occurs once cannot repeat and go no further. The others are gathered by anchor, equal
stretches once per task, and each task sorts the suffixes of its stretches in two stages: suffixes smaller than their successor are
sorted directly, the others are induced by scanning the buckets of first bytes in order. Neighbours in the array with a common
prefix of ``length`` bytes mark repeated windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import documents, mix64, slices, small_batches, written

LENGTH = 200
GRAM = 32
PART_BYTES = 8 << 20  # of stretches for one suffix array
SORTED = 1 << 16  # suffixes that are compared whole at a time


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the 32-byte strings at each position, by doubling."""
    h = data.astype(np.uint64) + np.uint64(1)
    base = np.array([0x9E3779B97F4A7C15], np.uint64)
    width = 1
    while width < GRAM:
        h = h[:-width] * base + h[width:]
        base = base * base
        width *= 2
    return mix64(h)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost smallest value in each run of ``width``."""
    n = len(values)
    keys = (values & ~np.uint64((1 << 24) - 1)) | np.arange(n, dtype=np.uint64)  # the position decides ties
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = keys
    grid = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(behind[: n - width + 1], ahead[width - 1 : n]) & np.uint64((1 << 24) - 1)).astype(np.int64)


def stretches(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first window start, number of starts, anchor hash) of the stretches of windows that share an anchor."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    h = gram_hashes(data)
    anchor = sliding_argmin(h, length - GRAM + 1)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    windows = np.maximum(sizes - length + 1, 0)
    owner = np.repeat(np.arange(len(texts)), windows)
    at = np.arange(int(windows.sum())) + np.repeat(begin - np.concatenate(([0], np.cumsum(windows)[:-1])), windows)
    a = anchor[at]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (owner[1:] != owner[:-1])))) if len(a) else none
    count = np.diff(np.concatenate((new, [len(a)])))
    return owner[new], at[new] - begin[owner[new]], count, h[a[new]].view(np.int64)


PIECE = 8 << 20


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """(offset, piece) so that every window of the text lies in exactly one piece."""
    for start in range(0, max(1, len(text) - length + 1), PIECE):
        yield start, text[start : start + PIECE + length - 1]


def _anchors(length: int):
    def run(batches):
        for ids, texts in slices(batches, 1 << 20):
            parts = [(i, off, p) for i, t in zip(ids, texts) for off, p in _pieces(t, length)]
            for group in _grouped(parts):
                own, start, count, key = stretches([p for _, _, p in group], length)
                docs = np.array([d for d, _, _ in group], np.int64)
                offs = np.array([o for _, o, _ in group], np.int64)
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(docs[own]), pa.array(start + offs[own]), pa.array(count)], ["key", "doc", "start", "count"])

    return run


def _grouped(parts):
    """Runs of pieces of at most 12 MB together."""
    now, size = [], 0
    for p in parts:
        if now and size + len(p[2]) > 12 << 20:
            yield now
            now, size = [], 0
        now.append(p)
        size += len(p[2])
    if now:
        yield now


_CUT = "key long, content long, doc long, start long, count long, times long, bytes binary"


def _cut(length: int):
    """Documents with their repeated anchors to stretches; the bytes of equal stretches once per task."""

    def run(batches):
        sent: set[int] = set()
        names = [x.split()[0] for x in _CUT.split(", ")]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            texts = batch.column("text").cast(pa.binary())
            for i, (doc, found) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("found").to_pylist())):
                text = texts[i].as_py()
                for s in found:
                    data = text[s["start"] : s["start"] + s["count"] + length - 1]
                    content = xxhash.xxh64_intdigest(data) - (1 << 63)
                    new = content not in sent
                    if new and len(sent) < 2_000_000:
                        sent.add(content)
                    for col, value in zip(out, (s["key"], content, doc, s["start"], s["count"], 1, data if new else None)):
                        col.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, [*[pa.int64()] * 6, pa.binary()])], names)

    return run


def sorted_suffixes(raw: bytes, at: np.ndarray, length: int) -> np.ndarray:
    """The positions in the order of the ``length`` bytes that begin there. Their first eight bytes are sorted as numbers; whole strings
    are made only for some neighbours in that order at a time, with all that share these bytes."""
    if not len(at):
        return at
    head = np.ndarray((len(raw),), ">u8", raw + bytes(7), strides=(1,))[at].astype(np.uint64)
    order = np.argsort(head, kind="stable")
    at, head = at[order], head[order]
    del order
    edges = np.concatenate((np.flatnonzero(head[1:] != head[:-1]) + 1, [len(at)]))
    del head
    out, start = [], 0
    while start < len(at):
        end = int(edges[min(np.searchsorted(edges, start + SORTED), len(edges) - 1)])
        out.append(np.array(sorted(at[start:end].tolist(), key=lambda i: raw[i : i + length]), np.int64))
        start = end
    return np.concatenate(out)


def two_stage_order(data: np.ndarray, needed: np.ndarray, length: int) -> np.ndarray:
    """The needed positions in the order of their suffixes, exact in the first ``length`` bytes.

    With every needed position that is larger than its successor, the successor is needed too, up to the first smaller one.
    """
    n = len(data)
    small = smaller_than_successor(data)
    raw = data.tobytes()
    direct = sorted_suffixes(raw, np.flatnonzero(needed & small), length)
    larger = needed & ~small
    first = data[direct]
    cuts = np.searchsorted(first, np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(positions: np.ndarray, bucket: int) -> np.ndarray:
        """Hands the predecessors of sorted suffixes to their buckets; returns those of the same bucket."""
        before = positions[positions > 0] - 1
        before = before[larger[before]]
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        edges = np.flatnonzero(np.concatenate(([True], byte[1:] != byte[:-1], [True]))) if len(byte) else []
        same = np.zeros(0, np.int64)
        for lo, hi in zip(edges[:-1], edges[1:]):
            if byte[lo] == bucket:
                same = before[lo:hi]
            else:
                waiting[byte[lo]].append(before[lo:hi])
        return same

    # The last position has no successor: it is larger than the end and comes first in its bucket.
    if n and larger[n - 1]:
        waiting[data[n - 1]].append(np.array([n - 1]))
    for bucket in range(256):
        wave = np.concatenate(waiting[bucket]) if waiting[bucket] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, bucket)
        part = direct[cuts[bucket] : cuts[bucket + 1]]
        out.append(part)
        induce(part, bucket)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def smaller_than_successor(data: np.ndarray) -> np.ndarray:
    """For each position: is its suffix smaller than the one that starts a byte later? The last one is not."""
    n = len(data)
    if not n:
        return np.zeros(0, bool)
    step = np.sign(np.diff(data.astype(np.int16)))
    last = np.concatenate((np.where(step != 0, np.arange(n - 1), n - 1), [n - 1]))
    nxt = np.minimum.accumulate(last[::-1])[::-1]  # the next position whose neighbour differs
    return np.concatenate((step, [-1]))[nxt] > 0


def common_at_least(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Do the strings at a and b agree in ``length`` bytes?"""
    words = np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,))
    alive = np.arange(len(a))
    for off in [*range(0, length - 7, 8), length - 8]:
        alive = alive[words[a[alive] + off] == words[b[alive] + off]]
    same = np.zeros(len(a), bool)
    same[alive] = True
    return same


def repeated_starts(segments: list[bytes], counts: np.ndarray, length: int) -> list[np.ndarray]:
    """For each distinct segment: which of its owned starts begin a string that also starts at another owned position."""
    sizes = np.array([len(s) for s in segments], np.int64)
    data = np.frombuffer(b"".join(segments), np.uint8)
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owned = np.zeros(len(data), bool)
    edges = np.zeros(len(data) + 1, np.int64)
    np.add.at(edges, begin, 1)
    np.add.at(edges, begin + counts, -1)
    owned = np.cumsum(edges[:-1]) > 0
    # A larger suffix is induced from its successor, so the run up to the first smaller one is needed too.
    small = smaller_than_successor(data)
    needed = owned.copy()
    ends = begin + counts
    grow = ends[(ends < len(data))]
    grow = grow[~small[grow - 1]]
    while len(grow):
        needed[grow] = True
        grow = grow[~small[grow]] + 1
        grow = grow[grow < len(data)]
        grow = grow[~needed[grow]]
    order = two_stage_order(data, needed, length)
    order = order[owned[order]]
    same = common_at_least(data, order[:-1], order[1:], length) if len(order) > 1 else np.zeros(0, bool)
    mark = np.zeros(len(data), bool)
    mark[order[:-1][same]] = True
    mark[order[1:][same]] = True
    return [mark[b : b + c] for b, c in zip(begin, counts)]


def _runs(mark: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mark.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def _suffixes(length: int):
    """All stretches of a task's anchors to (content, from, to): runs of repeated starts inside each distinct stretch."""

    def run(batches):
        times: dict[int, int] = {}
        held: dict[int, tuple[int, bytes]] = {}
        for batch in batches:
            for content, count, n, data in zip(*(batch.column(c).to_pylist() for c in ("content", "count", "times", "bytes"))):
                times[content] = times.get(content, 0) + n
                if data is not None:
                    held[content] = (count, data)
        names = list(held)
        rows = []
        if names:
            counts = np.array([held[c][0] for c in names], np.int64)
            for c, mark in zip(names, repeated_starts([held[c][1] for c in names], counts, length)):
                if times[c] > 1:
                    mark = np.ones(held[c][0], bool)
                rows += [(c, a, b) for a, b in _runs(mark)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["content", "a", "b"])

    return run


_KEPT = "text_key long, n_kept long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"


def _remove(length: int):
    """Texts with their runs of repeated starts to the spans removed and what stays."""
    names = [x.split()[0] for x in _KEPT.split(", ")]
    kinds = [pa.int64()] * 3 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]

    def run(batches):
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.binary())
            for i, (key, runs) in enumerate(zip(batch.column("text_key").to_pylist(), batch.column("runs").to_pylist())):
                text, spans = texts[i].as_py(), []
                for r in sorted((r["a"], r["b"] + length - 1) for r in runs):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], r[1]))
                    else:
                        spans.append(r)
                edges = [0, *(x for s in spans for x in s), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((key, len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "end": b} for a, b in spans]))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names)

    return run


def find_repeats(df: DataFrame, length: int = LENGTH, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (bytes to remove, end exclusive).

    Null text counts as empty; texts shorter than ``length`` lose nothing. A copy of a row is another occurrence, also under the same
    or a null id. Strings are judged on the input, not on what is left. An empty table gives no rows. Extra columns are not read.
    Texts are told apart by 64-bit hash: all copies of a text share one set of positions.
    """
    if length < GRAM + 8:
        raise ValueError(f"length must be {GRAM + 8} or more")
    small_batches(df.sparkSession)
    docs = documents(df).withColumn("text_key", F.xxhash64("text"))
    anchors = docs.select(F.col("text_key").alias("doc_id"), "text").mapInArrow(_anchors(length), "key long, doc long, start long, count long")
    anchors = written(anchors, "anchors")
    often = anchors.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    found = anchors.join(often, "key").distinct().groupBy("doc").agg(F.collect_list(F.struct("key", "start", "count")).alias("found"))
    # One text of each group of copies; the tasks keep one each before texts move.
    texts = docs.groupBy("text_key").agg(F.first("text").alias("text"))
    held = written(texts.join(found, texts["text_key"] == found["doc"]).select("doc", "text", "found"), "held")
    cut = written(held.mapInArrow(_cut(length), _CUT), "cut")
    size = cut.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    parts = cut.select("key", "content", "count", "times", "bytes").repartition(max(1, -(-size // part_bytes)), "key")
    ranges = written(parts.mapInArrow(_suffixes(length), "content long, a long, b long"), "ranges")
    runs = cut.select("content", "doc", "start").join(ranges, "content").groupBy("doc").agg(F.collect_list(F.struct((F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))).alias("runs"))
    told = held.select(F.col("doc").alias("text_key"), "text").join(runs, F.col("text_key") == F.col("doc")).select("text_key", "text", "runs").mapInArrow(_remove(length), _KEPT)
    rows = docs.select("doc_id", "text_key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("whole"))
    copies = rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    rows = rows.join(copies, "text_key", "left").join(told, "text_key", "left")
    gone = F.col("copies").isNotNull() & (F.col("n_bytes") >= length)
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    return rows.select(
        "doc_id", "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).alias("n_removed"),
        F.when(gone, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0).cast("long"))).alias("n_spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "whole")).alias("kept_sha256"),
        F.when(gone, all_of_it).otherwise(F.coalesce("spans", none)).alias("spans"),
    )
