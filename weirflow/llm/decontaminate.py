"""Benchmark decontamination: a broadcast hash set of normalised benchmark n-grams, scanned over training token windows.

Words of benchmark items get numbers; a window of numbers is looked up by a rolling 64-bit hash and verified word by word.
The benchmark is taken in blocks of bounded size, each broadcast by itself: a benchmark of any size costs more scans of the
words, never a larger broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import documents, slices, small_batches

WINDOW = 10
BLOCK_BYTES = 32 << 20  # of benchmark text in one broadcast
# Bytes that belong to words are digits, a-z and all of non-ASCII; A-Z becomes a-z, the rest separates.
NORMALISE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def normalised_words(text: bytes) -> list[bytes]:
    return text.translate(NORMALISE).split()


@dataclass
class Windows:
    """The n-grams of one benchmark block: word numbers, and for each window length its windows with their items."""

    words: dict[bytes, int] = field(default_factory=dict)
    by_length: dict[int, dict[tuple[int, ...], list]] = field(default_factory=dict)

    def add(self, item, text: bytes, size: int) -> None:
        ids = tuple(self.words.setdefault(w, len(self.words)) for w in normalised_words(text))
        length = min(size, len(ids))
        known = self.by_length.setdefault(length, {}) if length else {}
        for i in range(len(ids) - length + 1 if length else 0):
            items = known.setdefault(ids[i : i + length], [])
            if item not in items:
                items.append(item)


def _rolling(ids: np.ndarray, length: int) -> np.ndarray:
    h = np.zeros(len(ids) - length + 1, np.uint64)
    for k in range(length):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - length + 1 + k].astype(np.uint64) + np.uint64(1)
    return h


def scan(words: dict[bytes, int], by_length: dict[int, dict], hashes: dict[int, np.ndarray], docs: list[list[bytes]]) -> tuple[list[np.ndarray], list[set]]:
    """For each word list: which words are hit, and the items whose windows occur."""
    counts = np.array([len(d) for d in docs])
    ids = np.fromiter((words.get(w, -1) for d in docs for w in d), np.int64, int(counts.sum()))
    ends = np.cumsum(counts)
    owner = np.repeat(np.arange(len(docs)), counts)
    hit, items = np.zeros(len(ids), bool), [set() for _ in docs]
    unknown = np.concatenate(([0], np.cumsum(ids < 0)))
    for length, known in by_length.items():
        if len(ids) < length:
            continue
        at = np.arange(len(ids) - length + 1)
        at = at[(unknown[at + length] == unknown[at]) & (owner[at] == owner[at + length - 1])]
        if len(at):
            at = at[np.isin(_rolling(ids, length)[at], hashes[length])]
        for i in at.tolist():
            found = known.get(tuple(ids[i : i + length].tolist()))
            if found:
                hit[i : i + length] = True
                items[owner[i]].update(found)
    return np.split(hit, ends[:-1]) if len(docs) else [], items


def _blocks(benchmark: DataFrame, size: int, block_bytes: int) -> Iterator[Windows]:
    """Benchmark blocks of bounded text size, one at a time in the driver. A single larger item is a block of its own."""
    items = benchmark.select(benchmark["item_id"].alias("item"), F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("text"))
    block, used = Windows(), 0
    for row in items.toLocalIterator():
        data = row.text.encode()
        if used and used + len(data) > block_bytes:
            yield block
            block, used = Windows(), 0
        block.add(row.item, data, size)
        used += len(data)
    yield block


_ROW = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("_hit", pa.binary()), ("_items", pa.list_(pa.string()))])


def _pass(spark, docs: DataFrame, windows: Windows, last: bool) -> DataFrame:
    """One block against all documents: adds to the hit bits and items; the last block leaves the text away."""
    hashes = {n: np.unique(_rolling(np.array(list(known), np.int64).reshape(-1), n)[::n]) for n, known in windows.by_length.items()}
    # Plain objects: what is broadcast is pickled by reference, and executors do not have this package.
    shared = spark.sparkContext.broadcast((windows.words, windows.by_length, hashes))

    def run(batches):
        words, by_length, hashes = shared.value
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            done = 0
            for ids, texts in slices(iter([batch.select(["doc_id", "text"])])):
                old = rows.slice(done, len(ids))
                done += len(ids)
                hit, items = scan(words, by_length, hashes, [normalised_words(t) for t in texts])
                if "_hit" in old.column_names:
                    hit = [h | np.unpackbits(np.frombuffer(b, np.uint8), count=len(h)).astype(bool) for h, b in zip(hit, old.column("_hit").to_pylist())]
                    items = [s | set(b) for s, b in zip(({str(x) for x in s if x is not None} for s in items), old.column("_items").to_pylist())]
                if last:
                    names = [sorted(str(x) for x in s if x is not None) for s in items]
                    out = {
                        "doc_id": ids, "n_words": [len(h) for h in hit], "n_hit": [int(h.sum()) for h in hit], "n_items": [len(x) for x in names],
                        "item_ids": names, "items_sha256": [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names],
                        "hit_words": [np.flatnonzero(h).tolist() for h in hit],
                    }
                    table = pa.table({k: pa.array(v, _TYPES[k]) for k, v in out.items()})
                else:
                    table = pa.table([pa.array(ids, pa.int64()), pa.array([t.decode() for t in texts]), pa.array([np.packbits(h).tobytes() for h in hit], pa.binary()),
                                      pa.array([sorted(str(x) for x in s if x is not None) for s in items], pa.list_(pa.string()))], schema=_ROW)
                for name in rows.column_names:
                    if name == "row":
                        table = table.append_column("row", old.column("row"))
                yield from table.to_batches()

    row = f", row {docs.schema['row'].dataType.simpleString()}" if "row" in docs.columns else ""
    kinds = "doc_id long, n_words long, n_hit long, n_items long, item_ids array<string>, items_sha256 string, hit_words array<long>"
    return docs.mapInArrow(run, (kinds if last else "doc_id long, text string, _hit binary, _items array<string>") + row)


_TYPES = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_hit": pa.int64(), "n_items": pa.int64(), "item_ids": pa.list_(pa.string()), "items_sha256": pa.string(), "hit_words": pa.list_(pa.int64())}


def find_leaks(df: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, item_ids, items_sha256, hit_words, contaminated.

    A window is ``window`` consecutive words of an item; a shorter item with words is one window. Null and empty texts have no words;
    items without words match nothing; the windows of items without id hit words, but such items are not listed. Equal windows of several items count for each. Repeated rows and null ids each
    keep their row; repeated item ids count once. Empty tables give no rows, or rows without hits.
    """
    spark = df.sparkSession
    small_batches(spark)
    docs = documents(df, carry=carry)
    blocks = _blocks(benchmark, window, block_bytes)
    now = next(blocks)
    for after in blocks:
        docs = _pass(spark, docs, now, last=False)
        now = after
    return _pass(spark, docs, now, last=True).withColumn("contaminated", F.col("n_hit") > 0)


def drop_contaminated(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input rows without any benchmark window, with all their columns."""
    return find_leaks(df, benchmark, carry=True, **options).where("not contaminated").select("row.*")
