"""Cross-tokenizer alignment with inverted pair bitmaps.

Every text is encoded by two tokenizers. Byte offsets where tokens of both end cut the tokens into groups, and tokens whose byte ranges
overlap are linked. Links are counted per pair of ids over the whole corpus.

Documents are numbered inside blocks. For each pair of ids a block holds an inverted bitmap of its documents, in planes: plane j marks the
documents in which binary digit j of the pair's number of links is one. Planes are compressed: few documents as a list of numbers, many as
bits. A pair's document count is the popcount of its OR-merged planes, its link count the sum of the planes' popcounts with their
weights. Counts of all blocks are added up per pair, and the scores go back to the block, whose postings hand them to its documents.
Texts are encoded once and never shuffled.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import documents, slices, small_batches, written

TOKENIZERS = "/opt/tokenizers"
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BYTES = 16 << 20
BLOCK_DOCS = 1 << 16  # a document's number inside its block has 16 bits
PIECE_BITS = 16
LONG_SPACE = 200_000
# The split before the merges of the byte-level vocabulary, and the space mark of the other one.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "▁"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, the rest from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or (0xA1 <= b <= 0xFF and b != 0xAD)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Both tokenizers, from the bytes of their files."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        import sentencepiece
        import tiktoken

        model = json.loads(byte_file)
        letters = byte_letters()
        special = {t["content"] for t in model["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        # Ids are in the order of the merges, so they are ranks. Without special tokens, their strings are plain text.
        self.byte_file = byte_file
        self.bytes = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_file)
        size = max(ranks.values()) + 1
        self.a = [b""] * size
        for token, i in ranks.items():
            self.a[i] = token
        p = self.pieces
        self.b = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace(SPACE_MARK, " ").encode() for i in range(p.get_piece_size())]
        self.len_a, self.len_b = (np.array([len(x) for x in side], np.int64) for side in (self.a, self.b))
        self.text_a, self.text_b = (np.array([f"{i}{c}" for c in marks for i in range(len(side))], object) for side, marks in ((self.a, (",", "|")), (self.b, (",", ";", ""))))

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of both, or none where a side's tokens do not give the text back."""
        if not text:
            return [], []
        spaced = " " + text
        a, b = self._bytes(spaced), self.pieces.encode(text, num_threads=1)
        raw = spaced.encode()
        if b"".join(map(self.a.__getitem__, a)) != raw or b"".join(map(self.b.__getitem__, b)) != raw:
            return [], []
        return a, b

    def _bytes(self, text: str) -> list[int]:
        if len(text) <= LONG_SPACE or all(m.end() - m.start() <= LONG_SPACE for m in re.finditer(r"\s+", text)):
            return self.bytes.encode_ordinary(text)
        # The split of the quick library overflows its stack on such runs of white space; the slower one reads them.
        from tokenizers import Tokenizer

        slow = Tokenizer.from_buffer(self.byte_file)
        slow.encode_special_tokens = True
        return slow.encode(text, add_special_tokens=False).ids


class Aligned:
    """Tokens of several texts one after the other, with their groups and links."""

    def __init__(self, coder: Encoder, texts: list[str]):
        both = [coder.encode(t) for t in texts]
        self.n_a, self.n_b = (np.array([len(x[s]) for x in both], np.int64) for s in (0, 1))
        self.a, self.b = (np.fromiter((i for x in both for i in x[s]), np.int64, int(n.sum())) for s, n in ((0, self.n_a), (1, self.n_b)))
        end_a, end_b = np.cumsum(coder.len_a[self.a]), np.cumsum(coder.len_b[self.b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)  # a text ends in both, so groups and links stay inside it
        self.group_a, self.group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        doc_a, doc_b = (np.repeat(np.arange(len(texts)), n) for n in (self.n_a, self.n_b))
        last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (self.group_a, self.group_b))
        self.n_groups = np.bincount(doc_a[last_a], minlength=len(texts))
        # Links: from the B token that holds a token's first byte to the one that holds its last.
        first = np.searchsorted(end_b, end_a - coder.len_a[self.a], "right")
        width = np.searchsorted(end_b, end_a, "left") - first + 1
        self.n_links = np.bincount(doc_a, width, len(texts)).astype(np.int64)
        at = np.repeat(first - np.concatenate(([0], np.cumsum(width)[:-1])), width) + np.arange(int(width.sum())) if len(width) else np.zeros(0, np.int64)
        self.pairs = (np.repeat(self.a, width) << PIECE_BITS) | self.b[at]
        self.link_docs = np.repeat(doc_a, width)
        # One string per text: tokens in the order of groups, A before B, each with the mark after it.
        place_a = np.arange(len(self.a)) + np.searchsorted(self.group_b, self.group_a, "left")
        place_b = np.arange(len(self.b)) + np.searchsorted(self.group_a, self.group_b, "right")
        ends_doc = np.append(doc_b[1:] != doc_b[:-1], True) if len(doc_b) else np.zeros(0, bool)
        words = np.empty(len(self.a) + len(self.b), object)
        words[place_a] = coder.text_a[self.a + last_a * len(coder.a)]
        words[place_b] = coder.text_b[self.b + (last_b.astype(np.int64) + ends_doc) * len(coder.b)]
        words, cuts = words.tolist(), np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))
        self.groups = ["".join(words[lo:hi]) for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _digest(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def compress(docs: np.ndarray) -> bytes:
    """A set of sorted 16-bit document numbers: a list, or bits where that is shorter."""
    if len(docs) * 2 <= (int(docs[-1]) >> 3) + 1:
        return b"L" + docs.astype("<u2").tobytes()
    bits = np.zeros((int(docs[-1]) >> 3) * 8 + 8, np.uint8)
    bits[docs] = 1
    return b"B" + np.packbits(bits, bitorder="little").tobytes()


def expand(data: bytes) -> np.ndarray:
    if data[:1] == b"L":
        return np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=1), bitorder="little"))


def popcount(data: bytes) -> int:
    return (len(data) - 1) // 2 if data[:1] == b"L" else int(np.unpackbits(np.frombuffer(data, np.uint8, offset=1)).sum())


def merge_or(planes: list[bytes]) -> np.ndarray:
    """The documents in any of the planes."""
    out = expand(planes[0])
    for p in planes[1:]:
        out = np.union1d(out, expand(p))
    return out


def posting(docs: np.ndarray, times: np.ndarray) -> list[bytes]:
    """The planes of one pair, lowest digit first; a plane without documents is empty."""
    return [compress(docs[on]) if (on := (times >> j & 1).astype(bool)).any() else b"" for j in range(int(times.max()).bit_length())]


_OUT = "block long, doc int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, pair long, n_docs long, n_times long, planes array<binary>"
_KINDS = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.binary())]
_NAMES = [x.split()[0] for x in _OUT.split(", ")]


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[c], t) if c in columns else pa.nulls(n, t) for c, t in zip(_NAMES, _KINDS)], _NAMES)


def _single_planes(docs: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Postings of pairs that no document links twice and few documents link: one plane, as a list."""
    size = (ends - starts) * 2 + 1
    offsets = np.concatenate(([0], np.cumsum(size)))
    data = np.empty(int(offsets[-1]), np.uint8)
    mark = np.zeros(len(data), bool)
    mark[offsets[:-1]] = True
    data[mark], data[~mark] = ord("L"), docs.astype("<u2").view(np.uint8)
    lists = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1), pa.int32()), lists)


def _postings(block: int, keys: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The inverted bitmaps of a block. ``keys`` are pair and document, sorted and distinct."""
    pairs, docs = keys >> 16, keys & 0xFFFF
    if not len(keys):
        return
    starts = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    ends = np.append(starts[1:], len(pairs))
    most, n = np.maximum.reduceat(times, starts), ends - starts
    # A list is what ``compress`` would choose: two bytes a document are not more than the bits.
    plain = (most == 1) & (2 * n <= (docs[ends - 1] >> 3) + 1)
    rows = np.repeat(plain, n)
    if plain.any():
        lo = np.concatenate(([0], np.cumsum(n[plain])))
        made = _rows(block=np.full(plain.sum(), block), pair=pairs[starts[plain]], n_docs=n[plain], n_times=n[plain])
        yield made.set_column(_NAMES.index("planes"), "planes", _single_planes(docs[rows], lo[:-1], lo[1:]))
    kept = [(int(pairs[s]), posting(docs[s:e], times[s:e])) for s, e in zip(starts[~plain].tolist(), ends[~plain].tolist())]
    for at in range(0, len(kept), 4096):
        some = kept[at : at + 4096]
        yield _rows(block=[block] * len(some), pair=[p for p, _ in some], n_docs=[len(merge_or([x for x in planes if x])) for _, planes in some],
                    n_times=[sum(popcount(x) << j for j, x in enumerate(planes) if x) for _, planes in some], planes=[planes for _, planes in some])


def _encode(files, block_bytes: int, texts_out: bool):
    def run(batches):
        coder = Encoder(*files.value)
        part, block, doc, size = TaskContext.get().partitionId(), 0, 0, 0
        keys, times = [], []

        def merged():
            k, t = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (keys, times))
            if not len(k):
                return k, t
            order = np.argsort(k, kind="stable")
            k, t = k[order], t[order]
            first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
            return k[first], np.add.reduceat(t, first)

        for ids, texts in slices(batches):
            if doc + len(ids) > BLOCK_DOCS or size > block_bytes:
                yield from _postings((part << 32) + block, *merged())
                keys, times, block, doc, size = [], [], block + 1, 0, 0
            got = Aligned(coder, [t.decode() for t in texts])
            numbers = np.arange(doc, doc + len(ids))
            groups = {"groups": got.groups} if texts_out else {}
            yield _rows(block=np.full(len(ids), (part << 32) + block), doc=numbers, doc_id=ids, n_a=got.n_a, n_b=got.n_b, n_groups=got.n_groups, n_links=got.n_links, groups_sha256=[_digest(g) for g in got.groups], **groups)
            k, t = np.unique((got.pairs << 16) | (got.link_docs + doc), return_counts=True)
            keys.append(k)
            times.append(t)
            doc, size = doc + len(ids), size + sum(map(len, texts))
        yield from _postings((part << 32) + block, *merged())

    return run


class Alignment:
    """``rows``: documents and postings as they were written, block by block."""

    def __init__(self, rows: DataFrame):
        self.documents = rows.where("doc is not null").select(*_NAMES[:9])
        self.postings = rows.where("pair is not null").select("block", "pair", "n_docs", "n_times", "planes")

    def pairs(self) -> DataFrame:
        """(a, b, n_docs, n_links, best): every pair of ids over the whole corpus, and whether no other pair of its B id is linked more often."""
        total = written(self.postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_times").alias("n_links")), "pairs")
        b = F.col("pair").bitwiseAND(F.lit((1 << PIECE_BITS) - 1))
        most = total.groupBy(b.alias("b")).agg(F.max("n_links").alias("most"))
        total = total.withColumn("b", b).join(most, "b")
        return total.select("pair", F.shiftright("pair", PIECE_BITS).alias("a"), "b", "n_docs", "n_links", (F.col("n_links") == F.col("most")).alias("best"))

    def scores(self) -> DataFrame:
        """(block, doc, n_best, count_sum): what the postings return to the documents that have links."""
        asked = self.postings.select(F.col("block").alias("to"), F.col("pair").alias("code"))
        scored = asked.join(self.pairs().select(F.col("pair").alias("code"), "n_links", "best"), "code")

        def back(key, posted, scored):
            p, s = posted["pair"].to_numpy(), scored["code"].to_numpy()
            order = np.argsort(s)
            order = order[np.searchsorted(s[order], p)]
            links, best = scored["n_links"].to_numpy()[order], scored["best"].to_numpy(zero_copy_only=False)[order]
            docs, times, owner = [], [], []
            planes = posted["planes"].combine_chunks()
            lists, data = planes.offsets.to_numpy(), planes.values.to_pylist()
            for i, (lo, hi) in enumerate(zip(lists[:-1].tolist(), lists[1:].tolist())):
                for j in range(lo, hi):
                    if data[j]:
                        found = expand(data[j])
                        docs.append(found)
                        times.append(1 << (j - lo))
                        owner.append(i)
            size = np.array([len(d) for d in docs])
            docs, times, owner = np.concatenate(docs), np.repeat(np.array(times), size), np.repeat(np.array(owner), size)
            n = int(docs.max()) + 1
            has = np.bincount(docs, minlength=n) > 0
            n_best, count_sum = np.zeros(n, np.int64), np.zeros(n, np.int64)
            np.add.at(n_best, docs, times * best[owner])
            np.add.at(count_sum, docs, times * links[owner])
            at = np.flatnonzero(has)
            return pa.table({"block": pa.array(np.full(len(at), key[0].as_py()), pa.int64()), "doc": pa.array(at, pa.int32()), "n_best": n_best[at], "count_sum": count_sum[at]})

        return self.postings.select("block", "pair", "planes").groupBy("block").cogroup(scored.groupBy("to")).applyInArrow(back, "block long, doc int, n_best long, count_sum long")


def align(df: DataFrame, tokenizers: str = TOKENIZERS, block_bytes: int = BLOCK_BYTES, texts: bool = False) -> Alignment:
    """Encode and align every text; with ``texts`` the documents keep their ``groups`` as text (``a1,a2|b1;a3|b2,b3``).

    Null and empty texts, and texts that a tokenizer's tokens do not give back, have no tokens. Repeated rows and null ids each keep
    their row and count. A text is encoded whole, so memory follows the longest text and the block size. An empty table gives no rows.
    Extra columns are not read. The driver reads the two vocabulary files (2 MB) and broadcasts them.
    """
    spark = df.sparkSession
    small_batches(spark)
    files = []
    for name in (BYTE_FILE, PIECE_FILE):
        with open(os.path.join(tokenizers, name), "rb") as f:
            files.append(f.read())
    docs = documents(df)
    return Alignment(written(docs.mapInArrow(_encode(spark.sparkContext.broadcast(tuple(files)), block_bytes, texts), _OUT), "aligned"))


def report(df: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = align(df, **options)
    rows = found.documents.drop("groups").join(found.scores(), ["block", "doc"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
