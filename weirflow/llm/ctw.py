"""LM scoring by context-tree weighting over bytes.

A byte is coded as eight binary decisions. Each decision has a context tree over the preceding bytes; every node keeps a
Krichevsky-Trofimov estimate of its own counts, and a node's weighted probability is half its own estimate and half the product of
its children's, so all depths are mixed. The tree is learned from the training documents and then held fixed.

N-grams are written with the context turned round, the last byte first, so that all n-grams below a node are one interval of codes.
The work goes in five steps; n-grams stay packed, many to a row, in all of them:

1. Each task packs its documents into blocks, with a sample of their n-grams.
2. Quantiles of the sample cut the codes into ranges of about ``RANGE`` n-grams, whatever their contexts: a heavy context is cut deeper.
   Cuts decide where work is done, not what comes out.
3. Blocks list their words and n-grams with training counts, range by range. Each range sums its counts and weighs its nodes, one
   decision at a time. Nodes that a cut goes through send up their part: counts add up, and so do the logs of the children that lie
   inside a range.
4. The cut nodes are weighed, each of the 255 decisions apart: a few nodes per cut.
5. Each range mixes the estimates along the path of each n-gram and tells every block the numbers that it asked for.

A range weighs its nodes again in step 5: keeping what step 3 knew would take eight numbers for each n-gram. The n-grams of a block
are read from its texts wherever they are needed: kept beside the texts they would double the blocks on disk.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import documents, from_planes, mix64, planes, small_batches, written

DEPTH = 7  # context bytes: with the byte itself, all that a 64-bit code holds
BLOCK_BYTES = 16 << 20
SLICE_BYTES = 1 << 20
RANGE = 1 << 19  # n-grams of a range: the distinct ones, and an eighth of those that the blocks send
REPEATS = 8
SAMPLED = 256  # n-grams of a range that the cuts are made from
MERGED = 3 << 20  # n-grams that wait to be summed
CUT_BYTES = 6  # context bytes that a cut may tell apart
HELD_OUT = 10
END = 0xFF  # not a byte of UTF-8: stands before a text and ends it
ADD = 0.1


def is_held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % HELD_OUT == 0


def ngrams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the predicted positions (context bytes and the byte, most recent last) and the number of them per text."""
    pad = bytes([END]) * depth
    data = bytes(7 - depth) + pad + pad.join(texts) + pad + bytes(7)
    code = np.empty(len(data) - 7, np.uint64)
    for k in range(8):  # eight bytes are read at a time, from each of eight starting points
        code[k::8] = np.frombuffer(data, ">u8", len(code[k::8]), k)
    code = code[:-7] & np.uint64((1 << (8 * (depth + 1))) - 1)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)  # with the end
    starts = np.concatenate(([0], np.cumsum(sizes - 1 + depth)[:-1]))
    at = np.arange(int(sizes.sum())) + np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes)
    return code[at], sizes


def turned(codes: np.ndarray) -> np.ndarray:
    """The same n-grams with the last context byte highest and the predicted byte lowest."""
    x = codes.byteswap()
    return (x << np.uint64(8)) | (x >> np.uint64(56))


def _text_slices(ids: list, texts: list[bytes]):
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_BYTES:
            yield ids[start:i], texts[start:i]
            start, size = i, 0
        size += len(t)
    if texts:
        yield ids[start:], texts[start:]


def _distinct(codes: np.ndarray) -> np.ndarray:
    """Sorted and distinct. ``np.unique`` without counts hashes first, which takes many times the time and memory."""
    codes = np.sort(codes)
    return codes[np.concatenate(([True], codes[1:] != codes[:-1]))] if len(codes) else codes


def _indexed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted and distinct, and where in that each code stands."""
    order = np.argsort(codes)
    codes = codes[order]
    first = np.concatenate(([True], codes[1:] != codes[:-1]))
    at = np.empty(len(codes), np.int32)
    at[order] = np.cumsum(first, dtype=np.int32) - 1
    return codes[first], at


def _sum_codes(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not sum(map(len, codes)):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    u, n = np.concatenate(codes), np.concatenate(counts)
    order = np.argsort(u)
    u, n = u[order], n[order]
    del order
    first = np.flatnonzero(np.concatenate(([True], u[1:] != u[:-1])))
    return u[first], np.add.reduceat(n, first, dtype=np.int64)


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _restored(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def _pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Byte planes, compressed; of rising values their differences."""
    if not len(values):
        return _squeezed(b"")
    return _squeezed(planes(np.diff(values, prepend=values.dtype.type(0)) if rising else values))


def _unpack(data: bytes, dtype, rising: bool = False) -> np.ndarray:
    raw = _restored(data)
    values = from_planes(raw, dtype) if raw else np.zeros(0, dtype)
    return np.cumsum(values, dtype=dtype) if rising else values


def _words_of(data: bytes, n: int) -> list[bytes]:
    return _restored(data).split(b" ") if n else []


def _words_by_range(words: list[bytes], ranges: int) -> list[np.ndarray]:
    """Positions of the words that belong to each range."""
    r = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(ranges)
    order = np.argsort(r, kind="stable")
    return np.split(order, np.searchsorted(r[order], np.arange(1, ranges)))


def _tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), b""]  # the empty word is the end


def _numbered(texts: list[bytes], number: defaultdict) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens each text has, and their numbers; new words are numbered as they come."""
    ids = [np.fromiter(map(number.__getitem__, ws), np.int32, len(ws)) for ws in map(_tokens, texts)]
    return np.array([len(x) for x in ids]), np.concatenate(ids)


def inventory(ids: list, texts: list[bytes], depth: int) -> tuple[list[bytes], np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """The distinct words (as they come) and turned n-grams (sorted, one array for each slice of texts), with training counts."""
    number = defaultdict(count().__next__)
    trained, codes, counts = [np.zeros(0, np.int32)], [], []
    for some, part in _text_slices(ids, texts):
        out = np.array([is_held_out(i) for i in some])
        sizes, ws = _numbered(part, number)
        trained.append(ws[np.repeat(~out, sizes)])
        for flag in (False, True):
            chosen = [t for t, h in zip(part, out) if h == flag]
            if chosen:
                u, n = np.unique(turned(ngrams(chosen, depth)[0]), return_counts=True)
                codes.append(u)
                counts.append((n * (not flag)).astype(np.int32))
    return list(number), np.bincount(np.concatenate(trained), minlength=len(number)), codes, counts


def _ends(codes: np.ndarray, cuts: np.ndarray) -> list[int]:
    """Where in sorted codes the ranges begin and end."""
    return [0, *np.searchsorted(codes, cuts).tolist(), len(codes)]


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_BLOCK = "block long, ids array<long>, sizes binary, texts binary, sample array<long>"


def _blocks(depth: int, block_bytes: int, every: int):
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 2, pa.list_(pa.int64())]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(_BLOCK.split(", "), kinds)])

    def packed(block, ids, texts):
        sample = [np.zeros(0, np.uint64)]
        for _, part in _text_slices(ids, texts):
            codes = ngrams(part, depth)[0]
            sample.append(_distinct(turned(codes[mix64(codes) % np.uint64(every) == 0])))
        sizes = np.array([len(t) for t in texts], np.int64)
        row = (block, ids, _pack(sizes), _squeezed(b"".join(texts)), _distinct(np.concatenate(sample)).astype(np.int64))
        return _table([row], schema).to_batches()[0]

    def run(batches):
        first, n, size = TaskContext.get().partitionId() << 32, 0, 0
        ids, texts = [], []
        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary())):
                text = text.as_py()
                if size and size + len(text) > block_bytes:
                    yield packed(first + n, ids, texts)
                    ids, texts, n, size = [], [], n + 1, 0
                ids.append(i)
                texts.append(text)
                size += len(text)
        if ids:
            yield packed(first + n, ids, texts)

    return run


def _documents_of(row: dict) -> tuple[list, list[bytes]]:
    """Ids and texts of a block."""
    data = _restored(row["texts"])
    ends = np.cumsum(_unpack(row["sizes"], np.int64)).tolist()
    return row["ids"], [data[a:b] for a, b in zip([0, *ends], ends)]


def range_cuts(blocks: DataFrame, every: int, size: int, depth: int) -> np.ndarray:
    """First codes of all ranges but the first, from the sampled n-grams; one number per range comes to the driver."""
    sent = blocks.select("block", F.explode("sample").alias("code"))
    repeats = sent.where(F.pmod(F.xxhash64("block", "code"), F.lit(REPEATS)) == 0).select("code")
    sample = sent.select("code").distinct().unionByName(repeats)
    ranges = -(-sample.count() * every // size)
    if ranges <= 1:
        return np.zeros(0, np.uint64)
    high = sample.select(F.shiftrightunsigned("code", 11).alias("code"))  # as exact as a double
    at = high.approxQuantile("code", [i / ranges for i in range(1, ranges)], 1 / (8 * ranges))
    low = np.uint64((1 << (64 - 8 * min(depth, CUT_BYTES))) - 1)
    cuts = np.unique((np.array(at).astype(np.uint64) << np.uint64(11)) & ~low)
    return cuts[cuts > 0]


_ASKED = "r long, block long, words binary, word_n binary, codes binary, code_n binary"


def _ask(cuts: np.ndarray, depth: int = DEPTH):
    schema = pa.schema([(c.split()[0], t) for c, t in zip(_ASKED.split(", "), [pa.int64(), pa.int64(), *[pa.binary()] * 4])])

    def asked(row):
        words, word_n, codes, code_n = inventory(*_documents_of(row), depth)
        ends = [_ends(u, cuts) for u in codes]
        for r, mine in enumerate(_words_by_range(words, len(cuts) + 1)):
            some, n = _sum_codes(*([x[e[r] : e[r + 1]] for x, e in zip(of, ends)] for of in (codes, code_n)))
            if len(mine) or len(some):
                yield r, row["block"], _squeezed(b" ".join(map(words.__getitem__, mine.tolist()))), _pack(word_n[mine]), _pack(some, True), _pack(n)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one block at a time
                yield from _table(list(asked(batch.slice(i, 1).to_pylist()[0])), schema).to_batches()

    return run


def log_gamma(z: np.ndarray) -> np.ndarray:
    """Stirling's series after eight steps up."""
    p = np.ones_like(z)
    for i in range(8):
        p = p * (z + i)
    y = z + 8
    return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(p)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log probability of a sequence with a zeros and b ones under the Krichevsky-Trofimov estimator."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - 1.1447298858494002


class Estimator:
    """``log_kt`` of whole numbers, by a table where they are small."""

    def __init__(self, size: int = 1 << 12):
        n = np.arange(size, dtype=float)
        self.size, self.half, self.whole = size, log_gamma(n + 0.5), log_gamma(n + 1)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = a + b
        large = np.flatnonzero(n >= self.size)
        if not len(large):
            return self.half[a] + self.half[b] - self.whole[n] - 1.1447298858494002
        top = self.size - 1
        out = self.half[np.minimum(a, top)] + self.half[np.minimum(b, top)] - self.whole[np.minimum(n, top)] - 1.1447298858494002
        out[large] = log_kt(a[large].astype(float), b[large].astype(float))
        return out


def mixed(own: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A node's weighted log probability, and the weight of its own estimate."""
    both = np.logaddexp(own, children)
    return both - np.log(2), np.exp(own - both)


class Tree:
    """The context trees of the decisions number ``bit`` (0 to 7) of a byte, over the n-grams of one range.

    ``codes`` are turned, sorted and distinct, and all that lie from ``low`` to ``high``. The node at depth d of an n-gram is told by
    the first d context bytes and the bits before the decision. ``cut[d]`` marks the nodes that reach beyond the range: their counts
    are parts, ``below`` holds the logs of their children inside the range only, and they have no weights until ``fill``. Keys and
    ``below`` are held of the cut nodes only.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int, bit: int, low: int, high: int, kt: Estimator):
        self.depth, self.bit, self.codes = depth, bit, codes
        keys, self.zeros, self.ones, self.parents = {}, {}, {}, {}
        self.stay, self.below, self.cut, self.cut_keys = {}, {}, {}, {}
        x = codes & np.uint64(255)
        self.bits = ((x >> np.uint64(7 - bit)) & np.uint64(1)).astype(bool)
        group = codes >> np.uint64(8 - bit)
        starts = np.concatenate(([True], group[1:] != group[:-1]))
        first = np.flatnonzero(starts)
        self.index = (np.cumsum(starts) - 1).astype(np.int32)  # of the deepest node of each n-gram
        self.ones[depth] = np.add.reduceat(counts * self.bits, first)
        self.zeros[depth] = np.add.reduceat(counts, first) - self.ones[depth]
        context, u = codes[first] >> np.uint64(8), (x[first] >> np.uint64(8 - bit)) | np.uint64(1 << bit)
        keys[depth] = self._key(context, u, depth)
        weighted = kt(self.zeros[depth], self.ones[depth])
        inside = np.ones(len(first), bool)
        for d in range(depth - 1, -1, -1):  # a node's counts are the sums of its children's
            key = ((keys[d + 1] >> np.uint64(16)) << np.uint64(8)) | (keys[d + 1] & np.uint64(255))
            keys[d], up = np.unique(key, return_inverse=True)
            size = len(keys[d])
            self.parents[d + 1] = up.astype(np.int32)
            self.ones[d], self.zeros[d] = (np.bincount(up, v, size).astype(np.int64) for v in (self.ones[d + 1], self.zeros[d + 1]))
            self.below[d] = np.bincount(up, np.where(inside, weighted, 0.0), size)
            weighted, self.stay[d] = mixed(kt(self.zeros[d], self.ones[d]), self.below[d])
            inside = self._inside(keys[d], d, low, high)
            self.cut[d] = np.flatnonzero(~inside)
            self.below[d] = self.below[d][self.cut[d]]
            self.cut_keys[d] = keys[d][self.cut[d]].astype(np.int64)
            del keys[d + 1]

    @staticmethod
    def _key(context: np.ndarray, u: np.ndarray, d: int) -> np.ndarray:
        return ((context >> np.uint64(8 * (7 - d))) << np.uint64(8)) | u

    @staticmethod
    def _inside(keys: np.ndarray, d: int, low: int, high: int) -> np.ndarray:
        if d == 0:  # the root is weighed with the cut nodes, however many ranges there are
            return np.zeros(len(keys), bool)
        start = (keys >> np.uint64(8)) << np.uint64(64 - 8 * d)
        return (start >= np.uint64(low)) & ((start | np.uint64((1 << (64 - 8 * d)) - 1)) <= np.uint64(high))

    @property
    def keys(self) -> dict[int, np.ndarray]:
        """Keys of all nodes, made when they are asked for."""
        u = ((self.codes & np.uint64(255)) >> np.uint64(8 - self.bit)) | np.uint64(1 << self.bit)
        return {d: np.unique(self._key(self.codes >> np.uint64(8), u, d)) for d in range(self.depth + 1)}

    def parts(self):
        """(d, key, zeros, ones, below) of the cut nodes."""
        for d, at in self.cut.items():
            if len(at):
                yield d, self.cut_keys[d], self.zeros[d][at], self.ones[d][at], self.below[d]

    def fill(self, weighed: dict[int, tuple[np.ndarray, ...]]) -> None:
        """Set whole counts and weights of the cut nodes: per depth sorted keys, zeros, ones, weights of the own estimate."""
        for d, at in self.cut.items():
            if len(at):
                keys, zeros, ones, stay = weighed[d]
                found = np.searchsorted(keys, self.cut_keys[d])
                self.zeros[d][at], self.ones[d][at], self.stay[d][at] = zeros[found], ones[found], stay[found]

    def predict(self) -> np.ndarray:
        """The mixture of all depths' estimates of each n-gram's decision."""
        index, p = self.index, None
        for d in range(self.depth, -1, -1):
            if p is not None:
                index = self.parents[d + 1][index]
            a, b = self.zeros[d], self.ones[d]
            one = (b + 0.5) / (a + b + 1.0)
            own = one[index]
            own = np.where(self.bits, own, 1 - own)
            if p is None:
                p = own
            else:
                stay = self.stay[d][index]
                p = stay * own + (1 - stay) * p
        return p


def _bounds(cuts: np.ndarray, r: int) -> tuple[int, int]:
    low = int(cuts[r - 1]) if r else 0
    return low, int(cuts[r]) - 1 if r < len(cuts) else (1 << 64) - 1


_PART = "struct<d:int,key:long,zeros:long,ones:long,below:double>"
_SUMMED = f"r long, codes binary, code_n binary, blocks array<long>, at array<binary>, word_n array<binary>, n long, known long, parts array<{_PART}>"


def _sum_range(cuts: np.ndarray, depth: int):
    """One row for a range: its n-grams with counts, where in them those of each block stand, totals of each block's words, and its
    parts of the cut nodes."""
    part = pa.struct([("d", pa.int32()), ("key", pa.int64()), ("zeros", pa.int64()), ("ones", pa.int64()), ("below", pa.float64())])
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.list_(part)]
    schema = pa.schema([(c, t) for c, t in zip("r codes code_n blocks at word_n n known parts".split(), kinds)])

    def run(key, table):
        r, number = key[0].as_py(), defaultdict(count().__next__)
        codes, counts, words, word_n = [], [], [], []
        columns = [table[c] for c in ("words", "word_n", "codes", "code_n")]
        for i in range(table.num_rows):
            text, m, some, n = (c[i].as_py() for c in columns)
            word_n.append(_unpack(m, np.int64))
            words.append(np.fromiter(map(number.__getitem__, _words_of(text, len(word_n[-1]))), np.int32, len(word_n[-1])))
            codes.append(_unpack(some, np.uint64, True))
            counts.append(_unpack(n, np.int64))
            if sum(map(len, codes[1:])) > MERGED:
                codes, counts = ([x] for x in _sum_codes(codes, counts))
        codes, counts = _sum_codes(codes, counts)
        total = np.zeros(len(number), np.int64)
        for mine, m in zip(words, word_n):  # a block lists a word once
            total[mine] += m
        word_n = [_pack(total[mine]) for mine in words]
        at = [_pack(np.searchsorted(codes, _unpack(some.as_py(), np.uint64, True)).astype(np.uint32), True) for some in columns[2]]
        parts, kt = [], Estimator()
        if len(codes):
            for bit in range(8):
                for d, *values in Tree(codes, counts, depth, bit, *_bounds(cuts, r), kt).parts():
                    parts += [dict(zip(("d", "key", "zeros", "ones", "below"), (d, *v))) for v in zip(*(x.tolist() for x in values))]
        return _table([(r, _pack(codes, True), _pack(counts), table["block"].to_pylist(), at, word_n, int(total.sum()), int(np.count_nonzero(total)), parts)], schema)

    return run


_WEIGHED = "d int, key long, zeros long, ones long, stay double"


def _weigh(depth: int):
    def run(table):
        """The cut nodes of one decision, from the deepest to the root."""
        d, key = table["d"].to_numpy(), table["key"].to_numpy()
        zeros, ones, below = (table[c].to_numpy() for c in ("zeros", "ones", "below"))
        kt, out, deeper = Estimator(), [], None
        for level in range(depth, -1, -1):
            at = np.flatnonzero(d == level)
            at = at[np.argsort(key[at])]
            if not len(at):
                continue
            sums = below[at].copy()
            if deeper is not None:
                up = ((deeper[0] >> 16) << 8) | (deeper[0] & 255)
                np.add.at(sums, np.searchsorted(key[at], up), deeper[1])
            weighted, stay = mixed(kt(zeros[at], ones[at]), sums)
            deeper = key[at], weighted
            out.append((d[at], key[at], zeros[at], ones[at], stay))
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.table([pa.array(c, t) for c, t in zip(cols, [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.float64()])], names=[c.split()[0] for c in _WEIGHED.split(", ")])

    return run


_TOLD = "block long, r long, word_n binary, logp binary"


def _tell(cuts: np.ndarray, depth: int):
    """log10 probabilities of a range's n-grams, told to each block in its order, with the training counts of its words."""
    schema = pa.schema([("block", pa.int64()), ("r", pa.int64()), ("word_n", pa.binary()), ("logp", pa.binary())])

    def tell(row):
        codes, counts = _unpack(row["codes"], np.uint64, True), _unpack(row["code_n"], np.int64)
        nodes = sorted((x["d"], x["key"], x["zeros"], x["ones"], x["stay"]) for x in row["weighed"] or [])
        upper = {d: tuple(map(np.array, list(zip(*of))[1:])) for d, of in ((d, list(of)) for d, of in groupby(nodes, lambda x: x[0]))}
        logp, kt = np.zeros(len(codes)), Estimator()
        if len(codes):
            for bit in range(8):
                tree = Tree(codes, counts, depth, bit, *_bounds(cuts, row["r"]), kt)
                tree.fill(upper)
                logp += np.log10(tree.predict())
                del tree  # or it would stand beside the next
        logp = logp.astype(np.float32)
        for block, at, word_n in zip(row["blocks"], row["at"], row["word_n"]):
            yield block, row["r"], word_n, _pack(logp[_unpack(at, np.uint32, True)])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one range at a time
                yield from _table(list(tell(batch.slice(i, 1).to_pylist()[0])), schema).to_batches()

    return run


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, n_bytes long, base_score double, score double, bits_per_byte double"


def _score(depth: int, cuts: np.ndarray, n: int, v: int):
    kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 4, *[pa.float64()] * 3]
    schema = pa.schema([(c.split()[0], t) for c, t in zip(_SCORED.split(", "), kinds)])
    below = n + ADD * (v + 1)

    def by_words(slices, told):
        """Per slice, the number of tokens, that of known ones, and the base score of each text."""
        number = defaultdict(count().__next__)
        numbered = [_numbered(part, number) for _, part in slices]
        seen = np.zeros(len(number), np.int64)
        by_range = _words_by_range(list(number), len(cuts) + 1)
        for r, word_n in zip(told["r"].to_pylist(), told["word_n"]):
            seen[by_range[r]] = _unpack(word_n.as_py(), np.int64)
        value = np.log10((seen + ADD) / below)
        for size, ws in numbered:
            text = np.repeat(np.arange(len(size)), size)
            yield size, np.bincount(text, seen[ws] > 0, len(size)).astype(np.int64), np.bincount(text, value[ws], len(size))

    def by_ngrams(slices, told):
        """Per slice, the score of each text."""
        codes, ends, index, sizes = [], [], [], []
        for _, part in slices:
            grams, size = ngrams(part, depth)
            u, at = _indexed(turned(grams))
            codes.append(u)
            ends.append(_ends(u, cuts))
            index.append(at)
            sizes.append(size)
        logp = [np.empty(len(u), np.float32) for u in codes]
        for r, found in zip(told["r"].to_pylist(), told["logp"]):  # one range at a time
            mine, found = [u[e[r] : e[r + 1]] for u, e in zip(codes, ends)], _unpack(found.as_py(), np.float32)
            whole = _distinct(np.concatenate(mine))
            for some, p, e in zip(mine, logp, ends):
                p[e[r] : e[r + 1]] = found[np.searchsorted(whole, some)]
        for p, at, size in zip(logp, index, sizes):
            yield np.add.reduceat(p[at].astype(float), np.concatenate(([0], np.cumsum(size)[:-1])))

    def run(docs, told):
        ids, texts = _documents_of(docs.to_pylist()[0])
        slices = list(_text_slices(ids, texts))
        words = list(by_words(slices, told))  # done before the n-grams take memory
        out = []
        for (some, part), of, scores in zip(slices, words, by_ngrams(slices, told)):
            for doc, text, size, known, base, score in zip(some, part, *(x.tolist() for x in of), scores.tolist()):
                out.append((doc, is_held_out(doc), size, known, n, len(text), base, score, -score * np.log2(10) / (len(text) + 1)))
        return _table(out, schema)

    return run


def score(df: DataFrame, depth: int = DEPTH, block_bytes: int = BLOCK_BYTES, range_size: int = RANGE) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, n_bytes, base_score, score, bits_per_byte.

    ``score`` is the log10 probability of the text and its end under the tree; ``bits_per_byte`` the code length per byte, the end
    counted as a byte. Null text counts as empty and is one token, the end. A null id is held out. Repeated rows are learned as often
    as they stand there. Without training documents every bit has probability one half and N is 0. An empty table gives no rows.
    Texts are read whole, however long; other columns are not read. The log of each byte's probability is rounded to 24 bits.
    """
    small_batches(df.sparkSession)
    every = max(1, range_size // SAMPLED)
    blocks = written(documents(df).mapInArrow(_blocks(depth, block_bytes, every), _BLOCK), "blocks")
    cuts = range_cuts(blocks, every, range_size, depth)
    asked = blocks.drop("sample").mapInArrow(_ask(cuts, depth), _ASKED)
    summed = written(asked.groupBy("r").applyInArrow(_sum_range(cuts, depth), _SUMMED), "ranges")
    known = summed.agg(F.sum("n").alias("n"), F.sum("known").alias("v")).first()
    parts = summed.select("r", F.inline("parts"))
    nodes = parts.groupBy("d", "key").agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "below")))
    nodes = nodes.groupBy(F.col("key").bitwiseAND(F.lit(255)).alias("u")).applyInArrow(_weigh(depth), _WEIGHED)
    weighed = parts.select(F.col("r").alias("own"), "d", "key").join(nodes, ["d", "key"])
    # Small beside the ranges, which Spark shuffles only where these are too large for its broadcast threshold.
    weighed = written(weighed.groupBy("own").agg(F.collect_list(F.struct("d", "key", "zeros", "ones", "stay")).alias("weighed")), "weighed")
    ranges = summed.drop("parts", "n", "known").join(weighed, F.col("r") == F.col("own"), "left").drop("own")
    told = ranges.mapInArrow(_tell(cuts, depth), _TOLD)
    docs = blocks.drop("sample")
    return docs.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_score(depth, cuts, known.n or 0, known.v or 0), _SCORED)
