"""Peaks of memory inside Arrow tasks."""

import gc
import tracemalloc

import numpy as np
import pyarrow as pa

from weirflow.llm import ctw, substrings


def _peak(work):
    gc.collect()
    tracemalloc.start()
    try:
        out = work()
        return out, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def _prose(n):
    rng = np.random.default_rng(1)
    vocabulary = [rng.integers(97, 122, rng.integers(2, 9)).astype(np.uint8).tobytes() for _ in range(3000)]
    return b" ".join(vocabulary[i] for i in rng.integers(0, 3000, n))


def test_a_range_of_the_context_trees_holds_one_tree_of_few_columns():
    codes, n = np.unique(ctw.turned(ctw.ngrams([_prose(100_000)], 7)[0]), return_counts=True)
    root = [{"d": 0, "key": k, "zeros": 5, "ones": 5, "stay": 0.5} for k in range(1, 256)]
    row = {"r": 0, "codes": ctw._pack(codes, True), "code_n": ctw._pack(n), "weighed": root, "blocks": [1], "at": [ctw._pack(np.arange(len(codes), dtype=np.uint32), True)], "word_n": [b""]}
    _, peak = _peak(lambda: list(ctw._tell(np.zeros(0, np.uint64), 7)([pa.RecordBatch.from_pylist([row])])))
    assert peak < 240 * len(codes)  # 312 with two trees that hold all keys


class _Task:
    """Stands in for the context of a task."""

    get = classmethod(lambda cls: cls)
    partitionId = staticmethod(lambda: 0)


def test_a_block_of_the_context_trees_keeps_its_texts_and_lists_n_grams_by_range(monkeypatch):
    monkeypatch.setattr(ctw, "TaskContext", _Task)
    texts = _prose(1_200_000).split(b" ")
    texts = [b" ".join(texts[i : i + 2000]) for i in range(0, len(texts), 2000)]
    size = sum(map(len, texts))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": [t.decode() for t in texts]})
    cuts = (np.arange(ord("a"), ord("z") + 1, dtype=np.uint64) << np.uint64(56)) + (np.uint64(ord("m")) << np.uint64(48))

    def work():
        blocks = list(ctw._blocks(7, 16 << 20, 2048)([batch]))
        return blocks, list(ctw._ask(cuts)(blocks))

    (blocks, asked), peak = _peak(work)
    want, n = np.unique(ctw.turned(ctw.ngrams([t for i, t in enumerate(texts) if not ctw.is_held_out(i)], 7)[0]), return_counts=True)
    rows = sorted((x for b in asked for x in b.to_pylist()), key=lambda x: x["r"])
    codes, code_n = (np.concatenate([ctw._unpack(x[c], t, c == "codes") for x in rows]) for c, t in (("codes", np.uint64), ("code_n", np.int64)))
    assert (codes[code_n > 0] == want).all() and (code_n[code_n > 0] == n).all()
    assert np.isin(ctw.turned(ctw.ngrams(texts, 7)[0]), codes).all()
    assert len(blocks) == 1 and blocks[0].nbytes < 0.6 * size  # 1.38 with the n-grams in it
    assert peak < 20 * size  # 35 with all n-grams of a block summed at once


def test_suffix_sort_makes_few_whole_strings_at_a_time():
    raw = _prose(60_000) + b"\0\0a" + b"ab" * 500 + b"\0"
    at = np.flatnonzero(np.arange(len(raw)) % 3 > 0)
    got, peak = _peak(lambda: substrings.sorted_suffixes(raw, at, 200))
    assert got.tolist() == sorted(at.tolist(), key=lambda i: raw[i : i + 200])
    assert peak < 130 * len(at)  # whole strings alone are 233 bytes each
