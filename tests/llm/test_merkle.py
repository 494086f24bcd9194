"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from weirflow.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, part string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def climb(nodes):
    """All levels, and for each node its siblings on each level."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def up(levels, at):
    steps = []
    for level in levels[:-1]:
        start = at // 8 * 8
        steps.append((level[start:at], level[at + 1 : start + 8]))
        at //= 8
    return steps


def brute(rows):
    parts = {}
    for i, text, lang, source, n in rows:
        leaf = sha(*map(cell, (i, source, lang, n, text)))
        other = sha(*map(cell, (i, source, lang, n, lowered(text)))) if i is not None and zlib.crc32(str(i).encode()) % 3 == 0 else leaf
        parts.setdefault(lang, []).append((i is not None, i or 0, leaf, other))
    names = sorted(parts, key=lambda x: (x is not None, (x or "").encode()))
    trees = {name: climb([leaf for *_, leaf, _ in sorted(parts[name])]) for name in names}
    top = climb([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for at, (known, i, leaf, other) in enumerate(sorted(parts[name])):
            steps = up(trees[name], at) + up(top, place)
            folded = other
            for left, right in steps:
                folded = sha(*left, folded, *right)
            proof = sha(*(d for left, right in steps for d in left + right))
            out.append((i if known else None, leaf, trees[name][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def found(df):
    return sorted((tuple(r) for r in merkle.audit(df).collect()), key=str)


def test_edges(spark):
    rows = [
        (1, None, "en", "a", 3), (2, "", "en", None, None), (None, "No id", "en", "a", 1), (None, "No id", "en", "a", 1), (3, "Zwei", "de", "b", 4), (3, "Zwei", "de", "b", 4), (3, "ÄB Drei", "de", "b", 4),
        (4, "Solo", None, None, 4), (5, "Word " * 200_000, "fr", "a", 1), (-7, "Minus", "Z", "a", 1), (8, "x", "", "a", 1), (9, "x", "é", "a", 1),
    ]
    assert found(frame(spark, rows)) == brute(rows)
    assert found(frame(spark, [])) == []
    assert found(frame(spark, rows[:1])) == brute(rows[:1])


@pytest.mark.parametrize("size", [8, 9, 64, 65, 4097, 9000])
def test_storeys(spark, size):
    rows = [(i * 3, f"Text {i}", "en" if i % 300 else "de", "s", i) for i in range(size)]
    assert found(frame(spark, rows)) == brute(rows)


def test_versions_share_all_but_the_path(spark):
    rows = [(i, f"Text {i}", "en", "s", i) for i in range(100)]
    df = frame(spark, rows)
    made = merkle.manifest(df, F.col("doc_id") == 42).leaves().where("version is not null").collect()
    assert [r.key for r in made] == [42] and len(made[0].version) == 3
    changed = [(i, lowered(t) if i == 42 else t, *rest) for i, t, *rest in rows]
    assert made[0].version[-1] == merkle.manifest(frame(spark, changed)).leaves().first().root != made[0].root


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert found(docs) == brute(rows)
