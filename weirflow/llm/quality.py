"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus, by Spark expressions only.

Words and word pairs are hashed into ``BUCKETS`` features. Two multinomials are counted, one over trusted documents (a bounded
sample of those whose labels all say quality 1), one over every document. A document's score is the mean log ratio per feature,
and the same threshold holds for every document. Fixed text rules come before it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import documents, held_above, words

BUCKETS = 1 << 15
TRUSTED = 20_000  # at most this many trusted documents are used, the first by hash of the id
THRESHOLD = -0.125  # mean log ratio per feature
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PCT = 50


def _bucket(buckets: int, *c: Column) -> Column:
    return F.pmod(F.xxhash64(*c), F.lit(buckets)).cast("int")


def features(ws: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and adjacent word pairs."""
    bucket = lambda *c: _bucket(buckets, *c)
    pairs = F.when(F.size(ws) > 1, F.transform(F.slice(ws, 2, F.greatest(F.size(ws) - 1, F.lit(0))), lambda w, i: bucket(F.get(ws, i), w)))
    return F.concat(F.transform(ws, lambda w: bucket(w)), F.coalesce(pairs, F.array().cast("array<int>")))


def _trusted(labels: DataFrame, limit: int) -> DataFrame:
    good = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].alias("q")).where("doc_id is not null")
    return good.groupBy("doc_id").agg(F.min("q").alias("q"), F.count("q").alias("n"), F.count(F.lit(1)).alias("all")).where("q = 1 and n = all").orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).select("doc_id")


def log_ratios(df: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED) -> list[float]:
    """Log ratio of trusted to raw share for each bucket; add-one smoothing. All zero when nothing is trusted or there is no text."""
    docs = documents(df)
    marked = docs.join(F.broadcast(_trusted(labels, trusted).withColumn("good", F.lit(1))), "doc_id", "left")
    marked = marked.select(words(F.col("text")).alias("ws"), F.coalesce("good", F.lit(0)).alias("good"))
    # Outer generators: Spark adds no filter on their input, which would be computed twice.
    following = F.slice("ws", F.lit(2), F.greatest(F.size("ws"), F.lit(1)))
    pairs = marked.select("good", F.inline_outer(F.arrays_zip(F.col("ws").alias("w"), following.alias("v")))).toDF("good", "w", "v")
    both = F.array(F.when(F.col("w").isNotNull(), _bucket(buckets, F.col("w"))), F.when(F.col("v").isNotNull(), _bucket(buckets, F.col("w"), F.col("v"))))
    feats = pairs.select("good", F.explode_outer(both).alias("b")).where("b is not null")
    counts = feats.groupBy("b").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good")).collect()  # one row per bucket at most
    raw, good = sum(r.raw for r in counts), sum(r.good for r in counts)
    ratios = [math.log((raw + buckets) / (good + buckets)) if good else 0.0] * buckets
    for r in counts:
        if good:
            ratios[r.b] = math.log((r.good + 1) / (good + buckets)) - math.log((r.raw + 1) / (raw + buckets))
    return ratios


def window_hashes(ws: Column) -> Column:
    """64-bit hashes of all 3-word windows; they are compared within one text only."""
    hashed = F.transform(F.slice(ws, 3, F.greatest(F.size(ws) - 2, F.lit(0))), lambda w, i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), w))
    return F.when(F.size(ws) >= 3, hashed).otherwise(F.array().cast("array<bigint>"))


def repeated_places(hashes: Column) -> Column:
    """First words of the windows that stand there twice or more, in order. Sorting is only done where a hash repeats."""
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def measures(df: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, the words, the counts of the fixed rules and base_failed; with ``carry`` also the input row as struct ``row``."""
    docs = documents(df, carry=carry)
    row = ["row"] if carry else []
    lines = F.filter(F.split("text", "\n", -1), lambda s: F.btrim(s, F.lit(" \t\n\x0b\f\r")) != "")
    rows = docs.select(
        "doc_id", words(F.col("text")).alias("ws"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"), *row,
    )
    rows = rows.withColumn("hs", window_hashes(F.col("ws"))).withColumn("placed", repeated_places(F.col("hs")))
    beside = lambda x, k: F.coalesce(F.get("placed", k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("placed", k + 1)["h"] == x["h"], F.lit(False))
    rows = rows.withColumn("at", F.array_sort(F.transform(F.filter("placed", beside), lambda x: x["i"])))
    covered = F.aggregate(
        F.transform("at", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("at", k + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x
    )
    rows = rows.select(
        "doc_id", "ws",
        F.size("ws").cast("long").alias("n_words"),
        F.aggregate("ws", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"), *row,
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def scored(df: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED, threshold: float = THRESHOLD, carry: bool = False) -> DataFrame:
    """The measures with ``llr`` and the verdict ``kept``."""
    ratios = log_ratios(df, labels, buckets, trusted)
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")  # folded to one literal
    rows = measures(df, carry).withColumn("f", features(F.col("ws"), buckets))
    total = F.aggregate("f", F.lit(0.0), lambda a, b: a + F.get(table, b))
    rows = rows.withColumn("llr", F.when(F.size("f") > 0, total / F.size("f")).otherwise(0.0))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def judge(df: DataFrame, labels: DataFrame, buckets: int = BUCKETS, trusted: int = TRUSTED, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    Null or empty text has no words: it fails the rules and has ratio 0. Repeated rows and null ids each keep their row. Without
    trusted documents every ratio is 0, and the fixed rules decide alone. An empty table gives no rows. Extra columns of the
    input are not read. Labels with a null or contradicting quality are not trusted.
    """
    return scored(df, labels, buckets, trusted, threshold).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept")


def keep_good(df: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of the input that ``judge`` keeps, with all their columns."""
    return held_above(scored(df, labels, carry=True, **options), "kept").select("row.*")
