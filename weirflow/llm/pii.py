"""Personal data: fixed patterns, and information-theoretic sanitisation of the terms that give a protected value away.

Spark expressions only. Protected entities are the values the patterns find. The corpus tells how strongly a word reveals one:
with N documents, n(e) with the entity, n(t) with the word and n(e,t) with both, the word's pointwise mutual information with
the entity is log2(N n(e,t) / (n(e) n(t))), and the entity's whole information is log2(N / n(e)). Any word of a document with the
entity is disclosing when it carries at least ``DISCLOSURE`` of that information, the word counted as seen in one further
document without the entity: so values of one document are judged as well, and what little data shows by chance is not. Disclosing
words are generalised wherever they occur in a document with the entity; base matches are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import documents, held_above, written

# The base patterns. A run of an address or a number is entered at its start or where the last match ended, and
# quantifiers whose result cannot change are possessive, so that long runs stay linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"

UNSEEN = 1  # further documents with the word and without the entity
DISCLOSURE = 0.9  # share of the entity's information


def find(hits: Column, between: Column) -> Column:
    """array<struct<start, end, value>> of matches and the pieces between them, in code points, end exclusive.

    Lengths of pieces and matches add up to positions. Both should be columns of their own, so that each is found once.
    """
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def step(acc: Column, i: Column) -> Column:
        start = acc["at"] + F.length(F.get(between, i))
        end = start + F.length(F.get(hits, i))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"), F.get(hits, i).alias("value")))).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out"))
    return F.when(F.size(hits) > 0, F.aggregate(F.sequence(F.lit(0), F.size(hits) - 1), start, step, lambda acc: acc["out"])).otherwise(empty)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return acc + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _is_ip(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.right(p, F.lit(3)).try_cast("int"), F.lit(999)) <= 255))


def base_spans() -> dict[str, Column]:
    """Spans of each kind from its matches, failing ones dropped."""
    digits = lambda s: F.length(_digits(s["value"]))
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    spans = {k: F.coalesce(find(F.col(f"_{k}"), F.col(f"_{k}_between")), none) for k in KINDS}
    return {
        "email": spans["email"],
        "ip": F.filter(spans["ip"], lambda s: _is_ip(s["value"])),
        "card": F.filter(spans["card"], lambda s: F.when(digits(s).between(13, 19), luhn(_digits(s["value"]))).otherwise(False)),
        "phone": F.filter(spans["phone"], lambda s: digits(s).between(9, 15)),
    }


def _matches(text: Column) -> list[Column]:
    """Matches of each kind and the pieces between; a cheap test first, most texts hold none."""
    tests = {"email": (F.contains(text, F.lit("@")), EMAIL), "ip": (text.rlike(r"[0-9]\.[0-9]"), IP), "card": (text.rlike("[0-9][ -]?[0-9]"), CARD), "phone": (text.rlike(r"\+[0-9]"), PHONE)}
    return [c for k, (may, pattern) in tests.items() for c in (
        F.when(may, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias(f"_{k}"), F.when(may, F.split(text, pattern, -1)).alias(f"_{k}_between"))]


def detect(df: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, text, a row key and one column of spans per base kind. Null text counts as empty."""
    docs = documents(df, carry=carry)
    found = docs.select("*", F.xxhash64("doc_id", "text").alias("key"), *_matches(F.col("text")))
    return found.select(*docs.columns, "key", *(c.alias(k) for k, c in base_spans().items()))


def _named(kind: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("name"))


def _entity(kind: str):
    return lambda s: F.concat(F.lit(f"{kind}:"), s["value"])


def _located(kind: str):
    return lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"])


def _terms(text: Column) -> Column:
    """Lower-case runs of two letters or more."""
    return F.filter(F.split(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), r"[^\p{L}]+"), lambda w: F.length(w) >= 2)


def disclosing_terms(docs: DataFrame, held: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(key, terms): the disclosing words of each document that holds a protected entity. Counts cover all documents.

    ``docs``: all documents; ``held``: the rows of ``detect`` with spans. Copies and repeated rows count as documents.
    """
    spans = [F.transform(k, _entity(k)) for k in KINDS]
    seen = held.select("key", F.explode(F.array_distinct(F.concat(*spans))).alias("e"), F.array_distinct(_terms(F.col("text"))).alias("ts"))
    pairs = seen.select("key", "e", F.explode("ts").alias("t"))
    # Each row gives a pair once, so pairs are counted before they travel; a hot entity spreads over its words.
    n_et = pairs.groupBy("e", "t").agg(F.count(F.lit(1)).alias("n_et"))
    n_e = seen.groupBy("e").agg(F.count(F.lit(1)).alias("n_e"))
    n_t = docs.select(F.explode(F.array_distinct(_terms(F.col("text")))).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n_t"))
    n = docs.count()
    told = n_et.join(n_e, "e").join(n_t, "t")
    share = F.log(n * F.col("n_et") / (F.col("n_e") * (F.col("n_t") + UNSEEN))) / F.log(n / F.col("n_e"))
    told = written(told.where((F.col("n_e") < n) & (share >= disclosure)).select("e", "t"), "told")
    return pairs.join(told, ["e", "t"]).select("key", "t").distinct().groupBy("key").agg(F.array_sort(F.collect_list("t")).alias("terms"))


def term_spans(held: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, term): spans of the disclosing words in each document, outside the base spans."""
    rows = held.dropDuplicates(["key"]).join(terms, "key")
    quoted = F.array_join(F.transform("terms", lambda t: F.concat(F.lit(r"\Q"), t, F.lit(r"\E"))), "|")
    pattern = F.concat(F.lit(r"(?<!\p{L})(?i:"), quoted, F.lit(r")(?!\p{L})"))
    base = F.concat(*KINDS)
    rows = rows.withColumn("pattern", pattern)
    rows = rows.select("key", *KINDS, F.regexp_extract_all("text", F.col("pattern"), F.lit(0)).alias("hits"), F.split("text", F.col("pattern"), F.lit(-1)).alias("between"))
    apart = F.filter(find(F.col("hits"), F.col("between")), lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return rows.select("key", apart.alias(TERM))


def _all_spans(df: DataFrame, carry: bool, disclosure: float) -> DataFrame:
    """The detected spans of every document with a ``term`` column beside the base kinds."""
    found = detect(df, carry)
    held = written(held_above(detect(df), " or ".join(f"size({k}) > 0" for k in KINDS)).select("key", "text", *KINDS), "held")
    terms = term_spans(held, disclosing_terms(documents(df), held, disclosure))
    rows = found if carry else found.drop("text")
    return rows.join(written(terms, "terms"), "key", "left").withColumn(TERM, F.coalesce(TERM, F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")))


def _told(kinds) -> Column:
    return F.array_join(F.concat(*(F.transform(k, _located(k)) for k in kinds)), ",")


def report(df: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans.

    Null and empty texts have no spans; an entity that every document holds reveals nothing. Repeated rows and null ids each keep
    their row. Spans of different kinds may overlap; term spans avoid base spans. An empty table gives no rows.
    """
    rows = _all_spans(df, False, disclosure)
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in (*KINDS, TERM)]
    return rows.select("doc_id", *counts, F.sha2(_told(KINDS), 256).alias("base_sha256"), _told((*KINDS, TERM)).alias("spans"))


def sanitise(df: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """The input rows with the spans in ``text`` replaced by [EMAIL], [IP], [CARD], [PHONE] or [TERM]; overlapping spans become one,
    named after the first. A null text stays null."""
    rows = _all_spans(df, True, disclosure)
    spans = F.array_sort(F.concat(*(F.transform(k, _named(k)) for k in (*KINDS, TERM))))

    def step(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        piece = F.array(F.substring(F.col("text"), acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int")), s["name"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate(spans, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"].cast("int") + 1, F.lit(2147483647))))
    rows = rows.withColumn("clean", F.when(F.size(spans) > 0, clean).otherwise(F.col("row.text")))
    return rows.select(*(F.col("clean").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in df.columns))
