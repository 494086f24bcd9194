"""Row rules, contracts and good/bad splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.fixed import (
    CREDIT_SCORE_RANGE, INTEREST_RATE_RANGE, LOAN_REQUIRED, LOAN_TYPES, MAX_LOAN_AMOUNT,
)

ERRORS = "errors"


def with_errors(df: DataFrame, rules: Mapping[str, Column], out: str = ERRORS) -> DataFrame:
    """Add the names of all violated rules; a rule is a condition that means "bad" (NULL counts as good)."""
    return df.withColumn(out, F.array_compact(F.array(*[F.when(bad, F.lit(n)) for n, bad in rules.items()])))


def split_by_errors(df: DataFrame, errors: str = ERRORS) -> tuple[DataFrame, DataFrame]:
    """(good rows without the error column, bad rows with it).

    The row id keeps the optimizer from copying every rule and every cleaning step into the filter:
    the columns are computed once and the filter only looks at the finished array.
    """
    once = df.withColumn("__row", F.monotonically_increasing_id())
    computed = F.col("__row") >= 0
    good = once.filter((F.size(errors) == 0) & computed).drop(errors, "__row")
    return good, once.filter((F.size(errors) > 0) & computed).drop("__row")


def loan_rules(as_of: str) -> dict[str, Column]:
    """The six business rules for loan records."""
    low, high = CREDIT_SCORE_RANGE
    rate_low, rate_high = INTEREST_RATE_RANGE
    rules = {f"Missing required field: {f}": F.col(f).isNull() for f in LOAN_REQUIRED}
    rules |= {
        "Invalid amount": F.col("amount") <= 0,
        "Amount exceeds max": F.col("amount") > MAX_LOAN_AMOUNT,
        "Invalid credit score": (F.col("credit_score") < low) | (F.col("credit_score") > high),
        "Invalid rate": (F.col("interest_rate") < rate_low) | (F.col("interest_rate") > rate_high),
        "Unknown loan type": ~F.col("loan_type").isin(*LOAN_TYPES),
        "Future date": F.col("application_date") > F.lit(as_of).cast("date"),
    }
    return rules


def basic_loan_rules() -> dict[str, Column]:
    """The short form: amount, score and required ids."""
    low, high = CREDIT_SCORE_RANGE
    return {
        "Missing loan_id": F.col("loan_id").isNull() | (F.col("loan_id") == ""),
        "Invalid amount": F.col("amount").isNull() | (F.col("amount") <= 0),
        "Invalid credit score": (F.col("credit_score") < low) | (F.col("credit_score") > high),
    }


def required(df: DataFrame, fields: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Rows with all fields present and non-blank, and the numeric ones readable as numbers."""
    tests = []
    for f in fields:
        present = F.col(f).isNotNull()
        if isinstance(df.schema[f].dataType, T.StringType):
            present = present & (F.trim(f) != "")
        tests.append(present)
    tests += [F.col(f).cast("string").try_cast("double").isNotNull() for f in numeric]
    return df.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))


def matches_schema(df: DataFrame, required_fields: Sequence[str], types: Mapping[str, str]) -> DataFrame:
    """Required fields present and typed fields castable to their type."""
    tests = [F.col(f).isNotNull() for f in required_fields]
    tests += [F.col(f).isNull() | F.col(f).try_cast(t).isNotNull() for f, t in types.items()]
    return df.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))


def field_filter(df: DataFrame, field: str, equals=None, low=None, high=None) -> DataFrame:
    """Equality, or a closed range. With only one end of the range nothing passes."""
    if equals is not None:
        return df.filter(F.col(field) == equals)
    if low is not None and high is not None:
        return df.filter(F.col(field).between(low, high))
    return df.filter(F.lit(False))


@dataclass(frozen=True)
class ContractReport:
    missing: list[str]
    extra: list[str]
    wrong_type: list[str]

    @property
    def ok(self) -> bool:
        return not self.missing and not self.wrong_type


def check_contract(df: DataFrame, contract: T.StructType, *, check_types: bool = True) -> ContractReport:
    """Compare a frame with its contract: missing or mistyped columns break it, extra ones are reported."""
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in contract.fields}
    wrong = [n for n, t in want.items() if check_types and n in have and have[n] != t]
    return ContractReport(
        [n for n in want if n not in have], [n for n in have if n not in want], wrong
    )


def enforce_contract(df: DataFrame, contract: T.StructType, **options) -> DataFrame:
    report = check_contract(df, contract, **options)
    if not report.ok:
        raise ValueError(f"contract broken: missing {report.missing}, wrong type {report.wrong_type}")
    return df


def compatibility(old: T.StructType, new: T.StructType) -> str:
    """BACKWARD (new readers, old data), FORWARD (old readers, new data), FULL or NONE."""
    before = {f.name: f for f in old.fields}
    after = {f.name: f for f in new.fields}
    same = all(before[n].dataType == after[n].dataType for n in before.keys() & after.keys())
    backward = same and all(after[n].nullable for n in after.keys() - before.keys())
    forward = same and all(before[n].nullable for n in before.keys() - after.keys())
    return {(True, True): "FULL", (True, False): "BACKWARD", (False, True): "FORWARD"}.get(
        (backward, forward), "NONE"
    )


def cast_failures(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """One row per column: how many present values do not read as the type."""
    tests = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(c) for c, t in types.items()
    ]
    counted = df.agg(F.count(F.lit(1)).alias("__rows"), *tests)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in types])
    return counted.select("__rows", F.inline(pairs)).select(
        "column_name", F.col("__rows").alias("total_rows"), "failures"
    )


def require_cast_rate(df: DataFrame, types: Mapping[str, str], limit_pct: float = 5.0) -> None:
    """Raise when a column fails to cast in more than ``limit_pct`` percent of the rows."""
    for row in cast_failures(df, types).collect():  # one row per checked column
        rate = 100.0 * row.failures / row.total_rows if row.total_rows else 0.0
        if rate > limit_pct:
            raise ValueError(f"{row.column_name}: {row.failures} of {row.total_rows} values ({rate:.1f}%) do not cast")


def require_row_count(df: DataFrame, low: int, high: int) -> int:
    """Raise when the number of rows is outside the bounds."""
    n = df.count()
    if n < low:
        raise ValueError(f"too few rows: {n} (at least {low})")
    if n > high:
        raise ValueError(f"too many rows: {n} (at most {high})")
    return n
