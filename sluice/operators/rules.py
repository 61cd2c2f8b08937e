"""Row rules: evaluate once, split, wrap what failed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.context import Run
from sluice.functions import as_json

REASON = "reject_reason"
REASON_MARK = "|"
#: The text of a rejected row as it came, if it was asked for.
RAW = "raw_json"


@dataclass(frozen=True)
class Rule:
    """A reason and the condition that makes it apply.

    Conditions are three-valued: a rule fires on TRUE only, so a comparison
    with NULL never rejects a row.
    """

    reason: str
    broken: Column


def missing(column: str, reason: str) -> Rule:
    return Rule(reason, F.col(column).isNull())


def not_length(column: str, size: int, reason: str) -> Rule:
    return Rule(reason, F.length(column) != size)


def below(column: str, least: float, reason: str) -> Rule:
    return Rule(reason, F.col(column) < least)


def above(column: str, most: float, reason: str) -> Rule:
    return Rule(reason, F.col(column) > most)


def outside(column: str, least: float, most: float, reason: str) -> Rule:
    return Rule(reason, ~F.col(column).between(least, most))


def not_among(column: str, allowed: Sequence[str], reason: str) -> Rule:
    return Rule(reason, ~F.col(column).isin(*allowed))


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the reasons that apply, each once, first seen first; ``''`` if none.

    The list of reasons is built only for rows that break a rule at all.
    """
    fired = F.array(*[F.when(rule.broken, rule.reason) for rule in rules])
    any_broken = reduce(lambda a, b: a | b, [rule.broken for rule in rules])
    text = F.concat_ws(REASON_MARK, F.array_distinct(fired))
    return df.withColumn(REASON, F.when(any_broken, text).otherwise(""))


def is_valid() -> Column:
    return F.col(REASON) == ""


def valid_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(is_valid()).drop(REASON)


def invalid_rows(evaluated: DataFrame) -> DataFrame:
    return evaluated.filter(~is_valid())


def split(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows no rule rejects, and the others with their reasons."""
    evaluated = evaluate(df, rules)
    return valid_rows(evaluated), invalid_rows(evaluated)


def reason_list() -> Column:
    """The reasons of a rejected row as an array."""
    return F.split(REASON, r"\|")


def raw_if_broken(rules: Sequence[Rule], raw: Sequence[str], cleaned: DataFrame) -> DataFrame:
    """Add the raw columns as JSON to rows that break a rule, NULL to all others.

    Rules look at one row, so this can be told before copies are dropped; good rows
    carry nothing more than a NULL.  ``raw`` names the columns of ``cleaned`` with raw text; they go.
    """
    any_broken = reduce(lambda a, b: a | b, [rule.broken for rule in rules])
    text = F.to_json(F.struct(*[F.col(c).alias(c.removeprefix(RAW_PREFIX)) for c in raw]))
    return cleaned.withColumn(RAW, F.when(any_broken, text)).drop(*raw)


#: How the raw columns are called while they stand beside the cleaned ones.
RAW_PREFIX = "_raw_"


def reject_envelope(invalid: DataFrame, dataset: str | Column, run: Run) -> DataFrame:
    """One common shape for rejects: what, when, why, and the row as JSON.

    Rows that carry their raw text have it in a column of its own.
    """
    raw = [RAW] if RAW in invalid.columns else []
    return invalid.select(
        (F.lit(dataset) if isinstance(dataset, str) else dataset).alias("dataset_name"),
        F.lit(run.business_date).alias("business_date"),
        F.lit(run.run_id).alias("pipeline_run_id"),
        F.col(REASON),
        as_json([c for c in invalid.columns if c not in (RAW, DATASET)]).alias("record_json"),
        F.lit(run.started_at).alias("rejected_at"),
        *raw,
    )


#: A column that says to which dataset a rejected row is counted; it is no part of the record.
DATASET = "_dataset"


def union_all(frames: Sequence[DataFrame]) -> DataFrame | None:
    """All rows of all frames, matched by column name; None for no frames."""
    if not frames:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def reason_counts(rejects: DataFrame) -> DataFrame:
    """Rows per dataset and single reason."""
    return (
        rejects.select("dataset_name", F.explode(reason_list()).alias("reason"))
        .groupBy("dataset_name", "reason")
        .agg(F.count("*").alias("row_count"))
    )
