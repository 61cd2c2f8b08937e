"""From raw text to typed rows: one projection, one dedupe, one rule pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.context import Run
from sluice.functions import nullify
from sluice.operators.dedupe import dedupe
from sluice.operators.rules import RAW, RAW_PREFIX, Rule, evaluate, invalid_rows, raw_if_broken, valid_rows

COPIES = "_copies"


@dataclass(frozen=True)
class Dataset:
    """All that is particular to one raw table.

    ``casts`` work on text without null markers.  ``parsers`` are given the raw
    text: no marker is a number or a time, so they make it NULL by themselves
    and the search for markers is saved.
    """

    name: str
    file_name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    rules: Callable[[Run], Sequence[Rule]]
    casts: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    parsers: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)


def nullify_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn null markers into NULL."""
    return df.select(
        *[
            nullify(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "string" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def provenance(run: Run) -> dict[str, Column]:
    return {
        "business_date": F.lit(run.business_date),
        "source_zip": F.lit(run.source_zip),
        "pipeline_run_id": F.lit(run.run_id),
        "ingested_at": F.lit(run.started_at),
    }


def typed_columns(raw: DataFrame, spec: Dataset) -> DataFrame:
    """Typed columns of one dataset; columns the spec does not know pass through."""

    def typed(name: str) -> Column:
        if name in spec.parsers:
            return spec.parsers[name](F.col(name)).alias(name)
        step = spec.casts.get(name)
        text = nullify(F.col(name))
        return (step(text) if step else text).alias(name)

    others = [c for c in raw.columns if c not in spec.columns]
    return raw.select(*[typed(c) for c in spec.columns], *others)


def with_derived(cleaned: DataFrame, spec: Dataset) -> DataFrame:
    return cleaned.withColumns({name: make() for name, make in spec.derived.items()})


def clean(raw: DataFrame, spec: Dataset) -> DataFrame:
    """Typed and derived columns of one dataset."""
    return with_derived(typed_columns(raw, spec), spec)


@dataclass(frozen=True)
class Curated:
    """One dataset after cleaning, dedupe and rules.

    ``evaluated`` holds each surviving row once, with its reasons and with the
    number of raw rows behind it, so all counts can be had from this one frame.
    """

    spec: Dataset
    run: Run
    evaluated: DataFrame

    @property
    def valid(self) -> DataFrame:
        return valid_rows(self.evaluated).drop(COPIES, RAW)

    @property
    def invalid(self) -> DataFrame:
        return invalid_rows(self.evaluated).drop(COPIES)


def clean_with_raw(raw: DataFrame, spec: Dataset, run: Run) -> DataFrame:
    """Typed columns, and the raw text of the rows that break a rule."""
    held = {RAW_PREFIX + c: F.col(c) for c in spec.columns}
    cleaned = clean(raw.withColumns(held), spec)
    # A row's survivor is chosen by its cleaned columns: the raw text comes last.
    return raw_if_broken(spec.rules(run), list(held), cleaned)


def curate(
    raw: DataFrame, spec: Dataset, run: Run, order_by: Sequence[str] = (), keep_raw: bool = False
) -> Curated:
    """Clean, keep one row per key, evaluate the rules.

    ``order_by`` names the columns that say which copy came first; they are
    dropped, but for the archive a row came from.  Constants of the run and derived columns, on which no two
    rows differ that are equal in the others, are added after the shuffle, not carried through it.  With ``keep_raw``
    rejected rows keep the text they came as; rules are then applied before the shuffle, which may read derived columns.
    """
    if keep_raw:
        one_per_key = dedupe(clean_with_raw(raw, spec, run), spec.keys, order_by, copies=COPIES)
    else:
        one_per_key = with_derived(dedupe(typed_columns(raw, spec), spec.keys, order_by, copies=COPIES), spec)
    stamps = {n: c for n, c in provenance(run).items() if n not in one_per_key.columns}
    helpers = [c for c in order_by if c != "source_zip"]
    columns = [c for c in one_per_key.columns if c != COPIES and c not in helpers]
    stamped = one_per_key.select(*columns, *[c.alias(n) for n, c in stamps.items()], COPIES)
    return Curated(spec, run, evaluate(stamped, spec.rules(run)))
