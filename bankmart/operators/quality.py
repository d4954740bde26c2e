"""Data checks: unique, not null, accepted values, relationships.

Every check yields one result row (``RESULT_COLUMNS``). ``failures`` counts
duplicated values for ``unique``, rows for ``not_null`` and ``relationships``, and
distinct offending values for ``accepted_values``. Nulls only fail ``not_null``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIQUE, NOT_NULL, ACCEPTED_VALUES, RELATIONSHIPS = "unique", "not_null", "accepted_values", "relationships"
ERROR, WARN = "error", "warn"
RESULT_COLUMNS = ("test_name", "model", "column", "kind", "severity", "failures", "passed")


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    severity: str = ERROR
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"

    def result(self, failures: Column) -> list[Column]:
        return [
            F.lit(self.name).alias("test_name"),
            F.lit(self.model).alias("model"),
            F.lit(self.column).alias("column"),
            F.lit(self.kind).alias("kind"),
            F.lit(self.severity).alias("severity"),
            failures.cast("bigint").alias("failures"),
            (failures == 0).alias("passed"),
        ]


_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _numeric(dtype: str) -> bool:
    return dtype in (*_WHOLE, "float", "double") or dtype.startswith("decimal")


def _key(value: Column, own: str, other: str) -> list[Column]:
    """A value of type ``own`` as a number or a text, spelled as one of type ``other`` that equals it."""
    number = text = F.lit(None)
    if own in _WHOLE and other in _WHOLE:
        number = value
    elif own == other == "date":
        number = F.unix_date(value)
    elif own == other:
        text = value
    elif _numeric(own) and _numeric(other):
        text = value.try_cast("decimal(38,18)")
    else:
        text = value.cast(max(own, other))
    return [number.cast("bigint").alias("number"), text.cast("string").alias("text")]


def _suspects(check: Check, value: Column) -> Column:
    """Whether a row's value has to be counted for a check: any value, or only one that already fails."""
    if check.kind == NOT_NULL:
        return value.isNull()
    if check.kind == ACCEPTED_VALUES:
        return ~value.isin(*check.values)
    return value.isNotNull()


def check_model(df: DataFrame, checks: Sequence[Check], parents: Mapping[str, DataFrame]) -> DataFrame:
    """All checks of one model from one read of it.

    A row becomes one short row for each check that has to count its value: (check, value).
    These are counted map-side, so hot values and nulls are cheap, and shuffled once, together
    with the keys of the parent models. What a value adds to the failures of its check
    follows from its count and from whether a parent has it.
    """
    types = dict(df.dtypes)

    def parent_type(check: Check) -> str:
        return dict(parents[check.parent].dtypes)[check.parent_column] if check.parent else types[check.column]

    def entry(i: int, check: Check) -> Column:
        value = F.col(f"`{check.column}`")
        key = _key(value, types[check.column], parent_type(check))
        return F.when(_suspects(check, value), F.struct(F.lit(i).alias("check"), *key))

    entries = [entry(i, check) for i, check in enumerate(checks)]
    # Nulls are dropped by a filter: array_compact takes a function of elements, which Spark does not compile.
    rows = df.select(F.explode(F.array(*entries)).alias("entry")).where(F.col("entry").isNotNull()).select(
        "entry.*", F.lit(1).cast("bigint").alias("rows"), F.lit(False).alias("known")
    )
    for i, check in enumerate(checks):
        if check.kind == RELATIONSHIPS:
            keys = _key(F.col(f"`{check.parent_column}`"), parent_type(check), types[check.column])
            known = [F.lit(0).cast("bigint").alias("rows"), F.lit(True).alias("known")]
            rows = rows.unionByName(parents[check.parent].select(F.lit(i).alias("check"), *keys, *known))
    values = rows.groupBy("check", "number", "text").agg(F.sum("rows").alias("rows"), F.max("known").alias("known"))

    def failures(i: int, check: Check) -> Column:
        added = {
            NOT_NULL: F.col("rows"),
            ACCEPTED_VALUES: F.lit(1),
            UNIQUE: (F.col("rows") > 1).cast("int"),
            RELATIONSHIPS: F.when(~F.col("known"), F.col("rows")),
        }[check.kind]
        return F.coalesce(F.sum(F.when(F.col("check") == i, added)), F.lit(0)).alias(f"_{i}")

    counted = values.agg(*[failures(i, check) for i, check in enumerate(checks)])
    results = [F.struct(*check.result(F.col(f"_{i}"))) for i, check in enumerate(checks)]
    return counted.select(F.inline(F.array(*results)))


def run_checks(models: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Results of all checks, one row each, from one read of each model and of the parents it refers to."""
    by_model = [(model, list(own)) for model, own in groupby(checks, key=lambda check: check.model)]
    return reduce(DataFrame.unionByName, [check_model(models[model], own, models) for model, own in by_model])


class ChecksFailed(Exception):
    """Raised when a check of severity error has failures."""


def raise_on_error(results: DataFrame) -> None:
    """Raise for failed checks of severity error; warnings pass.

    Collects failed result rows, of which there are at most as many as checks.
    """
    failed = results.filter(~F.col("passed") & (F.col("severity") == ERROR)).select("test_name", "failures")
    rows = failed.collect()
    if rows:
        raise ChecksFailed(", ".join(f"{row.test_name}: {row.failures}" for row in rows))
