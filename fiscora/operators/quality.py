"""Declarative data tests, evaluated set-wise.

A test reports how many rows (or, for uniqueness, key groups) fail; a layer
passes only when every count is zero.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscora.catalog import ENDPOINTS, GRAIN, REPORT_TYPES

NOT_NULL = "not_null"
ACCEPTED_VALUES = "accepted_values"
UNIQUE = "unique"
UNIQUE_COMBINATION = "unique_combination_of_columns"


@dataclass(frozen=True)
class ModelTests:
    """Tests of one model. ``unique`` ignores NULL; in ``combination`` NULLs are equal."""

    not_null: tuple[str, ...] = ()
    accepted: tuple[tuple[str, tuple[str, ...]], ...] = ()
    unique: tuple[str, ...] = ()
    combination: tuple[str, ...] = ()

    @property
    def tested_columns(self) -> list[str]:
        names = [*self.not_null, *(c for c, _ in self.accepted), *self.unique, *self.combination]
        return list(dict.fromkeys(names))


_PERIOD_TESTS = ModelTests(
    not_null=GRAIN, accepted=(("report_type", REPORT_TYPES),), combination=GRAIN
)
SILVER_TESTS = {
    name: ModelTests(not_null=("symbol",), unique=("symbol",)) if e.is_flat else _PERIOD_TESTS
    for name, e in ENDPOINTS.items()
}
GOLD_TESTS = {"fundamental_kpis": _PERIOD_TESTS}


def not_null_failures(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def accepted_values_failures(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows outside the list; NULL passes."""
    return rows.where(~F.col(column).isin(*values))


def unique_failures(rows: DataFrame, column: str) -> DataFrame:
    """Repeated values with their counts; NULL is ignored."""
    return duplicate_groups(rows.where(F.col(column).isNotNull()), [column])


def duplicate_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row; NULLs are equal. Counted before the shuffle."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def _total(condition: Column, weight: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0)).cast("bigint")


def test_report(rows: DataFrame, model: str, tests: ModelTests) -> DataFrame:
    """``model, test, column, failures``: every test of a model in one pass.

    Rows are first counted per combination of tested columns (one shuffle, with
    map-side counts); all tests then read off those counts.
    """
    tested = tests.tested_columns
    counts = rows.groupBy(*tested).agg(F.count(F.lit(1)).alias("_n"))
    n, one = F.col("_n"), F.lit(1)
    measures: list[tuple[str, str, Column]] = []
    for column in tests.not_null:
        measures.append((NOT_NULL, column, _total(F.col(column).isNull(), n)))
    for column, values in tests.accepted:
        measures.append((ACCEPTED_VALUES, column, _total(~F.col(column).isin(*values), n)))
    separate = []
    for column in tests.unique:
        if tested == [column]:
            measures.append((UNIQUE, column, _total(F.col(column).isNotNull() & (n > 1), one)))
        else:
            separate.append((UNIQUE, column, unique_failures(rows, column)))
    if tests.combination:
        label = ", ".join(tests.combination)
        if set(tested) == set(tests.combination):
            measures.append((UNIQUE_COMBINATION, label, _total(n > 1, one)))
        else:
            separate.append((UNIQUE_COMBINATION, label, duplicate_groups(rows, tests.combination)))
    totals = counts.agg(*(m.alias(f"m{i}") for i, (_, _, m) in enumerate(measures)))
    report = totals.select(
        F.lit(model).alias("model"),
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), F.col(f"m{i}").alias("failures"))
                    for i, (t, c, _) in enumerate(measures)
                )
            )
        ),
    )
    for test, column, groups in separate:
        extra = groups.agg(F.count(F.lit(1)).alias("failures"))
        report = report.unionByName(
            extra.select(
                F.lit(model).alias("model"), F.lit(test).alias("test"), F.lit(column).alias("column"), "failures"
            )
        )
    return report


test_report.__test__ = False  # not a pytest case


def layer_report(models: dict[str, DataFrame], tests: dict[str, ModelTests]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [test_report(models[name], name, t) for name, t in tests.items() if name in models]
    )


def gate(report: DataFrame, layer: str) -> DataFrame:
    """One row: does the layer pass?"""
    return report.agg(
        F.lit(layer).alias("layer"),
        F.count(F.lit(1)).alias("tests"),
        F.coalesce(F.sum("failures"), F.lit(0)).cast("bigint").alias("failures"),
    ).withColumn("passed", F.col("failures") == 0)


class QualityGateError(RuntimeError):
    """A layer failed its tests."""


def require(report: DataFrame, layer: str) -> None:
    """Raise unless every test passes. The report has one row per declared test."""
    failed = report.where("failures > 0").orderBy("model", "test", "column").collect()
    if failed:
        lines = ", ".join(f"{r['model']}.{r['test']}({r['column']})={r['failures']}" for r in failed)
        raise QualityGateError(f"{layer}: {lines}")


def schema_mismatches(rows: DataFrame, declared: T.StructType) -> list[str]:
    """Differences between a frame and its declared columns: names, order and types."""
    actual = [(f.name, f.dataType.simpleString()) for f in rows.schema]
    expected = [(f.name, f.dataType.simpleString()) for f in declared]
    found = [f"duplicate column {n}" for n in rows.columns if rows.columns.count(n) > 1]
    found += [f"missing {n}: {t}" for n, t in expected if (n, t) not in actual]
    found += [f"undeclared {n}: {t}" for n, t in actual if (n, t) not in expected]
    if not found and actual != expected:
        found.append("column order differs")
    return found


def column_profile(rows: DataFrame, model: str) -> DataFrame:
    """``model, column, data_type, n_rows, n_values`` of every column, in one pass."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"), *(F.count(f"`{c}`").alias(f"v{i}") for i, c in enumerate(rows.columns))
    )
    return counts.select(
        F.lit(model).alias("model"),
        "n_rows",
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col(f"v{i}").alias("n_values"),
                    )
                    for i, f in enumerate(rows.schema)
                )
            )
        ),
    )


def compare_snapshots(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts, duplicate keys and key-set difference of two states of a table.

    Both sides are counted per key in one aggregation; nothing is joined.
    """
    sides = before.select(*keys, F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionByName(
        after.select(*keys, F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    per_key = sides.groupBy(*keys).agg(F.sum("_b").alias("b"), F.sum("_a").alias("a"))

    def total(column: Column) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    return per_key.agg(
        total(F.col("b")).alias("rows_before"),
        total(F.col("a")).alias("rows_after"),
        total((F.col("b") > 1).cast("int")).alias("duplicates_before"),
        total((F.col("a") > 1).cast("int")).alias("duplicates_after"),
        total(((F.col("b") == 0) & (F.col("a") > 0)).cast("int")).alias("keys_added"),
        total(((F.col("b") > 0) & (F.col("a") == 0)).cast("int")).alias("keys_lost"),
    )


def reconcile_kpis(
    gold: DataFrame,
    inputs: DataFrame,
    ratios: dict[str, tuple[str, str]],
    growths: dict[str, tuple[str, str]] | None = None,
    passed: dict[str, str] | None = None,
    tolerance: float = 1e-8,
) -> DataFrame:
    """Recompute KPIs from their Silver inputs and count rows where Gold differs.

    ``ratios`` are quotients of two inputs, ``growths`` relative changes from the second to the first,
    ``passed`` inputs that Gold shows under another name. Works in floating point on
    purpose: a second, independent route to the value. ``inputs`` holds the grain and the
    inputs. Output: ``kpi, compared, differing``.
    """
    growths, passed = growths or {}, passed or {}
    keys = list(GRAIN)
    g = gold.select(*keys, *(F.col(n).alias(f"g_{n}") for n in (*ratios, *growths, *passed)))
    amounts = dict.fromkeys([c for pair in (*ratios.values(), *growths.values()) for c in pair] + list(passed.values()))
    s = inputs.select(*(F.col(k).alias(f"_{k}") for k in keys), *amounts)
    matched = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = g.join(s, matched, "full_outer")

    def number(column: str) -> Column:
        return F.col(column).cast("double")

    expected = {n: F.try_divide(number(a), number(b)) for n, (a, b) in ratios.items()}
    expected |= {n: F.try_divide(number(a) - number(b), number(b)) for n, (a, b) in growths.items()}
    expected |= {n: number(c) for n, c in passed.items()}
    measures = []
    for name, again in expected.items():
        found = number(f"g_{name}")
        off = F.abs(found - again) > tolerance * F.greatest(F.lit(1.0), F.abs(again))
        differs = F.coalesce(off, found.isNull() != again.isNull())
        measures.append(F.struct(F.lit(name).alias("kpi"), F.count_if(differs).alias("differing")))
    per_kpi = joined.agg(F.count(F.lit(1)).alias("compared"), F.array(*measures).alias("m"))
    return per_kpi.select("compared", F.inline("m"))
