"""Data-quality rules. A suite compiles to one aggregation over the table; only uniqueness and the
examples of unexpected values, which need a grouping of their own, read it again."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellrisk.functions.numeric import nan_to_null

ERROR, WARNING = "ERROR", "WARNING"
SMALL_SHARE = 0.01
EXAMPLES = 5

# Columns a subscriber table must have and the limits of the standard suite.
REQUIRED_COLUMNS = [
    "subscriber_id", "tenure_months", "monthly_charges", "total_charges", "data_usage_gb",
    "call_minutes_monthly", "sms_monthly", "rsrp_avg", "rsrq_avg", "dl_throughput_mbps",
    "call_drop_rate_pct", "call_drops_monthly", "outage_minutes_monthly", "latitude", "longitude",
    "contract_type", "payment_method", "internet_service", "churned",
]
NO_NULL_COLUMNS = ["subscriber_id", "churned", "latitude", "longitude", "monthly_charges", "tenure_months"]
POSITIVE_COLUMNS = ["tenure_months", "monthly_charges", "total_charges"]
COLUMN_LIMITS = {
    "churned": (0, 1),
    "latitude": (-11.0, 6.0),
    "longitude": (95.0, 141.0),
    "rsrp_avg": (-140, -40),
    "rsrq_avg": (-25, 0),
    "call_drop_rate_pct": (0, 100),
}
COLUMN_SETS = {
    "contract_type": ["month-to-month", "one-year", "two-year"],
    "internet_service": ["DSL", "fiber_optic", "none"],
}
CHURN_RATE_LIMITS = (0.05, 0.35)
MIN_ROWS = 1000


def _thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def _listing(values: Sequence[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@dataclass(frozen=True)
class Measure:
    """One aggregate of a rule and how its outcome reads: `bad` rows, message and severity."""

    rule: str
    bad: Column
    passed: Column
    message: Column
    severity: Column = field(default_factory=lambda: F.lit(ERROR))


class Suite:
    """Chain expectations, then ask for `report` (a row per rule) or `summary` (one row)."""

    def __init__(self, df: DataFrame):
        self.df = df
        self._aggs: dict[str, Column] = {"n_rows": F.count(F.lit(1))}
        self._scalars: dict[str, DataFrame] = {}
        self._sets: list[tuple[str, Column]] = []
        self._results: list[Measure] = []

    def _has(self, column: str) -> bool:
        return column in self.df.columns

    def _known(self, column: str) -> Column:
        """The column with NaN as NULL."""
        kind = self.df.schema[column].dataType.typeName()
        return nan_to_null(column) if kind in ("double", "float") else F.col(column)

    def _count(self, name: str, condition: Column) -> Column:
        self._aggs[name] = F.count_if(F.coalesce(condition, F.lit(False)))
        return F.col(name)

    def expect_columns(self, columns: Sequence[str]) -> Suite:
        missing = [c for c in columns if not self._has(c)]
        text = f"Missing columns: {_listing(missing)}" if missing else f"All {len(columns)} required columns present"
        self._results.append(
            Measure("expect_columns", F.lit(len(missing)).cast("bigint"), F.lit(not missing), F.lit(text))
        )
        return self

    def expect_no_nulls(self, columns: Sequence[str]) -> Suite:
        for c in filter(self._has, columns):
            bad = self._count(f"null:{c}", self._known(c).isNull())
            share = F.format_string("%.2f%%", bad * 100.0 / F.col("n_rows"))
            text = F.concat(_thousands(bad), F.lit(" nulls found ("), share, F.lit(")"))
            self._results.append(
                Measure(f"no_nulls:{c}", bad, bad == 0, F.when(bad == 0, F.lit("No nulls")).otherwise(text))
            )
        return self

    def expect_between(self, column: str, low: float, high: float) -> Suite:
        """Inclusive; NULL and NaN pass; fewer than one percent of bad rows is a warning only."""
        if self._has(column):
            bad = self._count(f"range:{column}", (self._known(column) < low) | (self._known(column) > high))
            good, text = f"All values in [{low}, {high}]", f" values outside [{low}, {high}]"
            self._results.append(
                Measure(
                    f"range:{column}",
                    bad,
                    bad == 0,
                    F.when(bad == 0, F.lit(good)).otherwise(F.concat(_thousands(bad), F.lit(text))),
                    F.when(bad < F.col("n_rows") * SMALL_SHARE, F.lit(WARNING)).otherwise(F.lit(ERROR)),
                )
            )
        return self

    def expect_positive(self, column: str) -> Suite:
        if self._has(column):
            bad = self._count(f"positive:{column}", F.col(column) < 0)
            text = F.concat(_thousands(bad), F.lit(" negative values"))
            self._results.append(
                Measure(f"positive:{column}", bad, bad == 0, F.when(bad == 0, F.lit("All positive")).otherwise(text))
            )
        return self

    def expect_values_in(self, column: str, values: Sequence[str]) -> Suite:
        """NULL is unexpected too; the message shows the first few distinct unexpected values."""
        if self._has(column):
            unexpected = F.coalesce(~F.col(column).isin(*values), F.lit(True))
            bad = self._count(f"set:{column}", unexpected)
            self._sets.append((column, unexpected))
            shown = F.coalesce(F.try_element_at(F.col("examples"), F.lit(column)), F.lit("[]"))
            text = F.concat(_thousands(bad), F.lit(" unexpected values: "), shown)
            good = F.lit(f"All values in {_listing(sorted(values))}")
            self._results.append(
                Measure(f"valid_values:{column}", bad, bad == 0, F.when(bad == 0, good).otherwise(text))
            )
        return self

    def expect_rate_between(self, column: str, low: float, high: float) -> Suite:
        if self._has(column):
            name = f"rate:{column}"
            self._aggs[name] = F.avg(column)
            rate = F.col(name)
            passed = F.coalesce(rate.between(low, high), F.lit(False))
            limits = f" (expected {low * 100:.0f}%–{high * 100:.0f}%)"
            text = F.concat(F.lit("Churn rate = "), F.format_string("%.2f%%", rate * 100.0), F.lit(limits))
            self._results.append(
                Measure("churn_rate", F.lit(0).cast("bigint"), passed, F.coalesce(text, F.lit("Churn rate is unknown")), F.lit(WARNING))
            )
        return self

    def expect_row_count(self, low: int, high: int | None = None) -> Suite:
        n = F.col("n_rows")
        passed = (n >= low) if high is None else n.between(low, high)
        text = F.concat(_thousands(n), F.lit(f" rows (expected >= {low:,})"))
        self._results.append(Measure("row_count", F.lit(0).cast("bigint"), passed, text))
        return self

    def expect_unique(self, column: str) -> Suite:
        if self._has(column):
            name = f"dup:{column}"
            extra = duplicates(self.df, column).agg(F.coalesce(F.sum("n_extra"), F.lit(0)).alias("d"))
            self._scalars[name] = extra
            bad = F.col(name)
            text = F.concat(_thousands(bad), F.lit(" duplicates found"))
            self._results.append(
                Measure(f"unique:{column}", bad, bad == 0, F.when(bad == 0, F.lit("All values unique")).otherwise(text))
            )
        return self

    def _examples(self) -> DataFrame:
        """One map: column -> text of its smallest few unexpected values."""
        pairs = F.array_compact(
            F.array(
                *[
                    F.when(bad, F.struct(F.lit(c).alias("c"), F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias("v")))
                    for c, bad in self._sets
                ]
            )
        )
        distinct = self.df.select(F.explode(pairs).alias("p")).select("p.*").distinct()
        # The rank filter is applied before the shuffle as well, so few rows per task travel.
        few = distinct.withColumn("k", F.row_number().over(Window.partitionBy("c").orderBy("v"))).filter(
            F.col("k") <= EXAMPLES
        )
        listed = F.concat(F.lit("['"), F.array_join(F.array_sort(F.collect_list("v")), "', '"), F.lit("']"))
        per_column = few.groupBy("c").agg(listed.alias("text"))
        return per_column.agg(F.map_from_entries(F.collect_list(F.struct("c", "text"))).alias("m"))

    def report(self) -> DataFrame:
        row = self.df.agg(*[c.alias(name) for name, c in self._aggs.items()])
        extra = {name: one.scalar() for name, one in self._scalars.items()}
        if self._sets:
            extra["examples"] = self._examples().scalar()
        if extra:
            row = row.withColumns(extra)
        lines = F.array(
            *[
                F.struct(
                    F.lit(m.rule).alias("rule"),
                    m.passed.alias("passed"),
                    m.message.alias("message"),
                    m.severity.alias("severity"),
                    m.bad.cast("bigint").alias("n_bad"),
                    F.col("n_rows").alias("n_total"),
                )
                for m in self._results
            ]
        )
        return row.select(F.explode(lines).alias("r")).select("r.*")

    def summary(self) -> DataFrame:
        return summarize(self.report())


def summarize(report: DataFrame) -> DataFrame:
    """Passed, warnings, errors, and the gate: it holds when no error-level rule failed."""
    failed = ~F.col("passed")
    return report.agg(
        F.count_if("passed").alias("n_passed"),
        F.count_if(failed & (F.col("severity") == WARNING)).alias("n_warnings"),
        F.count_if(failed & (F.col("severity") == ERROR)).alias("n_errors"),
        F.coalesce(F.bool_and(F.col("passed") | (F.col("severity") == WARNING)), F.lit(True)).alias("ok"),
    )


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, and how many rows too many (NULLs count as equal)."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .withColumn("n_extra", F.col("n") - 1)
    )


def subscriber_suite(df: DataFrame, min_rows: int = MIN_ROWS) -> Suite:
    suite = Suite(df).expect_row_count(min_rows).expect_columns(REQUIRED_COLUMNS).expect_unique("subscriber_id")
    suite.expect_no_nulls(NO_NULL_COLUMNS)
    for c in POSITIVE_COLUMNS:
        suite.expect_positive(c)
    for c, (low, high) in COLUMN_LIMITS.items():
        suite.expect_between(c, low, high)
    for c, values in COLUMN_SETS.items():
        suite.expect_values_in(c, values)
    return suite.expect_rate_between("churned", *CHURN_RATE_LIMITS)


def gate(df: DataFrame) -> bool:
    """True when the standard suite has no failed error-level rule. Runs the suite."""
    return bool(subscriber_suite(df).summary().first()["ok"])
