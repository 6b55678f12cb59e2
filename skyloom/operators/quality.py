"""Data-quality suites and gates, each compiled to one aggregate over the table."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom import constants as C

RESULT = (
    "expectation_type string, column_name string, evaluated_count bigint, "
    "unexpected_count bigint, success boolean"
)


class QualityError(Exception):
    """A gate did not pass."""


@dataclass(frozen=True)
class Expectation:
    """``columns_match_set`` | ``not_null`` | ``between`` (nulls are not counted against it)."""

    kind: str
    column: str = ""
    low: float | None = None
    high: float | None = None
    mostly: float = 1.0
    columns: tuple[str, ...] = ()

    def result(self, available: list[str]) -> Column:
        """Struct of RESULT, as an aggregate expression. A column that is not there cannot
        be evaluated, which is a failure, not an error."""
        label = self.column or ",".join(self.columns)
        if self.kind == "columns_match_set":
            missing = len(set(self.columns) - set(available))
            return self._row(label, F.lit(len(self.columns)), F.lit(missing), F.lit(missing == 0))
        if self.column not in available:
            nothing = F.lit(None)
            return self._row(label, nothing, nothing, F.lit(False))
        value = F.col(self.column)
        if self.kind == "not_null":
            seen, bad = F.count(F.lit(1)), F.count_if(value.isNull())
        else:
            seen, bad = F.count(value), F.count_if(~value.between(self.low, self.high))
        # An empty or all-null column has nothing unexpected in it.
        return self._row(label, seen, bad, (seen - bad) >= seen * F.lit(self.mostly))

    def _row(self, label, seen, bad, success):
        return F.struct(
            F.lit(self.kind).alias("expectation_type"),
            F.lit(label).alias("column_name"),
            seen.cast("bigint").alias("evaluated_count"),
            bad.cast("bigint").alias("unexpected_count"),
            success.cast("boolean").alias("success"),
        )


def bronze_suite() -> list[Expectation]:
    return [
        Expectation("columns_match_set", columns=tuple(C.BRONZE_REQUIRED)),
        Expectation("not_null", "icao24"),
        *[
            Expectation("between", name, low, high, C.BRONZE_MOSTLY)
            for name, (low, high) in C.BRONZE_BOUNDS.items()
        ],
    ]


def validation_frame(states: DataFrame) -> DataFrame:
    """Landed states as the suite sees them: ``timestamp`` is the last contact if absent."""
    if "timestamp" in states.columns:
        return states
    return states.withColumn("timestamp", F.col("last_contact"))


def run_suite(df: DataFrame, suite: list[Expectation], name: str = "bronze_suite") -> DataFrame:
    """One row per expectation, from a single pass over ``df``."""
    results = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[e.result(df.columns).alias(f"e{i}") for i, e in enumerate(suite)],
    )
    rows = F.inline(F.array(*[F.col(f"e{i}").cast(f"struct<{_struct()}>") for i in range(len(suite))]))
    return results.select(
        F.lit(name).alias("suite_name"),
        "row_count",
        F.lit(len(df.columns)).alias("column_count"),
        rows,
    )


def _struct():
    return ",".join(part.strip().replace(" ", ":", 1) for part in RESULT.split(","))


def summarise(results: DataFrame) -> DataFrame:
    """Counts, rate (1.0 when nothing was evaluated) and verdict per suite."""
    passed = F.count_if("success")
    return results.groupBy("suite_name").agg(
        F.count("*").alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        F.round(success_rate(passed, F.count("*")), 4).alias("success_rate"),
        F.bool_and("success").alias("passed"),
        F.max("row_count").alias("row_count"),
        F.max("column_count").alias("column_count"),
    )


def success_rate(successful: Column, evaluated: Column) -> Column:
    return F.coalesce(F.try_divide(successful.cast("double"), evaluated.cast("double")), F.lit(1.0))


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("success")).select(
        "suite_name", "expectation_type", "column_name", "evaluated_count", "unexpected_count"
    )


def null_ratios(df: DataFrame, columns: list[str], ceiling: float = C.MAX_NULL_RATIO) -> DataFrame:
    """Share of nulls per column, all columns in one pass; 0 for an empty table."""
    ratios = df.agg(
        *[F.coalesce(F.avg(F.col(c).isNull().cast("int")), F.lit(0.0)).alias(c) for c in columns]
    )
    return ratios.unpivot([], columns, "column_name", "null_ratio").withColumn(
        "passed", F.col("null_ratio") <= ceiling
    )


def silver_gate_metrics() -> list[Column]:
    """The silver gate's inputs as aggregates, for a one-pass check or an Observation."""
    return [
        F.count(F.lit(1)).alias("silver_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in C.SILVER_NOT_NULL],
    ]


def check_silver(columns: list[str], metrics: dict) -> None:
    """Raise unless required columns, row floor and null ceiling all hold."""
    missing = sorted(set(C.SILVER_REQUIRED) - set(columns))
    if missing:
        raise QualityError(f"silver lacks columns {missing}")
    rows = metrics["silver_rows"]
    if rows < C.MIN_SILVER_ROWS:
        raise QualityError(f"silver has {rows} rows, fewer than {C.MIN_SILVER_ROWS}")
    ratios = {c: metrics[f"null_{c}"] / max(rows, 1) for c in C.SILVER_NOT_NULL}
    bad = {c: r for c, r in ratios.items() if r > C.MAX_NULL_RATIO}
    if bad:
        raise QualityError(f"silver null ratio above {C.MAX_NULL_RATIO}: {bad}")


def silver_gates(silver: DataFrame) -> DataFrame:
    """The same checks as rows (gate, observed, passed)."""
    measured = silver.agg(*silver_gate_metrics())
    worst = F.greatest(*[F.col(f"null_{c}") for c in C.SILVER_NOT_NULL]) / F.greatest(
        F.col("silver_rows"), F.lit(1)
    )
    missing = float(len(set(C.SILVER_REQUIRED) - set(silver.columns)))
    gates = [
        ("required_columns", F.lit(missing), F.lit(missing == 0)),
        ("min_rows", F.col("silver_rows").cast("double"), F.col("silver_rows") >= C.MIN_SILVER_ROWS),
        ("max_null_ratio", worst, worst <= C.MAX_NULL_RATIO),
    ]
    return measured.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("gate"), v.alias("observed"), ok.alias("passed"))
                    for n, v, ok in gates
                ]
            )
        )
    )


def poll_gates(batches: DataFrame, floor: int = C.MIN_STATES_PER_POLL) -> DataFrame:
    """Whether each landed batch has enough states."""
    return batches.select(
        "fetch_timestamp", "aircraft_count", (F.col("aircraft_count") >= floor).alias("passed")
    )
