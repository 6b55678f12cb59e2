from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import drift, routes
from skyloom.sources import lake


def plain_cusum(values, burn_in, slack):
    first = np.array(values[:burn_in])
    mean, spread, s, out = first.mean(), first.std() or 1.0, 0.0, []
    for v in values[burn_in:]:
        s = max(0.0, s + (mean - v) / spread - slack)
        out.append(s)
    return out


def days(spark, values, model="m"):
    rows = [(model, date(2024, 1, 1) + timedelta(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "model string, day date, auc double")


@pytest.mark.parametrize("seed", range(3))
def test_cusum_fires_on_a_drop_and_not_on_noise(spark, seed):
    rng = np.random.default_rng(seed)
    noise = (0.85 + rng.normal(0, 0.01, 40)).tolist()
    fallen = noise[:25] + [v - 0.04 for v in noise[25:]]
    both = days(spark, noise, "steady").unionByName(days(spark, fallen, "fallen"))
    out = drift.performance_drop(both, "auc", "day", ["model"], burn_in=14, slack=1.0, alarm=8.0).orderBy("model", "day").collect()
    for name, values in (("steady", noise), ("fallen", fallen)):
        mine = [r for r in out if r.model == name]
        assert [r.cusum for r in mine] == pytest.approx(plain_cusum(values, 14, 1.0), abs=1e-9)
        fired = [r.day for r in mine if r.dropped]
        assert bool(fired) == (name == "fallen") and all(d >= date(2024, 1, 26) for d in fired)


def test_cusum_edges(spark):
    assert drift.performance_drop(days(spark, []), "auc", "day").count() == 0
    assert drift.performance_drop(days(spark, [0.8] * 5), "auc", "day").count() == 0
    flat = drift.performance_drop(days(spark, [0.8] * 7 + [None, 0.8, 0.1]), "auc", "day", slack=0.1).orderBy("day").collect()
    assert [round(r.cusum, 6) for r in flat] == [0.0, 0.6] and not flat[-1].dropped


def test_fleet_sketches_stay_within_their_error(spark):
    """Fleets of 20 to 20,000 over ten days, many aircraft on several of them."""
    n = F.col("id") % 4
    size = F.element_at(F.array(*[F.lit(s) for s in (20, 300, 3_000, 20_000)]), (n + 1).cast("int"))
    rows = spark.range(300_000).select(
        F.concat(F.lit("r"), n).alias("route_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.xxhash64("id") % 10 + 5).cast("int")).alias("event_date"),
        F.pmod(F.xxhash64("id", F.lit(1)), size).cast("string").alias("aircraft_id"),
        F.lit("2024-01-01").cast("timestamp").alias("event_timestamp"),
        *[F.lit(1).cast("long").alias(c) for c in ("reports", "cruise_count")],
        *[F.lit(1.0).alias(c) for c in ("cruise_sum", "delay_sum")],
    )
    sketches = lake.staged(routes.day_sketches(rows), "sketches")
    assert sketches.groupBy("route_id", "event_date").count().filter("count > 1").isEmpty()
    exact = {r.route_id: r.unique_aircraft_count for r in routes.combined(rows).collect()}
    for r in routes.combined_sketches(sketches).collect():
        n = exact[r.route_id]
        assert abs(r.unique_aircraft_count - n) <= (0 if n < 100 else 4 * 1.04 / 64 * n)
    assert {r.route_id: r.route_density for r in routes.combined_sketches(sketches).collect()} == {r.route_id: r.route_density for r in routes.combined(rows).collect()}


def test_fleets_of_a_route_are_counted_exactly(spark):
    rows = spark.range(40_000).select(
        F.concat(F.lit("r"), F.col("id") % 2).alias("route_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("event_date"),
        F.when(F.col("id") > 1, (F.col("id") % 9_001).cast("string")).otherwise("").alias("aircraft_id"),
        F.lit("2024-01-01").cast("timestamp").alias("event_timestamp"),
        *[F.lit(1).cast("long").alias(c) for c in ("reports", "cruise_count")],
        *[F.lit(1.0).alias(c) for c in ("cruise_sum", "delay_sum")],
    )
    exact = {r.route_id: r.unique_aircraft_count for r in routes.combined(rows).collect()}
    found = routes.combined_sketches(lake.staged(routes.day_sketches(rows), "sketches")).collect()
    assert {r.route_id: r.unique_aircraft_count for r in found} == exact and min(exact.values()) > 8_000


def test_quantile_sketches_stay_within_their_error(spark):
    rows = spark.range(60_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("day"),
        (F.randn(1) + F.when(F.col("id") % 20 >= 14, 0.8).otherwise(0.0)).alias("moved"),
        F.when(F.col("id") % 3 > 0, F.randn(2)).alias("same"),
    )
    rows = lake.staged(rows, "values")
    sketches = lake.staged(drift.day_sketches(rows, "day", ["moved", "same"]), "sketches")
    assert sketches.count() == 40
    old, new = drift.window_sketch(sketches, "2024-01-01", "2024-01-14"), drift.window_sketch(sketches, "2024-01-15", "2024-01-20")
    is_new = rows.withColumn("is_new", F.col("day") >= F.lit("2024-01-15").cast("date"))
    exact = {r.feature: r for r in drift.psi(is_new, "is_new", drift.quantile_edges(is_new.filter("not is_new"), ["moved", "same"])).collect()}
    for r in drift.sketched_psi(old, new).collect():
        assert abs(r.psi - exact[r.feature].psi) < 0.03 and r.drifted == exact[r.feature].drifted == (r.feature == "moved")
    assert {r.feature: r["rows"] for r in new.collect()} == {"moved": 18_000, "same": 12_000}
