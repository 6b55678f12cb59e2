"""Small column expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom import constants as C


def route_id(callsign: Column) -> Column:
    """First six characters of a callsign of four or more, else all of it."""
    return F.when(F.length(callsign) >= 4, F.substring(callsign, 1, 6)).otherwise(callsign)


def heading_change(previous: Column, current: Column, wrap: bool = True) -> Column:
    """Turn in degrees; ``wrap=False`` gives the plain difference (350 -> 10 = 340)."""
    turn = F.abs(previous - current)
    return F.least(turn, F.lit(360.0) - turn) if wrap else turn


def day_of_week(when: Column, monday_first: bool = True) -> Column:
    """0 = Monday, or 1 = Sunday with ``monday_first=False``."""
    return F.weekday(when) if monday_first else F.dayofweek(when)


def delay_proxy(altitude: Column, speed: Column) -> Column:
    """Slow while high; unknown counts as no."""
    held = (altitude > C.DELAY_ALTITUDE_M) & (speed < C.DELAY_SPEED_MS)
    return F.when(held, F.lit(1.0)).otherwise(F.lit(0.0))


def clip01(value: Column) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def band(value: Column, cuts: list[tuple[float, str]]) -> Column:
    """Name of the highest cut reached; the last entry takes the rest."""
    (top, first), *others = cuts
    chain = F.when(value.isNull(), F.lit(None).cast("string")).when(value >= top, first)
    for low, name in others[:-1]:
        chain = chain.when(value >= low, name)
    return chain.otherwise(others[-1][1])


def risk_band(probability: Column) -> Column:
    return band(probability, C.RISK_BANDS)


def congestion_band(score: Column) -> Column:
    return band(score, C.CONGESTION_BANDS)


def is_anomaly(prediction: Column) -> Column:
    """Detector output -1 means anomalous, 1 means normal."""
    return prediction == F.lit(-1)


def key_hash(keys: list[str], seed: int) -> Column:
    """32 hex digits, the same in any engine and under any partitioning. Every value goes in
    with its length, and null as a mark of its own, so different keys differ."""
    parts = []
    for key in keys:
        text = F.col(key).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
