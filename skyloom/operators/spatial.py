"""Points within a radius of places, as an equi-join on cells."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.constants import AIRPORT_RADIUS_KM
from skyloom.functions.geo import cell_at, cell_lat, cell_lon, cover_columns, cover_rows, haversine_km, touches
from skyloom.operators.keyed import BUSY_ROWS
from skyloom.sources.lake import broadcast_within, fits, staged

CELL = ["cell_row", "cell_column"]
LEAF = ["leaf_level", "leaf_row", "leaf_column", "leaf_salt"]
MAX_CELLS = 200_000
#: Cells that split or are dealt to parts: rows of a broadcast, at eight or twelve bytes.
MAX_BUSY = 4_000_000
#: Cells of one degree split into four this many times at most: to about two kilometres.
LEVELS = 6


def place_cells(places: DataFrame, lat: str, lon: str, radius_km: float) -> DataFrame:
    """Each place once per cell its circle touches."""
    return places.withColumn(
        "cell_row", F.explode(cover_rows(F.col(lat), radius_km))
    ).withColumn("cell_column", F.explode(cover_columns(F.col(lat), F.col(lon), radius_km)))


def cell_id(level: int | Column, row: Column, column: Column) -> Column:
    """A number for a cell of any level."""
    level = F.lit(level) if isinstance(level, int) else level
    return (level.cast("long") * (1 << 34) + (row.cast("long") + (1 << 15)) * (1 << 17) + column.cast("long") + (1 << 16)).cast("long")


def busy_cells(located: DataFrame, busy_rows: int) -> DataFrame:
    """Stored (cell_row, cell_column, splits, salts) of the one-degree cells with more points than
    ``busy_rows``: the ids of its cells that split, and of those that are too busy at the last
    level too, with the number of parts to deal their points to."""
    lat, lon = F.col("latitude"), F.col("longitude")
    row, column = cell_at(lat, lon, LEVELS)
    counts = located.groupBy(row.alias("r"), column.alias("c")).agg(F.count("*").alias("n"))
    level = staged(counts, "finest_cells")
    found = None
    for at in range(LEVELS, -1, -1):
        if at < LEVELS:
            level = level.groupBy(F.shiftright("r", 1).alias("r"), F.shiftright("c", 1).alias("c")).agg(F.sum("n").alias("n"))
        busy = level.filter(F.col("n") > busy_rows).select(
            F.shiftright("r", at).alias("cell_row"),
            F.shiftright("c", at).alias("cell_column"),
            F.lit(at == LEVELS).alias("last"),
            cell_id(at, F.col("r"), F.col("c")).alias("id"),
            F.ceil(F.col("n") / busy_rows).cast("int").alias("parts"),
        )
        found = busy if found is None else found.unionByName(busy)
    pair = F.struct("id", "parts")
    return staged(
        found.groupBy(*CELL).agg(
            F.collect_list(F.when(~F.col("last"), F.col("id"))).alias("splits"),
            F.map_from_entries(F.collect_list(F.when(F.col("last"), pair))).alias("salts"),
        ),
        "busy_cells",
    )


def adaptive_pairs(points: DataFrame, places: DataFrame, radius_km: float, busy_rows: int, place_lat: str, place_lon: str) -> DataFrame:
    """Pairs of points and places in a common cell, for tables of any size: a cell with more than
    ``busy_rows`` points splits into four as often as it helps, and one that stays busy, as many
    points lie on one spot, is dealt to several parts, each with a copy of its places. Points whose
    position is null pair with none."""
    located = points.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    lat, lon = F.col("latitude"), F.col("longitude")
    # Cells are looked up by id, one at a time: a search of a busy degree's lists costs every row
    # as many steps as the degree has busy cells.
    busy = busy_cells(located, busy_rows)
    splits = broadcast_within(busy.select(F.explode("splits").alias("split_id")), MAX_BUSY)
    salts = broadcast_within(busy.select(F.explode("salts").alias("salt_id", "leaf_parts")), MAX_BUSY)
    # Points are numbered where they are read, so that a task that runs again deals them alike.
    keyed = located.withColumn("leaf_number", F.monotonically_increasing_id()).withColumn("leaf_level", F.lit(0))
    for level in range(LEVELS):
        found = F.col("split_id") == cell_id(level, *cell_at(lat, lon, level))
        deeper = F.col("leaf_level") + F.col("split_id").isNotNull().cast("int")
        keyed = keyed.join(splits, found, "left").withColumn("leaf_level", deeper).drop("split_id")
    cells = [cell_at(lat, lon, level) for level in range(LEVELS + 1)]
    for name, part in (("leaf_row", 0), ("leaf_column", 1)):
        keyed = keyed.withColumn(name, F.element_at(F.array(*[c[part] for c in cells]), F.col("leaf_level") + 1))
    leaf = F.col("salt_id") == cell_id(F.col("leaf_level"), F.col("leaf_row"), F.col("leaf_column"))
    spread = F.pmod(F.xxhash64("leaf_number"), F.coalesce("leaf_parts", F.lit(1))).cast("int")
    keyed = keyed.join(salts, leaf, "left").withColumn("leaf_salt", spread).select(*points.columns, *LEAF)

    covered = place_cells(places, place_lat, place_lon, radius_km)
    covered = covered.withColumns({"leaf_level": F.lit(0), "leaf_row": F.col("cell_row"), "leaf_column": F.col("cell_column")})
    for level in range(LEVELS):
        found = (F.col("leaf_level") == level) & (F.col("split_id") == cell_id(level, F.col("leaf_row"), F.col("leaf_column")))
        children = F.filter(
            F.array(*[
                F.struct(F.lit(level + 1).alias("leaf_level"), (F.col("leaf_row") * 2 + i).alias("leaf_row"), (F.col("leaf_column") * 2 + j).alias("leaf_column"))
                for i in (0, 1) for j in (0, 1)
            ]),
            lambda c: touches(c["leaf_row"], c["leaf_column"], level + 1, F.col(place_lat), F.col(place_lon), radius_km),
        )
        stay = F.array(F.struct("leaf_level", "leaf_row", "leaf_column"))
        covered = covered.join(splits, found, "left")
        covered = covered.withColumn("leaf", F.explode(F.when(F.col("split_id").isNotNull(), children).otherwise(stay)))
        covered = covered.withColumns({c: F.col(f"leaf.{c}") for c in LEAF[:3]}).drop("leaf", "split_id")
    covered = covered.join(salts, leaf, "left")
    copies = F.coalesce("leaf_parts", F.lit(1))
    covered = covered.withColumn("leaf_salt", F.explode(F.sequence(F.lit(0), copies - 1)))
    return keyed.join(covered.select(*places.columns, *LEAF), LEAF).drop(*LEAF)


def within_radius(
    points: DataFrame,
    places: DataFrame,
    radius_km: float = AIRPORT_RADIUS_KM,
    max_broadcast_cells: int = MAX_CELLS,
    busy_rows: int = BUSY_ROWS,
    place_lat: str = "airport_lat",
    place_lon: str = "airport_lon",
) -> DataFrame:
    """Every (point, place) pair at most ``radius_km`` apart, with ``dist_km``.

    A small place table is broadcast and points never move. A larger one is joined by shuffle
    on cells that adapt to the points (``adaptive_pairs``), so pass stored points."""
    cells = place_cells(places, place_lat, place_lon, radius_km)
    if fits(cells, max_broadcast_cells):
        located = points.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        keyed = located.withColumn("cell_row", cell_lat(F.col("latitude"))).withColumn("cell_column", cell_lon(F.col("longitude")))
        joined = keyed.join(F.broadcast(cells), CELL).drop(*CELL)
    else:
        joined = adaptive_pairs(points, places, radius_km, busy_rows, place_lat, place_lon)
    distance = haversine_km(F.col("latitude"), F.col("longitude"), F.col(place_lat), F.col(place_lon))
    return joined.withColumn("dist_km", distance).filter(F.col("dist_km") <= radius_km)


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    place: str = "airport_code",
    radius_km: float = AIRPORT_RADIUS_KM,
    place_lat: str = "airport_lat",
    place_lon: str = "airport_lon",
    max_broadcast_cells: int = MAX_CELLS,
    busy_rows: int = BUSY_ROWS,
) -> DataFrame:
    """``points`` plus the nearest place's code and ``dist_km``; nulls
    when none is in range. Of equally near places the first code is taken.

    The places of a cell form one array, so each point meets one row and nothing is shuffled.
    Place tables too large for that are joined to the points by adaptive cells, and the nearest
    of each point's places is an aggregate of that join.
    """
    cells = place_cells(places, place_lat, place_lon, radius_km)
    if not fits(cells, max_broadcast_cells):
        # Points are numbered, so that equal rows and rows without a key keep their own place.
        own_row = "_row" + "_" * max(len(c) for c in points.columns)  # no name of the table
        numbered = staged(points.withColumn(own_row, F.monotonically_increasing_id()), "numbered_points")
        asked = numbered.select(own_row, "latitude", "longitude")
        pairs = adaptive_pairs(asked, places.select(place, place_lat, place_lon), radius_km, busy_rows, place_lat, place_lon)
        away = haversine_km(F.col("latitude"), F.col("longitude"), F.col(place_lat), F.col(place_lon))
        pair = F.struct(away.alias("dist_km"), F.col(place))
        found = pairs.filter(away <= radius_km).groupBy(own_row).agg(F.min(pair).alias("near"))
        out = numbered.join(found, own_row, "left")
        return out.select(*points.columns, F.col(f"near.{place}").alias(place), "near.dist_km")
    per_cell = cells.groupBy(*CELL).agg(
        F.array_agg(F.struct(place_lat, place_lon, place)).alias("candidates")
    )
    keyed = points.withColumn("cell_row", cell_lat(F.col("latitude"))).withColumn(
        "cell_column", cell_lon(F.col("longitude"))
    )
    measured = F.transform(
        "candidates",
        lambda p: F.struct(
            haversine_km(
                F.col("latitude"), F.col("longitude"), p[place_lat], p[place_lon]
            ).alias("dist_km"),
            p[place].alias(place),
        ),
    )
    near = F.array_min(F.filter(measured, lambda p: p["dist_km"] <= radius_km))
    return (
        keyed.join(F.broadcast(per_cell), CELL, "left")
        .withColumn("near", near)
        .select(*points.columns, F.col(f"near.{place}").alias(place), "near.dist_km")
    )
