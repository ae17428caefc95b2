"""Radius search and map datasets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearplate.functions.geo import cell_lat, cell_lon, cell_step, covering_cells, haversine_m
from clearplate.operators.semantic import SemanticLayer
from clearplate.plans.build import Marts, within_days
from clearplate.session import written
from clearplate.sources.resultset import name_borough_pairs, result_table

# Fixed values.
RULE_RADIUS_M = 800.0
CALL_RADIUS_M = 804.0
TABLE_LIMIT, FEED_DAYS = 500, 365
GRADE_A_MAX, GRADE_B_MAX = 13, 27
COLOURS = {"A": [0, 180, 0, 210], "B": [255, 165, 0, 210], "C": [220, 50, 50, 210]}
OTHER_COLOUR = [150, 150, 150, 180]
MISSING_SCORE = "–"
# A grid cell with more places than this is cut into parts of about so many.
CELL_PLACES = 20_000


def _in_cells(df: DataFrame, points: DataFrame, metres: float, cell_places: int) -> tuple[DataFrame, DataFrame]:
    """Places with their cell and part, and points listed in every part of the cells their circle touches.

    A cell is as wide as the radius, so a circle in it touches nearly all of it, and smaller
    cells would keep no point away. A crowded cell is cut by its measured number of places instead.
    """
    step, around = cell_step(metres)
    located = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).withColumns({
        "_lat": F.col("latitude").cast("double"),
        "_lon": F.col("longitude").cast("double"),
    })
    cells = {"cell_lat": cell_lat(F.col("_lat"), step), "cell_lon": cell_lon(F.col("_lon"), step, around)}
    located = located.withColumns(cells)
    counted = located.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / cell_places).alias("_parts"))
    crowded = written(counted.filter("_parts > 1"), "crowded-cells")  # fewer rows than places / cell_places
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    located = located.join(crowded, list(cells), "left").withColumn("_part", F.pmod(F.xxhash64(*df.columns), parts)).drop("_parts")
    spread = points.withColumn("_cell", F.explode_outer(covering_cells(F.col("point_lat"), F.col("point_lon"), metres)))
    spread = spread.select(*points.columns, "_cell.cell_lat", "_cell.cell_lon").join(crowded, list(cells), "left")
    return located, spread.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts")


def within_radius(df: DataFrame, points: DataFrame, metres: float = CALL_RADIUS_M, cell_places: int = CELL_PLACES) -> DataFrame:
    """Pairs of a located row and a point at most ``metres`` apart, with the distance.

    ``df`` has latitude and longitude, ``points`` has point_lat and point_lon. Every
    point is listed in the grid cells its circle touches, so the join is an equality on
    cells and the distance is checked only there. A cell with more than ``cell_places``
    rows is cut into parts by count: rows take one part, points are repeated in each.
    """
    located, spread = _in_cells(df, points, metres, cell_places)
    distance = haversine_m(F.col("_lat"), F.col("_lon"), F.col("point_lat"), F.col("point_lon"))
    near = located.join(spread, ["cell_lat", "cell_lon", "_part"]).withColumn("distance_m", distance).filter(F.col("distance_m") <= metres)
    return near.select(*df.columns, *points.columns, "distance_m")


def count_within_radius(df: DataFrame, points: DataFrame, metres: float = CALL_RADIUS_M, cell_places: int = CELL_PLACES) -> DataFrame:
    """Points with the number of located rows at most ``metres`` away (restaurants) and the distance of the nearest (nearest_m).

    Rows of the same coordinates are met as one, and so are points: pairs of places are formed, not pairs of rows.
    """
    places = df.groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("_rows"))
    spots = points.select("point_lat", "point_lon").distinct()
    near = within_radius(places, spots, metres, cell_places).groupBy("point_lat", "point_lon").agg(F.sum("_rows").alias("restaurants"), F.min("distance_m").alias("nearest_m"))
    return points.join(near, ["point_lat", "point_lon"])


def nearby_critical(m: Marts, points: DataFrame, as_of: str, metres: float = CALL_RADIUS_M, months: int = 6) -> DataFrame:
    """Restaurants near each point with critical citations in the last months.

    Keys are narrowed to the circle first; the facts then meet only those restaurants.
    One row per point and restaurant: latest grade, mean score over citations, last date.
    """
    end = F.lit(as_of).cast("date")
    first = F.add_months(end, -months)
    columns = ["dim_restaurant_key", "restaurant_name", "street_address", "borough", "cuisine_description", "latitude", "longitude"]
    near = within_radius(m.dim_restaurant.select(*columns), points, metres)
    keys = near.select("dim_restaurant_key").distinct()
    cited = (
        within_days(m.fct_violations, first, end).filter("is_critical_violation")
        .select("dim_restaurant_key", "fct_inspection_key", "inspection_date")
        .join(keys, "dim_restaurant_key", "left_semi")
        # Citations of one visit count as many equal rows; one row with their number is enough.
        .groupBy("dim_restaurant_key", "fct_inspection_key", "inspection_date").agg(F.count(F.lit(1)).alias("n"))
    )
    visits = within_days(m.fct_inspections, first, end).select("fct_inspection_key", "grade", "inspection_score")
    newest = F.struct("inspection_date", "fct_inspection_key", F.coalesce("grade", F.lit("")))
    weight = F.when(F.col("inspection_score").isNotNull(), F.col("n"))
    per = cited.join(visits, "fct_inspection_key").groupBy("dim_restaurant_key").agg(
        F.max_by("grade", newest).alias("latest_grade"),
        F.round(F.sum(F.col("inspection_score") * F.col("n")) / F.sum(weight), 1).alias("score"),
        F.max("inspection_date").alias("last_inspection"),
    )
    return near.join(per, "dim_restaurant_key").drop("dim_restaurant_key").withColumn("last_inspection", F.date_format("last_inspection", "yyyy-MM-dd"))


def per_restaurant(
    layer: SemanticLayer, marts: Marts, start: str, end: str, boroughs: Sequence[str] = (), cuisines: Sequence[str] = (), legacy_by_name: bool = False,
) -> DataFrame:
    """One row per restaurant with coordinates and its outcome between two dates.

    Works by key, so two restaurants that share a name stay apart, and the mean is over
    visits. ``legacy_by_name`` joins on the name and averages averages, as maps once did.
    """
    if legacy_by_name:
        return _per_name(layer, start, end, boroughs, cuisines)
    seen = within_days(marts.fct_inspections, F.lit(start).cast("date"), F.lit(end).cast("date"))
    places = marts.dim_restaurant.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if boroughs:
        places = places.filter(F.col("borough").isin(list(boroughs)))
    if cuisines:
        places = places.filter(F.col("cuisine_description").isin(list(cuisines)))
    newest = F.struct("inspection_date", "fct_inspection_key", F.coalesce("grade", F.lit("")))
    outcome = seen.groupBy("dim_restaurant_key").agg(
        F.max_by("grade", newest).alias("latest_grade"),
        F.round(F.avg("inspection_score"), 1).alias("avg_score"),
        F.count(F.lit(1)).alias("inspection_count"),
        F.bool_or("has_critical_violation").alias("any_critical"),
    )
    return outcome.join(places, "dim_restaurant_key").select(
        "dim_restaurant_key", "restaurant_name", "borough", F.col("cuisine_description").alias("cuisine_type"),
        "latitude", "longitude", "latest_grade", "avg_score", "inspection_count", "any_critical",
    )


def _per_name(layer: SemanticLayer, start: str, end: str, boroughs, cuisines, by_cuisine: bool = True) -> DataFrame:
    places = layer.facts(["latitude", "longitude"], ["restaurant_name"]).groupBy("restaurant_name").agg(
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")
    ).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    where = [("inspections.inspection_date", lambda c: c.between(F.lit(start).cast("date"), F.lit(end).cast("date")))]
    if boroughs:
        where.append(("borough", lambda c: c.isin(list(boroughs))))
    if cuisines:
        where.append(("cuisine_type", lambda c: c.isin(list(cuisines))))
    who = ["restaurant_name", "borough"] + (["cuisine_type"] if by_cuisine else [])
    visits = layer.query(
        ["average_score", "total_inspections"], [*who, "inspections.inspection_date", "grade", "has_critical_violation"], where=where
    )
    newest = F.struct("inspection_date", F.coalesce("grade", F.lit("")), "has_critical_violation")
    outcome = visits.groupBy(*who).agg(
        F.max_by("grade", newest).alias("latest_grade"), F.round(F.avg("average_score"), 1).alias("avg_score"),
        F.sum("total_inspections").alias("inspection_count"), F.bool_or("has_critical_violation").alias("any_critical"),
    )
    return outcome.join(places, "restaurant_name").select(
        *who, "latitude", "longitude", "latest_grade", "avg_score", "inspection_count", "any_critical"
    )


def outcome_filter(df: DataFrame, grades: Sequence[str] = (), critical_only: bool = False) -> DataFrame:
    """Filters on the latest outcome. They follow the aggregation: before it they would change the outcome."""
    if grades:
        df = df.filter(F.col("latest_grade").isin(list(grades)))
    return df.filter("any_critical") if critical_only else df


def map_points(df: DataFrame) -> DataFrame:
    return df.select("restaurant_name", "borough", "latitude", "longitude", "cuisine_type", F.col("latest_grade").alias("grade"), F.col("avg_score").alias("score"))


def summary_table(df: DataFrame, k: int = TABLE_LIMIT) -> DataFrame:
    ties = [F.asc_nulls_last(c) for c in ("restaurant_name", "borough", "cuisine_type")]
    return (
        df.select("restaurant_name", "borough", "cuisine_type", "inspection_count", "avg_score", "latest_grade")
        .orderBy(F.desc("inspection_count"), F.asc_nulls_last("avg_score"), *ties).limit(k)
    )


def points_for_pairs(layer: SemanticLayer, pairs: DataFrame) -> DataFrame:
    """Map points of named (restaurant_name, borough) pairs that had a critical visit; an empty borough matches any."""
    chosen = pairs.select("restaurant_name", "borough").distinct()
    places = layer.facts(["latitude", "longitude"], ["restaurant_name"]).groupBy("restaurant_name").agg(
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")
    ).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    visits = layer.query(
        ["average_score"], ["restaurant_name", "borough", "inspections.inspection_date", "grade", "has_critical_violation"],
        where=[("has_critical_violation", lambda c: c)],
    )
    wanted = chosen.select(F.col("restaurant_name").alias("_name"), F.col("borough").alias("_borough"))
    match = (visits["restaurant_name"] == wanted["_name"]) & ((wanted["_borough"] == "") | (wanted["_borough"] == visits["borough"]))
    newest = F.struct("inspection_date", F.coalesce("grade", F.lit("")))
    outcome = visits.join(wanted, match, "left_semi").groupBy("restaurant_name", "borough").agg(
        F.max_by("grade", newest).alias("grade"), F.round(F.avg("average_score"), 1).alias("score")
    )
    return outcome.join(places, "restaurant_name").select("restaurant_name", "borough", "latitude", "longitude", "grade", "score")


def pairs_in_results(events: DataFrame, payload: str = "payload") -> DataFrame:
    return name_borough_pairs(events, payload)


def default_feed(layer: SemanticLayer, as_of: str, critical_only: bool = True, k: int | None = None) -> DataFrame:
    """Map feed of the last year: points by name and borough, the first ``k`` of them if given."""
    end = F.lit(as_of).cast("date")
    where = [("inspections.inspection_date", lambda c: c.between(F.date_sub(end, FEED_DAYS), end))]
    if critical_only:
        where.append(("has_critical_violation", lambda c: c))
    visits = layer.query(["average_score", "total_inspections"], ["restaurant_name", "borough", "inspections.inspection_date", "grade", "has_critical_violation"], where=where)
    places = layer.facts(["latitude", "longitude"], ["restaurant_name"]).groupBy("restaurant_name").agg(
        F.max("latitude").alias("latitude"), F.max("longitude").alias("longitude")
    ).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    newest = F.struct("inspection_date", F.coalesce("grade", F.lit("")))
    out = visits.groupBy("restaurant_name", "borough").agg(F.max_by("grade", newest).alias("grade"), F.round(F.avg("average_score"), 1).alias("score"))
    joined = out.join(places, "restaurant_name").select("restaurant_name", "borough", "latitude", "longitude", "grade", "score")
    return joined if k is None else joined.orderBy("restaurant_name", F.asc_nulls_last("borough")).limit(k)


def inferred_grade(score: Column) -> Column:
    """Grade from a mean score; low is good."""
    return F.when(score.isNull(), "").when(score <= GRADE_A_MAX, "A").when(score <= GRADE_B_MAX, "B").otherwise("C")


def points_from_rows(rows: DataFrame) -> DataFrame:
    """Result rows (string cells) with coordinates to one point per (name, borough), grade taken from the mean score."""
    located = rows.withColumns({"latitude": F.col("latitude").try_cast("double"), "longitude": F.col("longitude").try_cast("double"), "inspection_score": F.col("inspection_score").try_cast("double")})
    located = located.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    place = F.min(F.struct("latitude", "longitude", "cuisine_type")).alias("_place")
    out = located.groupBy("restaurant_name", "borough").agg(place, F.avg("inspection_score").alias("_mean"))
    return out.select(
        "restaurant_name", "borough", "_place.latitude", "_place.longitude", F.coalesce("_place.cuisine_type", F.lit("")).alias("cuisine_type"),
        inferred_grade(F.col("_mean")).alias("grade"), F.bround("_mean").cast("long").alias("score"),
    )


def points_from_events(events: DataFrame, payload: str = "payload") -> DataFrame:
    names = ["RESTAURANT_NAME", "BOROUGH", "LATITUDE", "LONGITUDE", "CUISINE_TYPE", "INSPECTION_SCORE"]
    table = result_table(events, names, payload)
    return points_from_rows(table.select(*[F.col(n).alias(n.lower()) for n in names]))


def style_points(df: DataFrame) -> DataFrame:
    """Display columns: no NULL text, upper-case grade, score as text, colour by grade."""
    grade = F.upper(F.coalesce("grade", F.lit("")))
    whole = F.when(F.col("score") >= 0, F.floor("score")).otherwise(F.ceil("score")).cast("string")
    colour = F.array(*map(F.lit, OTHER_COLOUR))
    for g, rgba in COLOURS.items():
        colour = F.when(grade == g, F.array(*map(F.lit, rgba))).otherwise(colour)
    return df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "restaurant_name", "borough", F.col("latitude").cast("double").alias("latitude"), F.col("longitude").cast("double").alias("longitude"),
        F.coalesce("cuisine_type", F.lit("")).alias("cuisine_type"), grade.alias("grade"),
        F.coalesce(whole, F.lit(MISSING_SCORE)).alias("score"), colour.alias("fill_color"),
    )


def kpi_strip(points: DataFrame) -> DataFrame:
    """Rows, graded rows, share of A among the graded, mean score."""
    graded = F.count_if(F.coalesce("grade", F.lit("")) != "")
    share = F.coalesce(100.0 * F.count_if(F.col("grade") == "A") / F.nullif(graded, F.lit(0)), F.lit(0.0))
    return points.agg(F.count(F.lit(1)).alias("total"), graded.alias("graded"), F.round(share, 1).alias("pct_a"), F.round(F.avg("score"), 1).alias("avg_score"))


def density(df: DataFrame, step: float = 0.01) -> DataFrame:
    """Points per grid cell of ``step`` degrees."""
    located = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    cell = lambda c: F.floor(F.col(c).cast("double") / step).cast("long")
    return located.groupBy(cell("latitude").alias("cell_lat"), cell("longitude").alias("cell_lon")).agg(F.count(F.lit(1)).alias("points"))


def boroughs(layer: SemanticLayer) -> DataFrame:
    listed = layer.query(["total_restaurants"], ["borough"], where=[("borough", lambda c: c.isNotNull() & (c != "0"))])
    return listed.select("borough").orderBy("borough")


def top_cuisines(layer: SemanticLayer, k: int = 20) -> DataFrame:
    return layer.query(
        ["total_restaurants"], ["cuisine_type"], where=[("cuisine_type", lambda c: c.isNotNull())],
        order=[("total_restaurants", "desc"), ("cuisine_type", "asc")], limit=k,
    )
