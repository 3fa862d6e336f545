"""Cities, boundaries and regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrane.functions import geo as G
from terrane.functions import tags as T
from terrane.operators.kernels import jaro_winkler
from terrane.operators.overlay import union_polygons
from terrane.schema import CITY_TYPES


def radius_m(type_code):
    """The radius of a place type, in metres."""
    return reduce(lambda c, x: c.when(type_code == x[0], float(x[1])), CITY_TYPES.values(), F.when(F.lit(False), 0.0))


def view_cities_def_names(city: DataFrame, city_name: DataFrame) -> DataFrame:
    """Cities with their name in the default language."""
    return city.join(city_name.where("lang = 'def'").select("id", F.col("name").alias("def_name")), "id")


def combine_city_boundary(city: DataFrame, boundary: DataFrame, pairs: DataFrame) -> DataFrame:
    """Cities (``id, population, website, wikipedia, names``) filled from their boundary; its names overlay the city's."""
    b = boundary.select(F.col("id").alias("boundary_id"), *(F.col(c).alias(f"b_{c}") for c in ("population", "website", "wikipedia", "names", "geom")))
    both = city.join(pairs.select(F.col("city_id").alias("id"), "boundary_id"), "id", "left").join(b, "boundary_id", "left")
    return both.select(
        "id",
        F.when(F.coalesce("population", F.lit(0)) == 0, F.col("b_population")).otherwise(F.col("population")).alias("population"),
        *(F.coalesce(T.filled(F.col(c)), F.col(f"b_{c}")).alias(c) for c in ("website", "wikipedia")),
        F.when(F.col("b_names").isNull(), F.col("names")).otherwise(T.merge_tags(F.col("names"), F.col("b_names"))).alias("names"),
        F.col("b_geom").alias("geom"),
    )


def alike(name, short, city, phrases: list[str] | None = None):
    """Similar names, without case: one holds the other as words, or they are close by Jaro and Winkler's measure."""
    a, b, c = (F.lower(x) for x in (name, short, city))
    some = (F.length(a) > 0) & (F.length(c) > 0)
    close = (jaro_winkler(a, c) > 0.89) | (jaro_winkler(F.coalesce(b, F.lit("")), c) > 0.89)
    return some & (T.similar_name(a, b, c, phrases and [p.lower() for p in phrases]) | close)


def center_city(boundary: DataFrame, city: DataFrame, inside: DataFrame, overrides: DataFrame | None = None, phrases: list[str] | None = None, guard: bool = False) -> DataFrame:
    """``boundary_id, city_id, stage``: the first stage that gives a city, the least id within it.

    ``guard``: a boundary of level 5 or less takes no hamlet, suburb or district by its admin centre or name.

    1: the override table; 2: the admin centre; 3: the same name, inside; 4: a similar name, inside; 5: none, a city is
    to be made of the boundary (null id). ``inside`` has ``id`` (city) and ``poly_id`` (boundary).
    """
    b = boundary.select(F.col("id").alias("boundary_id"), F.col("name").alias("b_name"), F.col("short_name").alias("b_short"), "admin_center_id")
    c = city.select(F.col("id").alias("city_id"), F.col("name").alias("c_name"))
    by_admin = b.join(c, b.admin_center_id == c.city_id).select("boundary_id", "city_id", F.lit(2).alias("stage"))
    held = b.join(inside.select(F.col("poly_id").alias("boundary_id"), F.col("id").alias("city_id")), "boundary_id").join(c, "city_id")
    same = (F.col("b_name") == F.col("c_name")) | F.coalesce(F.col("b_short") == F.col("c_name"), F.lit(False))
    similar = alike(F.col("b_name"), F.coalesce("b_short", F.lit("")), F.col("c_name"), phrases)
    by_name = held.select("boundary_id", "city_id", F.when(same, 3).when(similar, 4).alias("stage")).where("stage IS NOT NULL")
    made = b.select("boundary_id", F.lit(None).cast("bigint").alias("city_id"), F.lit(5).alias("stage"))
    every = by_admin.union(by_name)
    if guard:
        fit = boundary.select(F.col("id").alias("boundary_id"), "admin_level").join(every, "boundary_id").join(city.select(F.col("id").alias("city_id"), "type_code"), "city_id")
        every = fit.where("admin_level > 5 OR type_code <= 3").select("boundary_id", "city_id", "stage")
    every = every.union(made)
    if overrides is not None:
        every = every.union(overrides.select("boundary_id", "city_id", F.lit(1)))
    best = every.groupBy("boundary_id").agg(F.min(F.struct("stage", "city_id")).alias("m"))
    return best.select("boundary_id", "m.city_id", "m.stage")


def boundary_priority(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``priority``; columns ``same_name, is_place, is_admin_center, overridden, admin_level``."""
    level = T.level_priority(F.col("admin_level"))
    rule = (
        F.when(F.col("overridden"), 0)
        .when(F.col("same_name") & F.col("is_place"), 0)
        .when(F.col("same_name") & F.col("is_admin_center"), level)
        .when(F.col("same_name"), 10 + level)
        .when(F.col("is_admin_center"), 20 + level)
        .otherwise(30 + level)
    )
    return pairs.withColumn("priority", rule)


def city_boundary(pairs: DataFrame) -> DataFrame:
    """``city_id, boundary_id, priority``: of each city the boundary with the least priority, ties by id."""
    best = pairs.groupBy("city_id").agg(F.min(F.struct("priority", "boundary_id")).alias("m"))
    return best.select("city_id", "m.boundary_id", "m.priority")


def parent_city(city: DataFrame, inside: DataFrame, boundary: DataFrame, center: DataFrame) -> DataFrame:
    """``id, parent_id``: for places below a town, the centre city of the best-level boundary around them, not themselves."""
    small = city.where("type_code > 2").select("id")
    around = inside.join(small, "id").join(boundary.select(F.col("id").alias("poly_id"), "admin_level"), "poly_id")
    around = around.join(center.select(F.col("boundary_id").alias("poly_id"), "city_id"), "poly_id").where("city_id <> id")
    best = around.groupBy("id").agg(F.min(F.struct(T.level_priority(F.col("admin_level")).alias("p"), "poly_id", "city_id")).alias("m"))
    return best.select("id", F.col("m.city_id").alias("parent_id"))


def parent_region(city: DataFrame, inside: DataFrame, region: DataFrame) -> DataFrame:
    """``id, region_id``: a region around the city; one named in its is-in list first, then the larger, then the least id."""
    area = F.aggregate("geom", F.lit(0.0), lambda a, p: a + G.ring_area(p["outer"]))
    r = region.select(F.col("id").alias("region_id"), F.col("name").alias("r_name"), area.alias("area"))
    near = inside.select("id", F.col("poly_id").alias("region_id")).join(r, "region_id").join(city.select("id", "is_in"), "id")
    named = F.coalesce(F.array_contains(T.is_in_list(F.col("is_in")), F.col("r_name")), F.lit(False))
    best = near.groupBy("id").agg(F.max(F.struct(named.alias("named"), "area", (-F.col("region_id")).alias("k"), "region_id")).alias("m"))
    return best.select("id", "m.region_id")


def relative_importance(pairs: DataFrame) -> DataFrame:
    """``pairs`` with distance over radius over priority; columns ``dist_m, type_code, population, n_lang``."""
    return pairs.withColumn("importance", F.col("dist_m") / radius_m(F.col("type_code")) / T.city_priority(F.col("population"), F.col("n_lang")))


def top_level_cities(pairs: DataFrame, city: DataFrame) -> DataFrame:
    """``street_id, city_id`` of cities, towns and villages whose parent is not in the street's list too."""
    c = city.where("type_code <= 3").select(F.col("id").alias("city_id"), "parent_city_id")
    listed = pairs.join(c, "city_id")
    parents = pairs.select(F.col("street_id").alias("_s"), F.col("city_id").alias("_p"))
    return listed.join(parents, (F.col("street_id") == F.col("_s")) & (F.col("parent_city_id") == F.col("_p")), "left_anti").select("street_id", "city_id")


def cities_for_place(place: DataFrame, pairs: DataFrame) -> DataFrame:
    """``place_id, city_id, stage``: the cities that a place belongs to.

    ``pairs`` are candidates with ``place_id, city_id, type_code, in_list`` (named in the place's list), ``has_geom``,
    ``meets`` (the polygon), ``ratio`` (distance over radius) and ``importance``. Stages: named; polygon met and ratio
    under 3; then, where nothing or a suburb was found, cities without polygon by importance under 1: all suburbs and
    districts, else the first; then the best of each type but suburbs; last the nearest with a ratio under 3.
    """
    minor = F.col("type_code") >= 5
    first = pairs.withColumn("stage", F.when(F.col("in_list"), 1).when(F.col("has_geom") & F.col("meets") & (F.col("ratio") < 3), 2))
    got = first.where("stage IS NOT NULL").select("place_id", "city_id", "type_code", "stage")
    state = place.select(F.col("id").alias("place_id")).join(got.groupBy("place_id").agg(F.lit(True).alias("any"), F.max(minor).alias("flag")), "place_id", "left")
    open3 = state.where("any IS NULL OR flag").select("place_id")
    near = pairs.join(open3, "place_id").join(got.select("place_id", "city_id"), ["place_id", "city_id"], "left_anti")
    near = near.where((F.col("importance") < 1) & ~F.col("has_geom"))
    suburbs = near.where(minor).select("place_id", "city_id", "type_code", F.lit(3).alias("stage"))
    types = got.select("place_id", "type_code").distinct()
    best = lambda df, *keys: df.groupBy(*keys).agg(F.min(F.struct("importance", "city_id", "type_code")).alias("m"))
    one = best(near.where(~minor).join(types, ["place_id", "type_code"], "left_anti"), "place_id").select("place_id", "m.city_id", "m.type_code", F.lit(3).alias("stage"))
    got3 = got.union(suburbs).union(one.join(suburbs.select("place_id").distinct(), "place_id", "left_anti"))
    state4 = place.select(F.col("id").alias("place_id")).join(got3.groupBy("place_id").agg(F.lit(True).alias("any"), F.max(minor).alias("flag")), "place_id", "left")
    open4 = state4.where("any IS NULL OR flag").select("place_id")
    wide = pairs.where((F.col("importance") < 1) & ~minor).join(open4, "place_id").join(got3.select("place_id", "type_code").distinct(), ["place_id", "type_code"], "left_anti")
    got4 = got3.union(best(wide, "place_id", "type_code").select("place_id", "m.city_id", "type_code", F.lit(4).alias("stage")))
    last = pairs.join(got4.select("place_id").distinct(), "place_id", "left_anti").where("ratio < 3")
    nearest = last.groupBy("place_id").agg(F.min(F.struct("ratio", "city_id", "type_code")).alias("m"))
    return got4.union(nearest.select("place_id", "m.city_id", "m.type_code", F.lit(5).alias("stage"))).select("place_id", "city_id", "stage")


def match_countries(names: DataFrame, wanted: DataFrame) -> DataFrame:
    """``country, boundary_id``: any name of a boundary (long table ``id, name``) equals a wanted name, normalised, without case."""
    norm = F.lower(T.normalize_name(F.col("name")))
    return names.select(F.col("id").alias("boundary_id"), norm.alias("_n")).join(wanted.select(F.col("name").alias("country"), norm.alias("_n")), "_n").select("country", "boundary_id").distinct()


def country_boundary(matches: DataFrame, boundary: DataFrame) -> DataFrame:
    """``country, boundary_id``: of each country the boundaries of its lowest level; those at one level belong together."""
    known = matches.join(boundary.select(F.col("id").alias("boundary_id"), "admin_level"), "boundary_id")
    least = known.groupBy("country").agg(F.min("admin_level").alias("admin_level"))
    return known.join(least, ["country", "admin_level"]).select("country", "boundary_id", "admin_level")


def collect_parts(polygons: DataFrame, key: str) -> DataFrame:
    """``key, geom``: the union of the polygons of each key, as parts that do not overlap."""
    return union_polygons(polygons, key)


def missing_countries(wanted: DataFrame, found: DataFrame) -> DataFrame:
    return wanted.select(F.col("name").alias("country")).join(found.select("country").distinct(), "country", "left_anti")


def upsert_regions(dim: DataFrame, batch: DataFrame, key: str = "region_id") -> DataFrame:
    """The dimension after a batch: columns of the batch that are not null replace the old ones; new keys are added."""
    old, new = dim.select(*(F.col(c).alias(f"_o_{c}") for c in dim.columns)), batch.select(*(F.col(c).alias(f"_n_{c}") for c in batch.columns))
    both = old.join(new, F.col(f"_o_{key}") == F.col(f"_n_{key}"), "full_outer")
    return both.select(*(F.coalesce(F.col(f"_n_{c}"), F.col(f"_o_{c}")).alias(c) if c in batch.columns else F.col(f"_o_{c}").alias(c) for c in dim.columns))


def pivot_names(names: DataFrame, languages: list[str]) -> DataFrame:
    """Long names ``id, lang, name`` as one column a language."""
    return names.groupBy("id").pivot("lang", languages).agg(F.max("name"))


def fill_languages(names: DataFrame, languages: list[str], old_english: str = "old_en", strict: bool = False) -> DataFrame:
    """Missing names, and those equal to the old English one, take the new English one. ``strict``: no English is an error."""
    english = F.col("en")
    if strict:
        english = F.when(english.isNull(), F.raise_error(F.concat(F.lit("no English name: "), F.col("id").cast("string")))).otherwise(english)
    fill = lambda c: F.when(F.col(c).isNull() | (F.col(c) == F.col(old_english)), english).otherwise(F.col(c)).alias(c)
    return names.select("id", english.alias("en"), *(fill(c) for c in languages if c != "en"))
