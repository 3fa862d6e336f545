"""Tag rules as Column expressions. ``tags`` is a MAP<STRING,STRING> column."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrane.schema import CITY_TYPES

#: Fixed values.
RESIDENTIAL_LANDUSE = ("residential", "industrial", "railway", "commercial", "hospital", "brownfield", "cemetery")
ROUTES = ("bicycle", "mtb", "hiking", "foot", "ski", "piste")
CYCLING, HIKING = ("bicycle", "mtb"), ("hiking", "foot")
CYCLE_NETWORKS = ("lcn", "rcn", "ncn", "icn")
HIKING_NETWORKS = ("lwn", "rwn", "nwn", "iwn")
DEAD_STATES = ("proposed", "disused", "removed", "abandoned")
COLOURS = ("black", "blue", "brown", "green", "orange", "purple", "red", "white", "yellow")
ROUTE_KEYS = ("network", "route", "name", "ref", "osmc:symbol", "osmc", "piste:type", "piste:grooming", "piste:difficulty", "type", "educational")
INHERITED_KEYS = ("bridge", "highway", "layer", "mtb:scale", "sac_scale", "tunnel")
JUNCTION_KEYS = {"rcn_ref": "cycle_node", "rwn_ref": "hiking_node"}
ADDRESS_VALUES = ("street", "associatedStreet")


def tag(tags: str | Column, key: str) -> Column:
    """The value of a key, or null."""
    return (F.col(tags) if isinstance(tags, str) else tags)[key]


def filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def has(tags: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(tags, key), F.lit(False))


def tag_condition(tags: Column, expression: str) -> Column:
    """A filter such as ``highway=track,path``, ``name=*`` or ``name``; the entity kinds before a slash are not read here."""
    body = expression.rpartition("/")[2]
    key, eq, values = body.partition("=")
    if not eq or values == "*":
        return has(tags, key)
    return F.coalesce(tags[key].isin(values.split(",")), F.lit(False))


def tags_match(tags: Column, expressions: list[str], kind: str) -> Column:
    """True if any filter for this entity kind (``n``, ``w`` or ``r``) holds; a filter without kinds is for all."""
    mine = [e for e in expressions if "/" not in e or kind in e.partition("/")[0]]
    return reduce(or_, (tag_condition(tags, e) for e in mine), F.lit(False))


def keep_keys(tags: Column, keys: tuple[str, ...]) -> Column:
    return F.map_filter(tags, lambda k, _: k.isin(*keys))


def let(value: Column, body) -> Column:
    """Bind ``value`` once for use in ``body``; without it an expression used twice is computed twice."""
    return F.transform(F.array(value), body)[0]


def merge_tags(first: Column, second: Column) -> Column:
    """Both maps; where both have a key, the second's value."""
    return let(second, lambda s: F.map_concat(F.map_filter(first, lambda k, _: ~F.map_contains_key(s, k)), s))


def is_place(tags: Column) -> Column:
    return F.coalesce(F.lower(tags["place"]).isin(*CITY_TYPES), F.lit(False))


def is_continent(tags: Column) -> Column:
    return F.coalesce(tags["place"] == "continent", F.lit(False))


def address_way(tags: Column) -> Column:
    return ~F.coalesce(tags["highway"] == "proposed", F.lit(False))


def address_relation(tags: Column) -> Column:
    values = F.exists(F.map_values(tags), lambda v: v.isin(*ADDRESS_VALUES))
    pedestrian = F.coalesce(tags["highway"] == "pedestrian", F.lit(False))
    return F.coalesce(has(tags, "boundary") | has(tags, "place") | values | pedestrian | has(tags, "building"), F.lit(False))


def country_entity(tags: Column) -> Column:
    return F.coalesce(tags["admin_level"].isin("2", "3", "4"), F.lit(False)) | F.coalesce(tags["border_type"] == "territorial", F.lit(False))


def is_residential_landuse(tags: Column) -> Column:
    return F.coalesce(tags["landuse"].isin(*RESIDENTIAL_LANDUSE), F.lit(False))


def is_building(tags: Column) -> Column:
    return has(tags, "building")


def is_street_way(highway: Column) -> Column:
    return highway.isNotNull() & (highway != "platform")


def is_path(highway: Column) -> Column:
    return F.coalesce(highway.isin("track", "path", "cycleway"), F.lit(False))


def network_valid(route: Column, network: Column) -> Column:
    """A known network of the route's family; routes of other families need none."""
    cycling, hiking = F.coalesce(route.isin(*CYCLING), F.lit(False)), F.coalesce(route.isin(*HIKING), F.lit(False))
    return F.when(cycling, F.coalesce(network.isin(*CYCLE_NETWORKS), F.lit(False))).when(hiking, F.coalesce(network.isin(*HIKING_NETWORKS), F.lit(False))).otherwise(F.lit(True))


def fix_network(route: Column, network: Column) -> Column:
    """An empty or wrong network becomes the local one of the family."""
    bad = ~network_valid(route, network)
    return F.when(bad & route.isin(*CYCLING), "lcn").when(bad & route.isin(*HIKING), "lwn").otherwise(network)


def is_tourist_route(tags: Column) -> Column:
    alive = ~has(tags, "disused") & ~F.coalesce(tags["state"].isin(*DEAD_STATES), F.lit(False)) & ~F.coalesce(tags["type"] == "network", F.lit(False))
    is_super = F.coalesce(tags["type"] == "superroute", F.lit(False))
    super_ok = filled(tags["osmc:symbol"]).isNotNull() & network_valid(tags["route"], tags["network"])
    return F.coalesce(tags["route"].isin(*ROUTES), F.lit(False)) & alive & (~is_super | super_ok)


def same_style(parent: Column, child: Column) -> Column:
    """A named superroute and its child have one symbol; the child is then left out."""
    return F.coalesce((parent["type"] == "superroute") & filled(parent["name"]).isNotNull(), F.lit(False)) & parent["osmc:symbol"].eqNullSafe(child["osmc:symbol"])


def junction_tags(tags: Column) -> Column:
    """Nodes of numbered networks get a tag for each network they are a junction of."""
    marks = [F.when(has(tags, k), F.create_map(F.lit(v), F.lit("NLBE"))).otherwise(F.create_map().cast("map<string,string>")) for k, v in JUNCTION_KEYS.items()]
    return reduce(merge_tags, marks, tags)


def is_junction(tags: Column) -> Column:
    return reduce(or_, (has(tags, k) for k in JUNCTION_KEYS))


def street_name(tags: Column) -> Column:
    return F.coalesce(*(filled(tags[k]) for k in ("name", "street", "addr:street")))


def names_by_lang(tags: Column, key: str, default: Column) -> Column:
    """Names by two-letter language code, without empty ones and those equal to the default."""
    prefix = len(key) + 2
    kept = F.map_filter(tags, lambda k, v: k.startswith(f"{key}:") & (F.length(k) == prefix + 1) & (v != "") & ~v.eqNullSafe(default))
    return F.transform_keys(kept, lambda k, _: F.substring(k, prefix, 2))


def is_in_list(is_in: Column) -> Column:
    """The parts of a list with semicolons; a value without any is no list."""
    return F.when(is_in.contains(";"), F.transform(F.split(is_in, ";"), lambda x: F.trim(x))).otherwise(F.array().cast("array<string>"))


#: Fixed value: characters that names are normalised without.
PUNCTUATION = r"[~!@#$%^&*()\-_+=`|\\:;'<>,./?]"
#: Latin letters with marks and the letters that they are made of.
_ACCENTED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝàáâãäåçèéêëìíîïñòóôõöùúûüýÿĀāĂăĄąĆćĈĉĊċČčĎďĒēĔĕĖėĘęĚěĜĝĞğĠġĢģĤĥĨĩĪīĬĭĮįİĴĵĶķĹĺĻļĽľŃńŅņŇňŌōŎŏŐőŔŕŖŗŘřŚśŜŝŞşŠšŢţŤťŨũŪūŬŭŮůŰűŲųŴŵŶŷŸŹźŻżŽž"


def _plain(text: str) -> str:
    import unicodedata

    return "".join(unicodedata.normalize("NFD", c)[0] for c in text)


def normalize_name(c: Column) -> Column:
    """Without diacritics (Latin letters) and punctuation, single spaces, trimmed. Case is left to the caller."""
    bare = F.regexp_replace(F.translate(c, _ACCENTED, _plain(_ACCENTED)), r"\p{InCombiningDiacriticalMarks}+", "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, PUNCTUATION, " "), " {2,}", " "))


def similar_name(name: Column, short: Column, city: Column, phrases: list[str] | None = None) -> Column:
    """Boundary and city names where one holds the other as words, also after the phrases are taken out of the boundary's."""

    def as_word(a: Column, b: Column) -> Column:
        return (a == b) | a.startswith(F.concat(b, F.lit(" "))) | a.endswith(F.concat(F.lit(" "), b)) | a.contains(F.concat(F.lit(" "), b, F.lit(" ")))

    def alike(a: Column) -> Column:
        return F.coalesce((F.length(a) > 0) & (F.length(city) > 0) & (as_word(a, city) | as_word(city, a)), F.lit(False))

    out = alike(name) | alike(short)
    if phrases:
        bare = reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), phrases, name)
        out = out | alike(F.trim(bare))
    return out


def parse_osmc(symbol: Column) -> Column:
    """``colour:background:foreground:text:textcolour`` as a map; a value without colons counts only if it is a colour."""
    many = symbol.contains(":")
    colour = lambda c: F.lower(c).isin(*COLOURS)

    def spread(parts: Column) -> Column:
        at = lambda i: F.get(parts, F.lit(i))
        short = F.length(at(3)) <= 5
        pairs = {
            "osmc": F.lit("yes"),
            "osmc_color": F.when(F.when(many, colour(at(0))).otherwise(symbol.isin(*COLOURS)), at(0)),
            "osmc_background": F.when(many, at(1)),
            "osmc_foreground": F.when(many, at(2)),
            "osmc_text_length": F.when(many & short, F.length(at(3)).cast("string")),
            "osmc_text": F.when(many & short, at(3)),
            "osmc_text_color": F.when(many & colour(at(4)), at(4)),
        }
        entries = F.array(*(F.when(v.isNotNull(), F.struct(F.lit(k).alias("k"), v.alias("v"))) for k, v in pairs.items()))
        return F.map_from_entries(F.array_compact(entries))

    return F.when(F.coalesce(symbol, F.lit("")) == "", F.create_map().cast("map<string,string>")).otherwise(let(F.split(symbol, ":", -1), spread))


def route_colour(tags: Column) -> Column:
    return F.coalesce(tags["colour"], tags["color"])


def merge_ref_name(name: Column, ref: Column) -> Column:
    has_name, has_ref = F.length(name) > 0, F.length(ref) > 0
    return F.when(has_name & has_ref & ~name.contains(ref), F.concat(name, F.lit(", "), ref)).when(has_name, name).when(has_ref, ref).otherwise(name)


def inherit_way_tags(route_tags: Column, way_tags: Column) -> Column:
    """The route's tags and those of the way's that pass on and are absent; ``highway`` moves to two keys of its own."""
    def moved(own: Column) -> Column:
        road = own["highway"]
        rest = F.map_filter(own, lambda k, _: k != "highway")
        return F.when(road.isNull(), rest).otherwise(F.map_concat(F.map_filter(rest, lambda k, _: ~k.isin("osmc_highway", "lm_highway")), F.create_map(F.lit("osmc_highway"), road, F.lit("lm_highway"), road)))

    return let(merge_tags(keep_keys(way_tags, INHERITED_KEYS), route_tags), moved)


def admin_level(tags: Column) -> Column:
    """The level as a whole number, -1 if it is none."""
    return F.coalesce(F.when(tags["admin_level"].rlike("^[0-9]{1,9}$"), tags["admin_level"].cast("int")), F.lit(-1))


def is_int(c: Column) -> Column:
    return F.coalesce(c.rlike("^[+-]?[0-9]+$"), F.lit(False))


def is_numeric(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), F.lit(False))


def interpolation_step(c: Column) -> Column:
    """How house numbers go on along a way: all 1, even or odd 2, alphabetic 1, a whole number itself, else null."""
    kind = F.lower(c)
    return F.when(kind.isin("all", "alphabetic"), 1).when(kind.isin("even", "odd"), 2).when(kind.rlike("^[1-9][0-9]{0,5}$"), kind.cast("int"))


def can_interpolate(number: Column, kind: Column) -> Column:
    return F.coalesce(F.when(F.lower(kind) == "alphabetic", number.rlike("^.*[A-Za-z]$")).otherwise(number.rlike("^[0-9]+$")), F.lit(False))


def city_priority(population: Column, n_lang: Column) -> Column:
    by_lang = F.when(n_lang >= 30, 1.5).when((n_lang >= 12) & (n_lang <= 19), 1.0).when((n_lang >= 6) & (n_lang <= 11), 0.75).otherwise(0.0)
    return 1.0 + F.when(population >= 1_000_000, 1.75).when((population > 500_000) & (population < 1_000_000), 1.0).otherwise(by_lang)


def level_priority(level: Column) -> Column:
    return F.when(level == 8, 1).when(level == 7, 2).when(level == 6, 3).when(level == 9, 4).when(level == 10, 5).when(level.isNull() | (level < 0), 5).otherwise(6)


def poi_name(tags: Column) -> Column:
    """Keys in lower case, empty values skipped: the name, else the English one. Of equal keys the last one counts."""
    entries = F.filter(F.map_entries(tags), lambda e: e["value"] != "")
    pick = lambda key: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == key), -1)["value"]
    return F.coalesce(F.when(F.exists(entries, lambda e: F.lower(e["key"]) == "name"), pick("name")), F.when(F.exists(entries, lambda e: F.lower(e["key"]) == "name:en"), pick("name:en")))


def version_ms(c: Column) -> Column:
    return F.unix_millis(F.to_timestamp(c, "yyyy.MM.dd"))


def ferry_highway(tags: Column) -> Column:
    ferry = F.coalesce(tags["route"] == "ferry", F.lit(False)) & ~has(tags, "highway")
    return F.when(ferry, merge_tags(tags, F.create_map(F.lit("highway"), F.lit("ferry")))).otherwise(tags)


def boundary_attrs(tags: Column) -> dict[str, Column]:
    """Columns of a boundary's further names and facts."""
    return {
        "short_name": tags["short_name"],
        "official_name": tags["official_name"],
        "alt_name": tags["alt_name"],
        "int_name": tags["int_name"],
        "names": names_by_lang(tags, "name", tags["name"]),
        "official_names": names_by_lang(tags, "official_name", tags["official_name"]),
        "alt_names": names_by_lang(tags, "alt_name", tags["alt_name"]),
        "website": tags["website"],
        "wikipedia": tags["wikipedia"],
        "population": F.when(tags["population"].rlike("^[0-9]{1,9}$"), tags["population"].cast("int")),
    }
