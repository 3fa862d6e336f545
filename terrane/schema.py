"""Schemas of the entity tables, as DDL."""

POINT = "struct<lon:double,lat:double>"
LINE = f"array<{POINT}>"
POLYGON = f"struct<outer:{LINE},holes:array<{LINE}>>"
TAGS = "map<string,string>"

NODE = f"id bigint, lon double, lat double, tags {TAGS}"
WAY = f"id bigint, refs array<bigint>, tags {TAGS}"
RELATION = f"id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags {TAGS}"
CITY = f"id bigint, type_code int, name string, is_in string, population int, lon double, lat double, parent_city_id bigint, region_id bigint, geom array<{POLYGON}>"
BOUNDARY = f"id bigint, entity_type string, name string, short_name string, admin_level int, place string, admin_center_id bigint, geom array<{POLYGON}>"
REGION = f"id bigint, name string, admin_level int, geom array<{POLYGON}>"
STREET = f"id bigint, osm_id bigint, name string, name_norm string, is_path boolean, geom array<{LINE}>"
HOUSE = "osm_id bigint, street_id bigint, number string, name string, street_name string, place string, city string, postcode_id int, lon double, lat double"
POI_RULE = "kind string, key string, value string, root string, sub string, filters map<string,array<string>>"
TILE = "z int, x int, y int, data binary"
CHANGE = "type string, id bigint, version bigint, action string, ts timestamp"

#: Place types by code, with the radius in metres in which a place is looked for.
CITY_TYPES = {"city": (1, 10000), "town": (2, 4000), "village": (3, 1750), "hamlet": (4, 750), "suburb": (5, 750), "district": (6, 400)}
#: The 23 languages that names are kept in.
LANGUAGES = "ar cs da de el en es et fi fr hu it ja ko nl nb pl pt ru sk sl uk zh".split()
#: Metres.
EARTH_RADIUS = 6_372_800.0
PLAIN_RADIUS = 6_378_000.0
