"""A PySpark engine for map entities: nodes, ways and relations with free tags in, address, place, route and tile tables out."""
