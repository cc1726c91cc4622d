"""Every registered query of the terrain and road operators, and its DuckDB twin."""

from .plans import aggregates, attributes, borders, centerline, features, grids, lines, models, networks, profiles, shapes, sources, spans, spatial, streets, tables, water

MODULES = (sources, tables, attributes, features, grids, lines, profiles, shapes, aggregates, models, networks, spatial, spans, water, centerline, streets, borders)
QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.ORACLES.items()}
FLAGSHIP = "d4_biome_share"
