"""Terrain, raster and road-network analytics as PySpark DataFrame operators."""
