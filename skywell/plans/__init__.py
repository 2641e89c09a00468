"""Composed queries over the sensor tables."""
