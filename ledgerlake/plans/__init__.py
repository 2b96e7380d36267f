"""Composed jobs: star schema, report loads, the driver query catalog."""
