"""Operators over DataFrames: star schema, reports, quality, upsert, ML."""
