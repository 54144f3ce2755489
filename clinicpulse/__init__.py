"""Clinic product analytics as Spark jobs: every job maps DataFrames and typed parameters to a DataFrame."""
