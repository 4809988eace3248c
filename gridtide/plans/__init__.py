"""The models: staging, dimensions, facts, analytics, reports, and their checks. DataFrames in, DataFrame out."""
