"""DataFrame operators: dedup, joins, series, statistics, ranks, states, merges, quality checks."""
