"""DataFrame operators: scoring, ranking, joins, spatial join and data checks."""
