"""DataFrame operators: shaping, statistics, joins, encodings, reports."""
