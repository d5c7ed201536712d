"""DataFrame operators: flattening, ranking, joins and pivots."""
