"""Table operators: filters and cleaning, aggregates, pivots, joins, time, order, checks."""
