"""DataFrame-level operators: cleaning, statistics, joins, centres and layer styling."""
