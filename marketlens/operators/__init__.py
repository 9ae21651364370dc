"""Single steps: totals, joins, rankings, price history, pairs, time windows."""
