"""DataFrame-wide operators: newest row per key, validity end dates, whole-table
means, dense surrogate keys, grand totals, and the quality checks."""
