"""Table operators: change-data handling, merge, keys, lookups, ranks and quality checks."""
