"""Table builders (current-state, star schema) and the queries on top of them."""
