"""DataFrame operators: parse, predicate and counts."""
