"""DataFrame operators: spatial joins, aggregation, classification, checks."""
