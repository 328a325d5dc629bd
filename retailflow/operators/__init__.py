"""DataFrame operators: joins, aggregates and skew-safe window-style numbering."""
