"""DataFrame -> DataFrame operators: projection, merge, lookup joins, page parsing, ordered text."""
