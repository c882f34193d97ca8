"""Column builders: text, statistics, arrays and spans."""
