"""Column expressions: labels, ratios, money, keyed draws, calendar parts."""
