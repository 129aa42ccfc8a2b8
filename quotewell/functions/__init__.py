"""Column expressions: text parsing, calendar parts, labels and ratios."""
