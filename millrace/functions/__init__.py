"""Column-level helpers: text, dates, money, keys, arrays."""
