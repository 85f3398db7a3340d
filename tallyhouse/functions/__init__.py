"""Column helpers: exact rounding, money units, calendar periods."""
