"""Column helpers: fixed lookups, exact rounding, time slots."""
