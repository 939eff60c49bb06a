"""Column helpers: time arithmetic, distance and scoring rules."""
