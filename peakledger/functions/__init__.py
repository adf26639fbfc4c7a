"""Column functions: time, file names, event fields."""
