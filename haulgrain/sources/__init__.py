"""Reading source tables and writing target tables."""
