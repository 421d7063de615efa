"""Data marts: each plan takes source frames and returns one result frame at a declared grain."""
