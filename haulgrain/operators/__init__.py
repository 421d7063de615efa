"""DataFrame operators.  All are lazy and take and return DataFrames."""
