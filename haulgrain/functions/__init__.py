"""Column functions: business keys, period keys, predicates, rules and named formulas."""
