"""Column functions: dates, names, markers, policy predicates."""
