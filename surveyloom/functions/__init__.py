"""Column expressions and the one Arrow function the operators are made of."""
