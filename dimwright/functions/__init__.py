"""Column expressions with the reference's SQL semantics."""
