"""Column expressions: types, casts, payloads, log positions."""
