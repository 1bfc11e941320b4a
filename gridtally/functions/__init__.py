"""Column expressions: null rules, area codes, file names, geometry."""
