"""Column expressions and team catalogs."""
