"""Column-level helpers: names, fixed value dictionaries, shared expressions."""
