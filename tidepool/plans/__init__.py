"""Query catalogue: each named query is a DataFrame plan over the driver tables."""
