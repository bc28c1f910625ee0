"""Plans: the end-to-end batch run and the query bindings to the driver tables."""
