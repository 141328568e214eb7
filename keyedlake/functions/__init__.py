"""Column-level functions: parsing and normalisation."""
