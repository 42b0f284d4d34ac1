"""Reading source tables and writing results."""
