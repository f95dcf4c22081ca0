"""Column-level functions: everything here builds Catalyst expressions only."""
