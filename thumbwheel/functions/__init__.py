"""Column functions: built-in Catalyst expressions only."""
