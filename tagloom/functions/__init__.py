"""Column-to-column functions; everything here stays a Catalyst expression."""
