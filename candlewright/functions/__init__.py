"""Column functions: no actions, no Python UDFs."""
