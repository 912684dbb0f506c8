"""Column functions: text rules, null policy, fixed values."""
