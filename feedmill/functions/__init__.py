"""Column functions: event codes, text rules, name patterns."""
