"""Column functions: paths, types, text, errors, metrics and keys."""
