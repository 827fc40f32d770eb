"""Column-level logic: features, labels, validation, text."""
