"""Column functions: keys, sequences, messages and row images."""
