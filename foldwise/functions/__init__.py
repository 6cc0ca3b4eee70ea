"""Column expressions: names, hashes, measures and display texts."""
