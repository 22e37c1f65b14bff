"""Plans: the reference's jobs composed from operators, and their SQL oracles."""
