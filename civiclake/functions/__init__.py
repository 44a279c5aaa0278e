"""Column expressions: fingerprints, canonical numbers, bands, labels and classes."""
