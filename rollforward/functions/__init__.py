"""Column expressions: row hashes, load stamps, schema conformance."""
