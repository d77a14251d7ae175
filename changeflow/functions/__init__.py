"""Column expressions: JSON fields, canonical text, digests."""
