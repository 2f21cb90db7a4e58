"""Column expressions: time buckets, text extraction, id codec, classification."""
