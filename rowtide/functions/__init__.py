"""Column-level helpers: packet envelope, presence flags, typed values, JSON encoding."""
