"""Column expressions: no shuffle, no job, usable in batch and on streams."""
