"""The operators put together, from raw splits to written batches and losses."""
