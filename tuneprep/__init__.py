"""Spark DataFrame operators that prepare and score fine-tuning data."""
