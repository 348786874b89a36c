"""Order and sampling keys that depend on the row alone, never on its partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tuneprep.runtime import column, names

# Purposes of a key. Different salts make the orders independent of each other.
SHUFFLE = "shuffle"
HOLDOUT = "holdout"
SIDE = "side"


def order_key(purpose: str, seed: int, order_col) -> Column:
    """Uniform 32-digit hexadecimal key of a row: md5 of ``purpose:seed:key``."""
    keys = [column(c).cast("string") for c in names(order_col)]
    return F.md5(F.concat_ws(":", F.lit(purpose), F.lit(str(seed)), *keys))


def leading_bits(key: Column, digits: int) -> Column:
    """First ``digits`` hexadecimal digits of an order key, as a number that sorts like it."""
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def content_hash(text: Column) -> Column:
    """32-byte SHA-256 of a text; null counts as a value of its own."""
    return F.coalesce(F.unhex(F.sha2(text, 256)), F.unhex(F.lit("")))
