"""Near copies by SimHash: a segment-popcount grid under the Manhattan distance, then exact bits.

A fingerprint of 64 bits is embedded as 16 counts, the set bits of each 4-bit segment. A differing
bit changes one count by one, so the Manhattan distance of the counts never exceeds the number of
differing bits. Two lattice points at distance d or less have a lattice point within d // 2 of the
one and d - d // 2 of the other: every fingerprint is put into the grid cells within those radii
and pairs are found by an equi-join on the cell, whose rows grow with the number of fingerprints.
Each pair is then verified bit by bit. Equal fingerprints are one row throughout, and a fingerprint
has at most 2,080 others within two bits, so the links stay linear in the input.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneprep.llm.common import as_bytes, components, fresh, prepare_workers, row_hashes, table
from tuneprep.runtime import column, materialize

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 2

_SEGMENTS, _WIDTH = 16, 4
_BLOCK = 1 << 16


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number.

    Words are runs without ASCII white space (space, 09-0D), A-Z in lower case. Shingles are joined
    by one space and repeats count; fewer words are one shingle; a text without words has 0. A bit
    is set if it is set in over half the XXH64 values.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
        starts = [0, *(gaps[: len(words) - shingle] + 1).tolist()]
        ends = [*gaps[shingle - 1 :].tolist(), len(joined)]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        part = np.array(hashes[at : at + _BLOCK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """``fingerprint`` of each text; a null text counts as empty."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(x, shingle) for x in as_bytes(texts)], pa.int64())

    return simhash(text)


def _ball(radius: int) -> list[int]:
    """Offsets of all packed cells within the Manhattan radius; a count is one hex digit."""
    found = {0: 0}
    for step in range(1, radius + 1):
        for offset in list(found):
            for i in range(_SEGMENTS):
                for sign in (1, -1):
                    found.setdefault(offset + sign * (1 << (_WIDTH * i)), step)
    return sorted(found)


def _mask(pattern: int) -> Column:
    return F.lit(int(np.uint64(pattern).astype(np.int64)))


def _counts(bits: Column) -> Column:
    """Set bits of every 4-bit segment, each as one hex digit of a 64-bit number."""
    odd = _mask(0x5555555555555555)
    pairs = bits.bitwiseAND(odd), F.shiftrightunsigned(bits, 1).bitwiseAND(odd)
    low = _mask(0x3333333333333333)
    # The sums stay inside their digits; OR-free addition could overflow the sign, so digits are
    # added in two halves and put together again.
    def add(x, y):
        half = _mask(0x00000000FFFFFFFF)
        right = x.bitwiseAND(half) + y.bitwiseAND(half)
        left = F.shiftrightunsigned(x, 32) + F.shiftrightunsigned(y, 32)
        return F.shiftleft(left, 32).bitwiseOR(right)

    two = add(*pairs)
    return add(two.bitwiseAND(low), F.shiftrightunsigned(two, 2).bitwiseAND(low))


def near_fingerprints(distinct: DataFrame, bits: str, max_bits: int = MAX_BITS) -> DataFrame:
    """``a, b``: every pair of different fingerprints (a < b) that differ in at most ``max_bits``.

    ``distinct`` has each fingerprint once and no nulls.
    """
    if not 0 <= max_bits <= 8:
        raise ValueError("max_bits must be in 0..8")

    def cells(radius, name):
        offsets = F.array(*[F.lit(x) for x in _ball(radius)])
        return distinct.select(
            column(bits).alias(name), _counts(column(bits)).alias("_centre")
        ).select(
            name, F.explode(F.transform(offsets, lambda x: x + F.col("_centre"))).alias("cell")
        )

    left, right = cells(max_bits // 2, "a"), cells(max_bits - max_bits // 2, "b")
    ordered = F.col("a") < F.col("b") if max_bits % 2 == 0 else F.col("a") != F.col("b")
    # Spark sizes an exploded table like the one before it, 33 times too low, and would broadcast it.
    pairs = left.hint("merge").join(right, "cell").filter(
        ordered & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def groups(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: id, ``bits`` (fingerprint as bigint), ``component_id``, ``component``.

    ``component_id`` is the smallest id that links reach, the document's own included; null ids
    are passed over (a component of null ids only has null). ``component`` is its smallest
    fingerprint. Null and empty texts share fingerprint
    0; repeated rows and repeated ids stay as they are; an empty table gives no rows. Other columns
    of ``docs`` are not read, whatever their names.
    """
    rows = _fingerprinted(docs, text_col, shingle, column(id_col).alias("_id"))
    least = rows.groupBy("bits").agg(F.min("_id").alias("least"))
    labelled = _labelled(least, max_bits)
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_bits = labelled.join(smallest, "component").select("bits", "component_id", "component")
    return rows.join(by_bits, "bits", "left").select(
        F.col("_id").alias(id_col), "bits", "component_id", "component"
    )


def _fingerprinted(docs: DataFrame, text_col: str, shingle: int, *keys: Column) -> DataFrame:
    """``keys`` and fingerprint ``bits`` of every row, stored: texts are read once."""
    prepare_workers(docs.sparkSession)
    bits = fingerprint_column(column(text_col), shingle).alias("bits")
    return materialize(docs.select(*keys, bits), "fingerprints")


def _labelled(distinct: DataFrame, max_bits: int) -> DataFrame:
    """``distinct``, which has each fingerprint once, with its ``component``."""
    linked = components(near_fingerprints(distinct.select("bits"), "bits", max_bits), "a", "b")
    return distinct.join(linked, distinct["bits"] == linked["node"], "left").select(
        *distinct.columns, F.coalesce("component", "bits").alias("component")
    )


def keep_one(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """The rows of ``docs`` that remain if one document of each component stays.

    That is the one with the smallest id (ids that are null come last); of rows that repeat that id
    the smallest fingerprint stays, then the smallest hash of all columns, the same at each run. All
    columns are kept. Documents are found again by id and 128 bits of hash, so fingerprints are
    computed once and whole rows are shuffled once, to meet the rows that stay.
    """
    hashes = row_hashes(docs)
    rows = _fingerprinted(
        docs, text_col, shingle, column(id_col).alias("id"), *[h.alias(f"h{i}") for i, h in enumerate(hashes)]
    )
    # Copies of a text are folded map-side before any of their rows meet.
    least = rows.groupBy("bits").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h0", "h1")).alias("least")
    )
    first = F.struct("least.none", "least.id", "bits", "least.h0", "least.h1")
    kept = (
        _labelled(least, max_bits)
        .groupBy("component")
        .agg(F.min(first).alias("first"))
        .select("first.h0", "first.h1")
    )
    one, two, place = fresh("one"), fresh("two"), fresh("place")
    keepers = materialize(kept.toDF(one, two), "keepers")
    same = Window.partitionBy(column(one), column(two)).orderBy(column(one))  # rows equal throughout
    return (
        docs.withColumns({one: hashes[0], two: hashes[1]})
        .join(keepers, [one, two], "left_semi")
        .withColumn(place, F.row_number().over(same))
        .filter(column(place) == 1)
        .drop(one, two, place)
    )


def op2_simhash(spark, sf_dir):
    """Fingerprint and component of every document, as hex digits and smallest id."""
    found = groups(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
