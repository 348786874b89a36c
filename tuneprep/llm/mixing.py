"""Mix sources to target weights by systematic sampling.

Each source has a target of words. Its documents stand in a fixed order, smallest first, so that the
sample is spread over all sizes; the expected copies of a document, target over size of the source,
are summed up along that order. One offset per source, drawn from a hash, shifts the sums, and a
document is emitted once for every integer its own stretch crosses. Sums are held in units of
2**-20, so nothing depends on rounding: copies never exceed the limit and reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneprep.llm.common import fresh, row_hashes, table
from tuneprep.operators.indexing import index_keys
from tuneprep.runtime import column, materialize

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = 42

#: Sources with more than this share of the rows are at most 1,000, so they may be broadcast.
HOT_SHARE = 0.001

_UNIT_BITS = 20
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs without ASCII white space in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _md5_bits(text: Column, digits: int) -> Column:
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("long")


def targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """Add ``target`` and ``source_rank`` to one row per source (``source``, ``source_size``).

    Sources by code point, null last, take the weights in turn and share the total of all sizes. A
    target stops at ``max_repeats`` times its source's size and the excess is shared by weight among
    the others. That is the water level L with sum(min(limit, weight * L)) = total: in order of
    limit / weight, the sources before a row are at their limit, and the level is the largest that
    any row finds for the rest. The windows hold one row per source, never rows of the corpus.
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_limit = everything.orderBy("_ratio", "source_rank")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_limit.rowsBetween(0, Window.unboundedFollowing)
    turn = (F.col("source_rank") % len(weights) + 1).cast("int")
    return (
        sources.withColumn("source_rank", (F.row_number().over(by_name) - 1).cast("long"))
        .withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
        .withColumn("_limit", F.col("source_size") * max_repeats)
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
        .withColumn(
            "_level",
            (
                F.sum("source_size").over(everything)
                - F.coalesce(F.sum("_limit").over(before), F.lit(0))
            )
            / F.sum("_weight").over(onwards),
        )
        .withColumn(
            "target",
            F.least(
                F.col("_limit").cast("double"),
                F.col("_weight") * F.max("_level").over(everything),
            ),
        )
        .select(*sources.columns, "target", "source_rank")
    )


def _key_hashes(id_col: str, text_col: str, source_col: str) -> tuple[Column, Column]:
    """Two 64-bit hashes; rows of one id, text and source have both in common, and no others do."""
    values = [column(c) for c in (id_col, text_col, source_col)]
    return F.xxhash64(*values), F.xxhash64(F.lit("row"), *values)


def _join_sources(rows: DataFrame, sources: DataFrame, same, hot: Column, few: bool) -> DataFrame:
    """Every row with what is known of its source, no task having all rows of a hot one.

    ``few``: there are no more sources than may be hot, so all are broadcast. Else the hot ones are,
    and the rows of the others, none of which has many, are shuffled by source.
    """
    if few:
        return rows.join(F.broadcast(sources), same(rows, sources))
    top, others = sources.filter(hot), sources.filter(~hot)
    near = rows.join(F.broadcast(top), same(rows, top))
    far = rows.join(F.broadcast(top), same(rows, top), "left_anti")
    return near.unionByName(far.join(others, same(far, others)))


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: ``id, row_hash, row_hash_2, size, source_size, target, copies, taken``.

    Null and empty texts have size 0 and take no words; a null source is a source of its own. Ids
    may be null or repeat: every row counts for itself, and rows equal in id, text and source are
    interchangeable. A text of any length is one number here. An empty table gives no rows. Other columns are not read. Only narrow rows are
    ordered, by ranges of (source, size, hash), so a source of any size is spread over all tasks.
    """
    one, two = _key_hashes(id_col, text_col, source_col)
    rows = materialize(
        docs.select(
            column(id_col).alias("id"),
            column(source_col).alias("source"),
            word_count(column(text_col)).alias("size"),
            one.alias("row_hash"),
            two.alias("row_hash_2"),
        ),
        "sizes",
    )
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows")
    )
    aimed = materialize(targets(sizes, weights, max_repeats), "targets")
    n_sources, n_rows = aimed.agg(F.count(F.lit(1)), F.sum("source_rows")).first()
    hot = F.col("source_rows") > HOT_SHARE * (n_rows or 0)
    few = n_sources <= 1 / HOT_SHARE
    known = _join_sources(
        rows,
        aimed.select("source", "source_rank", "source_rows").withColumnRenamed("source", "_source"),
        lambda x, y: x["source"].eqNullSafe(y["_source"]),
        hot,
        few,
    ).select("id", "size", "row_hash", "row_hash_2", "source_rank")
    tie = _md5_bits(
        F.concat(F.lit(f"mix:{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 15
    )
    placed = index_keys(
        known.withColumn("tie", tie),
        ["source_rank", "size", "tie", "row_hash", "row_hash_2"],
        {"id": F.col("id")},
    )
    # The index runs through all sources in order, so a source begins where those before it end.
    firsts = placed.groupBy("source_rank").agg(F.min("idx").alias("first"))
    unit = 1 << _UNIT_BITS
    step = F.least(
        F.floor(F.col("target") / F.col("source_size") * unit), F.lit(max_repeats * unit)
    ).cast("long")
    offset = _md5_bits(F.concat(F.lit(f"offset:{seed}:"), F.coalesce("source", F.lit(""))), 5)
    steps = aimed.join(firsts, "source_rank").select(
        F.col("source_rank").alias("_rank"),
        "source_rows",
        "source_size",
        "target",
        "first",
        F.when(F.col("source_size") > 0, step).otherwise(F.lit(0)).alias("step"),
        offset.alias("offset"),
    )
    place = F.col("idx") - F.col("first")

    def crossed(upto):
        return F.shiftright(F.col("offset") + F.col("step") * upto, _UNIT_BITS)

    return (
        _join_sources(placed, steps, lambda x, y: x["source_rank"] == y["_rank"], hot, few)
        .withColumn("copies", crossed(place + 1) - crossed(place))
        .select(
            "id",
            "row_hash",
            "row_hash_2",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    **options,
) -> DataFrame:
    """The rows of the mixture, all columns kept, each as often as ``copies`` says.

    Rows equal in id, text and source share their copies evenly, in the order of a hash of all
    columns. Nulls, empty texts and an empty table are as in ``copies``. Whole rows move once, by the
    join on 128 bits of hash.
    """
    one, two, place, total, among = (fresh(x) for x in ("one", "two", "place", "total", "among"))
    keys = [column(one), column(two)]
    taken = (
        copies(docs, id_col, text_col, source_col, **options)
        .groupBy(F.col("row_hash").alias(one), F.col("row_hash_2").alias(two))
        .agg(F.sum("copies").alias(total), F.count(F.lit(1)).alias(among))
    )
    equal = Window.partitionBy(*keys).orderBy(*row_hashes(docs))
    share = F.floor(column(total) * column(place) / column(among)) - F.floor(
        column(total) * (column(place) - 1) / column(among)
    )
    hashes = _key_hashes(id_col, text_col, source_col)
    return (
        docs.withColumns({one: hashes[0], two: hashes[1]})
        .withColumn(place, F.row_number().over(equal))
        .join(taken.filter(column(total) > 0), [one, two])
        .withColumn(place, F.explode(F.array_repeat(F.lit(0), share.cast("int"))))
        .select(*[column(c) for c in docs.columns])
    )


def op8_mixing(spark, sf_dir):
    """Words taken of every document."""
    return copies(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


OP8_SQL = f"""
WITH rows AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)
    AS BIGINT) AS size FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) - 1 AS source_rank
  FROM rows GROUP BY source),
weighted AS (
  SELECT *, CASE source_rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight, source_size * {MAX_REPEATS} AS bound
  FROM sources),
levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) - CAST(coalesce(sum(bound) OVER (
      ORDER BY bound / weight, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS BIGINT)) / sum(weight) OVER (
      ORDER BY bound / weight, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    AS level FROM weighted),
aimed AS (
  SELECT *, least(CAST(bound AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels),
steps AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(least(
      target / source_size * {1 << _UNIT_BITS}, {MAX_REPEATS << _UNIT_BITS})) AS BIGINT) ELSE 0 END AS step,
    CAST('0x' || substr(md5('offset:{SEED}:' || coalesce(source, '')), 1, 5) AS BIGINT) AS shift
  FROM aimed),
placed AS (
  SELECT doc_id, size, source_size, target, step, shift, row_number() OVER (
    PARTITION BY steps.source ORDER BY size,
      CAST('0x' || substr(md5('mix:{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)) AS place
  FROM rows JOIN steps ON rows.source IS NOT DISTINCT FROM steps.source)
SELECT doc_id, size, source_size, target,
  size * (((shift + step * place) >> {_UNIT_BITS}) - ((shift + step * (place - 1)) >> {_UNIT_BITS})) AS taken
FROM placed"""
