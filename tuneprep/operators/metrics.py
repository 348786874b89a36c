"""Perplexity and stage counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tuneprep.functions.hashing import content_hash
from tuneprep.functions.text import has_text, normalize_text
from tuneprep.runtime import SPLIT, column, names

# Fixed value: from this mean loss on, perplexity is reported as infinite.
PERPLEXITY_LIMIT = 20.0


def perplexity(df: DataFrame, loss_col: str, by=(), weight_col: str | None = None) -> DataFrame:
    """``exp`` of the mean loss, infinite from a mean of 20; optionally weighted (scored tokens)."""
    loss = column(loss_col)
    if weight_col is None:
        mean = F.avg(loss)
    else:
        mean = F.sum(loss * column(weight_col)) / F.sum(column(weight_col))
    return (
        df.groupBy(*[column(c) for c in names(by)])
        .agg(mean.alias("mean_loss"))
        .withColumn(
            "perplexity",
            F.when(F.col("mean_loss").isNull(), F.lit(None).cast("double"))
            .when(F.col("mean_loss") < PERPLEXITY_LIMIT, F.exp("mean_loss"))
            .otherwise(F.lit(float("inf"))),
        )
    )


def prep_report(
    df: DataFrame, cols, dedup_key: str | None = None, pair: bool = False, within=SPLIT
) -> DataFrame:
    """Rows in, dropped by reason, and left, per split, for mapped but not yet normalised rows.

    Two small aggregations, exact whatever tasks are repeated. Rows are first folded by content
    hash, map-side, so neither a text nor an outcome that fills a third of the table is a hot spot.
    """
    texts = names(cols)
    group = [column(c) for c in names(within or []) if c in df.columns]
    missing = F.lit(False)
    for name in texts:
        missing = missing | ~F.coalesce(has_text(column(name)), F.lit(False))
    if pair:
        chosen, rejected = (normalize_text(column(name)) for name in texts)
        degenerate = chosen == rejected
    else:
        degenerate = F.lit(False)
    outcome = F.when(missing, "missing").when(degenerate, "degenerate").otherwise("kept")
    staged = df.select(
        *group,
        outcome.alias("_tp_outcome"),
        *([] if dedup_key is None else [column(dedup_key).alias("_tp_key")]),
    )
    fold = [*group, F.col("_tp_outcome")]
    if dedup_key is not None:
        staged = staged.withColumn(
            "_tp_content",
            F.when(F.col("_tp_outcome") == "kept", content_hash(normalize_text(F.col("_tp_key")))),
        )
        fold.append(F.col("_tp_content"))
    folded = staged.groupBy(*fold).agg(F.count(F.lit(1)).alias("_tp_rows"))

    def total(name):
        return F.coalesce(F.sum(F.when(F.col("_tp_outcome") == name, F.col("_tp_rows"))), F.lit(0))

    kept = F.col("_tp_outcome") == "kept"
    copies = F.when(kept, F.col("_tp_rows") - 1) if dedup_key is not None else F.lit(0)
    return (
        folded.groupBy(*group)
        .agg(
            F.sum("_tp_rows").alias("rows_in"),
            total("missing").alias("dropped_missing"),
            total("degenerate").alias("dropped_degenerate"),
            F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("dropped_duplicates"),
        )
        .withColumn(
            "rows_out",
            F.col("rows_in")
            - F.col("dropped_missing")
            - F.col("dropped_degenerate")
            - F.col("dropped_duplicates"),
        )
    )


class PrepCounts:
    """Counts of a preparation, taken on the very plans that do the work: no pass of their own.

    Each of ``rows_in``, ``cleaned`` and ``rows_out`` is observed behind the last shuffle of its job,
    where a task counts once however often it was tried.
    """

    def __init__(self, splits: Sequence[str], split_col: str = SPLIT):
        self.splits, self.split_col = list(splits), split_col
        self._seen: dict[str, Observation] = {}

    def _observe(self, df: DataFrame, stage: str, tests: Mapping[str, Column]) -> DataFrame:
        own = self._seen[stage] = Observation()
        metrics = [
            F.count_if((column(self.split_col) == split) & F.coalesce(test, F.lit(False))).alias(f"{name}_{i}")
            for i, split in enumerate(self.splits)
            for name, test in tests.items()
        ]
        return df.observe(own, *metrics)

    def rows_in(self, df: DataFrame, texts: Sequence[str]) -> DataFrame:
        """Mapped rows, before any is dropped."""
        whole = F.lit(True)
        for name in texts:
            whole = whole & F.coalesce(has_text(column(name)), F.lit(False))
        return self._observe(df, "in", {"rows_in": F.lit(True), "dropped_missing": ~whole})

    def cleaned(self, df: DataFrame, pair: Sequence[str] = ()) -> DataFrame:
        """Normalised rows; of a pair those with equal sides are about to be dropped."""
        if not pair:
            return df
        return self._observe(df, "clean", {"dropped_degenerate": column(pair[0]) == column(pair[1])})

    def rows_out(self, df: DataFrame) -> DataFrame:
        """The rows that are written."""
        return self._observe(df, "out", {"rows_out": F.lit(True)})

    def by_split(self) -> dict[str, dict[str, int]]:
        """Rows in, dropped by reason, and written, per split; asked once everything is written."""
        found = {name: value for own in self._seen.values() for name, value in own.get.items()}
        out = {}
        for i, split in enumerate(self.splits):
            own = {
                name: found.get(f"{name}_{i}", 0)
                for name in ("rows_in", "dropped_missing", "dropped_degenerate", "rows_out")
            }
            dropped = own["dropped_missing"] + own["dropped_degenerate"]
            own["dropped_duplicates"] = own["rows_in"] - dropped - own["rows_out"]
            out[split] = own
        return out


class Written(list):
    """The splits a preparation wrote; ``counts`` has the rows of each by outcome."""

    def __init__(self, splits: Sequence[str] = (), counts: Mapping[str, dict] | None = None):
        super().__init__(splits)
        self.counts = dict(counts or {})


def split_sizes(df: DataFrame, split_col: str = SPLIT) -> DataFrame:
    return df.groupBy(column(split_col)).agg(F.count(F.lit(1)).alias("n_rows"))
