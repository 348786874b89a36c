"""Language of a text: the family first, then one-versus-one linear SVMs within the family.

Features are hashed counts of letter 1- to 3-grams over the whole text, square-rooted and scaled to
length one. Only text is an input of a prediction. The classifiers are fitted on a bounded sample of
labelled rows (``sample_rows`` in all, spread evenly over the languages, at least one row for each).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tuneprep.llm.common import fresh, id_remainder, prepare_workers, table
from tuneprep.runtime import column

UNDETERMINED = "und"
FOLDS = 5
_SHARES = 64
SAMPLE_ROWS = 3000
SLOTS = 1 << 13

#: Language families by ISO 639 code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "fy", "is", "lb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "indo-aryan": ("bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"),
    "uralic": ("et", "fi", "hu"),
    "turkic": ("az", "kk", "ky", "tr", "tt", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "iranian": ("fa", "ku", "ps", "tg"),
    "malayo-polynesian": ("id", "jv", "ms", "tl"),
}


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(text: str) -> np.ndarray | None:
    """Unit vector of a text, or None if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, 32)
    codes = codes[letter | np.roll(letter, 1)]  # runs of other characters count once
    codes = np.concatenate(([32], codes, [32])).astype(np.uint32)
    mixed = codes * np.uint32(0x9E3779B1)
    two = (mixed[:-1] ^ (mixed[1:] >> np.uint32(7))) * np.uint32(0x85EBCA6B)
    three = (two[:-1] ^ (mixed[2:] >> np.uint32(11))) * np.uint32(0xC2B2AE35)
    shift = np.uint32(32 - (SLOTS.bit_length() - 1))
    counts = np.zeros(SLOTS, np.int64)
    for grams in (mixed, two, three):
        counts += np.bincount(grams >> shift, minlength=SLOTS)
    x = np.sqrt(counts).astype(np.float32)
    return x / np.sqrt((x * x).sum())


@dataclass
class Model:
    """Families, their languages and one weight column per classifier."""

    families: dict[str, list[str]] = field(default_factory=dict)
    mean: np.ndarray | None = None
    family_weights: np.ndarray | None = None
    pair_weights: dict[str, np.ndarray] = field(default_factory=dict)

    def predict(self, text: str | None) -> tuple[str, float]:
        x = None if text is None or not self.families else features(text)
        if x is None:
            return UNDETERMINED, 0.0
        x = np.append(x - self.mean, np.float32(1))
        names = list(self.families)
        score, family = 1.0, names[0]
        if len(names) > 1:
            chance = _logistic(x @ self.family_weights)
            best = int(np.argmax(chance))
            family, score = names[best], float(chance[best])
        languages = self.families[family]
        if len(languages) == 1:
            return languages[0], score
        chance = _logistic(x @ self.pair_weights[family])
        votes = np.zeros(len(languages))
        for p, (i, j) in zip(chance, combinations(range(len(languages)), 2), strict=True):
            votes[i] += p
            votes[j] += 1 - p
        best = int(np.argmax(votes))
        return languages[best], score * float(votes[best]) / (len(languages) - 1)


def _logistic(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4.0 * np.clip(margins, -20, 20)))


def _fit_svm(x: np.ndarray, sides: np.ndarray, penalty: float = 1e-3, steps: int = 150):
    """Weights of linear SVMs (squared hinge), one column each; sides are 1 and -1.

    Accelerated gradient steps; both sides of a classifier weigh the same.
    """
    positive = (sides > 0).mean(axis=0)
    weight = np.where(sides > 0, 0.5 / positive, 0.5 / (1 - positive)) / len(x)
    step = 1 / (2 * (weight.sum(axis=0) * 2).max() + penalty)
    w = np.zeros((x.shape[1], sides.shape[1]), np.float32)
    ahead = w
    for k in range(steps):
        slack = np.maximum(0, 1 - sides * (x @ ahead))
        gradient = penalty * ahead - 2 * (x.T @ (weight * slack * sides).astype(np.float32))
        new = (ahead - step * gradient).astype(np.float32)
        ahead = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w


def fit(rows: list[tuple[str, np.ndarray]], families: Mapping[str, tuple] = FAMILIES) -> Model:
    """Train on (language, feature vector) pairs."""
    if not rows:
        return Model()
    home = {lang: family for family, members in families.items() for lang in members}
    labels = np.array([lang for lang, _ in rows], dtype=object)
    x = np.stack([v for _, v in rows])
    mean = x.mean(axis=0)
    x = np.hstack([x - mean, np.ones((len(x), 1), np.float32)])
    grouped: dict[str, list[str]] = {}
    for lang in sorted(set(labels)):
        grouped.setdefault(home.get(lang, f"={lang}"), []).append(lang)
    model = Model(grouped, mean)
    own = np.array([home.get(lang, f"={lang}") for lang in labels], dtype=object)
    if len(grouped) > 1:
        model.family_weights = _fit_svm(
            x, np.stack([np.where(own == f, 1.0, -1.0) for f in grouped], axis=1)
        )
    for family, members in grouped.items():
        columns = []
        for one, other in combinations(members, 2):
            of_pair = (labels == one) | (labels == other)
            side = np.where(labels[of_pair] == one, 1.0, -1.0)[:, None]
            columns.append(_fit_svm(x[of_pair], side)[:, 0])
        if columns:
            model.pair_weights[family] = np.stack(columns, axis=1)
    return model


def _sample_features(batches):
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        found = [(place, lang, features(t)) for place, lang, t in zip(*columns, strict=True)]
        found = [row for row in found if row[2] is not None]
        drawn, found = [row[0] for row in found], [row[1:] for row in found]
        places = [np.flatnonzero(x).astype("<u2") for _, x in found]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(drawn, pa.int64()),
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([p.tobytes() for p in places], pa.binary()),
                pa.array(
                    [x[p].tobytes() for (_, x), p in zip(found, places, strict=True)], pa.binary()
                ),
            ],
            ["drawn", "lang", "places", "amounts"],
        )


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
    folds: int = FOLDS,
    families: Mapping[str, tuple] = FAMILIES,
) -> Model:
    """Fit on rows with a language whose id is not held out (crc32 of the id mod ``folds`` is not 0).

    The rows are those with the smallest hash of their id in each language, at most ``sample_rows``
    in all (one a language, should there be more languages than that). Ids decide first, on narrow
    columns, with a limit in each task before any row moves; only the texts chosen are then read.
    """
    prepare_workers(docs.sparkSession)
    learnable = docs.filter(
        (id_remainder(column(id_col), folds) != 0)
        & column(lang_col).isNotNull()
        & column(text_col).isNotNull()
    )
    narrow = learnable.select(column(lang_col).alias("_lang"), column(id_col).alias("_id"))
    languages = narrow.agg(F.count_distinct("_lang")).first()[0]
    if not languages:
        return Model()
    quota = max(1, sample_rows // languages)
    # The first of each salted share, then the first of those: no task ranks a whole language.
    by_hash = [F.xxhash64("_id"), F.col("_id")]
    share = F.pmod(F.xxhash64("_id", F.lit(1)), F.lit(_SHARES))
    chosen = (
        narrow.withColumn("_share", share)
        .withColumn("_place", F.row_number().over(Window.partitionBy("_lang", "_share").orderBy(*by_hash)))
        .filter(F.col("_place") <= quota)
        .withColumn("_place", F.row_number().over(Window.partitionBy("_lang").orderBy(*by_hash)))
        .filter(F.col("_place") <= quota)
        .select("_id")
        .distinct()
    )
    sample = (
        learnable.join(F.broadcast(chosen), column(id_col) == F.col("_id"), "left_semi")
        .select(
            F.xxhash64(column(id_col), column(text_col)).alias("drawn"),
            column(lang_col).alias("lang"),
            column(text_col).alias("text"),
        )
        .mapInArrow(_sample_features, "drawn long, lang string, places binary, amounts binary")
        .orderBy("drawn", "lang")  # repeated ids may be more rows than the bound
        .limit(max(sample_rows, languages))
        .drop("drawn")
    )
    rows = []
    for row in sorted(sample.collect()):
        x = np.zeros(SLOTS, np.float32)
        x[np.frombuffer(row.places, "<u2")] = np.frombuffer(row.amounts, np.float32)
        rows.append((row.lang, x))
    return fit(rows, families)


def predict(docs: DataFrame, text: Column, model: Model) -> Column:
    """Struct of ``lang_pred`` and ``score``; null texts and texts without a letter are ``und``, 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def language(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays(
            [
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
            ],
            ["lang_pred", "score"],
        )

    return language(text)


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    **training,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``.

    A null id counts as held out. Null and empty texts, and texts without a letter, are ``und``; so
    is everything if no row can be learned from. Ties go to the first family and language in code
    order. Repeated rows are predicted alike; other columns are not read.
    """
    model = train(docs, id_col, text_col, lang_col, **training)
    guess = fresh("guess")
    return docs.select(
        column(id_col).alias(id_col),
        (id_remainder(column(id_col), training.get("folds", FOLDS)) == 0).alias("held_out"),
        predict(docs, column(text_col), model).alias(guess),
    ).select(column(id_col), "held_out", f"{guess}.lang_pred", f"{guess}.score")


def _has_letter(text: Column) -> Column:
    @F.arrow_udf("boolean")
    def letter(texts: pa.Array) -> pa.Array:
        return pa.array([any(map(str.isalpha, t.as_py() or "")) for t in texts], pa.bool_())

    return letter(text)


def drop_undetermined(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", **training):
    """``docs`` without the rows whose text is null or has no letter; ``lang_col`` is the predicted language.

    If no row can be learned from, the same rows go and ``lang_col`` stays as it is.
    """
    model = train(docs, id_col, text_col, lang_col, **training)
    if not model.families:
        return docs.filter(_has_letter(column(text_col)))
    guess = fresh("guess")
    found = docs.withColumn(guess, predict(docs, column(text_col), model))
    return (
        found.filter(F.col(f"{guess}.score") > 0)  # a label may itself be ``und``
        .withColumn(lang_col, F.col(f"{guess}.lang_pred"))
        .drop(guess)
    )


def op10_langid(spark, sf_dir):
    """Language of every document."""
    return identify(table(spark, sf_dir, "documents"))
