"""URL filters: rules first, then naive Bayes over the words that host and path are made of.

Names in hosts are concatenated words. A unigram model, counted over the visible text of all pages
and the names in urls, splits them by Viterbi into the most probable words. The urls that a rule
decides are the training set of a multinomial naive Bayes model over those words, which decides the
rest. Both models are of a size fixed by ``DICTIONARY_WORDS``, whatever the number of pages.
"""

from __future__ import annotations

import html
import math
import re
import string
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneprep.llm.common import fresh, prepare_workers, table
from tuneprep.runtime import column, materialize

ALLOW, BLOCK = "allow", "block"

#: (verdict, host, path): fits the host and its subdomains where the path starts like that.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)

#: Most frequent words that make up the unigram model; anything else is an unknown word.
DICTIONARY_WORDS = 100_000
#: Letters of the longest word the model can hold.
LONGEST_WORD = 32
SMOOTHING = 1.0

UNKNOWN, NUMBER = "?", "#"

_WORD = re.compile(r"[^\W\d_]+")
_PART = re.compile(r"[^\W\d_]+|\d+")
_INVISIBLE = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_WORDS_KEPT = 500_000
_CACHE = 200_000


# --- urls and rules -----------------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct ``rule, verdict`` of the longest rule that fits, null without one.

    Of equally long rules the one with the longer host wins, then the first given.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1])), reverse=True)
    for verdict, own, start in reversed(ordered):
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        value = F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


# --- word segmentation --------------------------------------------------------------------------


@dataclass
class Segmenter:
    """Most probable split of a run of letters into words of a unigram model."""

    counts: dict[str, int]
    total: int = 0
    longest: int = 1
    known: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        self.total = max(1, sum(self.counts.values()))
        self.longest = max(map(len, self.counts), default=1)
        logs = math.log10(self.total)
        self.logp = {word: math.log10(n) - logs for word, n in self.counts.items()}

    def unknown(self, size: int) -> float:
        """log10 of an unknown word: rarer than any known one, tenfold for every letter."""
        return -math.log10(self.total) - size

    def split(self, letters: str) -> list[str]:
        """Viterbi over the ends of words; of equal splits that with the longer last word."""
        if letters in self.known:
            return self.known[letters]
        logp, unknown = self.logp, [self.unknown(n) for n in range(self.longest + 1)]
        best, back = [0.0], [0]
        for end in range(1, len(letters) + 1):
            top, start = -math.inf, end - 1
            for at in range(max(0, end - self.longest), end):
                word = logp.get(letters[at:end])
                score = best[at] + (unknown[end - at] if word is None else word)
                if score > top:
                    top, start = score, at
            best.append(top)
            back.append(start)
        words, end = [], len(letters)
        while end:
            word = letters[back[end] : end]
            words.append(word if word in logp else UNKNOWN)
            end = back[end]
        words.reverse()
        if len(self.known) >= _CACHE:
            self.known.clear()
        self.known[letters] = words
        return words

    def tokens(self, text: str) -> list[str]:
        """Words of all runs of letters, in order; a run of digits is a number, whichever."""
        found: list[str] = []
        for part in _PART.findall(text.lower()):
            found += [NUMBER] if part[0].isdigit() or not part[0].isalpha() else self.split(part)
        return found


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of the visible text of pages and of the paths as they stand."""
    counts: Counter = Counter()

    def flush():
        words = [w for w in counts if len(w) <= LONGEST_WORD]
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())],
            ["word", "n"],
        )
        counts.clear()

    for batch in batches:
        for path, page in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            counts.update(_WORD.findall(path.lower()))
            if page:
                counts.update(_WORD.findall(html.unescape(_INVISIBLE.sub(" ", page)).lower()))
            if len(counts) > _WORDS_KEPT:
                yield from flush()
    yield from flush()


def unigrams(urls: DataFrame, words: int = DICTIONARY_WORDS) -> dict[str, int]:
    """Counts of the most frequent words, ``words`` of them at most.

    ``urls`` has ``host``, ``path`` and ``html``. Texts and paths count on every page; the names in a
    host count once for each host, so that a name does not become a word by having many pages. The
    least count is the smallest sixteenth of a power of two that leaves no more words: it is found on
    a histogram of some hundred rows, and only the words chosen are collected.
    """
    texts = urls.select("path", "html").mapInArrow(_count_words, "word string, n long")
    names = (
        urls.select("host").distinct().select("host", F.lit(None).cast("string").alias("html"))
    ).mapInArrow(_count_words, "word string, n long")
    counted = materialize(
        texts.union(names)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .withColumn("band", F.floor(F.log2("n") * 16).cast("int")),
        "unigrams",
    )
    left, least = words, 0
    for row in sorted(counted.groupBy("band").count().collect(), reverse=True):
        left -= row["count"]
        if left < 0:
            least = row.band + 1
            break
    top = counted.filter(F.col("band") >= least).collect()
    return {row.word: row.n for row in sorted(top)}


# --- naive Bayes --------------------------------------------------------------------------------


def url_tokens(segmenter: Segmenter, host: str, path: str) -> list[str]:
    """Words of host and path, told apart."""
    return [f"h:{w}" for w in segmenter.tokens(host)] + [f"p:{w}" for w in segmenter.tokens(path)]


@dataclass
class Bayes:
    """log10 of how much likelier each token is in blocked urls; classes count as equally likely."""

    ratios: dict[str, float]

    @classmethod
    def fit(cls, counts: dict[str, dict[str, int]], smoothing: float = SMOOTHING) -> Bayes:
        """From the counts of tokens by verdict. With one verdict only nothing can be learned."""
        if any(not counts.get(verdict) for verdict in (ALLOW, BLOCK)):
            return cls({})
        tokens = counts[ALLOW].keys() | counts[BLOCK].keys()
        logs = {}
        for verdict in (ALLOW, BLOCK):
            total = sum(counts[verdict].values()) + smoothing * len(tokens)
            logs[verdict] = {
                t: math.log10((counts[verdict].get(t, 0) + smoothing) / total) for t in tokens
            }
        return cls({t: logs[BLOCK][t] - logs[ALLOW][t] for t in tokens})

    def score(self, tokens: Sequence[str]) -> float:
        """Positive: rather to be blocked. Tokens never seen in training say nothing."""
        return math.fsum(self.ratios.get(t, 0.0) for t in tokens)


def _count_tokens(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for host, path, verdict in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                counts.update((verdict, t) for t in url_tokens(shared.value, host, path))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([v for v, _ in counts], pa.string()),
                pa.array([t for _, t in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            ["verdict", "token", "n"],
        )

    return count


def train(urls: DataFrame, shared) -> Bayes:
    """Fit on all urls that a rule decides; two fields of dictionary words bound what is collected."""
    found = (
        urls.filter("verdict is not null")
        .select("host", "path", "verdict")
        .mapInArrow(_count_tokens(shared), "verdict string, token string, n long")
        .groupBy("verdict", "token")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts: dict[str, dict] = {}
    for row in found:
        counts.setdefault(row.verdict, {})[row.token] = row.n
    return Bayes.fit(counts)


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str | None = "html",
    rules: Sequence[tuple[str, str, str]] = RULES,
    words: int = DICTIONARY_WORDS,
) -> DataFrame:
    """One row per page: id, ``host, path, rule, verdict, score, host_words``.

    ``verdict`` is that of the longest rule that fits, else that of the model: ``block`` if its score
    (log10 odds, also given where a rule decides) is above 0. A null url and one without ``://`` have
    an empty host and path, which no rule fits and which score 0, as does everything if the rules
    decide for one verdict only. Urls and texts of any length are read whole. Ids may be null or
    repeat, repeated rows are judged alike (and each counts in training); other columns are not
    read; an empty table gives no rows.
    """
    spark = pages.sparkSession
    prepare_workers(spark)
    host, path = host_of(column(url_col)), path_of(column(url_col))
    page = F.lit(None).cast("string") if html_col is None else column(html_col)
    own = pages.select(column(id_col).alias("id"), host.alias("host"), path.alias("path"), page.alias("html"))
    segmenter = spark.sparkContext.broadcast(Segmenter(unigrams(own, words)))
    narrow = own.drop("html")
    decided = matching_rule(F.col("host"), F.col("path"), rules)
    urls = materialize(
        narrow.withColumn("decided", decided).select(
            "id", "host", "path", F.col("decided.rule").alias("rule"), F.col("decided.verdict").alias("verdict")
        ),
        "urls",
    )
    model = spark.sparkContext.broadcast(train(urls, segmenter))

    @F.arrow_udf("score double, host_words string")
    def scored(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        scores, names = [], []
        for own_host, own_path in zip(hosts.to_pylist(), paths.to_pylist(), strict=True):
            tokens = url_tokens(segmenter.value, own_host, own_path)
            scores.append(model.value.score(tokens))
            names.append(" ".join(t[2:] for t in tokens if t.startswith("h:")))
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(names, pa.string())], ["score", "host_words"]
        )

    id_name = fresh("id")
    method = F.when(F.col("found.score") > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return (
        urls.withColumnRenamed("id", id_name)
        .withColumn("found", scored("host", "path"))
        .select(
            column(id_name).alias(id_col),
            "host",
            "path",
            "rule",
            F.coalesce("verdict", method).alias("verdict"),
            F.col("found.score").alias("score"),
            F.col("found.host_words").alias("host_words"),
        )
    )


def op12_urls(spark, sf_dir):
    """Verdict on the url of every page."""
    return judge(table(spark, sf_dir, "pages"))
