"""Collocations by weighted acyclic automata: count transducers of sorted n-grams, united by range.

Three passes over the texts, each with a bounded worker and a narrow shuffle:

1. words are counted per language; the frequent ones go into a bit filter of fixed size;
2. pairs of such words are counted by hash; the frequent ones go into a second filter. A filter lets
   too many through, never too few: the exact counts that follow drop what should not have passed;
3. every shard (a stretch of some million tokens of one language) sorts the n-grams that can still
   be frequent, builds count transducers from them one by one, one transducer per prefix range, and
   ships these. The transducers of a range are united, their weights summed.

Then every range asks the others for the counts of the parts of its phrases, each part once however
many phrases have it; the answers are a transducer again, with which the phrases are composed.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tuneprep.llm.common import as_bytes, prepare_workers, table
from tuneprep.runtime import column, materialize

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
NO_LANG = "und"
#: A phrase goes if a longer one has at least this many per cent of its occurrences.
CONTAINED_PERCENT = 100

#: Bits of the filters of frequent words and pairs: 8 and 16 MB, whatever the data.
WORD_BITS, PAIR_BITS = 26, 27
#: Tokens that a worker counts at a time, and n-gram occurrences of one prefix range.
SHARD_TOKENS = 2_000_000
RANGE_ROWS = 1_000_000
#: Words that decide the range of an n-gram: what follows a hot word or pair spreads over the ranges.
PREFIX_WORDS = 3

_TEXT_BLOCK = 1 << 20
_WORDS_KEPT = 500_000
_SALTS = 64
_BREAK = b"\xff"
# What ends a piece. No byte of UTF-8 is FF.
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_TOKENS = bytes(0xFF if i in _PIECE_ENDS else 0x20 if i == 0x09 else i for i in range(256))


# --- texts to tokens ----------------------------------------------------------------------------


def token_blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text and a break between pieces, in blocks of about a megabyte."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _TEXT_BLOCK)
        while end < len(text) and text[end] not in b" \t" and text[end] not in _PIECE_ENDS:
            end += 1
        block = text[at:end].lower().translate(_TO_TOKENS)
        # Only blanks are left of what bytes.split() takes for white space.
        yield block.replace(_BREAK, b" \xff ").split()
        at = end


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    return zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, part, n`` of the words of a stretch of texts; the empty part counts all of them."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush():
        for lang, words in counts.items():
            words.pop(_BREAK, None)
            total = sum(words.values())
            if not total:
                continue
            parts = [b"", *words]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(parts), pa.string()),
                    pa.array(parts, pa.binary()).cast(pa.string()),
                    pa.array([total, *words.values()], pa.int64()),
                ],
                ["lang", "part", "n"],
            )
        counts.clear()

    for batch in batches:
        for lang, text in _by_language(batch):
            for block in token_blocks(text):
                counts[lang].update(block)
            if sum(map(len, counts.values())) > _WORDS_KEPT:
                yield from flush()
    yield from flush()


# --- filters of fixed size ----------------------------------------------------------------------


def bit_filter(hashed: DataFrame, bits: int) -> np.ndarray:
    """A bit for every hash modulo ``2**bits``, as bytes; at most ``2**bits / 8`` of them travel."""
    place = column(hashed.columns[0]).bitwiseAND(F.lit((1 << bits) - 1))
    found = (
        hashed.select(place.alias("at"))
        .groupBy(F.shiftright("at", 15).alias("block"))
        .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << 15) - 1))).alias("bitmap"))
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in found.toLocalIterator():
        part = np.frombuffer(bytes(row.bitmap), np.uint8)[: 1 << 12]
        out[row.block << 12 : (row.block << 12) + len(part)] = part[: len(out)]
    return out


def _passes(filter_bytes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = (len(filter_bytes) << 3) - 1
    at = (hashes & np.uint64(bits)).astype(np.int64)
    return (filter_bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def word_hash(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def language_seed(lang: str) -> int:
    """As Spark's ``xxhash64(lang, word)`` chains its columns."""
    return xxhash.xxh64_intdigest(lang.encode(), 42)


def _pair_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) ^ (right + np.uint64(0xC2B2AE3D27D4EB4F))
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ mixed >> np.uint64(32)


class _Shards:
    """Stretches of token ids of one language, from texts of any length, within bounded memory.

    Ids of words that pass the filter count from 1; 0 is any other word, a break or the end of a
    text. ``take`` is called with a language, its words and hashes, a stretch, and how many of its
    positions n-grams may start at: the rest is seen again at the head of the next stretch.
    """

    def __init__(self, words_filter: np.ndarray, overlap: int, take):
        self.words_filter, self.overlap, self.take = words_filter, overlap, take
        self.pending: dict[str, list[bytes]] = {}
        self.waiting = 0
        self.reset()

    def reset(self):
        self.ids: dict[str, dict] = {}
        self.words: dict[str, list] = {}
        self.hashes: dict[str, list] = {}
        self.parts: dict[str, list] = defaultdict(list)
        self.held = 0

    def _numbers(self, lang: str, block: list[bytes]) -> np.ndarray:
        known = self.ids.setdefault(lang, {_BREAK: 0})
        words = self.words.setdefault(lang, [_BREAK])
        hashes = self.hashes.setdefault(lang, [0])
        new = [w for w in set(block) if w not in known]
        if new:
            seed = language_seed(lang)
            found = np.array([word_hash(w, seed) for w in new], np.uint64)
            for word, own, ok in zip(new, found.tolist(), _passes(self.words_filter, found).tolist(), strict=True):
                known[word] = len(words) if ok else 0
                if ok:
                    words.append(word)
                    hashes.append(own)
        return np.fromiter(map(known.__getitem__, block), np.int64, len(block))

    def add(self, lang: str, text: bytes):
        self.pending.setdefault(lang, []).append(text)
        self.waiting += len(text)
        if self.waiting >= _TEXT_BLOCK:
            yield from self._drain()

    def finish(self):
        yield from self._drain()
        yield from self.flush()

    def _drain(self):
        """Short texts are read together, each ended by a break."""
        pending, self.pending, self.waiting = self.pending, {}, 0
        for lang, texts in pending.items():
            for block in token_blocks(b"\n".join([*texts, b""])):
                numbers = self._numbers(lang, block)
                self.parts[lang].append(numbers)
                self.held += len(numbers)
                if self.held >= SHARD_TOKENS:  # maybe mid-text: the last words are seen again
                    yield from self.flush(lang)

    def flush(self, unfinished: str | None = None):
        carried = []
        for lang, parts in self.parts.items():
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            starts = len(ids)
            if lang == unfinished:
                starts = max(0, len(ids) - self.overlap)
                carried = [self.words[lang][i] for i in ids[starts:].tolist()]
            if starts:
                hashes = np.array(self.hashes[lang], np.uint64)
                yield from self.take(lang, self.words[lang], hashes, ids, starts)
        self.reset()
        if carried:
            self.parts[unfinished].append(self._numbers(unfinished, carried))
            self.held = len(carried)


def _pair_counter(words_filter):
    """``hash, n`` of pairs of neighbouring words that both pass the filter."""

    def take(lang, words, hashes, ids, starts):
        first, second = ids[:-1][:starts], ids[1:][:starts]
        own = hashes[ids]
        good = np.flatnonzero((first > 0) & (second > 0))
        found, n = np.unique(_pair_hashes(own[good], own[good + 1]), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"]
        )

    def count(batches):
        shards = _Shards(words_filter.value, 1, take)
        for batch in batches:
            for lang, text in _by_language(batch):
                yield from shards.add(lang, text)
        yield from shards.finish()

    return count


# --- weighted acyclic automata ------------------------------------------------------------------


class Transducer:
    """A minimal acyclic automaton over words; the weight of an accepting state is a count.

    State ``i`` has ``weights[i]`` (0 if it accepts nothing) and ``arcs[i]``, label to target in the
    order of labels. The last state is the initial one.
    """

    def __init__(self, weights: list[int], arcs: list[dict[bytes, int]]):
        self.weights, self.arcs = weights, arcs

    @classmethod
    def from_sorted(cls, items: Iterable[tuple[Sequence[bytes], int]]) -> Transducer:
        """Built incrementally from keys in ascending order, each once.

        Only the path of the last key is open. What a new key leaves behind is closed: a state equal
        to one already there, weights included, becomes that one.
        """
        weights: list[int] = []
        arcs: list[dict] = []
        registry: dict = {}

        def close(state):
            weight, out = state
            signature = (weight, tuple(out.items()))
            if signature not in registry:
                registry[signature] = len(weights)
                weights.append(weight)
                arcs.append(out)
            return registry[signature]

        path, last = [[0, {}]], ()
        for key, count in items:
            shared = 0
            for a, b in zip(last, key, strict=False):
                if a != b:
                    break
                shared += 1
            while len(path) > shared + 1:
                done = path.pop()
                path[-1][1][last[len(path) - 1]] = close(done)
            for _ in key[shared:]:
                path.append([0, {}])
            path[-1][0] = count
            last = key
        while len(path) > 1:
            done = path.pop()
            path[-1][1][last[len(path) - 1]] = close(done)
        close(path[0]) if not weights else (weights.append(path[0][0]), arcs.append(path[0][1]))
        return cls(weights, arcs)

    def step(self, state: int, word: bytes) -> int | None:
        return self.arcs[state].get(word)

    def prefix_counts(self, key: Sequence[bytes]) -> list[int]:
        """Weights along the path of ``key``; 0 from where there is none."""
        state: int | None = len(self.weights) - 1
        out = []
        for word in key:
            state = None if state is None else self.arcs[state].get(word)
            out.append(0 if state is None else self.weights[state])
        return out

    def count(self, key: Sequence[bytes]) -> int:
        counts = self.prefix_counts(key)
        return counts[-1] if counts else self.weights[-1]

    def items(self) -> Iterator[tuple[tuple[bytes, ...], int]]:
        """Keys in ascending order with their counts."""
        yield from union_items([self])

    def to_bytes(self) -> bytes:
        words = sorted({w for out in self.arcs for w in out})
        place = {w: i for i, w in enumerate(words)}
        sizes = [len(w) for w in words]
        degrees = [len(out) for out in self.arcs]
        labels = [place[w] for out in self.arcs for w in out]
        targets = [t for out in self.arcs for t in out.values()]
        head = np.array([len(words), len(self.weights), len(labels)], "<i8").tobytes()
        numbers = [sizes, self.weights, degrees, labels, targets]
        return head + b"".join(np.array(x, "<i8").tobytes() for x in numbers) + b"".join(words)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        n_words, n_states, n_arcs = np.frombuffer(data, "<i8", 3).tolist()
        at, lists = 24, []
        for n in (n_words, n_states, n_states, n_arcs, n_arcs):
            lists.append(np.frombuffer(data, "<i8", n, at).tolist())
            at += 8 * n
        sizes, weights, degrees, labels, targets = lists
        words = []
        for size in sizes:
            words.append(data[at : at + size])
            at += size
        arcs, done = [], 0
        for degree in degrees:
            own = slice(done, done + degree)
            arcs.append({words[i]: t for i, t in zip(labels[own], targets[own], strict=True)})
            done += degree
        return cls(weights, arcs)


def union_items(parts: Sequence[Transducer]) -> Iterator[tuple[tuple[bytes, ...], int]]:
    """Keys of the union in ascending order; the weights of a key are summed.

    A state of the union is one state of each part that has the path to it.
    """

    def walk(states, key):
        weight = sum(part.weights[s] for part, s in states)
        if weight:
            yield key, weight
        if len(states) == 1:
            part, state = states[0]
            for word, target in part.arcs[state].items():
                yield from walk([(part, target)], (*key, word))
            return
        following = defaultdict(list)
        for part, state in states:
            for word, target in part.arcs[state].items():
                following[word].append((part, target))
        for word in sorted(following):
            yield from walk(following[word], (*key, word))

    if parts:
        yield from walk([(part, len(part.weights) - 1) for part in parts], ())


def shard_ngrams(
    words: list[bytes], hashes: np.ndarray, ids: np.ndarray, starts: int, pairs: np.ndarray, longest: int
) -> list[tuple[tuple[bytes, ...], int]]:
    """Sorted n-grams of 2 to ``longest`` words all of whose pairs pass the filter, with counts."""
    present = np.unique(ids)
    present = present[present > 0]
    ordered = sorted(present.tolist(), key=words.__getitem__)
    rank = np.zeros(len(words), np.int64)
    rank[ordered] = np.arange(1, len(ordered) + 1)
    label = rank[ids]
    names = [words[i] for i in ordered]
    own = hashes[ids]
    good = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    good = good[_passes(pairs, _pair_hashes(own[good], own[good + 1]))]
    linked = np.zeros(len(ids) + longest, bool)
    linked[good] = True
    at = good[good < starts]
    state, keys = label, [(name,) for name in names]
    keys.insert(0, ())
    found: list[tuple[tuple[bytes, ...], int]] = []
    for size in range(2, longest + 1):
        at = at[linked[at + size - 2]]
        if not len(at):
            break
        # A state is the place of its prefix in sorted order, so the next level comes out sorted.
        code, number, n = np.unique(
            state[at] * (len(names) + 1) + label[at + size - 1], return_inverse=True, return_counts=True
        )
        before, word = np.divmod(code, len(names) + 1)
        keys = [
            (*keys[b], names[w - 1]) for b, w in zip(before.tolist(), word.tolist(), strict=True)
        ]
        found.append(list(zip(keys, n.tolist(), strict=True)))
        state = np.zeros(len(ids), np.int64)
        state[at] = number
    return list(heapq.merge(*found))


def _range_of(lang: str, key: Sequence[bytes], ranges: int) -> int:
    return crc32(b" ".join(key[:PREFIX_WORDS]), crc32(lang.encode())) % ranges


def _transducer_builder(words_filter, pairs_filter, longest: int, ranges: int):
    """``lang, range, transducer``: the n-grams of each shard, cut into prefix ranges."""

    def take(lang, words, hashes, ids, starts):
        by_range = defaultdict(list)
        for key, n in shard_ngrams(words, hashes, ids, starts, pairs_filter.value, longest):
            by_range[_range_of(lang, key, ranges)].append((key, n))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(by_range), pa.string()),
                pa.array(list(by_range), pa.int32()),
                pa.array([Transducer.from_sorted(x).to_bytes() for x in by_range.values()], pa.binary()),
            ],
            ["lang", "range", "transducer"],
        )

    def build(batches):
        shards = _Shards(words_filter.value, longest - 1, take)
        for batch in batches:
            for lang, text in _by_language(batch):
                yield from shards.add(lang, text)
        yield from shards.finish()

    return build


def _uniter(min_count: int):
    def unite(own: pa.Table) -> pa.Table:
        """The n-grams of one range that are frequent once the shards' weights are summed."""
        rows = sorted(
            zip(own.column("lang").to_pylist(), own.column("transducer").to_pylist(), strict=True)
        )
        found = []
        for lang, group in groupby(rows, key=lambda row: row[0]):
            parts = [Transducer.from_bytes(data) for _, data in group]
            found += [(lang, b" ".join(key), n) for key, n in union_items(parts) if n >= min_count]
        number = own.column("range")[0].as_py()
        return pa.table(
            {
                "lang": pa.array([f[0] for f in found], pa.string()),
                "range": pa.array([number] * len(found), pa.int32()),
                "part": pa.array([f[1] for f in found], pa.binary()).cast(pa.string()),
                "n": pa.array([f[2] for f in found], pa.int64()),
            }
        )

    return unite


_SCORED = (
    "lang string, phrase string, a long, l long, r long, n long, score long, cut int, "
    "head_contained boolean, rest_contained boolean"
)


def best_cut(counts: Transducer, key: Sequence[bytes], total: int) -> tuple[int, int, int, int, int]:
    """(score, cut, a, l, r) of the cut with the lowest score, ties to the shortest first part."""
    heads = counts.prefix_counts(key)
    a = heads[-1]
    cuts = []
    for k in range(1, len(key)):
        left, right = heads[k - 1], counts.count(key[k:])
        cuts.append((1000 * a * total // (left * right), k, a, left, right))
    return min(cuts)


def _composer(percent: int):
    def compose(phrases: pa.Table, parts: pa.Table) -> pa.Table:
        """Scores of the phrases of one range, looked up in the transducer of their parts."""
        asked: dict[str, dict] = defaultdict(dict)
        answers = [parts.column(c).to_pylist() for c in ("lang", "part", "n")]
        for lang, part, n in zip(*answers, strict=True):
            asked[lang][tuple(part.encode().split(b" ")) if part else ()] = n
        own = [phrases.column(c).to_pylist() for c in ("own_lang", "phrase", "a")]
        by_lang = defaultdict(list)
        for lang, phrase, n in zip(*own, strict=True):
            key = tuple(phrase.encode().split(b" "))
            by_lang[lang].append((phrase, key))
            asked[lang][key] = n
        out = []
        for lang, group in by_lang.items():
            total = asked[lang].pop(())
            counts = Transducer.from_sorted(sorted(asked[lang].items()))
            for phrase, key in group:
                score, cut, a, left, right = best_cut(counts, key, total)
                head, rest = counts.count(key[:-1]), counts.count(key[1:])
                out.append(
                    (lang, phrase, a, left, right, total, score, cut,
                     100 * a >= percent * head, 100 * a >= percent * rest)
                )
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 5, pa.int32(), pa.bool_(), pa.bool_()]
        names = [field.split(" ")[0] for field in _SCORED.split(", ")]
        return pa.table(
            {name: pa.array([row[i] for row in out], kinds[i]) for i, name in enumerate(names)}
        )

    return compose


# --- the operator -------------------------------------------------------------------------------


def frequent_ngrams(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
) -> tuple[DataFrame, DataFrame]:
    """(words, phrases), stored: exact counts of all that occur ``min_count`` times in a language.

    ``words`` is ``lang, part, n`` and has the number of all words of the language under the empty
    part; ``phrases`` is ``lang, range, part, n`` with 2 to ``longest`` words, space-joined.
    """
    spark = docs.sparkSession
    prepare_workers(spark)
    texts = docs.select(
        F.coalesce(column(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"),
        column(text_col).alias("text"),
    ).filter(F.length("text") > 0)
    words = materialize(
        texts.mapInArrow(_count_words, "lang string, part string, n long")
        .groupBy("lang", "part")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("n") >= min_count) | (F.col("part") == "")),
        "words",
    )
    frequent = words.filter(F.col("part") != "").select(F.xxhash64("lang", "part"))
    words_filter = spark.sparkContext.broadcast(bit_filter(frequent, WORD_BITS))
    pairs = materialize(
        texts.mapInArrow(_pair_counter(words_filter), "hash long, n long")
        .groupBy("hash")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= min_count),
        "pairs",
    )
    pairs_filter = spark.sparkContext.broadcast(bit_filter(pairs.select("hash"), PAIR_BITS))
    occurrences = pairs.agg(F.sum("n")).first()[0] or 0
    ranges = max(1, math.ceil(occurrences * (longest - 1) / RANGE_ROWS))
    build = _transducer_builder(words_filter, pairs_filter, longest, ranges)
    phrases = materialize(
        texts.mapInArrow(build, "lang string, range int, transducer binary")
        .groupBy("range")
        .applyInArrow(_uniter(min_count), "lang string, range int, part string, n long"),
        "phrases",
    )
    return words, phrases


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    contained_percent: int = CONTAINED_PERCENT,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, cut``: the ``top`` phrases of each language.

    A phrase of 2 to ``longest`` words with ``a >= min_count`` occurrences within pieces scores
    ``floor(1000 a n / (l r))`` at its worst cut into parts with counts ``l`` and ``r``; ``n`` is the
    number of words of the language. A phrase goes if a longer one holds it and has at least
    ``contained_percent`` of its occurrences. Ranks follow (score desc, a desc, phrase).

    Null and empty texts have no words, a null language is ``und``; repeated rows count each time;
    texts of any length are read in blocks, words and n-grams crossing them included. Ids and other
    columns are not read. An empty table gives no rows.
    """
    words, phrases = frequent_ngrams(docs, lang_col, text_col, min_count, longest)
    split = F.split("part", " ")
    cuts = F.sequence(F.lit(1), F.size("w") - 1)
    parts = F.concat(
        F.array(F.lit("")),
        F.transform(cuts, lambda k: F.array_join(F.slice("w", 1, k), " ")),
        F.transform(cuts, lambda k: F.array_join(F.slice("w", k + 1, F.size("w")), " ")),
    )
    # A part is asked for once by each range, so that a very common word is no hot key.
    asked = (
        phrases.select("lang", "range", split.alias("w"))
        .select("lang", "range", F.explode(parts).alias("part"))
        .distinct()
    )
    known = words.union(phrases.select("lang", "part", "n"))
    answers = asked.join(known, ["lang", "part"])
    own = phrases.toDF("own_lang", "own_range", "phrase", "a")
    scored = materialize(
        own.groupBy("own_range")
        .cogroup(answers.groupBy("range"))
        .applyInArrow(_composer(contained_percent), _SCORED),
        "scored",
    )
    # A longer phrase that holds another often enough has one of one word less that does so too.
    longer = scored.select("lang", F.split("phrase", " ").alias("w"), "head_contained", "rest_contained")
    head = longer.filter("head_contained").select(
        "lang", F.array_join(F.slice("w", F.lit(1), F.size("w") - 1), " ").alias("phrase")
    )
    rest = longer.filter("rest_contained").select(
        "lang", F.array_join(F.slice("w", F.lit(2), F.size("w")), " ").alias("phrase")
    )
    kept = scored.join(head.union(rest).distinct(), ["lang", "phrase"], "left_anti")
    best = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # The first of each salted share first, so that a large language is not sorted by one task.
    share = F.pmod(F.xxhash64("phrase"), F.lit(_SALTS))
    firsts = (
        kept.withColumn("_share", share)
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*best)))
        .filter(F.col("rank") <= top)
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    return (
        firsts.withColumn("rank", rank)
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
    )


def op13_phrases(spark, sf_dir):
    """The first 2,000 collocations of each language."""
    return collocations(table(spark, sf_dir, "documents")).drop("cut")


OP13_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
sizes AS (SELECT unnest(range(1, {LONGEST + 1})) AS size),
ngrams AS (
  SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM listed, sizes WHERE len(w) >= size),
counted AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS part, count(*) AS f
  FROM ngrams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang),
candidates AS (
  SELECT lang, part AS phrase, string_split(part, ' ') AS w, size, f AS a FROM counted
  WHERE size > 1 AND f >= {MIN_COUNT}),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scores AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, n, k,
    1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN totals USING (lang)
  JOIN counted x ON x.lang = c.lang AND x.part = array_to_string(w[1:k], ' ')
  JOIN counted y ON y.lang = c.lang AND y.part = array_to_string(w[k + 1:len(w)], ' ')),
lowest AS (
  SELECT * FROM scores
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM lowest c WHERE NOT EXISTS (
    SELECT 1 FROM candidates b WHERE b.lang = c.lang AND length(b.phrase) > length(c.phrase)
      AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')
      AND 100 * b.a >= {CONTAINED_PERCENT} * c.a)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked WHERE rank <= {TOP}"""
