"""Language-model scores of all documents by a weighted backoff automaton.

The model is an n-gram model over words with Dirichlet smoothing: with counts c of the training
tokens, P(w | h) = (c(hw) + m P(w | h')) / (c(h) + m), where h' is h without its first word and the
last P is that of the base, (c(w) + 0.1) / (N + 0.1 (V + 1)). As an automaton: every context h that
occurs is a state, every n-gram that occurs is an arc with its probability, and a failure arc with
weight m / (c(h) + m) leads from h to h'. A text is read once from left to right, a state carried from
token to token: failure arcs lead down to a state with an arc for the token, that arc leads to the
next state, and the log-probabilities of all arcs taken add up.

Neither the vocabulary nor the n-grams fit a broadcast, so the automaton stays distributed. The
documents become chunks of token numbers, at most ``CHUNK`` tokens each. A chunk sends the distinct
n-grams it has, once each with its own counts and packed by ranges of their hash, to be summed; the
sums come back in the same order, so they need no keys, less what the chunk counted itself. Then the states,
arcs and failure arcs that the texts of the chunk can meet are built, and its texts are walked.
Frequent n-grams are one entry per chunk, never a hot key.

N-grams are known by 64-bit hashes. With V n-grams the chance that any two collide is about
V**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tuneprep.llm.common import as_bytes, id_remainder, prepare_workers, shuffle_files_freed, table
from tuneprep.runtime import column, materialize

ORDER = 3
STRENGTH = 100.0
FOLDS = 10
#: Hash ranges are at least so many, and as many more as keep their n-grams of one order, each counted
#: once per chunk, at about ``BUCKET_GRAMS``.
BUCKETS = 128
BUCKET_GRAMS = 1 << 21
CHUNK = 1 << 19
#: Stretches of a chunk walked side by side.
LANES = 4096

_END = b"\n"  # no word has white space
_EXTRA = 0.1


def _pack(values: np.ndarray) -> bytes:
    """Bytes of the numbers by significance, so that leading zeros stand together and compress."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unpack(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts in 32 bits where they fit; the first byte tells."""
    small = counts.max(initial=0) < 1 << 32
    return bytes([int(small)]) + _pack(counts.astype(np.uint32 if small else np.uint64))


def _unpack_counts(data: bytes) -> np.ndarray:
    return _unpack(data[1:], np.uint32 if data[0] else np.uint64).astype(np.int64)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ (b + np.uint64(0x9E3779B97F4A7C15) + (a << np.uint64(6)) + (a >> np.uint64(2))))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Some documents as numbers of their own distinct words; number 0 is the end of a text."""

    def __init__(self, hashes: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, held: np.ndarray):
        self.hashes, self.tokens, self.lengths, self.held = hashes, tokens, lengths, held
        self.starts = np.cumsum(lengths) - lengths

    def grams(self, order: int) -> Iterator[np.ndarray]:
        """Hash of the k-gram that ends at each token, k = 1 .. order; a text follows upon ends."""
        at = self.hashes[self.tokens]
        place = np.arange(len(self.tokens)) - np.repeat(self.starts, self.lengths)
        end, own = self.hashes[0], at
        yield own
        for k in range(1, order):
            own = _mix(own, np.where(place >= k, np.roll(at, k), end))
            yield own

    def numbered(self, own: np.ndarray):
        """Of the n-grams that end at each token: the distinct ones, their counts in training texts, a
        place where each ends, and the number of the one at each token."""
        keys, places, number = np.unique(own, return_index=True, return_inverse=True)
        counts = np.bincount(number[~np.repeat(self.held, self.lengths)], minlength=len(keys))
        return keys, counts, places.astype(np.int32), number.astype(np.int32)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    number = 0
    numbers: dict[bytes, int] = {_END: 0}
    tokens, lengths, ids, held, size = [], [], [], [], 0

    def made():
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in numbers], np.uint64)
        flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int32)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([(part << 24) + number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([lengths], pa.list_(pa.int32())),
                pa.array([_pack(hashes)], pa.binary()),
                pa.array([_pack(flat)], pa.binary()),
            ],
            ["chunk_id", "ids", "held", "lengths", "hashes", "tokens"],
        )

    for batch in batches:
        for doc_id, out, text in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_bytes(batch.column(2)), strict=True
        ):
            words = text.lower().split()
            words.append(_END)
            for word in words:
                if word not in numbers:
                    numbers[word] = len(numbers)
            tokens.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            lengths.append(len(words))
            ids.append(doc_id)
            held.append(out)
            size += len(words)
            if size >= CHUNK:
                yield made()
                number += 1
                numbers = {_END: 0}
                tokens, lengths, ids, held, size = [], [], [], [], 0
    if lengths:
        yield made()


def _opened(row) -> Chunk:
    return Chunk(
        _unpack(row["hashes"], np.uint64),
        _unpack(row["tokens"], np.int32),
        np.array(row["lengths"], np.int64),
        np.array(row["held"], bool),
    )


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}


def _bucket_cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Places in sorted keys where the hash ranges begin, and the end."""
    width = (1 << 64) // buckets
    edges = np.array([k * width for k in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _requests(k, buckets):
    """The distinct (k + 1)-grams of each chunk with their counts, by hash range."""

    def run(batches):
        for row in _rows(batches):
            chunk = _opened(row)
            *_, own = chunk.grams(k + 1)
            keys, counts, *_ = chunk.numbered(own)
            counts = counts.astype(np.uint32)
            cuts = _bucket_cuts(keys, buckets)
            pieces = [
                (b, keys[i:j], counts[i:j])
                for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))
                if j > i
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, *_ in pieces], pa.int32()),
                    pa.array([row["chunk_id"]] * len(pieces), pa.int64()),
                    pa.array([k] * len(pieces), pa.int32()),
                    pa.array([_pack(np.diff(x, prepend=np.uint64(0))) for _, x, _ in pieces], pa.binary()),
                    pa.array([_pack(c) for *_, c in pieces], pa.binary()),
                ],
                ["bucket", "chunk_id", "k", "keys", "counts"],
            )

    return run


def _sum_bucket(rows: pa.Table) -> pa.Table:
    """Sums of one hash range and order, sent back to each chunk in the order of its request.

    A chunk gets what the others counted: mostly zeros, which compress, for n-grams that occur once.
    """
    packed = [np.cumsum(_unpack(x.as_py(), np.uint64), dtype=np.uint64) for x in rows.column("keys")]
    counts = np.concatenate([_unpack(x.as_py(), np.uint32) for x in rows.column("counts")])
    sizes = [len(x) for x in packed]
    distinct, back = np.unique(np.concatenate(packed), return_inverse=True)
    totals = np.bincount(back, counts, len(distinct)).astype(np.int64)
    others = totals[back] - counts
    answers = np.split(others, np.cumsum(sizes)[:-1])
    first = [1] + [0] * (len(sizes) - 1)
    unigram = rows.column("k")[0].as_py() == 0
    return pa.table(
        {
            "bucket": rows.column("bucket"),
            "chunk_id": rows.column("chunk_id"),
            "k": rows.column("k"),
            "others": pa.array([_pack_counts(x) for x in answers], pa.binary()),
            "n_tokens": pa.array([x * unigram * int(totals.sum()) for x in first], pa.int64()),
            "n_types": pa.array([x * unigram * int((totals > 0).sum()) for x in first], pa.int64()),
        }
    )


class Automaton:
    """States, arcs and failure arcs of the n-grams that the texts of a chunk can meet.

    State 0 is the root, states 1 .. order - 1 are the contexts of so many ends, with which a text
    starts, then come the n-grams of the chunk by length. Arcs are sorted by (state, token).
    ``grams[k - 1]`` are the training counts of the distinct k-grams, a place where each ends, and
    the number of the k-gram that ends at each token.
    """

    def __init__(self, chunk: Chunk, grams: list, n_tokens: int, n_types: int, strength: float):
        self.order, self.words = len(grams), len(chunk.hashes)
        unigrams, places, number = grams[0]
        texts = int(unigrams[number[chunk.tokens == 0][0]])  # each text has one end
        self.start = self.order - 1 if texts else 0
        sizes = [len(counts) for counts, *_ in grams[:-1]]
        offsets = self.order + np.cumsum([0, *sizes])
        # Failure arcs: from each state to the one without its first word.
        met = np.concatenate([[0], np.full(self.order - 1, texts), *(c for c, *_ in grams[:-1])])
        self.fail = np.log(strength / (met + strength))
        self.down = np.concatenate([[0], np.arange(self.order - 1)] + [np.zeros(n, np.int64) for n in sizes])
        for j in range(1, self.order - 1):
            lower = grams[j - 1][2][grams[j][1]]
            self.down[offsets[j] : offsets[j + 1]] = offsets[j - 1] + lower
        # Arcs: an n-gram leads from its context to its longest ending that is a state.
        opening = np.zeros(len(chunk.tokens), bool)
        opening[chunk.starts] = True
        logs = np.log((unigrams + _EXTRA) / (n_tokens + _EXTRA * (n_types + 1)))
        keys, weights, targets = [], [], []
        for k, (counts, places, _) in enumerate(grams):
            if k == 0:
                source, known = np.zeros(len(places), np.int64), np.ones(len(places), bool)
            else:
                before = offsets[k - 1] + grams[k - 1][2][places - 1]
                source, known = np.where(opening[places], k, before), counts > 0
                lower = np.exp(logs[grams[k - 1][2][places]])
                logs = np.log((counts + strength * lower) / (met[source] + strength))
            depth = min(k + 1, self.order - 1)
            target = offsets[depth - 1] + grams[depth - 1][2][places] if depth else source
            target = np.where(counts > 0, target, 0)
            target[chunk.tokens[places] == 0] = self.start
            keys.append((source * self.words + chunk.tokens[places])[known])
            weights.append(logs[known])
            targets.append(target[known])
        arcs = np.concatenate(keys)
        by_key = np.argsort(arcs)
        self.arcs = arcs[by_key]
        self.weights = np.concatenate(weights)[by_key]
        self.targets = np.concatenate(targets)[by_key]

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of a token in each state, and the states after it."""
        state, log, after = state.copy(), np.zeros(len(state)), np.zeros(len(state), np.int64)
        todo = np.arange(len(state))
        while len(todo):
            key = state[todo] * self.words + token[todo]
            arc = np.minimum(np.searchsorted(self.arcs, key), len(self.arcs) - 1)
            taken = self.arcs[arc] == key
            done, arc, todo = todo[taken], arc[taken], todo[~taken]
            log[done] += self.weights[arc]
            after[done] = self.targets[arc]
            log[todo] += self.fail[state[todo]]
            state[todo] = self.down[state[todo]]
        return log, after

    def walk(self, chunk: Chunk, lanes: int = 0) -> np.ndarray:
        """Natural log-probability of every token, from left to right.

        A state tells the last order - 1 tokens at most. So a stretch can be walked beside the others
        once that many tokens before it have been read from the root: its state is then the one that
        a walk from the start of the text carries. An end leads to the state that starts a text.
        """
        n = len(chunk.tokens)
        width = -(-n // (lanes or LANES))
        first = np.arange(0, n, width)
        warm = self.order - 1
        opening = np.zeros(n, bool)
        opening[chunk.starts] = True
        state = np.where(opening[np.maximum(first - warm, 0)], self.start, 0)
        out = np.zeros(n)
        for off in range(-warm, width):
            place = first + off
            live = np.flatnonzero((place >= 0) & (place < n))
            log, state[live] = self.step(state[live], chunk.tokens[place[live]].astype(np.int64))
            if off >= 0:
                out[place[live]] = log
        return out


def _score(order, strength, n_tokens, n_types):
    def run(key, chunks: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        row = {name: chunks.column(name)[0].as_py() for name in chunks.schema.names}
        chunk = _opened(row)
        at = np.lexsort((answers.column("bucket").to_numpy(), answers.column("k").to_numpy()))
        others = {k: [] for k in range(order)}
        for i in at.tolist():
            others[answers.column("k")[i].as_py()].append(
                _unpack_counts(answers.column("others")[i].as_py())
            )
        grams = [
            (counts + np.concatenate(others.pop(k)), places, number)
            for k, (_, counts, places, number) in enumerate(map(chunk.numbered, chunk.grams(order)))
        ]
        known = grams[0][0][grams[0][2]]
        base = np.log10((known + _EXTRA) / (n_tokens + _EXTRA * (n_types + 1)))
        log = Automaton(chunk, grams, n_tokens, n_types, strength).walk(chunk)
        n = len(chunk.lengths)
        return pa.table(
            {
                "id": pa.array(row["ids"], pa.int64()),
                "held_out": pa.array(chunk.held, pa.bool_()),
                "n_tokens": pa.array(chunk.lengths, pa.int64()),
                "n_known": pa.array(np.add.reduceat((known > 0).astype(np.int64), chunk.starts)),
                "train_tokens": pa.array(np.full(n, n_tokens), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, chunk.starts)),
                "score": pa.array(np.add.reduceat(log, chunk.starts) / np.log(10)),
            }
        )

    return run


def hash_ranges(n_tokens: int) -> int:
    """Hash ranges for so many tokens."""
    return max(BUCKETS, -(-n_tokens // BUCKET_GRAMS))


def score(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    strength: float = STRENGTH,
    folds: int = FOLDS,
    buckets: int | None = None,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` (log10 probabilities of the whole text, its end included).

    The model learns from all rows whose id is not held out (crc32 of the id mod ``folds`` is not
    0; a null id is held out). Null and empty texts are one token, the end. Repeated rows count each
    time; an empty table gives no rows; other columns are not read. Ids must be whole numbers.
    ``buckets`` hash ranges bound what one task sums; unless given, they follow from the number of
    tokens (``hash_ranges``).
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    prepare_workers(docs.sparkSession)
    chunks = materialize(
        docs.select(
            column(id_col).cast("long").alias("id"),
            (id_remainder(column(id_col), folds) == 0).alias("held"),
            column(text_col).alias("text"),
        ).mapInArrow(
            _chunks,
            "chunk_id long, ids array<long>, held array<boolean>, lengths array<int>, "
            "hashes binary, tokens binary",
        ),
        "chunks",
    )
    if buckets is None:
        size = F.aggregate("lengths", F.lit(0).cast("long"), lambda total, n: total + n)
        buckets = hash_ranges(chunks.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0])
    # One order after the other, so that the scratch disk holds the requests of one at a time.
    answers = None
    for k in range(order):
        summed = (
            chunks.mapInArrow(
                _requests(k, buckets), "bucket int, chunk_id long, k int, keys binary, counts binary"
            )
            .groupBy("bucket")
            .applyInArrow(
                _sum_bucket,
                "bucket int, chunk_id long, k int, others binary, n_tokens long, n_types long",
            )
        )
        with shuffle_files_freed(docs.sparkSession):
            stored = materialize(summed, "answers")
        answers = stored if answers is None else answers.union(stored)
    n_tokens, n_types = answers.agg(
        F.coalesce(F.sum("n_tokens"), F.lit(0)), F.coalesce(F.sum("n_types"), F.lit(0))
    ).first()
    scored = (
        chunks.groupBy("chunk_id")
        .cogroup(answers.toDF(*[f"answer_{c}" if c == "chunk_id" else c for c in answers.columns]).groupBy("answer_chunk_id"))
        .applyInArrow(
            _score(order, strength, n_tokens, n_types),
            "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )
    return scored.withColumnRenamed("id", id_col)


def op4_ngram_lm(spark, sf_dir):
    """Scores of every document."""
    return score(table(spark, sf_dir, "documents"))
