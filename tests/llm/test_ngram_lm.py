import math
import random
import re
import zlib
from collections import Counter

import pytest

from tuneprep.llm import ngram_lm

SCHEMA = "doc_id long, text string, score string, n_tokens int"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def held(i):
    return i is None or zlib.crc32(str(i).encode()) % 10 == 0


def automaton(rows, order, strength):
    """States, arcs and failure arcs as dictionaries, and a traversal token by token."""
    grams = Counter()
    for i, text in rows:
        if not held(i):
            own = ["\n"] * (order - 1) + tokens(text)
            for t in range(order - 1, len(own)):
                for k in range(1, order + 1):
                    grams[tuple(own[t - k + 1 : t + 1])] += 1
    states = Counter()
    for gram, n in grams.items():
        states[gram[:-1]] += n
    n, v = states[()], sum(len(g) == 1 for g in grams)

    def probability(context, token):
        if not context:
            return (grams[token,] + 0.1) / (n + 0.1 * (v + 1))
        lower = probability(context[1:], token)
        return (grams[(*context, token)] + strength * lower) / (states[context] + strength)

    out = []
    for i, text in rows:
        state, total, base, known = ("\n",) * (order - 1), 0.0, 0.0, 0
        for token in tokens(text):
            context = state
            while context and not states[context]:
                context = context[1:]
            total += math.log10(probability(context, token))
            base += math.log10(probability((), token))
            known += grams[token,] > 0
            state = (*state, token)[len(state) + 1 - (order - 1) :] if order > 1 else ()
        out.append((i, held(i), len(tokens(text)), known, n, base, total))
    return out


def documents():
    rng = random.Random(9)
    words = "a b c d E e f É é x\x0by long-word".split(" ")
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 30)))) for i in range(150)]
    return rows + [(3, "a b c"), (3, "a b c"), (None, "a new word"), (400, None), (401, ""), (402, "b " * 3000)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_scores_are_those_of_a_traversal_by_hand(spark, order, monkeypatch):
    rows = documents()
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(3)
    got = ngram_lm.score(df, order=order, strength=5.0, buckets=7).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    want = sorted(automaton(rows, order, 5.0), key=key)
    for g, w in zip(sorted(map(tuple, got), key=key), want, strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], abs=1e-7)


def test_chunks_change_nothing(monkeypatch):
    import pyarrow as pa

    class Part:
        @staticmethod
        def get():
            return Part

        @staticmethod
        def partitionId():
            return 1

    monkeypatch.setattr(ngram_lm, "TaskContext", Part)
    monkeypatch.setattr(ngram_lm, "CHUNK", 40)
    rows = documents()
    batch = pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in rows]), pa.array([held(i) for i, _ in rows]), pa.array([t for _, t in rows])],
        ["id", "held", "text"],
    )
    made = list(ngram_lm._chunks([batch]))
    assert len(made) > 20
    assert len({m.column(0)[0].as_py() for m in made}) == len(made)
    lengths = [n for m in made for n in m.column(3)[0].as_py()]
    assert lengths == [len(tokens(t)) for _, t in rows]


def chunk_of(texts, hold):
    """A chunk with its n-grams as counted by itself alone."""
    import numpy as np

    words = ["\n", *sorted({w for t in texts for w in tokens(t)[:-1]})]
    flat = [words.index(w) for t in texts for w in tokens(t)]
    lengths = np.array([len(tokens(t)) for t in texts])
    hashes = np.array([zlib.crc32(w.encode()) + 7 for w in words], np.uint64)
    chunk = ngram_lm.Chunk(hashes, np.array(flat, np.int32), lengths, np.array(hold))
    grams = [chunk.numbered(own)[1:] for own in chunk.grams(3)]
    known = grams[0][0]
    return chunk, ngram_lm.Automaton(chunk, grams, int(known.sum()), int((known > 0).sum()), 2.0)


def test_probabilities_of_every_state_sum_to_one():
    import numpy as np

    # One word of the held-out text is unknown: its probability is that of all unknown words.
    chunk, model = chunk_of(["a b c a b", "b c", "", "c a b d"], [False, False, False, False])
    held, model_held = chunk_of(["a b c a b", "b c", "", "c a b new"], [False, False, False, True])
    tokens = np.arange(model_held.words)
    for state in np.unique(model_held.targets):
        log, _ = model_held.step(np.full(len(tokens), state), tokens)
        assert np.exp(log).sum() == pytest.approx(1)
    # Without an unknown word the share of one is missing.
    log, _ = model.step(np.zeros(model.words, np.int64), np.arange(model.words))
    assert np.exp(log).sum() < 1


def test_lanes_change_nothing():
    rng = random.Random(4)
    texts = [" ".join(rng.choices("abcdef", k=rng.choice([0, 1, 2, 3, 40]))) for _ in range(40)]
    chunk, model = chunk_of(texts, [i % 5 == 0 for i in range(len(texts))])
    want = model.walk(chunk, lanes=1)
    for lanes in (2, 3, 7, 50, 10_000):
        assert model.walk(chunk, lanes=lanes) == pytest.approx(want, abs=0)


def test_hash_ranges_grow_with_the_tokens():
    assert ngram_lm.hash_ranges(0) == ngram_lm.BUCKETS
    assert ngram_lm.hash_ranges(1 << 40) == (1 << 40) // ngram_lm.BUCKET_GRAMS


def test_empty_table(spark):
    assert ngram_lm.score(spark.createDataFrame([], SCHEMA)).count() == 0
