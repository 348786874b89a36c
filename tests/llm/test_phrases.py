import random
import re
from collections import Counter

import numpy as np
import pytest

from tuneprep.llm import phrases

SCHEMA = "lang string, text string, n long, part string, range int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, longest, top, percent=100):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    own[tuple(words[i : i + size])] += 1
    out = []
    for lang, own in counts.items():
        found = {p: f for p, f in own.items() if len(p) > 1 and f >= min_count}
        kept = []
        for p, a in found.items():
            if any(
                len(q) > len(p) and 100 * b >= percent * a
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in found.items()
            ):
                continue
            cuts = [(1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]], k))
        for rank, (score, a, p, left, right, k) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score, k))
    return sorted(out)


def texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)] + ["Été", "ÉTÉ", "\x1c", "\xa0", "x y", "Of", "oF"]
    rows = []
    for i in range(120):
        parts = [rng.choice(words[: rng.choice((3, 8, len(words)))]) for _ in range(rng.randrange(60))]
        ends = [rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!\r", " ;"]) for _ in parts]
        text = "".join(a + b for a, b in zip(parts, ends, strict=True))
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    phrase = "one two three four five six seven "
    rows += [("en", phrase * 3 + "tail"), ("en", phrase), ("en", phrase)] * 4 + [rows[0]] * 5
    return [*rows, ("en", None), ("en", ""), (None, None), ("xx", "lonely"), ("de", "w1 w2 " * 400)]


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, 1, "clash", 2) for lang, text in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize(("top", "percent"), [(2000, 100), (7, 100), (2000, 40)])
def test_same_as_brute_force(spark, top, percent):
    rows = texts()
    got = phrases.collocations(frame(spark, rows), min_count=6, top=top, contained_percent=percent)
    want = brute(rows, 6, phrases.LONGEST, top, percent)
    assert sorted(map(tuple, got.collect())) == want
    assert len({row[0] for row in want}) > 2


def test_stretches_and_blocks_lose_nothing(monkeypatch):
    """Texts far longer than a block and a stretch, and n-grams that cross both."""
    rng = random.Random(1)
    text = "".join(rng.choice(["a ", "b ", "c ", "a b c ", "d. "]) for _ in range(3000)).encode()
    every = np.full(1 << (phrases.WORD_BITS - 3), 255, np.uint8)

    def counted(tokens, block):
        monkeypatch.setattr(phrases, "SHARD_TOKENS", tokens)
        monkeypatch.setattr(phrases, "_TEXT_BLOCK", block)
        total = Counter()

        def take(lang, words, hashes, ids, starts):
            total.update(dict(phrases.shard_ngrams(words, hashes, ids, starts, every, 5)))
            yield 1

        shards = phrases._Shards(every, 4, take)
        stretches = len([*shards.add("en", text), *shards.add("de", b"x y x y"), *shards.finish()])
        return total, stretches

    whole, one = counted(10**9, 1 << 30)
    parts, many = counted(50, 64)
    assert whole == parts
    assert one == 2 and many > 40


def test_transducers():
    rng = random.Random(2)
    tables = []
    for _ in range(4):
        keys = {tuple(rng.choices([b"a", b"b", b"c\xc3\xa9", b"d"], k=rng.randrange(1, 6))) for _ in range(80)}
        tables.append({k: rng.randrange(1, 4) for k in keys})
    parts = [phrases.Transducer.from_sorted(sorted(t.items())) for t in tables]
    for part, own in zip(parts, tables, strict=True):
        again = phrases.Transducer.from_bytes(part.to_bytes())
        assert dict(again.items()) == own
        assert list(again.items()) == sorted(own.items())
        signatures = [(w, tuple(out.items())) for w, out in zip(part.weights, part.arcs, strict=True)]
        assert len(signatures[:-1]) == len(set(signatures[:-1]))  # minimal
        assert len(signatures) < sum(map(len, own))
        for key in [*own, (b"zz",), (b"a", b"zz")]:
            assert part.count(key) == own.get(key, 0)
    total = Counter()
    for own in tables:
        total.update(own)
    assert list(phrases.union_items(parts)) == sorted(total.items())
    assert list(phrases.Transducer.from_sorted([]).items()) == []


def test_products_beyond_64_bits_are_exact():
    big = 3_000_000_000_000
    counts = phrases.Transducer.from_sorted([((b"a",), big + 1), ((b"a", b"b"), big), ((b"b",), big + 7)])
    score, cut, a, left, right = phrases.best_cut(counts, (b"a", b"b"), 10**16)
    assert (score, cut, a, left, right) == (1000 * big * 10**16 // ((big + 1) * (big + 7)), 1, big, big + 1, big + 7)


def test_filter_holds_what_spark_hashed(spark):
    words = [("en", f"w{i}") for i in range(500)] + [("de", "été"), ("en", "")]
    df = spark.createDataFrame(words, "lang string, part string").selectExpr("xxhash64(lang, part) h")
    bits = phrases.bit_filter(df, 20)
    own = np.array([phrases.word_hash(w.encode(), phrases.language_seed(lang)) for lang, w in words], np.uint64)
    assert phrases._passes(bits, own).all()
    other = np.array([phrases.word_hash(f"x{i}".encode(), phrases.language_seed("en")) for i in range(500)], np.uint64)
    assert phrases._passes(bits, other).mean() < 0.05


def test_empty_tables(spark):
    assert phrases.collocations(frame(spark, [])).collect() == []
    assert phrases.collocations(frame(spark, [("en", None), (None, ""), ("en", "a b c")])).collect() == []
