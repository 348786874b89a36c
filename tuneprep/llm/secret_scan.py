"""Secrets in texts: three base patterns, and a linear-chain CRF that adds what they miss.

Tokens are tagged as begin, inside or outside of a secret. The CRF sees the shape of a token, its
identity and shape at offsets -3 to 1, and features of the whole text; it is trained on windows
around what the base patterns find in a bounded sample of the documents, on windows without a find,
and on the latter with drawn secrets put in. Decoding is Viterbi. All features of a token type and
its neighbours are summed per type once, so a text costs one lookup per token; where the scores rule
out any label but outside whatever the neighbours are, Viterbi's path is known and cut there.
"""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from bisect import bisect_left
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneprep.llm.common import fresh, prepare_workers, table, worker_state
from tuneprep.runtime import column

#: Fixed patterns of the base, with the group that must be long and its least length.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Bounds of the labelled sample that the model is fitted on: documents, and windows in all.
SAMPLE_ROWS = 2000
SAMPLE_WINDOWS = 3000
WINDOW = 16
REDACTED = "[SECRET]"

_TOKEN = re.compile(r"[\w+/.\-]+|[^\w\s+/.\-]")
_OFFSETS = (-3, -2, -1, 0, 1)
_SLOTS = 1 << 15
_BEGIN, _INSIDE, _OUTSIDE = range(3)
_TYPES = 150_000
_CHUNK = 1 << 18


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns' finds, in order, code points."""
    found = []
    low = text.lower()
    if any(cue in low for cue in _CUES):
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if m.end(2) - m.start(2) >= ASSIGN_LENGTH
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LENGTH
        ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _secret_parts(text: str) -> list[tuple[int, int]]:
    """The secret itself of each base find: the value of an assignment, else the whole."""
    parts = []
    for start, kind, end in base_spans(text):
        parts.append(ASSIGN.match(text, start).span(2) if kind == 0 else (start, end))
    return parts


def joined(spans: list[tuple[int, int, int]]) -> str:
    names = (*KINDS, "crf")
    return ",".join(f"{names[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _slot(*parts) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"))


_shape_slots: dict[tuple, int] = {}


def _plain_features(token: str) -> tuple[int, int, int, int, int]:
    """Features of a token of lower-case letters, by far the most frequent kind."""
    return (
        *_shape(len(token), 1, 3, 0, False),
        1,
        zlib.crc32(b"i\x1f" + token.encode()) if len(token) <= 12 else 2,
    )


def _shape(n: int, mask: int, runs: int, changes: int, hexadecimal: bool) -> tuple:
    size = n if n < 8 else 4 + n.bit_length()
    mixed = changes if changes < 4 else 4 + (changes > 8)
    shape = (mask, size, runs, mixed, hexadecimal)
    found = _shape_slots.get(shape)
    if found is None:
        if len(_shape_slots) > 100_000:
            _shape_slots.clear()
        found = _shape_slots[shape] = (
            _slot("m", mask, size),
            _slot("r", runs),
            _slot("h", hexadecimal, mixed, size, mask),
        )
    return found


def token_features(token: str) -> tuple[int, int, int, int, int]:
    """Five hashed features: mask and length, runs, hex and length, head, identity."""
    if token.isalpha() and token.islower():
        return _plain_features(token)
    lower = upper = digit = other = 0
    runs = changes = last = 0
    for c in token:
        if c.isdigit():
            now, digit = 1, digit + 1
        elif c.isalpha():
            if c.isupper():
                now, upper = 2, upper + 1
            else:
                now, lower = 3, lower + 1
        else:
            now, other = 4, other + 1
        if now != last:
            changes += last != 0
            if changes < 5:
                runs = runs * 5 + now
            last = now
    n = len(token)
    mask = (lower > 0) | (upper > 0) << 1 | (digit > 0) << 2 | (other > 0) << 3
    hexadecimal = n >= 8 and digit > 0 and all(c in "0123456789abcdefABCDEF" for c in token)
    return (
        *_shape(n, mask, runs, changes, hexadecimal),
        _slot("p", token[:4]) if digit and n >= 12 else 1,
        _slot("i", token.lower()) if n <= 12 and not digit else 2,
    )


def text_features(n_tokens: int, n_signs: int) -> tuple[int, int]:
    """Features of the whole text: its length, and how many of its tokens are signs."""
    share = 0 if n_tokens == 0 else int(8 * n_signs / n_tokens)
    return _slot("n", n_tokens.bit_length()), _slot("s", share)


def _at_offset(slots: np.ndarray, offset: int) -> np.ndarray:
    mixed = (slots.astype(np.uint64) + np.uint64(1000003 * (offset + 7))) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - 15)).astype(np.int64)


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros((_SLOTS, 3), np.float32))
    moves: np.ndarray = field(default_factory=lambda: np.zeros((3, 3), np.float32))

    def __post_init__(self):
        to, since = self.moves, self.moves
        around = to[:, :, None] + since[None, :, :]  # previous, label, next
        outside = to[:, _OUTSIDE][:, None, None] + since[_OUTSIDE][None, None, :]
        #: A label can win at most this much by its neighbours over outside.
        self.most = float((around - outside).max()) + 1e-4


class _Run:
    """Viterbi over a run of tokens that comes in parts; outside before it and after it.

    Kept are the best scores of the three labels, in double precision as they add up over the run,
    and one byte a token: two bits of back pointer for each label.
    """

    def __init__(self, moves: np.ndarray, start: int):
        self.start, self.moves = start, moves.astype(np.float64).tolist()
        self.best = tuple(0.0 if y == _OUTSIDE else -np.inf for y in range(3))
        self.back = bytearray()

    def extend(self, e: np.ndarray):
        (m00, m01, m02), (m10, m11, m12), (m20, m21, m22) = self.moves
        a, b, c = self.best
        put = self.back.append
        for e0, e1, e2 in e.tolist():
            x, y, z = a + m00, b + m10, c + m20
            s0, from0 = (x, 0) if x >= y and x >= z else (y, 1) if y >= z else (z, 2)
            x, y, z = a + m01, b + m11, c + m21
            s1, from1 = (x, 0) if x >= y and x >= z else (y, 1) if y >= z else (z, 2)
            x, y, z = a + m02, b + m12, c + m22
            s2, from2 = (x, 0) if x >= y and x >= z else (y, 1) if y >= z else (z, 2)
            a, b, c = s0 + e0, s1 + e1, s2 + e2
            put(from0 | from1 << 2 | from2 << 4)
        self.best = (a, b, c)

    def path(self) -> list[int]:
        last = [score + to[_OUTSIDE] for score, to in zip(self.best, self.moves, strict=True)]
        label = last.index(max(last))
        path = bytearray()
        for back in reversed(self.back):
            path.append(label)
            label = back >> 2 * label & 3
        return list(reversed(path))

    def close(self, labels):
        for at, label in enumerate(self.path(), self.start):
            if label != _OUTSIDE:
                labels[at] = label


class Tagger:
    """Decodes texts; scores per token type are kept up to a bound, then begun anew."""

    def __init__(self, model: Model):
        self.model = model
        self.trained = bool(model.weights.any())
        self._reset()

    def _reset(self):
        self.types: dict[str, int] = {"": 0}
        self.scores = np.zeros((len(_OFFSETS), 1024, 3), np.float32)
        self.filled = 1

    def _learn(self, new: list[str]):
        slots = np.array([token_features(t) for t in new], np.int64)
        need = self.filled + len(new)
        if need > self.scores.shape[1]:
            grown = np.zeros((len(_OFFSETS), 2 * need, 3), np.float32)
            grown[:, : self.filled] = self.scores[:, : self.filled]
            self.scores = grown
        for k, offset in enumerate(_OFFSETS):
            self.scores[k, self.filled : need] = self.model.weights[_at_offset(slots, offset)].sum(axis=1)
        self.filled = need

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Secrets of one text in order; an untrained model finds none."""
        if not self.trained:
            return []
        tokens = _TOKEN.findall(text)
        if not tokens:
            return []
        signs = sum(len(t) == 1 for t in tokens)
        file_score = self.model.weights[
            _at_offset(np.array(text_features(len(tokens), signs)), 5)
        ].sum(axis=0)
        labels = bytearray([_OUTSIDE]) * len(tokens)
        run = None
        for start in range(0, len(tokens), _CHUNK):
            run = self._decode(tokens, start, min(len(tokens), start + _CHUNK), file_score, labels, run)
        if labels.count(_OUTSIDE) == len(labels):
            return []
        return self._positions(text, labels)

    def _decode(self, tokens, start, end, file_score, labels, run=None):
        """Label tokens start to end; takes and returns the run that is open at the border, if any.

        Runs are cut at tokens that are surely outside, and labelled where they end.
        """
        before = ["", "", "", *tokens[max(0, start - 3) : start]][-3:]
        part = [*before, *tokens[start:end], *(tokens[end : end + 1] or [""])]
        get = self.types.get
        ids = [get(t, -1) for t in part]
        if -1 in ids:
            if len(self.types) > _TYPES:
                self._reset()
                get = self.types.get
            new = [t for t in dict.fromkeys(part) if t not in self.types]
            self.types.update(zip(new, range(self.filled, self.filled + len(new)), strict=True))
            self._learn(new)
            ids = [get(t) for t in part]
        ids = np.array(ids)
        n = end - start
        e = np.tile(file_score, (n, 1))
        for k, offset in enumerate(_OFFSETS):
            e += self.scores[k][ids[3 + offset : 3 + offset + n]]
        open_at = np.flatnonzero(np.maximum(e[:, 0], e[:, 1]) - e[:, 2] > -self.model.most)
        cuts = np.flatnonzero(np.diff(open_at) > 1) + 1
        for at in np.split(open_at, cuts) if len(open_at) else ():
            if run is not None and at[0] > 0:
                run.close(labels)
                run = None
            if run is None:
                run = _Run(self.model.moves, start + int(at[0]))
            run.extend(e[at])
            if at[-1] < n - 1 or end == len(tokens):
                run.close(labels)
                run = None
        if run is not None and not (len(open_at) and open_at[-1] == n - 1):
            run.close(labels)
            run = None
        return run

    def _viterbi(self, e: np.ndarray) -> list[int]:
        run = _Run(self.model.moves, 0)
        run.extend(e)
        return run.path()

    def _positions(self, text, labels) -> list[tuple[int, int]]:
        spans: list[list[int]] = []
        before = -2
        for i, m in enumerate(_TOKEN.finditer(text)):
            label = labels[i]
            if label == _INSIDE and before == i - 1:
                spans[-1][1] = m.end()
            elif label != _OUTSIDE:
                spans.append([m.start(), m.end()])
            if label != _OUTSIDE:
                before = i
        return [tuple(s) for s in spans]


def all_spans(text: str, tagger: Tagger) -> tuple[list, list]:
    """(base spans, spans the CRF adds); an added span overlaps no base span."""
    base = base_spans(text)
    starts = [s for s, _, _ in base]
    reach = [0, *accumulate((e for _, _, e in base), max)]  # farthest end of the first finds
    added = [
        (start, len(KINDS), end)
        for start, end in tagger.spans(text)
        if reach[bisect_left(starts, end)] <= start
    ]
    return base, added


# --- training -----------------------------------------------------------------------------------


def _drawn_secret(rng: random.Random) -> str:
    alphabets = (
        "0123456789abcdef",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
        "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
        "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-",
    )
    value = "".join(rng.choices(rng.choice(alphabets), k=rng.randint(16, 48)))
    return rng.choice(("", "", "sk_", "ghp_", "xox-")) + value[:-1] + str(rng.randint(0, 9))


def _look_alike(rng: random.Random) -> str:
    """What has digits and marks as secrets have, and is none: an address, version, date, path, UUID."""
    number = lambda top: str(rng.randrange(top))
    word = lambda: "".join(rng.choices("abcdefghilmnoprstu", k=rng.randint(3, 8)))
    kind = rng.randrange(8)
    if kind == 0:
        return ".".join(number(256) for _ in range(4))
    if kind == 1:
        return "v" * rng.randint(0, 1) + ".".join(number(40) for _ in range(rng.randint(2, 4)))
    if kind == 2:
        return f"{rng.randint(1990, 2040)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    if kind == 3:
        return f"{rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.randrange(60):02d}.{number(1000)}"
    if kind == 4:
        return "/".join(["", *[word() + number(10) * rng.randint(0, 1) for _ in range(rng.randint(2, 6))]])
    if kind == 5:
        return "-".join("".join(rng.choices("0123456789abcdef", k=k)) for k in (8, 4, 4, 4, 12))
    if kind == 6:
        return f"+{number(99)}-{number(999)}-{rng.randrange(10**6, 10**8)}"
    return f"https://www.{word()}.com/{word()}/{number(10**6)}?page={number(50)}"


def _windows(text: str, rng: random.Random, most: int):
    """Training windows of a text: (tokens with 3 before and 1 after, labels, text features).

    One for each find; of more than ``most``, those with the smallest hash of their place.
    """
    spans = _secret_parts(text)
    matches = list(_TOKEN.finditer(text))
    if not matches:
        return
    tokens = [m.group() for m in matches]
    labels = [_OUTSIDE] * len(tokens)
    centres = []
    for start, end in spans:
        inside = [i for i, m in enumerate(matches) if m.start() < end and m.end() > start]
        for k, i in enumerate(inside):
            labels[i] = _BEGIN if k == 0 else _INSIDE
        centres += inside[:1]
    whole = text_features(len(tokens), sum(len(t) == 1 for t in tokens))
    if not centres:
        at = rng.randrange(len(tokens))
        low = max(0, at - WINDOW)
        own, tags = tokens[low : at + WINDOW], labels[low : at + WINDOW]
        yield own, tags, whole
        cue = rng.choice(("key", "password", "secret", "token", "auth", "pwd", "credential", "bearer"))
        put = [cue, rng.choice("=:"), *([rng.choice("\"'")] * rng.randint(0, 1))]
        for before, value, secret in (
            (put, _drawn_secret(rng), True),
            ([], _drawn_secret(rng), True),
            ([], _look_alike(rng), False),
            ([], _look_alike(rng), False),
        ):
            if rng.random() < 0.5:
                continue
            found = _TOKEN.findall(value)
            marks = [_BEGIN] + [_INSIDE] * (len(found) - 1) if secret else [_OUTSIDE] * len(found)
            k = rng.randint(0, len(own))
            yield (
                own[:k] + before + found + own[k:],
                tags[:k] + [_OUTSIDE] * len(before) + marks + tags[k:],
                whole,
            )
    if len(centres) > most:
        centres = heapq.nsmallest(most, centres, key=lambda at: zlib.crc32(b"%d" % at))
    for at in centres:
        low = max(0, at - WINDOW)
        yield tokens[low : at + WINDOW], labels[low : at + WINDOW], whole


def _window_rows(most: int):
    """``place, key, slots, tags, whole``: windows, and the hash by which a sample of them is drawn."""

    def windows(batches):
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rng = random.Random(int(key))
                own = xxhash.xxh64_intdigest(text, int(key) & (1 << 64) - 1)
                for i, (tokens, tags, whole) in enumerate(_windows(text, rng, most)):
                    slots = np.array([token_features(t) for t in tokens], "<i8")
                    place = xxhash.xxh64_intdigest(b"%d:%d" % (own, i)) >> 1
                    rows.append((place, key, slots.tobytes(), bytes(tags), list(whole)))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                ["place", "key", "slots", "tags", "whole"],
            )

    return windows


def fit(windows: list[tuple[bytes, bytes, list[int]]], steps: int = 40, penalty: float = 1e-4) -> Model:
    """Maximise the conditional likelihood of the windows' tags by resilient gradient steps."""
    if not any(set(tags) - {_OUTSIDE} for _, tags, _ in windows):
        return Model()
    longest = max(len(tags) for _, tags, _ in windows)
    n = len(windows)
    empty = np.zeros((1, 5), np.int64)
    slots = np.full((n, longest, len(_OFFSETS) * 5 + 2), -1, np.int64)
    tags = np.zeros((n, longest), np.int64)
    lengths = np.zeros(n, np.int64)
    for i, (raw, labels, whole) in enumerate(windows):
        own = np.frombuffer(raw, "<i8").reshape(-1, 5)
        m = lengths[i] = len(own)
        padded = np.vstack([np.repeat(empty, 3, 0), own, empty])
        known = np.vstack([np.zeros((3, 1)), np.ones((m, 1)), np.zeros((1, 1))])[:, 0] > 0
        for k, offset in enumerate(_OFFSETS):
            at = slice(3 + offset, 3 + offset + m)
            slots[i, :m, 5 * k : 5 * k + 5] = np.where(
                known[at, None], _at_offset(padded[at], offset), -1
            )
        slots[i, :m, -2:] = _at_offset(np.array(whole), 5)
        tags[i, :m] = np.frombuffer(labels, np.uint8)
    present = np.arange(longest)[None, :] < lengths[:, None]
    flat = slots.reshape(n * longest, -1)
    used = flat >= 0
    rows = np.repeat(np.arange(len(flat)), used.sum(axis=1))
    cols = flat[used]
    w, moves = np.zeros((_SLOTS, 3)), np.zeros((3, 3))
    climbs = (_Climb(w.shape), _Climb(moves.shape))
    gold = np.zeros((n, longest, 3))
    np.put_along_axis(gold, tags[:, :, None], 1.0, axis=2)
    gold *= present[:, :, None]
    rows_of = np.arange(n)
    for _ in range(steps):
        e = np.stack([np.bincount(rows, w[cols, y], len(flat)) for y in range(3)], axis=1)
        e = e.reshape(n, longest, 3)
        # Both ends of a window have a neighbour outside; padding stays in the label outside.
        forward = np.zeros((n, longest, 3))
        forward[:, 0] = moves[_OUTSIDE] + e[:, 0]
        for t in range(1, longest):
            step = _log_sum(forward[:, t - 1][:, :, None] + moves, 1) + e[:, t]
            forward[:, t] = np.where(present[:, t, None], step, forward[:, t - 1])
        backward = np.tile(moves[:, _OUTSIDE], (n, longest, 1))
        for t in range(longest - 2, -1, -1):
            step = _log_sum(moves[None] + (e[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(present[:, t + 1, None], step, backward[:, t])
        total = _log_sum(forward[rows_of, lengths - 1] + moves[:, _OUTSIDE], 1)
        chance = np.exp(forward + backward - total[:, None, None]) * present[:, :, None]
        off = (gold - chance).reshape(len(flat), 3)
        grad = np.stack([np.bincount(cols, off[rows, y], _SLOTS) for y in range(3)], axis=1) / n
        pair = np.exp(
            forward[:, :-1, :, None] + moves + (e + backward)[:, 1:, None, :] - total[:, None, None, None]
        )
        pair *= present[:, 1:, None, None]
        seen = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
        grad_moves = (seen - pair.sum(axis=(0, 1))) / n
        last = gold[rows_of, lengths - 1] - chance[rows_of, lengths - 1]
        grad_moves[:, _OUTSIDE] += last.sum(axis=0) / n
        grad_moves[_OUTSIDE] += (gold[:, 0] - chance[:, 0]).sum(axis=0) / n
        grad, grad_moves = grad - penalty * w, grad_moves - penalty * moves
        w, moves = w + climbs[0].step(grad), moves + climbs[1].step(grad_moves)
    return Model(w.astype(np.float32), moves.astype(np.float32))


class _Climb:
    """Resilient steps: each weight's own, longer while its gradient keeps its sign, else shorter."""

    def __init__(self, shape):
        self.size, self.before = np.full(shape, 0.1), np.zeros(shape)

    def step(self, gradient: np.ndarray) -> np.ndarray:
        agree = np.sign(gradient * self.before)
        self.size = np.clip(self.size * np.where(agree > 0, 1.2, np.where(agree < 0, 0.5, 1)), 1e-6, 2)
        self.before = np.where(agree < 0, 0, gradient)
        return np.sign(self.before) * self.size


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis=axis)) + np.squeeze(most, axis)


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    sample_windows: int = SAMPLE_WINDOWS,
) -> Model:
    """Fit on windows of the documents with the ``sample_rows`` smallest hashes of id; without finds, no model.

    Hashes decide on narrow columns first. The texts chosen stay where they are: windows are cut from
    them there, and the ``sample_windows`` with the smallest hash of (id, text, place) are collected,
    the same at each run, also if ids repeat.
    """
    prepare_workers(docs.sparkSession)
    hashed = F.xxhash64(column(id_col))
    with_text = docs.filter(column(text_col).isNotNull())
    chosen = with_text.select(hashed.alias("_hash")).orderBy("_hash").limit(sample_rows).distinct()
    rows = (
        with_text.select(hashed.alias("_hash"), column(text_col).alias("_text"))
        .join(F.broadcast(chosen), "_hash", "left_semi")
        .mapInArrow(
            _window_rows(sample_windows), "place long, key long, slots binary, tags binary, whole array<long>"
        )
        .orderBy("place", "key")
        .limit(sample_windows)
        .collect()
    )
    ordered = sorted((r.key, bytes(r.slots), bytes(r.tags), list(r.whole)) for r in rows)
    return fit([r[1:] for r in ordered])


# --- use ----------------------------------------------------------------------------------------

def scan_column(docs: DataFrame, text: Column, model: Model) -> Column:
    """Struct of counts, digest and spans for each text; a null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def scan(texts: pa.Array) -> pa.Array:
        tagger = worker_state("secrets", shared, Tagger)
        counts, digests, lists = ([], [], []), [], []
        for item in texts:
            base, added = all_spans(item.as_py() or "", tagger)
            for kind in range(3):
                counts[kind].append(sum(k == kind for _, k, _ in base))
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            lists.append(joined(base + added))
        return pa.StructArray.from_arrays(
            [
                *[pa.array(c, pa.int64()) for c in counts],
                pa.array(digests, pa.string()),
                pa.array(lists, pa.string()),
            ],
            ["n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )

    return scan(text)


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """One row per document: id, ``n_assign, n_access, n_hex, base_sha256, spans``.

    Null and empty texts have no spans (the digest is that of the empty string). Ids may be null or
    repeat; an empty table gives no rows; other columns are not read.
    """
    model = train(docs, id_col, text_col, sample_rows)
    found = fresh("found")
    return docs.select(
        column(id_col).alias(id_col), scan_column(docs, column(text_col), model).alias(found)
    ).select(column(id_col), f"{found}.*")


def redacted(text: str, tagger: Tagger) -> str:
    """The text with each secret (the value only, of an assignment) replaced by a mark."""
    _, added = all_spans(text, tagger)
    parts = sorted(_secret_parts(text) + [(s, e) for s, _, e in added])
    out, at = [], 0
    for start, end in parts:
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """All rows and columns of ``docs``, with the secrets in the texts replaced by a mark."""
    model = train(docs, id_col, text_col, sample_rows)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        tagger = worker_state("secrets", shared, Tagger)
        return pa.array(
            [None if t is None else redacted(t, tagger) for t in texts.to_pylist()], pa.string()
        )

    return docs.withColumn(text_col, clean(column(text_col)))


def op9_secrets(spark, sf_dir):
    """Secrets in every document."""
    return scan(table(spark, sf_dir, "documents"))
