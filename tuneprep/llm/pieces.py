"""SentencePiece encoding and decoding by suffix-array matching.

White space marks split a text into segments that no piece crosses. The segments of a batch that are
new to the worker are put one after another and indexed by a suffix array over as many characters as
the longest piece has; every piece is found by binary search, level by level of its characters, as a
range of the array, and each occurrence is an edge from its start to its end. The edges are sorted
by their end and relaxed in that order. For a BPE vocabulary, an edge extends the piece before it if
merging would have left just these two: then the last piece of the encoding of every prefix is
unique, and following it from the end gives the encoding that merging by rank gives.

The vocabulary is read once on the driver, from a file whose path is a parameter, and sent to the
workers; it has a fixed size. What segments encode to is kept per worker up to a bound. A long segment
(text without blanks or line breaks) is relaxed in blocks side by side, which are joined where the
last pieces agree.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tuneprep.llm.common import fresh, prepare_workers, table, worker_state
from tuneprep.runtime import column

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"

_MARK = "▁"
_SEGMENT = re.compile(f"{_MARK}*[^{_MARK}\n]+|{_MARK}+|\n")
_BORDER = re.compile(f"\n|[^{_MARK}]{_MARK}")
_PROBES = ("", " ", "  a  b ", "x\ty\n\nz", "é①ﬁ", "The quick brown fox, 12345!")
_KEPT = 75_000
_TEXT_CHUNK = 1 << 20
_CACHE_BITS = 20
_KEPT_IDS = 1 << 21
_BLOCK = 1 << 10
_BLOCKS_AT_ONCE = 256
_NEVER = np.iinfo(np.int64).max


@dataclass
class Vocabulary:
    """Pieces by id, what they decode to, and how each is merged from two others."""

    pieces: list[str]
    byte_ids: np.ndarray
    decoded: list[bytes]
    found: np.ndarray  # ids of the pieces that can be matched in a text
    rank: np.ndarray  # order of merging, -1 for single characters
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray  # left id * size + right id of all pairs that merge, sorted
    pair_ranks: np.ndarray

    @property
    def size(self) -> int:
        return len(self.pieces)


def _merged(text: str, ranks: dict[str, int]) -> tuple[list[str], tuple[str, str] | None]:
    """Merge neighbours by rank, leftmost first; the result and the last merge."""
    parts, last = list(text), None
    while True:
        options = [
            (ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks
        ]
        if not options:
            return parts, last
        _, i = min(options)
        last = (parts[i], parts[i + 1])
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def load(path: str = MODEL_FILE) -> Vocabulary:
    """Read a BPE model with byte fallback, identity normalisation and a mark before the text."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    is_byte = [model.is_byte(i) for i in range(size)]
    byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
    normal = {pieces[i]: i for i in range(size) if not special[i] and not is_byte[i]}
    by_score = sorted((p for p in normal if len(p) > 1), key=lambda p: (-model.get_score(normal[p]), normal[p]))
    ranks = {p: k for k, p in enumerate(by_score)}
    rank, left, right = (np.full(size + 1, -1, np.int64) for _ in range(3))
    found = [i for p, i in normal.items() if len(p) == 1]
    for p in by_score:
        parts, last = _merged(p, ranks)
        if len(parts) > 1 or not all(x in normal for x in last):
            continue  # merging never arrives at it
        i = normal[p]
        rank[i], left[i], right[i] = ranks[p], normal[last[0]], normal[last[1]]
        if max(rank[left[i]], rank[right[i]]) >= rank[i]:
            raise ValueError(f"piece {p!r} ranks before a part of it")
        found.append(i)
    pairs = {}
    for p in by_score:
        for cut in range(1, len(p)):
            a, b = normal.get(p[:cut]), normal.get(p[cut:])
            if a is not None and b is not None:
                pairs[a * (size + 1) + b] = ranks[p]
        if any(c not in normal for c in p):
            raise ValueError(f"piece {p!r} has a character that is no piece")
        if _MARK in p.lstrip(_MARK) or ("\n" in p and len(p) > 1):
            raise ValueError(f"piece {p!r} goes on beyond a segment")
    keys = np.array(sorted(pairs), np.int64)
    decoded = [
        bytes([int(p[3:5], 16)]) if byte else b"" if bad else p.replace(_MARK, " ").encode()
        for p, bad, byte in zip(pieces, special, is_byte, strict=True)
    ]
    decoded[model.unk_id()] = " ⁇ ".encode()
    vocabulary = Vocabulary(
        pieces, byte_ids, decoded, np.array(sorted(found)), rank, left, right, keys,
        np.array([pairs[k] for k in keys.tolist()], np.int64),
    )
    encoder = Encoder(vocabulary)
    for text in _PROBES:
        if encoder.encode([text])[0].tolist() != model.encode(text):
            raise ValueError("not a model of the supported kind")
    return vocabulary


class Encoder:
    """Encodes lists of texts in one worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.unknown = vocabulary.size
        self._index_pieces()
        self.valid_keys = np.full(1 << _CACHE_BITS, -1, np.int64)
        self.valid_bits = np.zeros(1 << _CACHE_BITS, bool)
        self._reset()

    def _index_pieces(self):
        """The characters of the pieces, numbered, and the prefixes of the pieces by length."""
        v = self.v
        texts = [v.pieces[i] for i in v.found]
        alphabet = np.array(sorted({ord(c) for t in texts for c in t}), np.int64)
        self.alphabet, self.longest = alphabet, max(map(len, texts))
        self.warm = max(_BLOCK // 4, self.longest)
        self.lengths = np.ones(v.size + 1, np.int64)
        self.lengths[v.found] = [len(t) for t in texts]
        levels, parents = [], {"": 0}
        self.ends = []  # per level: (number of the prefix, id of the piece that ends there)
        for depth in range(1, self.longest + 1):
            prefixes = sorted({t[:depth] for t in texts if len(t) >= depth})
            number = {p: k for k, p in enumerate(prefixes)}
            last = np.array([ord(p[-1]) for p in prefixes], np.int64)
            levels.append(
                (
                    np.array([parents[p[:-1]] for p in prefixes], np.int64),
                    np.searchsorted(alphabet, last) + 1,
                )
            )
            whole = [(number[t], i) for t, i in zip(texts, v.found.tolist(), strict=True) if len(t) == depth]
            self.ends.append(np.array(whole, np.int64).reshape(-1, 2))
            parents = number
        self.levels = levels

    def _reset(self):
        self.known: dict[str, int] = {}
        self.starts = np.zeros(1024, np.int64)
        self.counts = np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.int32)
        self.used = 0

    # --- matching

    def _suffix_array(self, codes: np.ndarray) -> np.ndarray:
        """Suffixes in the order of their first ``longest`` characters."""
        def ahead(rank, by):
            out = np.zeros_like(rank)
            out[: -by or None] = rank[by:]
            return out

        # As many characters as fit into 62 bits make the first key; then the span doubles.
        width = len(self.alphabet).bit_length()
        key, span = codes.astype(np.int64), 1
        while (span + 1) * width <= 62 and span < self.longest:
            key = (key << width) | ahead(codes, span)
            span += 1
        while span < self.longest:
            rank = np.unique(key, return_inverse=True)[1]
            key = rank * (int(rank.max(initial=0)) + 1) + ahead(rank, span)
            span *= 2
        return np.argsort(key)

    def _edges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, piece) of every occurrence of every piece; 0 in ``codes`` matches nothing."""
        order = self._suffix_array(codes)
        padded = np.concatenate([codes, np.zeros(self.longest, codes.dtype)])
        n = len(order)
        low, high = np.zeros(1, np.int64), np.full(1, n, np.int64)
        starts, ids = [], []
        for depth, (parent, char) in enumerate(self.levels):
            def bound(strict, low=low, high=high, depth=depth, parent=parent, char=char):
                a, b = low[parent].copy(), high[parent].copy()
                while (todo := a < b).any():
                    mid = (a + b) >> 1
                    seen = padded[order[np.minimum(mid, n - 1)] + depth]
                    below = (seen <= char) if strict else (seen < char)
                    a = np.where(todo & below, mid + 1, a)
                    b = np.where(todo & ~below, mid, b)
                return a

            low, high = bound(False), bound(True)
            number, piece = self.ends[depth].T
            sizes = high[number] - low[number]
            hit = sizes > 0
            number, piece, sizes = number[hit], piece[hit], sizes[hit]
            at = np.repeat(low[number] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            starts.append(order[at])
            ids.append(np.repeat(piece, sizes))
        lone = np.flatnonzero(codes == 0)
        return np.concatenate([*starts, lone]), np.concatenate([*ids, np.full(len(lone), self.unknown)])

    def _adjacent(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of a and b, each a piece, ends with just these two pieces."""
        width = self.unknown + 1
        keys = a * width + b
        slot = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _CACHE_BITS)).astype(np.int64)
        missing = self.valid_keys[slot] != keys
        out = self.valid_bits[slot]
        if missing.any():
            new, back = np.unique(keys[missing], return_inverse=True)
            fresh_bits = self._check(new // width, new % width)
            out[missing] = fresh_bits[back]
            self.valid_keys[slot[missing]] = keys[missing]
            self.valid_bits[slot[missing]] = fresh_bits[back]
        return out

    def _check(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges on both sides of the border, latest first.

        The two tokens at the border must never be a pair that merges before either of them is
        merged away from it; of equal ranks the left goes first.
        """
        v, valid = self.v, np.ones(len(a), bool)
        live = np.arange(len(a))
        next_a, next_b = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
        a, b = a.copy(), b.copy()
        while len(live):
            keys = a[live] * (self.unknown + 1) + b[live]
            at = np.minimum(np.searchsorted(v.pair_keys, keys), len(v.pair_keys) - 1)
            merge = np.where(v.pair_keys[at] == keys, v.pair_ranks[at], _NEVER)
            broken = (merge < next_a[live]) & (merge <= next_b[live]) & (merge < _NEVER)
            valid[live[broken]] = False
            rank_a, rank_b = v.rank[a[live]], v.rank[b[live]]
            undo_a = rank_a > rank_b
            going = ~broken & (np.maximum(rank_a, rank_b) >= 0)
            left, right = live[going & undo_a], live[going & ~undo_a]
            next_a[left], a[left] = v.rank[a[left]], v.right[a[left]]
            next_b[right], b[right] = v.rank[b[right]], v.left[b[right]]
            live = live[going]
        return valid

    # --- segments

    def _relax(self, segments: list[str]):
        """The matched segments: code points, first places, and the last piece of every prefix."""
        lengths = np.array([len(s) for s in segments], np.int64)
        text = "".join(segments)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        plain = np.where(self.alphabet[at] == points, at + 1, 0)
        # One free place after each segment, where nothing matches and the path of it ends.
        base = np.cumsum(lengths + 1) - (lengths + 1)
        of = np.repeat(np.arange(len(segments)), lengths)
        where = np.arange(len(points)) + of
        codes = np.zeros(len(points) + len(segments), np.int64)
        codes[where] = plain
        start, piece = self._edges(codes)
        segment = np.repeat(np.arange(len(segments)), lengths + 1)[start]
        inside = start < base[segment] + lengths[segment]
        start, piece, segment = start[inside], piece[inside], segment[inside]
        step = start + self.lengths[piece] - base[segment]
        order = np.argsort(step)
        start, piece, segment, step = start[order], piece[order], segment[order], step[order]
        last = np.full(len(codes) + 1, -1, np.int64)
        self._extend(last, start, piece, step, start == base[segment])
        return _Relaxed(points, base, lengths, last, (start, piece, segment, step))

    def _extend(self, last, start, piece, step, first):
        """Relax the edges, which are in the order of ``step``; ``first`` ones begin a segment."""
        end = start + self.lengths[piece]
        cuts = np.flatnonzero(np.diff(step)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(step)], strict=True):
            good = first[a:b].copy()
            rest = np.flatnonzero(~good)
            before = last[start[a:b][rest]]
            good[rest] = self._adjacent(before, piece[a:b][rest])
            last[end[a:b][good]] = piece[a:b][good]

    def _learn(self, segments: list[str]):
        """Encode new segments and keep the result."""
        short = [s for s in segments if len(s) <= 2 * _BLOCK]
        if short:
            self._learn_short(short)
        for s in segments:
            if len(s) > 2 * _BLOCK:
                self._learn_long(s)

    def _learn_short(self, segments: list[str]):
        found = self._relax(segments)
        base, last = found.base, found.last
        # Follow the last pieces back from each segment's end.
        position, alive = base + found.lengths, np.arange(len(segments))
        owners, ids, places = [], [], []
        while len(alive):
            own = last[position[alive]]
            owners.append(alive)
            ids.append(own)
            places.append(position[alive])
            position[alive] -= self.lengths[own]
            alive = alive[position[alive] > base[alive]]
        owner, own, place = (np.concatenate(x) for x in (owners, ids, places))
        order = np.argsort(place)
        owner, own, place = owner[order], own[order], place[order]
        self._keep(segments, owner, own, found.points, place - 1 - owner)

    def _learn_long(self, segment: str):
        """A segment of any length, in blocks that are relaxed side by side.

        Each block begins some pieces early, as if a segment began there. What it finds is right if
        the last pieces found at the end of the block before agree over the length of the longest
        piece, as no edge reaches further back; else the block is relaxed again from those.
        """
        n, warm, longest = len(segment), self.warm, self.longest
        last = np.full(n + 1, -1, np.int32)
        begins = range(0, n, _BLOCK)
        for group in range(0, len(begins), _BLOCKS_AT_ONCE):
            own = begins[group : group + _BLOCKS_AT_ONCE]
            early = [max(0, b - warm) for b in own]
            found = self._relax([segment[e : b + _BLOCK] for e, b in zip(early, own, strict=True)])
            for i, (e, b) in enumerate(zip(early, own, strict=True)):
                at, size = int(found.base[i]), min(_BLOCK, n - b)
                here = at + b - e  # the place of the block's first character
                if e:
                    carried = last[b - longest + 1 : b + 1]
                    if not np.array_equal(found.last[here - longest + 1 : here + 1], carried):
                        found.last[here - longest + 1 : here + 1] = carried
                        start, piece, of, step = found.edges
                        mine = np.flatnonzero((of == i) & (step > b - e))
                        none = np.zeros(len(mine), bool)
                        self._extend(found.last, start[mine], piece[mine], step[mine], none)
                last[b + 1 : b + size + 1] = found.last[here + 1 : here + size + 1]
        places, length = [], self.lengths.tolist()
        place, ids = n, last.tolist()
        while place:
            places.append(place)
            place -= length[ids[place]]
        place = np.array(places[::-1], np.int64)
        points = np.frombuffer(segment.encode("utf-32-le", "surrogatepass"), "<u4")
        self._keep([segment], np.zeros(len(place), np.int64), last[place], points, place - 1)

    def _keep(self, segments, owner, own, points, point_at):
        unknown = np.flatnonzero(own == self.unknown)
        if len(unknown):  # a character without a piece becomes its bytes
            spelled = [
                self.v.byte_ids[list(chr(points[point_at[i]]).encode("utf-8", "replace"))]
                for i in unknown.tolist()
            ]
            many = np.ones(len(own), np.int64)
            many[unknown] = [len(x) for x in spelled]
            owner, slots = np.repeat(owner, many), np.cumsum(many) - many
            own = np.repeat(own, many)
            for i, x in zip(unknown.tolist(), spelled, strict=True):
                own[slots[i] : slots[i] + len(x)] = x
        counts = np.bincount(owner, minlength=len(segments))
        first = len(self.known)
        need = first + len(segments)
        if need > len(self.starts):
            self.starts = np.resize(self.starts, 2 * need)
            self.counts = np.resize(self.counts, 2 * need)
        if self.used + len(own) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + len(own)))
        self.flat[self.used : self.used + len(own)] = own
        self.counts[first:need] = counts
        self.starts[first:need] = self.used + np.cumsum(counts) - counts
        self.used += len(own)
        self.known.update(zip(segments, range(first, need), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in _parts(_MARK + text.replace(" ", _MARK)) if text else ():
                waiting.append((i, _SEGMENT.findall(part)))
                size += len(part)
                if size >= _TEXT_CHUNK:
                    self._encode(waiting, out)
                    waiting, size = [], 0
        self._encode(waiting, out)
        return [
            np.concatenate(x) if len(x) > 1 else x[0] if x else np.zeros(0, np.int32) for x in out
        ]

    def _encode(self, waiting, out):
        if len(self.known) > _KEPT or self.used > _KEPT_IDS:
            self._reset()
        known = self.known
        new = dict.fromkeys(
            chain.from_iterable(filterfalse(known.__contains__, segments) for _, segments in waiting)
        )
        if new:
            self._learn(list(new))
        for i, segments in waiting:
            own = np.fromiter(map(known.__getitem__, segments), np.int64, len(segments))
            counts = self.counts[own]
            ends = np.cumsum(counts)
            at = np.repeat(self.starts[own] - ends + counts, counts) + np.arange(ends[-1])
            out[i].append(self.flat[at])


@dataclass
class _Relaxed:
    points: np.ndarray
    base: np.ndarray
    lengths: np.ndarray
    last: np.ndarray
    edges: tuple[np.ndarray, ...]


def _parts(text: str):
    """The text in parts of bounded length, cut where segments end: at a line break, or before a
    mark that follows another character. A segment that is longer than a part stays whole."""
    at = 0
    while len(text) - at > _TEXT_CHUNK:
        cut = _last_border(text, at, at + _TEXT_CHUNK)
        if cut <= at:
            ahead = _BORDER.search(text, at + _TEXT_CHUNK)
            if ahead is None:
                break
            cut = ahead.end() - (ahead.group()[-1] == _MARK)
        yield text[at:cut]
        at = cut
    if at < len(text):
        yield text[at:]


def _last_border(text: str, low: int, high: int) -> int:
    cut = text.rfind(_MARK, low + 1, high)
    while cut > low and text[cut - 1] == _MARK:
        cut -= 1
    return max(cut, text.rfind("\n", low, high) + 1)


def _id_lists(lists: pa.Array):
    """One list of ids at a time, so a batch is never held as Python numbers."""
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    missing = lists.is_null().to_numpy(zero_copy_only=False)
    for a, b, null in zip(offsets[:-1].tolist(), offsets[1:].tolist(), missing.tolist(), strict=True):
        yield None if null else values[a:b].tolist()


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    """Text of a list of ids; one leading blank is that of the encoder and goes."""
    data = b"".join(map(vocabulary.decoded.__getitem__, ids))
    return data[data[:1] == b" " :].decode("utf-8", "replace")


class Pieces:
    """Encoding and decoding of columns with the model of a file."""

    def __init__(self, spark, path: str = MODEL_FILE):
        prepare_workers(spark)
        self.vocabulary = load(path)
        self._shared = spark.sparkContext.broadcast(self.vocabulary)

    def encode(self, text: Column) -> Column:
        """array<int> of piece ids; null for null, no ids for the empty text."""
        shared = self._shared

        @F.arrow_udf("array<int>")
        def encode_pieces(texts: pa.Array) -> pa.Array:
            given = texts.to_pylist()
            found = worker_state("pieces", shared, Encoder).encode([t or "" for t in given])
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in found], dtype=np.int64)])
            if len(found) and offsets[-1] >= 1 << 31:
                raise ValueError("a batch has too many pieces; lower the Arrow batch size")
            values = np.concatenate(found) if found else np.zeros(0, np.int32)
            missing = pa.array(np.array([t is None for t in given], bool))
            return pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)), pa.array(values, pa.int32()), mask=missing
            )

        # A deterministic function would be computed again by each user of its result.
        return encode_pieces.asNondeterministic()(text)

    def decode(self, ids: Column) -> Column:
        """Text of piece ids; null for null. Ids outside the vocabulary are an error."""
        shared = self._shared

        @F.arrow_udf("string")
        def decode_pieces(lists: pa.Array) -> pa.Array:
            vocabulary = shared.value
            return pa.array(
                (None if x is None else decode(x, vocabulary) for x in _id_lists(lists)),
                pa.string(),
            )

        return decode_pieces(ids)


def encode_documents(docs: DataFrame, text_col: str = "text", path: str = MODEL_FILE, ids_col: str = "piece_ids"):
    """``docs`` with the ids of each text in ``ids_col`` (replaced if it exists).

    Null texts have null ids, empty texts no ids; a text of any length is encoded whole. Rows are
    never moved or dropped, so repeated rows and an empty table come back as they are.
    """
    return docs.withColumn(ids_col, Pieces(docs.sparkSession, path).encode(column(text_col)))


def op1_sentencepiece(spark, sf_dir):
    """Ids of every document, as number and hash, and whether decoding gives the text again."""
    pieces = Pieces(spark)
    docs = table(spark, sf_dir, "documents")
    ids, again = fresh("ids"), fresh("again")
    encoded = docs.select("doc_id", "text", pieces.encode(F.col("text")).alias(ids))
    decoded = encoded.withColumn(again, pieces.decode(F.col(ids)))
    return decoded.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_pieces"),
        F.xxhash64(ids).alias("ids_hash"),
        F.col(again).eqNullSafe(F.replace("text", F.lit(_MARK), F.lit(" "))).alias("round_trip"),
    )
