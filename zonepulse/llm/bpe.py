"""Byte-level BPE: encoding texts to token ids, and back.

Pre-tokens are found without a regex; which code points are letters, numbers or white space is read off the library
whose ids are to be equalled, once a worker, so it doesn't hang on Python's Unicode version. Every character gets a symbol from its class and the next two
characters; a symbol acts on the scanner's eight states as a function, and such functions compose
associatively. All functions that can arise are numbered once with their composition table, so a
block scan over numbers gives the state at each character of a whole batch of texts: within all
blocks at once, then over the blocks' totals. Text starts reset the state. Pre-tokens are then byte
slices, encoded through a cache of pair merges. Each token's byte offset is kept; decoding places the tokens' bytes there.

A null text is an empty text and has no tokens. Equal texts get equal ids; texts of any length are
read whole; an empty frame gives no rows; other columns pass through unchanged.
"""

import base64
import functools
import heapq
import sys
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, types as T

from zonepulse.llm.text import plain
from zonepulse.llm.workers import keeps, tidied

CHUNK = 1 << 18             # bytes scanned together; a longer text is a chunk of its own
ROWS = 256                  # decoded together
CACHE = 200_000             # pre-tokens remembered by a worker; then it starts anew
BLOCK = 128
LONG = 48                   # bytes; longer pre-tokens are merged one by one
NO_PAIR = 1 << 40

# Character classes.
LETTER, NUMBER, SPACE, BLANK, MARK = range(5)       # BLANK: white space other than U+0020
CLASS_PATTERNS = {LETTER: r"\p{L}", NUMBER: r"\p{N}", BLANK: r"\s"}
SURROGATES = range(0xD800, 0xE000)      # in no text
# Symbols: LETTER and NUMBER as above, a space or blank before a visible character, white space before
# more of it or the end, a mark, an apostrophe that starts a suffix of two or of three characters.
LAST_SPACE, LAST_BLANK, MID_WHITE, PLAIN, SUFFIX2, SUFFIX3 = range(2, 8)
# States: nothing open, in letters, in numbers, in marks, after a joining space, in white space, one or two
# characters of a suffix to come.
FRESH, LETTERS, NUMBERS, MARKS, JOINING, WHITES, ONE_LEFT, TWO_LEFT = range(8)
SYMBOLS, STATES = 8, 8


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a pre-token starts at this character)."""
    if state == TWO_LEFT:
        return ONE_LEFT, False
    if state == ONE_LEFT:
        return FRESH, False
    if symbol == LETTER:
        return LETTERS, state not in (LETTERS, JOINING)
    if symbol == NUMBER:
        return NUMBERS, state not in (NUMBERS, JOINING)
    if symbol == LAST_SPACE:
        return JOINING, True
    if symbol == LAST_BLANK:
        return FRESH, True
    if symbol == MID_WHITE:
        return WHITES, state != WHITES
    if state in (MARKS, JOINING):
        return MARKS, False
    return {PLAIN: MARKS, SUFFIX2: ONE_LEFT, SUFFIX3: TWO_LEFT}[symbol], True


def character_classes() -> np.ndarray:
    """The class of each code point.

    With the single bytes as its ranks and a class as its pattern, the library encodes just the characters of that class
    of a text: here a text of all characters.
    """
    single = {bytes([b]): b for b in range(256)}
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if c not in SURROGATES)
    kinds = np.full(sys.maxunicode + 1, MARK, np.uint8)
    for kind, pattern in CLASS_PATTERNS.items():
        found = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        kinds[np.frombuffer(bytes(found).decode().encode("utf-32-le"), np.uint32)] = kind
    kinds[ord(" ")] = SPACE
    return kinds


@functools.cache
def _tables():
    """(classes by code point, starts[state, symbol], composition[f, g], action[f, state],
    function of each symbol, function of each symbol at a text's start, identity)."""
    kinds = character_classes()
    starts = np.array([[_step(s, x)[1] for x in range(SYMBOLS)] for s in range(STATES)])
    plain = [tuple(_step(s, x)[0] for s in range(STATES)) for x in range(SYMBOLS)]
    first = [(_step(FRESH, x)[0],) * STATES for x in range(SYMBOLS)]
    found = {tuple(range(STATES)): 0}
    todo = list(found)
    for f in todo:                                   # closure under composition with a symbol
        for g in plain + first:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                todo.append(h)
    action = np.array(list(found), np.uint8)
    composition = np.array([[found[tuple(g[s] for s in f)] for g in found] for f in found], np.int32)
    number = lambda fs: np.array([found[f] for f in fs], np.int32)
    return kinds, starts, composition, action, number(plain), number(first), 0


def _scan(functions: np.ndarray, composition: np.ndarray, identity: int) -> np.ndarray:
    """Inclusive composition of all functions up to each place."""
    n = len(functions)
    if n <= BLOCK:
        out, total = np.empty(n, np.int32), identity
        for i, f in enumerate(functions):
            out[i] = total = composition[total, f]
        return out
    rows = -(-n // BLOCK)
    padded = np.full(rows * BLOCK, identity, np.int32)
    padded[:n] = functions
    columns = np.ascontiguousarray(padded.reshape(rows, BLOCK).T)
    flat, width = composition.ravel(), len(composition)
    total = columns[0]
    for j in range(1, BLOCK):
        total = columns[j] = flat[total * width + columns[j]]
    before = np.empty(rows, np.int32)
    before[0] = identity
    before[1:] = _scan(total, composition, identity)[:-1]
    return flat[before[None, :] * width + columns].T.ravel()[:n]


def pre_token_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Places of the first characters of all pre-tokens of texts laid end to end.

    ``points``: code points; ``text_starts``: ascending places where a text begins.
    """
    kinds, starts, composition, action, plain, first, identity = _tables()
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = kinds[points]
    begins = np.zeros(n, bool)
    begins[text_starts[text_starts < n]] = True
    more = np.append(~begins[1:], False)             # the next character is of the same text
    following = np.append(kind[1:], MARK)
    white = (kind == SPACE) | (kind == BLANK)
    visible_next = more & (following != SPACE) & (following != BLANK)
    symbol = np.where(kind == MARK, PLAIN, kind).astype(np.uint8)
    symbol[white] = MID_WHITE
    symbol[white & visible_next & (kind == SPACE)] = LAST_SPACE
    symbol[white & visible_next & (kind == BLANK)] = LAST_BLANK
    apostrophes = np.flatnonzero(points == ord("'"))
    if len(apostrophes):
        padded = np.append(points, [0, 0])
        one = np.where(more[apostrophes], padded[apostrophes + 1], 0)
        two = np.where((one > 0) & np.append(more, False)[apostrophes + 1], padded[apostrophes + 2], 0)
        symbol[apostrophes[np.isin(one, [ord(c) for c in "stmd"])]] = SUFFIX2
        three = functools.reduce(np.logical_or, ((one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")))
        symbol[apostrophes[three]] = SUFFIX3
    states = action[_scan(np.where(begins, first[symbol], plain[symbol]), composition, identity), FRESH]
    before = np.append(FRESH, states[:-1])
    before[begins] = FRESH
    return np.flatnonzero(starts[before, symbol])


class Vocabulary(dict):
    """Pre-token → its ids as little-endian unsigned 32-bit integers, as far as learnt; ids are ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)

        single = np.zeros(256, np.int64)
        for token, rank in ranks.items():
            if len(token) == 1:
                single[token[0]] = rank
        self.single = single
        self.size = size

    @functools.cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(sorted keys of mergeable pairs of ids, ranks they merge to); decoding needs none."""
        ranks = self.ranks
        found = sorted((ranks[token[:i]] * self.size + ranks[token[i:]], rank) for token, rank in ranks.items()
                       for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks)
        return (np.array([k for k, _ in found] + [self.size ** 2], np.int64),
                np.array([r for _, r in found] + [NO_PAIR], np.int64))

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each merged pair of ids; ``NO_PAIR`` where it is no token or an id is absent (-1)."""
        keys = np.where((left < 0) | (right < 0), -1, left * self.size + right)
        known, ranks = self.pairs
        at = np.searchsorted(known, keys)
        return np.where(known[at] == keys, ranks[at], NO_PAIR)

    def learn(self, pieces: set[bytes]) -> None:
        """Adds the ids of pre-tokens that aren't known yet."""
        new = {p for p in pieces if p not in self}
        if len(self) + len(new) > CACHE:
            self.clear()
            new = pieces
        by_length: dict[int, list[bytes]] = {}
        for piece in new:
            rank = self.ranks.get(piece)
            if rank is not None:
                self[piece] = rank.to_bytes(4, "little")
            elif len(piece) > LONG:
                self[piece] = np.array(merge_long(piece, self.ranks), "<u4").tobytes()
            else:
                by_length.setdefault(len(piece), []).append(piece)
        for length, group in by_length.items():
            ids = self.merged(np.frombuffer(b"".join(group), np.uint8).reshape(-1, length))
            counts = (ids >= 0).sum(axis=1).tolist()
            rows = ids.astype("<u4").tobytes()
            for i, (piece, n) in enumerate(zip(group, counts)):
                self[piece] = rows[i * length * 4:(i * length + n) * 4]

    def merged(self, raw: np.ndarray) -> np.ndarray:
        """Ids of pre-tokens of one length (rows of bytes), filled up with -1.

        In each round every row merges its leftmost adjacent pair of lowest rank, until none has one.
        """
        n, length = raw.shape
        done = np.full((n, length), -1, np.int64)
        ids = np.column_stack([self.single[raw], np.full(n, -1)])       # a last column to shift in
        ranks = np.column_stack([self.pair(ids[:, :-1], ids[:, 1:]), np.full(n, NO_PAIR)])
        rows, column = np.arange(n), np.arange(length + 1)
        while len(rows):
            best = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            value = ranks[each, best]
            ended = value == NO_PAIR
            if ended.any():
                done[rows[ended]] = ids[ended, :length]
                rows, ids, ranks, best, value = (x[~ended] for x in (rows, ids, ranks, best, value))
                each = np.arange(len(rows))
            if not len(rows):
                break
            later = column > best[:, None]
            source = np.minimum(column + later, length)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[each, best] = value
            ids[:, length] = -1
            ranks = np.take_along_axis(ranks, np.minimum(column + (column >= best[:, None]), length), axis=1)
            ranks[each, best] = self.pair(value, ids[each, np.minimum(best + 1, length)])
            left = best > 0
            ranks[each[left], best[left] - 1] = self.pair(ids[each[left], best[left] - 1], value[left])
        return done

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> bytes:
        """The bytes of tokens at their offsets (ascending; the first is taken as the origin)."""
        if not len(ids):
            return b""
        lengths = self.lengths[ids]
        inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out = np.empty(int(offsets[-1] - offsets[0] + lengths[-1]), np.uint8)
        out[np.repeat(offsets - offsets[0], lengths) + inside] = self.blob[np.repeat(self.places[ids], lengths) + inside]
        return out.tobytes()


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one long pre-token: merges in the same order, with a heap of pairs (n log n)."""
    n = len(piece)
    end, left = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i):
        if i >= 0 and end[i] and end[i] < n:
            stop = end[end[i]]
            rank = ranks.get(piece[i:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, i, stop))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not end[i] or end[i] >= n or end[end[i]] != stop:
            continue                                    # one of the pair has been merged meanwhile
        end[end[i]], end[i] = 0, stop
        if stop < n:
            left[stop] = i
        offer(i)
        offer(left[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


_VOCABULARIES: dict[int, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """Of a rank file's content; a worker keeps it, and its cache, between tasks of this module."""
    key = zlib.crc32(content)
    keeps(__name__, _VOCABULARIES.clear)
    if key not in _VOCABULARIES:
        pairs = (line.split() for line in content.splitlines() if line)
        _VOCABULARIES[key] = Vocabulary({base64.b64decode(t): int(r) for t, r in pairs})
    return _VOCABULARIES[key]


def encode_texts(texts: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """Ids of each UTF-8 text."""
    data = b"".join(texts)
    raw = np.frombuffer(data, np.uint8)
    byte_of = np.flatnonzero((raw & 0xC0) != 0x80)              # first byte of each character
    points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), "<u4")
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths) - lengths                       # in bytes
    starts = byte_of[pre_token_starts(points, np.searchsorted(byte_of, begins))]
    edges = [*starts.tolist(), len(data)]
    pieces = [data[a:b] for a, b in zip(edges, edges[1:])]
    vocab.learn(set(pieces))
    coded = list(map(vocab.__getitem__, pieces))
    first = np.searchsorted(starts, np.append(begins, len(data))).tolist()
    return [np.frombuffer(b"".join(coded[a:b]), "<u4") for a, b in zip(first, first[1:])]


def _chunks(sizes: list[int]):
    """Slices of about ``CHUNK`` bytes: (from, to)."""
    begin, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > CHUNK:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(sizes):
        yield begin, len(sizes)


def _lists(arrays: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(arrays).astype(kind)))


def encode(df: DataFrame, ranks: str, text: str = "text", ids: str = "ids", offsets: str = "offsets") -> DataFrame:
    """``df`` without ``text``, with its token ``ids`` (array<int>) and their byte ``offsets`` (array<int>)."""
    content = df.sparkSession.sparkContext.broadcast(read_ranks(ranks))      # about a megabyte
    df = plain(df, ids, offsets)

    def run(batches):
        vocab = vocabulary(content.value)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
            rest = batch.drop_columns([text])
            for a, b in _chunks(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
                coded = encode_texts([t or b"" for t in column.slice(a, b - a).to_pylist()], vocab)
                places = [np.cumsum(n) - n for n in (vocab.lengths[c] for c in coded)]
                part = rest.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(coded, np.int32), _lists(places, np.int32)],
                                                 names=[*part.schema.names, ids, offsets])

    kept = [f for f in df.schema if f.name != text]
    schema = T.StructType([*kept, T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(offsets, T.ArrayType(T.IntegerType()))])
    return df.mapInArrow(tidied(run, owner=__name__), schema)


def _rows(column: pa.Array) -> list[np.ndarray]:
    values, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def decode(df: DataFrame, ranks: str, ids: str = "ids", offsets: str = "offsets", into: str = "decoded",
           id_bytes: str | None = None) -> DataFrame:
    """``df`` with the bytes that its ids stand for (binary) in place of the offsets.

    With ``id_bytes``, also the ids as little-endian unsigned 32-bit integers (binary), in place of the array.
    """
    content = df.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    gone = {offsets, into, id_bytes} | ({ids} if id_bytes else set())
    kept = [f for f in df.schema if f.name not in gone]
    made = [into] + [id_bytes] * bool(id_bytes)

    def run(batches):
        vocab = vocabulary(content.value)
        for batch in (whole.slice(i, ROWS) for whole in batches for i in range(0, whole.num_rows, ROWS)):
            at = batch.schema.get_field_index
            coded, places = _rows(batch.column(at(ids))), _rows(batch.column(at(offsets)))
            columns = [pa.array([vocab.decode(i, o) for i, o in zip(coded, places)], pa.binary())]
            if id_bytes:
                columns.append(pa.array([i.astype("<u4").tobytes() for i in coded], pa.binary()))
            yield pa.RecordBatch.from_arrays([*(batch.column(at(f.name)) for f in kept), *columns],
                                             names=[*(f.name for f in kept), *made])

    return df.mapInArrow(tidied(run, owner=__name__), T.StructType([*kept, *(T.StructField(m, T.BinaryType()) for m in made)]))
