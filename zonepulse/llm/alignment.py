"""Alignment of two tokenizers' tokens over the same bytes.

A text's tokens by tokenizer A and by tokenizer B both cover its bytes, so two ascending lists of byte ends describe how they
overlap. The lists are merged by merge path: the merge of lists of m and n ends is a path of m + n steps, and a binary
search on every ``PIECE``-th diagonal finds where it crosses, so pieces of equal work are merged on their own, wherever texts
begin and end, however long one is. A piece emits the overlaps and the cuts (offsets where tokens of both end) that it
sees; a group of tokens open at a piece's end is closed by the first cut of a later one when the pieces are stitched.

Counts of linked ids cover the whole corpus. The most frequent pairs, of a number that is fixed, are sent to all tasks; all
others are joined.
"""

import hashlib
import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_type

from zonepulse.llm.hashing import as_bytes, chunks
from zonepulse.llm.text import plain
from zonepulse.session import materialize

MARK = "\u2581"             # stands for a space in pieces
CACHE = 200_000             # words remembered by a worker, and as many from before
CHUNK = 1 << 18             # bytes of text encoded together; a longer text is a chunk of its own
PIECE = 1 << 16             # steps of a merge path merged at a time
PAIRS_HELD = 1 << 21        # different pairs counted in a task before they are handed on
HOT = 1 << 18               # pairs whose counts all tasks get


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 characters are themselves, the
    other bytes follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE of the tokenizers library, read from its JSON text."""

    def __init__(self, description: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"          # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.encode_special_tokens = True             # their strings in a text are plain text
        table, vocabulary = byte_of(), self.tokenizer.get_vocab()
        self.entries = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            known = all(c in table for c in entry)
            self.entries[i] = bytes(table[c] for c in entry) if known else entry.encode()
        parts = json.loads(description)
        before = parts["pre_tokenizer"] or {}
        # This pattern ends a pre-token before each space that stands between characters that aren't white space.
        self.by_word = not parts["normalizer"] and before.get("type") == "ByteLevel" and before.get("use_regex", True)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [code.ids for code in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: a sentencepiece model, which puts a space before each text itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_proto=model)
        self.entries, self.by_word = [], True
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            self.entries.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace(MARK, " ").encode())
            # Nothing is merged over a space if no piece holds one behind another character.
            self.by_word &= MARK not in piece.lstrip(MARK)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


Code = tuple[bytes, bytes, bool]


class Encoder:
    """Ids of both tokenizers. If neither merges over single spaces, each different word is encoded once.

    A word is what single spaces part: not empty, no white space at its ends. What stands between two spaces and isn't a word is
    encoded together with its neighbours, as one text.
    """

    def __init__(self, description: str, model: bytes):
        self.a, self.b = ByteLevel(description), Pieces(model)
        self.lengths = [np.array([len(e) for e in t.entries]) for t in (self.a, self.b)]
        self.digits = Digits(max(len(self.a.entries), len(self.b.entries)))
        self.by_word = self.a.by_word and self.b.by_word
        self.known: dict[str, Code] = {}
        self.older: dict[str, Code] = {}

    def whole(self, texts: list[str]) -> list[Code]:
        """(A ids, B ids, whether the bytes of both are a space and the text) of each text; ids as 32-bit integers."""
        data = [b" " + t.encode() for t in texts]
        wanted, every = np.array([len(d) for d in data], np.int64), b"".join(data)
        fine, out = np.ones(len(texts), bool), []
        for codes, entries, lengths in zip((self.a.encode(texts), self.b.encode(texts)), (self.a.entries, self.b.entries), self.lengths):
            stops = np.cumsum([len(x) for x in codes], dtype=np.int64)
            flat = np.fromiter(chain.from_iterable(codes), "<i4", int(stops[-1]) if len(stops) else 0)
            size = np.append(0, np.cumsum(lengths[flat]))[np.append(0, stops)]
            joined = b"".join(map(entries.__getitem__, flat.tolist()))
            same = np.diff(size) == wanted
            if joined != every or not same.all():
                ends = size.tolist()
                fine &= same & np.array([joined[x:y] == d for x, y, d in zip(ends, ends[1:], data)], bool)
            ids, ends = flat.tobytes(), (4 * np.append(0, stops)).tolist()
            out.append([ids[x:y] for x, y in zip(ends, ends[1:])])
        return list(zip(*out, fine.tolist()))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > CACHE:
            self.known, self.older = {w: self.known[w] for w in words if w in self.known}, self.known
        found = {w: self.older[w] for w in new if w in self.older}
        self.known.update(found)
        new = [w for w in new if w not in found]
        self.known.update(zip(new, self.whole(new)))

    def encode(self, texts: list[str]) -> list[Code]:
        if not self.by_word:
            return self.whole(texts)
        split = [t.split(" ") for t in texts]
        words = set().union(*split)
        odd = {w for w in words if not w or w[0].isspace() or w[-1].isspace()}
        if odd:
            for i, parts in enumerate(split):
                if not odd.isdisjoint(parts):
                    split[i] = _runs(parts)
            words = set().union(*split)
        self.learn(words)
        get, out = self.known.__getitem__, []
        for parts in split:
            a, b, fine = zip(*map(get, parts))
            out.append((b"".join(a), b"".join(b), False not in fine))
        return out


def _runs(parts: list[str]) -> list[str]:
    """Words on their own; others joined with the words beside them."""
    out, open_ = [], False
    for part in parts:
        word = bool(part) and not part[0].isspace() and not part[-1].isspace()
        if out and (open_ or not word):
            out[-1] += " " + part
        else:
            out.append(part)
        open_ = not word
    return out


class Tokens:
    """Ids of one tokenizer over several texts in a row: ``ids``, their byte ``ends``, and ``stops``, tokens up to each text's end."""

    def __init__(self, ids: list[bytes], lengths: np.ndarray):
        self.stops = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
        self.ids = np.frombuffer(b"".join(ids), "<i4").astype(np.int64)
        self.ends = np.cumsum(lengths[self.ids])


def crossings(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two strictly ascending lists crosses every ``piece``-th diagonal: (i, j) of each piece's start,
    and of the end. Of equal ends A's comes first; a piece that would end between them takes B's as well."""
    diagonal = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # Before the crossing stand those of A that are no greater than the last of B before it.
        before = np.zeros(len(diagonal), bool)
        before[open_] = a[middle[open_]] <= b[diagonal[open_] - middle[open_] - 1]
        low, high = np.where(open_ & before, middle + 1, low), np.where(open_ & ~before, middle, high)
    i, j = low, diagonal - low
    parted = (i > 0) & (j < len(b))
    parted[parted] = a[i[parted] - 1] == b[j[parted]]
    return i, j + parted


def pieces(a: np.ndarray, b: np.ndarray, piece: int = PIECE):
    """For each piece of the merge of byte ends: (A token, B token, from, to, cut) of the overlaps that end in it, as arrays.

    ``cut``: both tokens end with the overlap. Pieces don't need each other; the last end before a piece is all they share.
    """
    i, j = crossings(a, b, piece)
    for i0, i1, j0, j1 in zip(i, i[1:], j, j[1:]):
        left, right = a[i0:i1], b[j0:j1]
        ends = np.concatenate([left, right])
        ends.sort(kind="stable")                            # two ascending runs
        if len(ends):
            ends = ends[np.append(True, ends[1:] != ends[:-1])]
            x, y = np.searchsorted(left, ends), np.searchsorted(right, ends)
            before = max(a[i0 - 1] if i0 else 0, b[j0 - 1] if j0 else 0)
            in_a, in_b = (np.append(v, -1)[at] == ends for v, at in ((left, x), (right, y)))
            yield i0 + x, j0 + y, np.append(before, ends[:-1]), ends, in_a & in_b


def stitched(parts) -> tuple[np.ndarray, np.ndarray]:
    """(A tokens, B tokens) before the end of each group, from all pieces' cuts in order."""
    cuts = [(x[cut] + 1, y[cut] + 1) for x, y, _, _, cut in parts]
    empty = np.empty(0, np.int64)
    return np.concatenate([c[0] for c in cuts] or [empty]), np.concatenate([c[1] for c in cuts] or [empty])


class Digits:
    """Decimal strings of ids, written for many ids at once."""

    def __init__(self, most: int):
        self.width = len(str(most - 1))
        ids = np.arange(most)
        self.digits = np.stack([ids // 10 ** k % 10 + 48 for k in range(self.width - 1, -1, -1)], axis=1).astype(np.uint8)
        self.lengths = np.maximum(1, np.searchsorted(10 ** np.arange(1, self.width + 1), ids, "right") + 1)

    def written(self, ids: np.ndarray, marks: np.ndarray) -> bytes:
        """The ids, each followed by its mark."""
        table = np.concatenate([self.digits[ids], marks[:, None]], axis=1)
        return table[np.arange(self.width + 1) >= self.width - self.lengths[ids][:, None]].tobytes()


def group_strings(a: Tokens, b: Tokens, a_group: np.ndarray, b_group: np.ndarray, digits: Digits) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each text: ids of A and of B, group by group."""
    sizes = np.diff(a_group, prepend=0), np.diff(b_group, prepend=0)
    of_a, of_b = (np.repeat(np.arange(len(s)), s) for s in sizes)
    n = len(a.ids) + len(b.ids)
    ids, marks = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    at_a = np.arange(len(a.ids)) + np.append(0, b_group)[of_a]
    at_b = np.arange(len(b.ids)) + a_group[of_b]
    ids[at_a], ids[at_b] = a.ids, b.ids
    marks[at_a[a_group - 1]], marks[at_b[b_group - 1]] = ord("|"), ord(";")
    data = digits.written(ids, marks)
    ends = np.append(0, np.cumsum(digits.lengths[ids] + 1))[np.append(0, a.stops + b.stops)].tolist()
    return [data[x:y - 1] for x, y in zip(ends, ends[1:])]


@lru_cache(2)
def _encoder(description: str, model: bytes) -> Encoder:
    """A worker keeps it, and its words, between tasks."""
    return Encoder(description, model)


def _text(data: bytes) -> str:
    """The text; nothing if the bytes aren't UTF-8, as no tokens give them back."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        return ""


class Aligned:
    """Tokens and groups of several texts; ``fine``: the texts that have any."""

    def __init__(self, texts: list[bytes], description: str, model: bytes):
        encoder = _encoder(description, model)
        strings = [_text(t) for t in texts]
        codes = encoder.encode(strings)
        self.digits = encoder.digits
        self.fine = np.flatnonzero([bool(t) and right for t, (_, _, right) in zip(strings, codes)])
        self.a, self.b = (Tokens([codes[i][k] for i in self.fine], encoder.lengths[k]) for k in (0, 1))
        self.pieces = list(pieces(self.a.ends, self.b.ends))
        self.a_group, self.b_group = stitched(self.pieces)
        self.group_stops = np.searchsorted(self.a_group, self.a.stops) + 1      # a text's end is a cut

    def strings(self) -> list[bytes]:
        return group_strings(self.a, self.b, self.a_group, self.b_group, self.digits)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(A id, B id) of the tokens that end together; as many for a text as it has groups."""
        return self.a.ids[self.a_group - 1], self.b.ids[self.b_group - 1]


def _files(spark: SparkSession, byte_level: str, piece_model: str):
    """Both tokenizers' files for all tasks: a few megabytes."""
    with open(byte_level, encoding="utf-8") as text, open(piece_model, "rb") as data:
        return spark.sparkContext.broadcast((text.read(), data.read()))


def align_texts(df: DataFrame, byte_level: str, piece_model: str, text: str = "text") -> DataFrame:
    """``df`` with a_ids, b_ids, a_groups, b_groups, overlap_a, overlap_b, overlap_bytes (arrays of int).

    ``a_groups``, ``b_groups``: tokens of A and B before the end of each group; ``overlap_a``, ``overlap_b``: indices of two
    tokens that share ``overlap_bytes`` bytes of a space and the text, in order. Null and empty texts, and those whose
    tokens' bytes by A or B aren't a space and the text, have empty arrays. An empty frame gives no rows.
    """
    names = ("a_ids", "b_ids", "a_groups", "b_groups", "overlap_a", "overlap_b", "overlap_bytes")
    given = plain(df, *names)
    files = _files(df.sparkSession, byte_level, piece_model)
    schema = T.StructType([*given.schema, *(T.StructField(n, T.ArrayType(T.IntegerType())) for n in names)])
    at = given.columns.index(text)

    def lists(fine, n, values, stops):
        ends = np.zeros(n + 1, np.int64)
        ends[fine + 1] = np.diff(stops, prepend=0)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(ends), pa.int32()), pa.array(values.astype(np.int32)))

    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column(at))
            for x, y in chunks(texts, CHUNK):
                found, n = Aligned(texts[x:y], *files.value), y - x
                per = [found.a.stops, found.b.stops, found.group_stops]
                empty = np.empty(0, np.int64)
                over_a, over_b, begin, end, _ = (np.concatenate([p[k] for p in found.pieces] or [empty]) for k in range(5))
                stops = np.searchsorted(over_a, found.a.stops)
                # Indices and counts start anew with each text.
                def own(values, base, to):
                    return values - np.repeat(np.append(0, base)[:len(to)], np.diff(to, prepend=0))
                columns = [lists(found.fine, n, found.a.ids, per[0]), lists(found.fine, n, found.b.ids, per[1]),
                           lists(found.fine, n, own(found.a_group, per[0], per[2]), per[2]),
                           lists(found.fine, n, own(found.b_group, per[1], per[2]), per[2]),
                           lists(found.fine, n, own(over_a, per[0], stops), stops),
                           lists(found.fine, n, own(over_b, per[1], stops), stops), lists(found.fine, n, end - begin, stops)]
                yield pa.RecordBatch.from_arrays([*batch.slice(x, n).columns, *columns], names=schema.names)

    return given.mapInArrow(run, schema)


def _different(text: np.ndarray, pairs: np.ndarray):
    """(text, pair, times) of the different pairs of each text, ascending."""
    order = np.lexsort((pairs, text))
    text, pairs = text[order], pairs[order]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (pairs[1:] != pairs[:-1])])) if len(text) else order
    return text[first], pairs[first], np.diff(np.append(first, len(text)))


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending pairs and the sum of their counts."""
    pairs, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, at, np.concatenate([h[1] for h in held]))
    return pairs, counts


LONG = T.LongType()
DIGEST = [T.StructField(c, LONG) for c in ("n_a", "n_b", "n_groups")] + [T.StructField("groups_sha256", T.StringType())]


def _counted(df: DataFrame, byte_level: str, piece_model: str, key: str, text: str) -> DataFrame:
    """(row, key, n_a, n_b, n_groups, groups_sha256, pairs, times) of every text: its different linked ids, as
    A id << 32 | B id, and how often each occurs. Besides, (pair, n) as each task counts them, in rows of a null ``row``."""
    files = _files(df.sparkSession, byte_level, piece_model)
    schema = T.StructType([
        T.StructField("row", LONG), T.StructField("key", df.schema[key].dataType), *DIGEST, T.StructField("pairs", T.ArrayType(LONG)),
        T.StructField("times", T.ArrayType(LONG)), T.StructField("pair", LONG), T.StructField("n", LONG)])

    def run(batches):
        held, size, types = [], 0, None
        for batch in batches:
            texts = as_bytes(batch.column(2))
            for x, y in chunks(texts, CHUNK):
                found, n = Aligned(texts[x:y], *files.value), y - x
                a, b = found.links()
                per = np.diff(found.group_stops, prepend=0)
                of, pairs, times = _different(np.repeat(found.fine, per), a << 32 | b)
                held.append((pairs, times))
                size += len(pairs)
                if size > PAIRS_HELD:
                    held = [_merged(held)]
                    size = len(held[0][0])
                    if size > PAIRS_HELD // 2:
                        yield told(*held[0], types)
                        held, size = [], 0
                digests = [""] * n
                for i, s in zip(found.fine.tolist(), found.strings()):
                    digests[i] = hashlib.sha256(s).hexdigest()
                counts = np.zeros((3, n), np.int64)
                counts[:, found.fine] = [np.diff(t, prepend=0) for t in (found.a.stops, found.b.stops, found.group_stops)]
                ends = pa.array(np.searchsorted(of, np.arange(n + 1)), pa.int32())
                columns = [batch.column(0).slice(x, n), batch.column(1).slice(x, n), *map(pa.array, counts), pa.array(digests, pa.string()),
                           pa.ListArray.from_arrays(ends, pa.array(pairs)), pa.ListArray.from_arrays(ends, pa.array(times)),
                           pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())]
                types = [c.type for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        if held:
            yield told(*_merged(held), types)

    def told(pairs, counts, types):
        if types is None:       # before the first texts' rows
            types = [to_arrow_type(f.dataType) for f in schema]
        return pa.RecordBatch.from_arrays([*(pa.nulls(len(pairs), t) for t in types[:-2]), pa.array(pairs), pa.array(counts)],
                                          names=schema.names)

    return df.select(F.monotonically_increasing_id(), key, text).mapInArrow(run, schema)


def most_frequent(pairs: DataFrame, most: int = HOT) -> DataFrame:
    """At most ``most`` rows of (pair, n, best): all that occur at least as often as some bound, a power of 2 ** (1 / 8)."""
    step = F.floor(F.log2("n") * 8)
    total, bound = 0, None
    for row in pairs.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():         # at most 8 * 64 rows
        total += row["count"]
        if total > most:
            break
        bound = row["step"]
    return pairs.where(step >= bound) if bound is not None else pairs.limit(0)


def _looked_up(texts: DataFrame, hot, key_type: T.DataType) -> DataFrame:
    """``texts`` with n_best and count_sum of the links whose pairs are in ``hot`` (pairs, counts, best); the others as
    rare_pairs and rare_times."""
    sent = texts.sparkSession.sparkContext.broadcast(hot)
    names = ["row", "key", *(f.name for f in DIGEST)]
    schema = T.StructType([T.StructField("row", LONG), T.StructField("key", key_type), *DIGEST, T.StructField("n_best", LONG),
                           T.StructField("count_sum", LONG), T.StructField("rare_pairs", T.ArrayType(LONG)),
                           T.StructField("rare_times", T.ArrayType(LONG))])

    def run(batches):
        pairs, counts, best = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, times = (batch.column(k).flatten().to_numpy() for k in (6, 7))
            ends = np.append(0, np.cumsum(np.diff(batch.column(6).offsets.to_numpy())))
            at = np.minimum(np.searchsorted(pairs, codes), max(len(pairs) - 1, 0))
            known = pairs[at] == codes if len(pairs) else np.zeros(len(codes), bool)
            value, top = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
            value[known], top[known] = counts[at[known]] * times[known], best[at[known]] * times[known]
            sums = [np.diff(np.append(0, np.cumsum(v))[ends]) for v in (top, value)]
            rare = pa.array(np.append(0, np.cumsum(~known))[ends], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], *map(pa.array, sums), *(pa.ListArray.from_arrays(rare, pa.array(v[~known])) for v in (codes, times))],
                names=schema.names)

    return texts.select(*names, "pairs", "times").mapInArrow(run, schema)


def link_counts(df: DataFrame, byte_level: str, piece_model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``df``.

    A link is a token of A and a token of B that end together. ``count_sum`` sums, over a text's links, how many links of all
    texts have the same ids; ``n_best`` counts those of which no other A id is linked more often to their B id.
    ``groups_sha256``: digest of ``group_strings``. Texts without tokens (see ``align_texts``) have zeros and an empty string.
    Rows of equal or null keys are rows of their own. An empty frame gives no rows.
    """
    found = materialize(_counted(df, byte_level, piece_model, key, text), "aligned")
    totals = found.where(F.col("row").isNull()).groupBy("pair").agg(F.sum("n").alias("n"))
    totals = materialize(totals.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "pairs")
    highest = totals.groupBy("b").agg(F.max("n").alias("highest"))
    pairs = materialize(totals.join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).cast("bigint").alias("best")), "counts")
    hot = most_frequent(pairs).toPandas().sort_values("pair")               # at most HOT rows of 24 bytes
    hot = tuple(hot[c].to_numpy(np.int64) for c in ("pair", "n", "best"))
    texts = materialize(_looked_up(found.where(F.col("row").isNotNull()), hot, df.schema[key].dataType), "looked-up")
    rare = (texts.select("row", F.explode(F.arrays_zip("rare_pairs", "rare_times")).alias("r"))
            .select("row", F.col("r.rare_pairs").alias("pair"), F.col("r.rare_times").alias("times")).join(pairs, "pair")
            .groupBy("row").agg(F.sum(F.col("best") * F.col("times")).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more")))
    return texts.join(rare, "row", "left").select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
