"""Toxicity by class-conditional Kneser-Ney models of how words are spelt.

Toxic and ordinary texts each get a model that spells a word character by character to its end, with everything
before in the word as context. Discounted counts of one class back off to continuation counts shared by both (how many
beginnings end in three characters), so a spelling seen in neither class says nothing, and one seen once little: discounts for counts of
one, two and more come from the counts of counts (Chen and Goodman, 1999). A text is compared by its
log-likelihood ratio per word, in all and over those words that lean clearly to the toxic side; a
logistic curve, fitted on texts whose own words the models had not seen, turns these into a score.

Counts come from all labelled rows. Words are dealt out once, by their first two characters, and stored packed, a row a bucket; a task makes the
trie of a bucket's labelled words and walks the words asked for through it, so neither beginnings nor contexts become rows. What stands above the
second character is one row a first character. Only the three-feature curve is fitted on at most
``FIT_ROWS`` rows of each class, chosen by a hash of their key. The ratios of the ``COMMON`` most frequent labelled words of up to
``COMMON_LENGTH`` characters are broadcast, and so are the beginnings of as many characters as make ``NODES`` nodes at most: a word
that leaves the trie, or ends, within these has its ratio at once. All other words are asked for where their trie is: each task packs the
different ones of some texts by bucket, and the answers go back to these texts.
"""

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from zonepulse.llm.hashing import mix
from zonepulse.llm.jaccard_join import bitmap_of, passed, place
from zonepulse.llm.text import plain
from zonepulse.llm.workers import tidied
from zonepulse.session import materialize, without_shuffle_files

FIT_ROWS = 3_000            # labelled rows of each class on which the curve is fitted
CAUTION = 3.0               # a missed toxic text weighs as much as this many ordinary ones dropped
LEAN = 3.0                  # a word's log ratio from which it leans clearly
COMMON = 1 << 16            # words whose ratios every task gets
COMMON_LENGTH = 64          # characters of such a word
NODES = 1 << 21             # beginnings whose ratios every task gets, 16 bytes each
LEVELS = 64                 # characters of such a beginning
SLICE = 1 << 18             # characters of texts summed together; a longer text alone
PAIRED = 1 << 22            # characters of texts whose pairs of words are gathered before they are sent
SPREAD = 8                  # buckets of a word's pairs
BUCKETS = 64                # tries, for each shuffle partition
ASKED = 1 << 22             # characters of texts whose other words are asked for together
WALKED = 1 << 16            # words walked together
KINDS = 128                 # kinds of characters that shared counts tell apart
BOTH = 2                    # the model of all rows; 0 and 1 are those of the halves
MODELS = ((0, 1), (2, 3), (0, 1, 2, 3))     # columns of counts (half, class) that make up each model, even ones ordinary
LABEL_BITS = 21             # a code point
END = ord("$")              # behind a word's last character; never in a word
WORD = re.compile(r"\w+")


def found_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def count_words(train: DataFrame, text: str) -> DataFrame:
    """(word, c00, c01, c10, c11): after how many different words it occurs, by half and class; a word of a passage that
    many texts repeat counts once."""
    return partial_counts(train, text).groupBy("word").agg(*(F.sum(c).alias(c) for c in COUNTS))


def partial_counts(train: DataFrame, text: str) -> DataFrame:
    """As ``count_words``, in parts: a word has several rows, whose counts add up.

    Different pairs of a word and the one before it are dealt out by their hashes, a word's to ``SPREAD`` buckets at most. They travel
    as sorted, packed lists: one row from a task to a bucket for every ``PAIRED`` characters, with the lists of all halves and classes.
    """
    buckets = 2 * int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def send(batches):
        found, size = [set() for _ in COUNTS], 0
        for batch in batches:
            for of, t in zip(*(c.to_pylist() for c in batch.columns)):
                words = found_words(t)
                found[of].update(map(" ".join, zip(words, ["", *words])))
                size += len(t or "")
                if size >= PAIRED:
                    yield packed(found)
                    found, size = [set() for _ in COUNTS], 0
        yield packed(found)

    def packed(found):
        dealt = [[[] for _ in COUNTS] for _ in range(buckets)]
        for of, pairs in enumerate(found):
            for pair in sorted(pairs):
                word = pair.partition(" ")[0]
                dealt[(crc32(word.encode()) + crc32(pair.encode()) % SPREAD) % buckets][of].append(pair)
        used = [k for k, x in enumerate(dealt) if any(x)]
        lists = ["\r".join(map("\n".join, dealt[k])).encode() for k in used]
        return pa.RecordBatch.from_arrays([
            pa.array(used, pa.int32()), pa.array(map(len, lists), pa.int64()),
            pa.array([pa.compress(x, "zstd", asbytes=True) for x in lists], pa.binary())], names=["bucket", "size", "pairs"])

    def meet(batches):
        current, found = None, [set() for _ in COUNTS]
        for batch in batches:
            for bucket, size, pairs in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != current:
                    yield counted(found)
                    current, found = bucket, [set() for _ in COUNTS]
                for mine, some in zip(found, pa.decompress(pairs, size, "zstd", asbytes=True).decode().split("\r")):
                    mine.update(some.split("\n") if some else ())
        yield counted(found)

    def counted(found):
        times = [Counter([p.partition(" ")[0] for p in pairs]) for pairs in found]
        words = list(set().union(*times))
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *(pa.array([n[w] for w in words], pa.int64()) for n in times)],
                                          names=["word", *COUNTS])

    of = (2 * F.col("_half") + F.col("_toxic")).cast("int")
    sent = train.select(of.alias("_of"), text).mapInArrow(tidied(send), "bucket int, size long, pairs binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(meet), COUNTED)


COUNTS = ["c00", "c01", "c10", "c11"]
COUNTED = "word string, " + ", ".join(f"{c} long" for c in COUNTS)


def kind_of(points: np.ndarray) -> np.ndarray:
    """Kinds of characters: 0 stands before a word, 1 behind it, a to z and so on have their own, rare ones share theirs."""
    out = 94 + points % 34
    out = np.where((points >= 0x80) & (points < 0x250), 30 + points % 64, out)
    out = np.where((points >= 97) & (points <= 122), points - 95, out)
    out = np.where((points >= 48) & (points <= 57), 28, out)
    return np.where(points == 95, 29, np.where(points == END, 1, out))


class Trie:
    """Beginnings of words as nodes, level by level; node 0 is the empty one. ``keys``: (parent, character) of node i + 1."""

    def __init__(self, points: np.ndarray, lengths: np.ndarray, counts: np.ndarray):
        begin = np.cumsum(lengths) - lengths
        at, active = np.zeros(len(lengths), np.int64), np.arange(len(lengths))
        levels, self.counts, nodes = [], [counts.sum(axis=0, keepdims=True)], 1
        for depth in range(int(lengths.max(initial=0))):
            active = active[lengths[active] > depth]
            keys, place = np.unique(at[active] << LABEL_BITS | points[begin[active] + depth], return_inverse=True)
            sums = np.zeros((len(keys), counts.shape[1]))
            np.add.at(sums, place, counts[active])
            at[active] = nodes + place
            nodes += len(keys)
            levels.append(keys)
            self.counts.append(sums)
        self.depths = np.repeat(np.arange(len(levels) + 1), [1, *map(len, levels)])
        self.keys, self.counts = np.concatenate([np.empty(0, np.int64), *levels]), np.concatenate(self.counts)
        self.parent, self.char = self.keys >> LABEL_BITS, self.keys & ((1 << LABEL_BITS) - 1)

    def trigrams(self) -> np.ndarray:
        """Of each node but the empty one: its last three kinds of characters in one number."""
        kind = np.concatenate([[0], kind_of(self.char)])
        one = np.concatenate([[0], kind[self.parent]])
        two = np.concatenate([[0], one[self.parent]])
        return ((two * KINDS + one) * KINDS + kind)[1:]

    def by_model(self) -> np.ndarray:
        """(node, model, class) counts."""
        return np.stack([np.stack([self.counts[:, [c for c in m if c % 2 == k]].sum(axis=1) for k in (0, 1)], axis=1) for m in MODELS], axis=1)


def points_of(words: pa.Array, end: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, each followed by ``END``; lengths with it)."""
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    text = "".join(w + "$" for w in words.to_pylist())
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64), lengths


FLOORS = (0.999, 1.6, 2.0)   # least discounts: most words of labelled texts occur once or twice by chance


def discounts(of_counts: np.ndarray) -> np.ndarray:
    """What is taken of counts of 0, 1, 2 and more, by how many beginnings are counted once to four times in a class; ``FLOORS``
    at least."""
    n1, n2, n3, n4 = np.maximum(of_counts, 0.5)
    y = n1 / (n1 + 2 * n2)
    found = np.array([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.append(0.0, np.clip(found, FLOORS, (0.999, 1.9, 2.9)))


def shared_chances(times: np.ndarray) -> np.ndarray:
    """Kneser-Ney chance of the third kind of character behind two others, from how many beginnings end so."""
    def lower(counts, below):
        seen, after = (counts > 0).sum(axis=-1, keepdims=True), counts.sum(axis=-1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            found = (np.maximum(counts - 0.75, 0) + 0.75 * seen * below) / after
        return np.where(after > 0, found, below)

    two = (times > 0).sum(axis=0)
    one = (two > 0).sum(axis=0)
    return lower(times, lower(two, (one + 1) / (one.sum() + KINDS))[None])


@dataclass
class Top:
    """What no single bucket knows: first characters, their counts, and of each how many second characters are counted once, twice, oftener."""

    chars: np.ndarray       # ascending
    counts: np.ndarray      # (character, model, class)
    kinds: np.ndarray       # (character, model, class, 3)


@dataclass
class Shared:
    """``top``, shared chances (``KINDS`` cubed) and discounts by class, for tasks. Most pairs of kinds never occur, and all of one second
    kind have the same chances: these travel once."""

    top: Top
    chances: np.ndarray
    discount: np.ndarray

    def __iter__(self):
        return iter((self.top, self.chances, self.discount))

    def __getstate__(self):
        rows: dict[bytes, int] = {}
        places = [rows.setdefault(row.tobytes(), len(rows)) for row in self.chances.reshape(-1, KINDS)]
        return self.top, b"".join(rows), np.array(places, np.int32), self.discount

    def __setstate__(self, state):
        self.top, rows, places, self.discount = state
        self.chances = np.frombuffer(rows).reshape(-1, KINDS)[places].ravel()


@dataclass
class Spelling:
    """Labelled words with their counts, and what all tasks get: ``top``, shared chances (``KINDS`` cubed), discounts by class.

    ``packed``: a row for each of at most ``buckets`` buckets. ``levels``: how many beginnings have 0, 1, … ``LEVELS`` characters (0 for the
    first two, which ``top`` has)."""

    packed: DataFrame
    buckets: int
    top: Top
    shared: np.ndarray
    discount: np.ndarray
    levels: np.ndarray

    @property
    def words(self) -> DataFrame:
        return unpack(self.packed)

    @cached_property
    def sent(self) -> Broadcast:
        """One broadcast for all that use it: each has a file in the driver and on every executor."""
        return self.packed.sparkSession.sparkContext.broadcast(Shared(self.top, self.shared, self.discount))


def _bucket(many: int) -> Column:
    return F.pmod(F.crc32(F.expr("left(concat(word, '$'), 2)")), F.lit(many)).cast("int").alias("bucket")


def bucket_of(word: str, many: int) -> int:
    """As ``_bucket``."""
    return crc32((word + "$")[:2].encode()) % many


PACKED = "bucket int, n long, size long, words binary, counts binary"


def pack(words: DataFrame, many: int) -> DataFrame:
    """A row for each bucket: its ``n`` words, in ``size`` bytes, and the sums of their counts. A word may have several rows."""
    summed = (words.select(_bucket(many), "word", *COUNTS).repartition("bucket")
              .groupBy("bucket", "word").agg(*(F.sum(c).alias(c) for c in COUNTS)).sortWithinPartitions("bucket", "word"))

    def run(batches):
        for bucket, _, table in _parts(batches):
            data = "\n".join(table["word"].to_pylist()).encode()
            counts = np.stack([table[c].to_numpy() for c in COUNTS], axis=1).tobytes()
            yield pa.RecordBatch.from_arrays([
                pa.array([bucket], pa.int32()), pa.array([table.num_rows]), pa.array([len(data)]),
                *(pa.array([pa.compress(x, "zstd", asbytes=True)], pa.binary()) for x in (data, counts))],
                names=["bucket", "n", "size", "words", "counts"])

    return summed.select("bucket", F.lit(0).alias("side"), "word", *COUNTS).mapInArrow(tidied(run), PACKED)


def _words_in(size: int, words: bytes) -> pa.Array:
    return pa.array(pa.decompress(words, size, "zstd", asbytes=True).decode().split("\n"), pa.string())


def _unpacked(n: int, size: int, words: bytes, counts: bytes) -> tuple[pa.Array, np.ndarray]:
    """Words and their counts (word, column)."""
    data = pa.decompress(counts, 8 * len(COUNTS) * n, "zstd", asbytes=True)
    return _words_in(size, words), np.frombuffer(data, np.int64).reshape(n, len(COUNTS))


def _each(batches):
    """(words, counts) of each packed row."""
    for batch in batches:
        for row in zip(*(batch.column(c) for c in ("n", "size", "words", "counts"))):
            yield _unpacked(*(x.as_py() for x in row))


def unpack(packed: DataFrame) -> DataFrame:
    """(word, c00, c01, c10, c11)"""
    def run(batches):
        for words, counts in _each(batches):
            yield pa.RecordBatch.from_arrays([words, *map(pa.array, np.ascontiguousarray(counts.T))], names=["word", *COUNTS])

    return packed.mapInArrow(tidied(run), COUNTED)


def _top(words: DataFrame) -> Top:
    sums = [F.sum(c).alias(c) for c in COUNTS]
    second = words.groupBy(F.expr("left(concat(word, '$'), 2)").alias("two")).agg(*sums)
    columns = []
    for m, parts in enumerate(MODELS):
        for k in (0, 1):
            n = sum((F.col(COUNTS[c]) for c in parts if c % 2 == k), F.lit(0))
            columns += [F.sum(n).alias(f"n{m}{k}"), *(F.count_if(n == i if i < 3 else n >= 3).alias(f"k{m}{k}{i}") for i in (1, 2, 3))]
    found = second.groupBy(F.expr("left(two, 1)").alias("one")).agg(*columns).toPandas()        # one row a character
    found["point"] = [ord(c) for c in found["one"]]
    found = found.sort_values("point")
    values = found[[c for c in found.columns if c not in ("one", "point")]].to_numpy(float).reshape(-1, 3, 2, 4)
    return Top(found["point"].to_numpy(np.int64), values[..., 0], values[..., 1:])


def _parts(batches):
    """(bucket, side, table) of neighbouring rows; words asked for come in parts of at most ``WALKED``."""
    held, key, size = [], None, 0
    for batch in batches:
        bucket, side = (batch.column(k).to_numpy() for k in (0, 1))
        cuts = np.flatnonzero((bucket[1:] != bucket[:-1]) | (side[1:] != side[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            if b > a:
                now = int(bucket[a]), int(side[a])
                if held and (now != key or now[1] and size >= WALKED):
                    yield *key, pa.Table.from_batches(held).combine_chunks()
                    held, size = [], 0
                key = now
                held.append(batch.slice(a, b - a))
                size += b - a
    if held:
        yield *key, pa.Table.from_batches(held).combine_chunks()


def _trie(words: pa.Array, counts: np.ndarray) -> Trie:
    return Trie(*points_of(words), counts.astype(float))


def learn(words: DataFrame) -> Spelling:
    """Shared chances and discounts of all beginnings of ``words``, which are stored packed; a word may have several rows."""
    many = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")) * BUCKETS
    packed = materialize(pack(words, many), "spelling")
    top = _top(unpack(packed))

    def run(batches):
        trigrams, of_counts, levels = Counter(), np.zeros((2, 4)), np.zeros(LEVELS + 1, np.int64)
        for some in _each(batches):
            trie = _trie(*some)
            deep = trie.depths[1:] >= 2
            trigrams.update(dict(zip(*(x.tolist() for x in np.unique(trie.trigrams()[deep], return_counts=True)))))
            levels += np.bincount(np.minimum(trie.depths[1:][deep], LEVELS), minlength=LEVELS + 1)
            both = trie.by_model()[1:][deep, BOTH]
            for k in (0, 1):
                of_counts[k] += [(both[:, k] == i).sum() for i in (1, 2, 3, 4)]
        cells = list(trigrams.items()) + [(-1 - 4 * k - i, n) for k in (0, 1) for i, n in enumerate(of_counts[k].tolist())]
        cells += [(-9 - d, n) for d, n in enumerate(levels.tolist()) if n]
        yield pa.RecordBatch.from_arrays([pa.array([int(c) for c, _ in cells], pa.int64()), pa.array([int(n) for _, n in cells], pa.int64())],
                                         names=["cell", "n"])

    found = (packed.mapInArrow(tidied(run), "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toPandas())       # at most KINDS ** 3 rows
    cell, n = found["cell"].to_numpy(np.int64), found["n"].to_numpy(float)
    times = np.zeros(KINDS ** 3)
    times[cell[cell >= 0]] = n[cell >= 0]
    np.add.at(times, kind_of(top.chars), 1)                                 # beginnings of one character
    below = np.zeros(9 + LEVELS)
    below[-1 - cell[cell < 0]] = n[cell < 0]
    of_counts, levels = below[:8], below[8:]
    return Spelling(packed, many, top, shared_chances(times.reshape((KINDS,) * 3)).ravel(),
                    np.stack([discounts(of_counts[:4]), discounts(of_counts[4:])]), levels)


def node_ratios(trie: Trie, top: Top, shared: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log ratio of reading each node's character, by model; log ratio of any other character behind each node, by model)."""
    n = trie.by_model()
    one = trie.depths == 1
    first = np.searchsorted(top.chars, trie.char[one[1:]])
    n[one] = top.counts[first]
    n[0] = top.counts.sum(axis=0)
    def taken(counts):      # (…, class)
        return np.stack([discount[k][np.minimum(counts[..., k], 3).astype(int)] for k in (0, 1)], axis=-1)
    below = np.zeros_like(n)
    np.add.at(below, trie.parent, taken(n[1:]))
    weights = discount[:, 1:]
    below[one] = (top.kinds[first] * weights).sum(axis=-1)
    below[0] = taken(top.counts).sum(axis=0)
    left = np.where(n > 0, below / np.maximum(n, 1), 1.0)
    parent, back = trie.parent, shared[trie.trigrams()][:, None, None]
    mine = np.where(n[parent] > 0, (n[1:] - taken(n[1:])) / np.maximum(n[parent], 1), 0.0)
    chance = np.maximum(mine, 0) + left[parent] * back
    ratio = np.log(chance[..., 1] / chance[..., 0])
    other = np.where(left > 0, left, 1.0)           # nothing follows the end of a word
    return np.concatenate([np.zeros((1, 3)), ratio]), np.log(other[..., 1] / other[..., 0])


class Walk:
    """Ratios of words that begin as a bucket's labelled words do; without any, no labelled word begins so."""

    def __init__(self, shared: "Shared", words: pa.Array | None = None, counts: np.ndarray | None = None):
        self.shared = shared
        if words is None:
            self.trie = _trie(pa.array([], pa.string()), np.zeros((0, len(COUNTS))))
            self.trie.counts = np.zeros((1, len(COUNTS)))
        else:
            self.trie = _trie(words, counts)
        self.ratio, self.other = node_ratios(self.trie, *shared)

    def ratios(self, words: pa.Array, model: np.ndarray) -> np.ndarray:
        trie, ratio, other = self.trie, self.ratio, self.other
        points, lengths = points_of(words)
        begin, at, total = np.cumsum(lengths) - lengths, np.zeros(len(lengths), np.int64), np.zeros(len(lengths))
        active = np.arange(len(lengths))
        for depth in range(int(lengths.max(initial=0))):
            active = active[lengths[active] > depth]
            if not len(active):
                break
            wanted = at[active] << LABEL_BITS | points[begin[active] + depth]
            place = np.minimum(np.searchsorted(trie.keys, wanted), max(len(trie.keys) - 1, 0))
            found = trie.keys[place] == wanted if len(trie.keys) else np.zeros(len(active), bool)
            if depth == 0 and not found.all():
                # A first character that other buckets know still counts, and what can follow it.
                top = self.shared.top
                lost = active[~found]
                char = points[begin[lost]]
                spot = np.minimum(np.searchsorted(top.chars, char), max(len(top.chars) - 1, 0))
                seen = top.chars[spot] == char if len(top.chars) else np.zeros(len(lost), bool)
                alone = top_ratios(*self.shared)
                total[lost[seen]] += (alone[0] + alone[1])[spot[seen], model[lost[seen]]]
                total[lost[~seen]] += other[0, model[lost[~seen]]]
            elif depth:
                total[active[~found]] += other[at[active[~found]], model[active[~found]]]
            active, place = active[found], place[found]
            at[active] = place + 1
            total[active] += ratio[place + 1, model[active]]
        return total


def word_ratios(words: DataFrame, spelling: Spelling) -> DataFrame:
    """``words`` (model, word, n) with ``ratio``: log-likelihood under the toxic model minus that under the ordinary model.

    Behind a beginning that was never counted both classes read the same shared counts, so the rest of the word adds nothing.
    """
    shared = spelling.sent

    def run(batches):
        walk, known = None, None
        for bucket, side, table in _parts(batches):
            if known != bucket:
                walk, known = None, bucket
            if side == 0:
                walk = Walk(shared.value, *next(_each(table.to_batches())))
                continue
            walk = walk or Walk(shared.value)
            total = walk.ratios(table["word"].combine_chunks(), table["model"].to_numpy())
            yield pa.RecordBatch.from_arrays([*(table[c].combine_chunks() for c in ("model", "word", "asked")), pa.array(total)],
                                             names=["model", "word", "n", "ratio"])

    def no(*typed):
        return [F.lit(None).cast(t).alias(c) for c, _, t in (x.partition(" ") for x in typed)]

    known = spelling.packed.select("bucket", F.lit(0).alias("side"), "n", "size", "words", "counts", *no("model bigint", "word string", "asked bigint"))
    asked = words.select(_bucket(spelling.buckets), F.lit(1).alias("side"), *no("n bigint", "size bigint", "words binary", "counts binary"),
                         F.col("model").cast("bigint"), "word", F.col("n").cast("bigint").alias("asked"))
    return (known.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "side")
            .mapInArrow(tidied(run), "model long, word string, n long, ratio double"))


def top_ratios(top: Top, shared: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``node_ratios``, for the beginnings of one character."""
    trie = Trie(top.chars, np.ones(len(top.chars), np.int64), np.zeros((len(top.chars), 4)))
    ratio, other = node_ratios(trie, top, shared, discount)
    return ratio[1:], other[1:]


def _spelt(before: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Hash of a beginning with one more character."""
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + points.astype(np.uint64) + np.uint64(1))


@dataclass
class Shallow:
    """Ratios under the model of all rows of words that go on otherwise behind a known beginning, or end there.

    ``depth``: characters of the longest beginnings; ``hashes`` ascend; ``none``: of words with an unknown first character.
    """

    depth: int
    hashes: np.ndarray
    values: np.ndarray
    none: float

    def ratios(self, words: list[str]) -> dict[str, float]:
        """Of the words that leave the known beginnings, or end, within ``depth`` characters."""
        found = {}
        for at in range(0, len(words), WALKED):
            some = words[at:at + WALKED]
            points, lengths = points_of(pa.array(some, pa.string()))
            begin, reach = np.cumsum(lengths) - lengths, np.minimum(lengths, self.depth)
            hashes = np.zeros((int(reach.max()) + 1, len(some)), np.uint64)
            for d in range(1, len(hashes)):
                hashes[d] = _spelt(hashes[d - 1], points[begin + np.minimum(d, lengths) - 1])
            each, low, high = np.arange(len(some)), np.zeros(len(some), np.int64), reach.copy()
            value = np.full(len(some), self.none)
            while len(open_ := np.flatnonzero(low < high)):         # every beginning of a known one is known
                middle = (low[open_] + high[open_] + 1) // 2
                wanted = hashes[middle, each[open_]]
                place = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
                known = self.hashes[place] == wanted
                low[open_[known]], high[open_[~known]] = middle[known], middle[~known] - 1
                value[open_[known]] = self.values[place[known]]
            sure = np.flatnonzero((low < reach) | (low == lengths))
            found.update(zip([some[i] for i in sure.tolist()], value[sure].tolist()))
        return found


def shallow(spelling: Spelling, most: int = NODES) -> Shallow:
    """The beginnings of as many characters as make ``most`` nodes at most, and all first characters."""
    depth = max(int(np.searchsorted(np.cumsum(spelling.levels[:LEVELS]), most, side="right")) - 1, 1)
    shared = spelling.sent

    def run(batches):
        for some in _each(batches):
            trie = _trie(*some)
            hashes, values = _behind(trie, *shared.value)
            wanted = (trie.depths >= 2) & (trie.depths <= depth)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[wanted].view(np.int64)), pa.array(values[wanted])], names=["hash", "value"])

    rows = spelling.packed.mapInArrow(tidied(run), "hash long, value double").toArrow()         # at most ``most`` rows
    top = spelling.top
    first = Trie(top.chars, np.ones(len(top.chars), np.int64), np.zeros((len(top.chars), 4)))
    hashes, values = _behind(first, top, spelling.shared, spelling.discount)
    whole = np.concatenate([rows["hash"].to_numpy().view(np.uint64), hashes[1:]])
    order = np.argsort(whole)
    return Shallow(depth, whole[order], np.concatenate([rows["value"].to_numpy(), values[1:]])[order], float(values[0]))


def frequent(spelling: Spelling) -> dict[str, float]:
    """Ratios of the ``COMMON`` most frequent labelled words of at most ``COMMON_LENGTH`` characters."""
    often = (spelling.words.where(F.length("word") <= COMMON_LENGTH).orderBy(F.desc(sum(map(F.col, COUNTS))), "word").limit(COMMON))
    context, shared = spelling.packed.sparkSession.sparkContext, spelling.sent
    wanted = context.broadcast([r["word"] for r in often.select("word").collect()])         # at most COMMON rows

    def run(batches):
        names = pa.array(wanted.value, pa.string())
        for words, counts in _each(batches):
            some = words.filter(pc.is_in(words, names))
            if len(some):
                total = Walk(shared.value, words, counts).ratios(some, np.full(len(some), BOTH))
                yield pa.RecordBatch.from_arrays([some, pa.array(total)], names=["word", "ratio"])

    found = dict(map(tuple, spelling.packed.mapInArrow(tidied(run), "word string, ratio double").collect()))
    wanted.destroy()
    return found


def _behind(trie: Trie, top: Top, shared: np.ndarray, discount: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each node: hash of its beginning; log ratio of a word that goes on otherwise behind it or, at ``END``, ends."""
    ratio, other = (r[:, BOTH] for r in node_ratios(trie, top, shared, discount))
    hashes, total = np.zeros(len(trie.depths), np.uint64), np.zeros(len(trie.depths))
    edges = np.searchsorted(trie.depths, np.arange(1, trie.depths[-1] + 2))
    for a, b in zip(edges, edges[1:]):
        parent = trie.parent[a - 1:b - 1]
        hashes[a:b] = _spelt(hashes[parent], trie.char[a - 1:b - 1])
        total[a:b] = total[parent] + ratio[a:b]
    ended = np.append(False, trie.char == END)
    return hashes, total + np.where(ended, 0.0, other)


def _slices(texts: list):
    """Neighbouring texts of about ``SLICE`` characters together."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t or "") > SLICE:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield held


class _Numbers(dict):
    """Numbers of words, from 0 by first occurrence."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Reader:
    """Sums over texts of the ratios that are known, and the other words. Each different word is looked up once."""

    def __init__(self, known: dict[str, float], beginnings: Shallow | None):
        self.known, self.beginnings = known, beginnings
        self.numbers, self.ratio, self.place = _Numbers(), np.empty(0), np.empty(0, np.int64)
        self.rest: list[str] = []       # words without a known ratio

    def read(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(number of words, sum of the known ratios, sum of what leans, (place in ``rest``, times) of the other words) of each text. Nothing
        but the text decides in which order ratios are added."""
        of = [found_words(t) for t in texts]
        before, n = len(self.numbers), np.array([len(words) for words in of], np.int64)
        at = np.fromiter((i for words in of for i in map(self.numbers.__getitem__, words)), np.int64, int(n.sum()))
        self._learn(list(islice(self.numbers, before, None)))
        text, ratio, place = np.repeat(np.arange(len(of)), n), self.ratio[at], self.place[at]
        total, leaning = (np.bincount(text, v, len(of)).astype(float) for v in (ratio, np.maximum(ratio - LEAN, 0.0)))
        other = np.flatnonzero(place >= 0)
        different, first, times = np.unique(text[other] << 32 | place[other], return_index=True, return_counts=True)
        order = np.argsort(first)
        different, times = different[order], times[order]
        ends = np.searchsorted(different >> 32, np.arange(len(of) + 1)).tolist()
        places = different & ((1 << 32) - 1)
        return n, total, leaning, [(places[a:b], times[a:b]) for a, b in zip(ends, ends[1:])]

    def _learn(self, new: list[str]) -> None:
        found = [self.known.get(w) for w in new]
        open_ = [w for w, r in zip(new, found) if r is None]
        more = self.beginnings.ratios(open_) if self.beginnings and open_ else {}
        found = [more.get(w) if r is None else r for w, r in zip(new, found)]
        lost = np.array([r is None for r in found], bool)
        place = np.where(lost, len(self.rest) + np.cumsum(lost) - 1, -1)
        self.rest += [w for w, r in zip(new, found) if r is None]
        self.ratio = np.append(self.ratio, np.array([0.0 if r is None else r for r in found], float))
        self.place = np.append(self.place, place)


def _all_words(text: Column) -> Column:
    """Of a text: number of words, and how often it holds each."""
    @F.pandas_udf("n long, rest map<string, long>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        words = [found_words(t) for t in texts.tolist()]
        return pd.DataFrame([(len(x), dict(Counter(x))) for x in words], columns=["n", "rest"])
    return counted(text)


def _added(rest: DataFrame, ratios: DataFrame, *keys: str) -> DataFrame:
    """Sums over the words (keys, _at, word, _n) that ``_summed`` left; ``_at`` counts from 0 in each text, and equal texts of
    one key count once."""
    texts = F.count_if(F.col("_at") == 0)
    return rest.join(ratios, [c for c in ("model", "word") if c in rest.columns]).groupBy(*keys).agg(
        (F.sum(F.col("_n") * F.col("ratio")) / texts).alias("_total"),
        (F.sum(F.col("_n") * F.greatest(F.col("ratio") - LEAN, F.lit(0.0))) / texts).alias("_leaning"))


TOLD = "_chunk long, _bucket int, _n long, _size long, _total double, _leaning double, _words binary, _at binary"


def _asking(df: DataFrame, kept: list[str], text: str, ratios: Broadcast, many: int) -> DataFrame:
    """``kept`` columns of every row with its number of words, sums of ratios, and which other words, by their number in its chunk (_at), it
    holds how often (_words). Besides, in rows that have a ``_bucket``: that bucket's words of a chunk, packed, and their numbers.

    A chunk is neighbouring texts of one task, about ``ASKED`` characters. ``ratios``: of words, and of beginnings (``Shallow``).
    """
    own = df.select(*kept).schema
    at_text = own.names.index(text) if text in own.names else len(own)      # sent once
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in own), *T.StructType.fromDDL(TOLD)])

    def run(batches):
        chunk, reader, size, types = TaskContext.get().partitionId() << 33, Reader(*ratios.value), 0, None
        for batch in batches:
            texts, begin = batch.column(at_text).to_pylist(), 0
            for some in _slices(texts):
                read, total, leaning, rest = reader.read(some)
                n = len(some)
                times, at = (pa.array([r[k].astype("<i4").tobytes() for r in rest], pa.binary()) for k in (1, 0))
                columns = [*batch.slice(begin, n).columns[:len(own)], pa.array([chunk] * n, pa.int64()), pa.nulls(n, pa.int32()),
                           pa.array(read), pa.nulls(n, pa.int64()), pa.array(total), pa.array(leaning), times, at]
                types = [c.type for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                begin, size = begin + n, size + sum(len(t or "") for t in some)
                if size >= ASKED:
                    yield from asked(reader.rest, chunk, types)
                    chunk, reader, size = chunk + 1, Reader(*ratios.value), 0
        yield from asked(reader.rest, chunk, types)

    def asked(rest, chunk, types):
        dealt = {}
        for i, word in enumerate(rest):
            dealt.setdefault(bucket_of(word, many), []).append((word, i))
        if dealt:
            n, lists = len(dealt), ["\n".join([w for w, _ in x]).encode() for x in dealt.values()]
            columns = [pa.array([chunk] * n, pa.int64()), pa.array([*dealt], pa.int32()), pa.array([len(x) for x in dealt.values()], pa.int64()),
                       pa.array([len(x) for x in lists], pa.int64()), pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64()),
                       pa.array([pa.compress(x, "zstd", asbytes=True) for x in lists], pa.binary()),
                       pa.array([np.array([i for _, i in x], "<i4").tobytes() for x in dealt.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays([*(pa.nulls(n, t) for t in types[:len(own)]), *columns], names=schema.names)

    return df.select(*kept, *([F.col(text).alias("_text")] if at_text == len(own) else [])).mapInArrow(tidied(run), schema)


def _answers(told: DataFrame, spelling: Spelling) -> DataFrame:
    """(_chunk, _at, _words): numbers of words in a chunk and their ratios, a row for each list that was asked for."""
    shared = spelling.sent

    def run(batches):
        current, walk, held, size = None, None, [], 0
        for batch in batches:
            for bucket, side, n, length, words, more, chunk in zip(*batch.columns):
                bucket, n = bucket.as_py(), n.as_py()
                if held and (bucket != current or size >= WALKED):
                    yield answered(walk, held)
                    held, size = [], 0
                if bucket != current:
                    current, walk = bucket, None
                if side.as_py() == 0:
                    walk = Walk(shared.value, *_unpacked(n, length.as_py(), words.as_py(), more.as_py()))
                    continue
                walk = walk or Walk(shared.value)
                held.append((chunk.as_py(), more.as_py(), _words_in(length.as_py(), words.as_py())))
                size += n
        if held:
            yield answered(walk, held)

    def answered(walk, held):
        words = pa.concat_arrays([h[2] for h in held]).dictionary_encode()
        values = walk.ratios(words.dictionary, np.full(len(words.dictionary), BOTH))[words.indices.to_numpy()]
        ends = np.cumsum([len(h[2]) for h in held])[:-1]
        return pa.RecordBatch.from_arrays([
            pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.binary()),
            pa.array([v.tobytes() for v in np.split(values, ends)], pa.binary())], names=["_chunk", "_at", "_words"])

    known = spelling.packed.select("bucket", F.lit(0).alias("side"), "n", "size", "words", "counts", F.lit(None).cast("bigint").alias("chunk"))
    asked = told.where(F.col("_bucket").isNotNull()).select(
        F.col("_bucket").alias("bucket"), F.lit(1).alias("side"), F.col("_n").alias("n"), F.col("_size").alias("size"),
        F.col("_words").alias("words"), F.col("_at").alias("counts"), F.col("_chunk").alias("chunk"))
    return (known.unionByName(asked).repartition("bucket").sortWithinPartitions("bucket", "side")
            .mapInArrow(tidied(run), "_chunk long, _at binary, _words binary"))


def _answered(told: DataFrame, answers: DataFrame) -> DataFrame:
    """The rows of texts with ``_n``, ``_total``, ``_leaning`` of all their words."""
    own = [f for f in told.schema if not f.name.startswith("_")]
    schema = T.StructType([*own, *T.StructType.fromDDL("_n long, _total double, _leaning double")])

    def run(batches):
        values, of = np.empty(0), None
        for chunk, side, table in _parts(batches):
            at, more = (b"".join(table[c].to_pylist()) for c in ("_at", "_words"))
            at = np.frombuffer(at, "<i4")
            if side == 0:
                values, of = np.empty(len(at)), chunk
                values[at] = np.frombuffer(more)
                continue
            if len(at):
                assert of == chunk
            lengths = pc.binary_length(table["_at"]).to_numpy() // 4
            ratio, times, row = values[at], np.frombuffer(more, "<i4"), np.repeat(np.arange(len(lengths)), lengths)
            total, leaning = (np.bincount(row, times * v, len(lengths)).astype(float) for v in (ratio, np.maximum(ratio - LEAN, 0.0)))
            columns = [*(table[f.name] for f in own), table["_n"], pa.array(table["_total"].to_numpy() + total),
                       pa.array(table["_leaning"].to_numpy() + leaning)]
            yield from pa.table(columns, names=schema.names).to_batches()

    texts = told.where(F.col("_bucket").isNull()).select(
        "_chunk", F.lit(1).alias("_side"), "_at", "_words", "_n", "_total", "_leaning", *(f"`{f.name}`" for f in own))
    found = answers.select("_chunk", F.lit(0).alias("_side"), "_at", "_words", *(
        F.lit(None).cast(texts.schema[c].dataType).alias(c) for c in texts.columns[4:]))
    return (found.unionByName(texts).repartition("_chunk").sortWithinPartitions("_chunk", "_side")
            .mapInArrow(tidied(run), schema))


def features(n: Column, total: Column, leaning: Column) -> tuple[Column, Column, Column]:
    """Mean log ratio per word; that of clearly leaning words, per root of the words and summed (log)."""
    n = F.greatest(n, F.lit(1))
    return total / n, leaning / F.sqrt(n), F.log1p(leaning)


def fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> tuple:
    """(means, scales, coefficients with the intercept last) of a ridge logistic regression, by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    penalty = np.diag([*[ridge] * x.shape[1], 1e-3])
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (weight * (y - p)) - penalty @ beta
        step = np.linalg.solve((z.T * (weight * p * (1 - p))) @ z + penalty, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta


@dataclass
class Model:
    spark: SparkSession
    spelling: Spelling | None       # none without rows of both classes
    curve: tuple

    def score(self, text: str | None) -> float:
        return score(self.spark.createDataFrame([(text,)], "text string"), self).first()["score"]


def labelled(labels: DataFrame, key: str, label: str) -> DataFrame:
    """(key, toxic, half) of each labelled key; null keys or labels are left out."""
    clean = (labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
             .groupBy(key).agg(F.max(F.col(label)).cast("int").alias("_toxic")))       # a key labelled twice: toxic if once
    return clean.withColumn("_order", F.xxhash64(F.col(key), F.lit(7))).withColumn("_half", F.pmod("_order", F.lit(2)).cast("int"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        rows: int = FIT_ROWS) -> Model:
    """A model of the labelled documents (class 1 against 0).

    Spelling counts come from all labelled rows. The curve is fitted on ``rows`` of each class at most, least hashes first, on
    ratios by models of the other half, the classes weighted as among all labels with toxic ones ``CAUTION``-fold. Without
    rows of both classes scores are 0.
    """
    spark = docs.sparkSession
    keys = materialize(labelled(labels, key, label), "labels")      # stored, so that Spark knows its size in joins
    halves = [keys.where(F.col("_toxic") == c).orderBy("_order", key).limit(rows) for c in (0, 1)]
    picked = halves[0].unionByName(halves[1])
    context = spark.sparkContext
    sample = materialize(docs.select(key, text).join(F.broadcast(picked), key)      # at most 2 * rows keys
                         .select("_toxic", (1 - F.col("_half")).alias("model"), _all_words(F.col(text)).alias("_sums")),
                         "sample")
    if sample.select("_toxic").distinct().count() < 2:
        return Model(spark, None, (np.zeros(3), np.ones(3), np.array([0.0, 0.0, 0.0, -30.0])))
    # Texts of other documents stay where they are: a bitmap of hashed keys, of fixed size, goes to all tasks. Some may pass it too.
    packed = context.broadcast(bitmap_of(keys.select(F.col(key).alias("doc"))))

    @F.pandas_udf("boolean")
    def suspect(places: pd.Series) -> pd.Series:
        return pd.Series(passed(packed.value, places.to_numpy(np.int64)))

    near = docs.select(key, text).where(F.col(key).isNotNull()).where(suspect(place(key)))
    train = near.join(keys.select(key, "_toxic", "_half"), key)
    spelling = learn(partial_counts(train, text))
    packed.destroy()                                                # nothing reads ``train`` again
    sample = sample.withColumn("_id", F.monotonically_increasing_id())
    held = materialize(sample.select("_id", "model", F.posexplode("_sums.rest").alias("_at", "word", "_n")), "sample-words")
    asked = held.groupBy("model", "word").agg(F.sum("_n").alias("n"))
    sums = _added(held, word_ratios(asked, spelling).select("model", "word", "ratio"), "_id")
    zero = F.lit(0.0)
    with without_shuffle_files(spark):
        found = np.array(sample.join(sums, "_id", "left").select("_toxic", *features(
            F.col("_sums.n"), F.coalesce("_total", zero), F.coalesce("_leaning", zero))).collect(), float)      # three numbers a row
    x, y = found[:, 1:], found[:, 0]
    size = {c: n for c, n in labels.where(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    weight = np.where(y > 0, CAUTION * size.get(1, 1) / y.sum(), size.get(0, 1) / (1 - y).sum())
    return Model(spark, spelling, fit_curve(x, y, weight * len(y) / weight.sum()))


def score(df: DataFrame, model: Model, text: str = "text", into: str = "score", keep_text: bool = True) -> DataFrame:
    """``df``, without its text unless ``keep_text``, with a score of 0 to 1 (higher: toxic likelier). Null and empty texts get the score of a text
    without words; equal texts equal scores; an empty frame gives no rows; columns that begin with an underscore are dropped."""
    mean, scale, beta = model.curve
    df = plain(df, into)
    kept = [f"`{c}`" for c in df.columns if c != into and (keep_text or c != text)]
    if model.spelling is None:
        return df.select(*kept, F.lit(1 / (1 + math.exp(-float(beta[-1])))).alias(into))
    common = df.sparkSession.sparkContext.broadcast((frequent(model.spelling), shallow(model.spelling)))
    told = materialize(_asking(df, kept, text, common, model.spelling.buckets), "word-sums")
    out = _answered(told, _answers(told, model.spelling))
    total, leaning = F.col("_total"), F.col("_leaning")
    z = F.lit(float(beta[-1]))
    for i, value in enumerate(features(F.col("_n"), total, leaning)):
        z = z + float(beta[i]) * (value - float(mean[i])) / float(scale[i])
    scored = out.withColumn(into, 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))))
    return scored.select(*kept, into)


def held_out(key: Column) -> Column:
    """Whether the CRC-32 of the key as text is divisible by five."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0
