"""Token ids on disk: Parquet with one list of ids per document, in ascending key order.

Encoding runs after a range shuffle of the texts, so each task writes one ordered run of documents
straight to shared storage. The id lists are dictionary encoded (ids repeat) in pages and row
groups of set sizes; keys and counts are delta encoded by the version 2 writer, and page indexes let a filter on the
sorted key skip pages. Counts and places are columns of their own, so they are read without any ids.
"""

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonepulse.llm.hashing import as_bytes, chunks, hashed_words

END_ID = 1
WORD_END = "</w>"           # of vocabulary entries that end a word
MARKS = ".,;:!?*$%&#|"      # no letters, digits or apostrophes
TOGETHER = 1000             # words encoded as one text
CACHE = 600_000             # words remembered by a worker (some 40 bytes each), and as many from before
CHUNK = 1 << 20             # bytes encoded together; a longer text is a chunk of its own
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}
LETTER, MARK, OTHER, GAP = range(4)     # bytes
KINDS = np.array([LETTER if chr(b).isalpha() and b < 128 else MARK if chr(b) in MARKS else GAP if b == 32 else OTHER
                  for b in range(256)], np.uint8)


def only_letters(word: str) -> bool:
    """Letters alone, also once the tokenizer has composed and lower-cased them."""
    return word.isascii() and word.isalpha() or unicodedata.normalize("NFC", word).lower().isalpha() and word.isalpha()


class Codes:
    """Ids of words by the words' hashes, as sorted arrays."""

    def __init__(self):
        self.hashes, self.starts, self.sizes = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash; -1: not there."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1)

    def taken(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words at these places in a row, number of each)."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(total)], sizes

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """Words that aren't there yet."""
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate([self.ids, ids])
        whole = np.concatenate([self.hashes, hashes])
        order = np.argsort(whole, kind="stable")
        self.hashes = whole[order]
        self.starts = np.concatenate([self.starts, starts])[order]
        self.sizes = np.concatenate([self.sizes, sizes])[order]


class Encoder:
    """Ids of texts by a tokenizer that never looks across white space: different words are encoded once, and remembered by hash.

    Punctuation after a word of letters is a pre-token of its own. Special tokens' strings inside a
    text are special tokens, as the library has it; ``literal_special``: ordinary text.
    """

    def __init__(self, description: str, literal_special: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.encode_special_tokens = literal_special
        self.codes, self.older = Codes(), Codes()
        pieces = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(pieces.values()) + 1, bool)
        self.closing[[i for piece, i in pieces.items() if piece.endswith(WORD_END)]] = True

    def _words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of words one by one."""
        return [np.array(c.ids, np.int32) for c in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _together(self, blob: bytes, ends: np.ndarray, closings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of each word) of plain words in UTF-8 with a space behind each.

        ``ends``: bytes up to a word's end with its space; ``closings``: pre-tokens of each. Many are encoded as one text, cut at
        the tokens that end a pre-token.
        """
        ids, sizes, begin = [], [], 0
        for at in range(0, len(ends), TOGETHER):
            some = closings[at:at + TOGETHER]
            end = int(ends[at + len(some) - 1])
            text, begin = blob[begin:end - 1].decode("utf-8"), end
            found = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            cuts = np.flatnonzero(self.closing[found]) + 1
            if len(cuts) == some.sum():
                ids.append(found)
                sizes.append(np.diff(cuts[np.cumsum(some) - 1], prepend=0))
            else:                                   # a tokenizer that cuts words otherwise
                each = self._words(text.split(" "))
                ids += each
                sizes.append(np.array([len(e) for e in each], np.int64))
        return (np.concatenate(ids), np.concatenate(sizes)) if ids else (np.empty(0, np.int32), np.empty(0, np.int64))

    def learn(self, raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order of the words, their ids in that order, number of each): words of ASCII letters with marks behind them
        first, then other words of letters, then the rest."""
        lengths = last - first + 1                  # with a space
        ends = np.cumsum(lengths)
        begins = ends - lengths
        bytes_ = raw[np.minimum(np.repeat(first - begins, lengths) + np.arange(ends[-1]), len(raw) - 1)]
        bytes_[ends - 1] = 0x20
        kinds = KINDS[bytes_]
        broken = kinds == OTHER
        broken[:-1] |= (kinds[:-1] == MARK) & (kinds[1:] == LETTER)
        plain = (kinds[begins] == LETTER) & ~np.logical_or.reduceat(broken, begins)
        marked = kinds[ends - 2] == MARK
        ids, sizes = self._together(bytes_[np.repeat(plain, lengths)].tobytes(), np.cumsum(lengths[plain]), 1 + marked[plain])
        blob = bytes_.tobytes()
        letters, rest = [], []
        for i in np.flatnonzero(~plain).tolist():
            word = blob[begins[i]:ends[i] - 1].decode("utf-8", "replace")
            base = word.rstrip(MARKS)
            (letters if base and only_letters(base) else rest).append((i, word, len(base) < len(word)))
        coded = [word.encode() + b" " for _, word, _ in letters]
        more = self._together(b"".join(coded), np.cumsum([len(c) for c in coded]), np.array([1 + m for *_, m in letters], np.int64))
        each = self._words([word for _, word, _ in rest])
        order = np.concatenate([np.flatnonzero(plain), np.array([i for i, *_ in letters + rest], np.int64)])
        return (order, np.concatenate([ids, more[0], *each]),
                np.concatenate([sizes, more[1], np.array([len(e) for e in each], np.int64)]))

    def remember(self, hashes: np.ndarray, raw: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The places in ``codes`` of different words, given by hash and by where one of each lies."""
        if len(self.codes.hashes) > CACHE:
            self.codes, self.older = Codes(), self.codes
        new = np.flatnonzero(self.codes.find(hashes) < 0)
        if len(new):
            old = self.older.find(hashes[new])
            known, new = new[old >= 0], new[old < 0]
            self.codes.add(hashes[known], *self.older.taken(old[old >= 0]))
        if len(new):
            order, ids, sizes = self.learn(raw, first[new], last[new])
            self.codes.add(hashes[new[order]], ids, sizes)
        return self.codes.find(hashes)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with the end id behind it; ids of each text)."""
        data = b"\n".join(texts)
        hashes, first, last = hashed_words(data)
        at = np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        different, place, which = np.unique(hashes, return_index=True, return_inverse=True)
        places = self.remember(different, np.frombuffer(data, np.uint8), first[place], last[place])
        words, length = self.codes.taken(places[which])
        before = np.append(0, np.cumsum(length))
        counts = np.diff(before[at]) + 1
        ids, inside = np.full(int(counts.sum()), END_ID, np.int32), np.ones(int(counts.sum()), bool)
        inside[np.cumsum(counts) - 1] = False
        ids[inside] = words
        return ids, counts


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(description: str, literal_special: bool) -> Encoder:
    """A worker keeps it, and its cache, between tasks."""
    key = zlib.crc32(description.encode()), literal_special
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(description, literal_special)
    return _ENCODERS[key]


def write_tokens(df: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text",
                 literal_special: bool = False) -> None:
    """Writes ``key``, n_tokens, part, place, ids: files ascend by key, as do the rows in each.

    ``place`` counts the ids before the document in its part. Null and empty texts are the end id
    alone. Null keys come first; rows of one key are ordered by their text's hash; repeated rows are
    all kept; an empty frame writes files without rows. Other columns are not written. ``literal_special``: see ``Encoder``.
    """
    spark = df.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        description = spark.sparkContext.broadcast(file.read())         # a few megabytes
    schema = T.StructType([
        T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("place", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        coder, place = encoder(description.value, literal_special), 0
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for a, b in chunks(texts, CHUNK):
                ids, counts = coder.encode(texts[a:b])
                ends = np.cumsum(counts)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(counts), batch.column(2).slice(a, b - a),
                     pa.array(place + ends - counts), lists], names=schema.names)
                place += int(ends[-1])

    order = (F.col(key), F.xxhash64(text))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.select(key, text).repartitionByRange(parts, *order).sortWithinPartitions(*order)
     .withColumn("part", F.spark_partition_id())
     .mapInArrow(run, schema).write.options(**LAYOUT).parquet(path))


def read_tokens(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """``columns`` (default: all) of token files, and ``start``: ids of all documents before.

    Only the columns asked for are read; the start takes part, place and, once, counts per part.
    """
    stored = spark.read.parquet(path)
    counts = stored.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()      # one row per file
    starts, total = [], 0
    for row in sorted(counts):
        starts.append((row["part"], total))
        total += row["n"]
    offsets = spark.createDataFrame(starts, "part int, _start bigint")
    chosen = [c for c in columns or stored.columns if c != "start"]
    return (stored.join(F.broadcast(offsets), "part").withColumn("start", F.col("_start") + F.col("place"))
            .select(*chosen, "start"))


def with_crc32(df: DataFrame, ids: str = "ids", into: str = "ids_crc32") -> DataFrame:
    """``df`` with the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers, in place of them."""

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(ids))
            values, ends = column.values.to_numpy(zero_copy_only=False).astype("<u4"), column.offsets.to_numpy()
            sums = pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])], pa.int64())
            part = batch.drop_columns([ids])
            yield pa.RecordBatch.from_arrays([*part.columns, sums], names=[*part.schema.names, into])

    kept = [f for f in df.schema if f.name != ids]
    return df.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.LongType())]))
