"""N-gram Jaccard join by parity sketches: exact links of documents whose shingle sets are alike.

A document's sketch has one bit per shingle hash, modulo the sketch's length, flipped by every
shingle that falls there. Every element in which two sets differ changes one bit at most, so the
Hamming distance of two sketches is at most the symmetric difference of the sets; for a
similarity of ``PERCENT`` that is at most ``(a + b) * (100 - PERCENT) / (100 + PERCENT)``.
Sketches of one size band have the same number of words, more than this bound, so two linked documents agree in
all words but as many (pigeonhole): ordered by one order for all (most bits of uncommon shingles first, as these words are
rarest), the first ``bound + 1`` words of both must share one. Those words are the join keys.

1. Documents of equal sets are one class; its least document stands for it.
2. Tasks make the keys of their documents, keep one document per key and send these on; keys that are shared
   give buckets, each with its least document as pivot.
3. Every document is verified against one pivot, then against all pivots it isn't yet connected to, then, within
   buckets, against all documents of other components. Documents connected already need no further link.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from zonepulse.llm.components import components
from zonepulse.llm.hashing import as_bytes, chunks, mix, shingle_sets
from zonepulse.llm.text import plain, words
from zonepulse.llm.workers import tidied
from zonepulse.session import materialize

PERCENT = 80
WORD_BITS = 16              # log2 of a sketch word's bits
SLACK = 1.5                 # words beyond the bound, as a share of it; the poorest words are not sent
PART_BYTES = 32 << 20       # keys that meet in one step of a task
LARGE = 64                  # documents of a bucket that is joined with others of its cluster
BLOCK = 2048                # documents of a bucket that a task compares with as many
NEAR_BLOCK = 1024           # of them, whose sketches are compared with 64 others at a time
SMALL = 64                  # rows of a block that is compared together with others as small
PAIRS = 4096                # pairs of small blocks whose sketches are compared at a time
FILTER_BITS = 1 << 26       # of the bitmap of documents whose sets are wanted again
COMMON_SHARE = 1024         # a shingle is common if one in so many documents has it,
COMMON_LEAST = 16           # and so many documents;
COMMON_MOST = 1 << 20       # so many shingles are kept, the most common ones
KEY_CHUNK = 32 << 20        # bytes of text whose keys are pre-aggregated together


def sketch_keys(hashes: np.ndarray, percent: int = PERCENT, common: np.ndarray | None = None) -> np.ndarray:
    """Join keys of a set of shingle hashes: in its own size band and, near its lower end, the band below.

    Words are ordered by the bits that no shingle in ``common`` (sorted) has set, then by all bits, then by value: an order of
    words, whatever the set they come from.
    """
    if common is not None and len(common):
        at = np.minimum(np.searchsorted(common, hashes), len(common) - 1)
        usual = common[at] == hashes
    else:
        usual = np.zeros(len(hashes), bool)
    n = len(hashes)
    if not n:
        return np.empty(0, np.uint64)
    apart = (100 - percent) / (100 + percent)           # symmetric difference per (a + b), at most
    band = n.bit_length() - 1
    most = int(n * (100 - percent) / percent) + 1       # bound + 1 for any partner
    keys = []
    for k in range(max(band - 1, 0), band + 1):
        end = (2 << k) * 100 // percent                 # sizes 2**k to below this meet in band k
        if n >= end:
            continue
        bound = int(2 * end * apart)
        words = bound + 2 + int(SLACK * bound)
        bits = hashes % np.uint64(words << WORD_BITS)
        order = np.argsort(bits)
        bits, rare = bits[order], ~usual[order]
        run = np.flatnonzero(np.concatenate([[True], bits[1:] != bits[:-1]]))
        odd = np.diff(np.append(run, n)) % 2 == 1
        bits, rare = bits[run[odd]], np.minimum.reduceat(rare, run)[odd]
        word = (bits >> np.uint64(WORD_BITS)).astype(np.int64)
        counts = np.bincount(word, minlength=words)
        values = np.zeros(words, np.uint64)
        if len(bits):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            values[word[starts]] = np.bitwise_xor.reduceat(mix(bits + np.uint64(1)), starts)
        values = mix(values ^ mix(np.arange(words, dtype=np.uint64) + np.uint64((k + 1) << 40)))
        rarer = np.bincount(word, weights=rare, minlength=words)
        keys.append(values[np.lexsort((values, -counts, -rarer))[:most]])
    return np.concatenate(keys)


def parity_bits(hashes: np.ndarray) -> bytes:
    """A short sketch, of two to four bits a shingle: its length is a power of two, so that sketches of different
    length are compared after the longer one is folded."""
    bits = 1 << max(6, len(hashes).bit_length() + 1)
    odd = np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart_at_least(x: bytes, y: bytes) -> int:
    """Hamming distance of two sketches: no more than the sets' symmetric difference."""
    width = min(len(x), len(y))
    a, b = (np.frombuffer(_folded(s, width), np.uint64) for s in (x, y))
    return int(np.bitwise_count(a ^ b).sum())


def _set_digests(sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    one = [int(mix(s).sum(dtype=np.uint64).astype(np.int64)) for s in sets]
    two = [int(np.bitwise_xor.reduce(mix(s + np.uint64(0x5851F42D4C957F2D))).astype(np.int64)) if len(s) else 0 for s in sets]
    return one, two


def describe(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, n, d1, d2): number of shingles and two digests of the set.

    Besides, for each chunk of texts, rows of a null key with the shingles that at least one in ``COMMON_SHARE`` of its texts,
    and ``COMMON_LEAST``, have: n is minus that number, d1 the hash.
    """
    schema = T.StructType([df.schema[key], *(T.StructField(c, T.LongType()) for c in ("n", "d1", "d2"))])

    def run(batches):
        for batch in batches:
            texts = as_bytes(batch.column(1))
            for c, d in chunks(texts, KEY_CHUNK):
                every = []
                for a, b in chunks(texts[c:d]):
                    sets = shingle_sets(texts[c + a:c + b], size)
                    one, two = _set_digests(sets)
                    every.extend(sets)
                    yield rows(batch.column(0).slice(c + a, b - a), [len(s) for s in sets], one, two)
                hashes, found = np.unique(np.concatenate(every), return_counts=True)
                many = found >= max(COMMON_LEAST, (d - c) / COMMON_SHARE)
                if many.any():
                    n = int(many.sum())
                    yield rows(pa.nulls(n, batch.column(0).type), -found[many], hashes[many].astype(np.int64), np.zeros(n, np.int64))

    def rows(keys, *columns):
        return pa.RecordBatch.from_arrays([keys, *(pa.array(c, pa.int64()) for c in columns)], names=schema.names)

    return df.select(key, text).mapInArrow(tidied(run), schema)


def _runs(keys: np.ndarray, docs: np.ndarray):
    """(order by key and document, first of each run, its length)."""
    order = np.lexsort((docs, keys))
    sorted_keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return order, first, np.diff(np.append(first, len(keys)))


def _shared(keys: np.ndarray, docs: np.ndarray):
    """(keys, documents, pivots) of the runs of two or more; and the first row of every run (key, document)."""
    order, first, length = _runs(keys, docs)
    keys, docs = keys[order], docs[order]
    pivots, many = np.repeat(docs[first], length), np.repeat(length > 1, length)
    return (keys[many], docs[many], pivots[many]), (keys[first], docs[first])


def common_shingles(told: DataFrame, documents: int) -> np.ndarray:
    """Sorted hashes of shingles that many documents have, ``COMMON_MOST`` at most; only the order of words depends on them."""
    totals = (told.where("n < 0").groupBy("d1").agg((-F.sum("n")).alias("n"))
              .where(F.col("n") >= max(COMMON_LEAST, documents / COMMON_SHARE)))
    found = totals.orderBy(F.desc("n"), "d1").limit(COMMON_MOST).select("d1").toPandas()["d1"]
    return np.sort(found.to_numpy(np.int64).astype(np.uint64))


def buckets(df: DataFrame, key: str, text: str, size: int, percent: int, parts: int, common: np.ndarray) -> DataFrame:
    """(key, doc, pivot) of all documents that share a join key; copies within a task's chunk are left out.

    Rows travel as arrays, one pair per chunk and part. What chunks have already joined goes along, dealt out evenly.
    """
    sent = T.StructType([T.StructField("part", T.IntegerType())] + [
        T.StructField(c, T.BinaryType()) for c in ("keys", "docs", "pivots")])
    bucket = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "doc", "pivot")])

    usual = df.sparkSession.sparkContext.broadcast(common)

    def make(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), as_bytes(batch.column(1))
            for a, b in chunks(texts, KEY_CHUNK):
                best: dict[tuple, tuple] = {}
                for c, d in chunks(texts[a:b]):
                    sets = shingle_sets(texts[a + c:a + d], size)
                    for doc, s, one, two in zip(ids[a + c:a + d], sets, *_set_digests(sets)):
                        if doc is None or not len(s):
                            continue
                        same = len(s), one, two
                        if same not in best:
                            best[same] = doc, sketch_keys(s, percent, usual.value)
                        elif doc < best[same][0]:
                            best[same] = doc, best[same][1]
                if not best:
                    continue
                keys = np.concatenate([k for _, k in best.values()])
                docs = np.repeat(np.array([d for d, _ in best.values()], np.int64), [len(k) for _, k in best.values()])
                joined, left = _shared(keys, docs)
                yield from rows(left[0] % np.uint64(parts), *left, None)
                yield from rows(joined[1] % parts, *joined)

    def rows(part, keys, docs, pivots):
        if len(keys):
            part = part.astype(np.int64)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            used = [i for i in range(parts) if ends[i] < ends[i + 1]]
            blobs = [[None if v is None else v[order[ends[i]:ends[i + 1]]].tobytes() for i in used] for v in (keys, docs, pivots)]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), *(pa.array(x, pa.binary()) for x in blobs)],
                                             names=sent.names)

    def meet(batches):
        current, held = None, []
        for batch in batches:
            for part, keys, docs, pivots in zip(*(c.to_pylist() for c in batch.columns)):
                if part != current:
                    yield from close(held)
                    current, held = part, []
                if pivots is None:
                    held.append((keys, docs))
                else:
                    yield out(keys, docs, pivots)
        yield from close(held)

    def close(held):
        if held:
            keys = np.frombuffer(b"".join(k for k, _ in held), np.uint64)
            docs = np.frombuffer(b"".join(d for _, d in held), np.int64)
            joined, _ = _shared(keys, docs)
            if len(joined[0]):
                yield out(*joined)

    def out(*columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(c if isinstance(c, np.ndarray) and c.dtype == np.int64 else np.frombuffer(c, np.int64)) for c in columns],
            names=bucket.names)

    made = df.select(key, text).mapInArrow(tidied(make), sent)
    return made.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(tidied(meet), bucket)


BACKWARDS = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)[:, ::-1], axis=1).ravel()     # each byte's bits


def place(doc) -> Column:
    return F.pmod(F.xxhash64(doc), F.lit(FILTER_BITS))


def bitmap_of(wanted: DataFrame) -> np.ndarray:
    """Packed bits, of fixed size, set at the places of the documents in ``wanted`` (column doc)."""
    # Spark's bitmap functions count from 1: place 0 is bit 0 of bucket 1.
    found = (wanted.select((place("doc") + 1).alias("_p")).groupBy(F.bitmap_bucket_number("_p").alias("bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("bits")).collect())   # at most FILTER_BITS in all
    bitmap = np.zeros((FILTER_BITS + (1 << 18)) // 8, np.uint8)         # never a byte for each bit
    for row in found:
        bits = BACKWARDS[np.frombuffer(bytes(row["bits"]), np.uint8)]
        begin = (row["bucket"] - 1) * len(bits)
        bitmap[begin:begin + len(bits)] = bits[:len(bitmap) - begin]
    return bitmap


def passed(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((bits[places >> 3] >> (7 - (places & 7))) & 1).astype(bool)


def wanted_sets(df: DataFrame, wanted: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(doc, n, d1, d2, bits, hashes) of the documents in ``wanted`` (column doc): their number of shingles, digests, short sketch and
    sorted shingle hashes, as bytes.

    The texts aren't shuffled: a bitmap of hashed document ids, of fixed size, is sent to all tasks. Some others may
    pass it as well.
    """
    packed = df.sparkSession.sparkContext.broadcast(bitmap_of(wanted))
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("doc", "n", "d1", "d2")), T.StructField("bits", T.BinaryType()), T.StructField("hashes", T.BinaryType())])

    def run(batches):
        for batch in batches:
            at = batch.column(2).to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(passed(packed.value, at)))
            texts = as_bytes(batch.column(1))
            for a, b in chunks(texts):
                sets = shingle_sets(texts[a:b], size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                     *(pa.array(d, pa.int64()) for d in _set_digests(sets)), pa.array([parity_bits(s) for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], names=schema.names)

    return (df.where(F.col(key).isNotNull()).select(F.col(key).alias("doc"), text)
            .withColumn("_p", place("doc")).mapInArrow(tidied(run), schema))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike: 100 * |intersection| >= percent * |union|.

    Sizes and short sketches rule most others out before any set is fetched.
    """

    @F.pandas_udf(T.BooleanType())
    def alike(x, y):
        out = []
        for p, q in zip(x, y):
            s, t = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(s, t, assume_unique=True))
            out.append(100 * both >= percent * (len(s) + len(t) - both))
        return pd.Series(out, dtype="bool")

    @F.pandas_udf(T.BooleanType())
    def near(x, y, m, n):
        return pd.Series([(100 + percent) * apart_at_least(p, q) <= (100 - percent) * (i + j)
                          for p, q, i, j in zip(x, y, m, n)], dtype="bool")

    def with_both(frame, *columns):
        for c in "ab":
            frame = frame.join(sets.select(F.col("doc").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in columns)), c)
        return frame

    sizes = 100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n")
    close = materialize(with_both(pairs, "n", "bits").where(sizes).where(near("a_bits", "b_bits", "a_n", "b_n"))
                        .select("a", "b"), "near")
    return with_both(close, "hashes").where(alike("a_hashes", "b_hashes")).select("a", "b")


def near_in_buckets(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(x, y) with different labels in one bucket whose sizes and short sketches allow a link; ``rows``: (key, doc, label).

    Only documents outside a bucket's least label are compared with all others of it. A bucket is cut into blocks of
    about ``BLOCK`` documents and a task compares the sketches of two blocks, so no pair becomes a row unless it is near.
    """
    mixed = (rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("c"))
             .where("low <> high").select("key", "low", "c"))
    # The large buckets of one cluster hold much the same documents: met by their least label, a pair is compared once.
    met = F.when(F.col("c") >= LARGE, F.xxhash64("low", F.lit("large"))).otherwise(F.col("key"))
    open_ = materialize(rows.join(mixed, "key").withColumn("key", met).select("key", "low", "doc", "label").distinct(), "open")
    sizes = open_.groupBy("key").agg(F.count("*").alias("c"), F.sum((F.col("label") != F.col("low")).cast("bigint")).alias("f"))
    known = open_.join(sizes, "key").join(sets.select("doc", "n", "bits"), "doc").withColumns({
        "_across": F.ceil(F.col("c") / BLOCK).cast("int"), "_down": F.ceil(F.col("f") / BLOCK).cast("int")})
    spread = F.xxhash64("doc")
    columns = ["key", "i", "j", "minor", "doc", "label", "n", "bits"]
    minor = (known.where(F.col("label") != F.col("low")).withColumn("i", F.pmod(spread, "_down").cast("int"))
             .withColumn("j", F.explode(F.expr("sequence(0, _across - 1)"))).withColumn("minor", F.lit(True)).select(*columns))
    every = (known.withColumn("j", F.pmod(spread, "_across").cast("int"))
             .withColumn("i", F.explode(F.expr("sequence(0, _down - 1)"))).withColumn("minor", F.lit(False)).select(*columns))
    pair = T.StructType([T.StructField(c, T.LongType()) for c in "xy"])

    def run(batches):
        current, held = None, []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            edges = np.concatenate([[0], np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1, [n]])
            if held and tuple(k[0] for k in keys) == current:
                held.append(batch.slice(0, edges[1]))
                edges = edges[1:]
            if len(edges) < 2:
                continue
            yield from compare(held)
            current, held = tuple(k[edges[-2]] for k in keys), [batch.slice(edges[-2])]     # may go on in the next batch
            lengths = np.diff(edges[:-1])
            of = np.repeat(np.arange(len(lengths)), lengths)
            some = (lengths <= SMALL)[of]
            rows = edges[0] + np.flatnonzero(some)
            yield from found(_near_in_small(pa.Table.from_batches([batch]).take(pa.array(rows)), of[some], percent))
            for k in np.flatnonzero(lengths > SMALL):
                yield from compare([batch.slice(edges[k], lengths[k])])
        yield from compare(held)

    def found(pairs):
        for x, y in pairs:
            yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], names=pair.names)

    def compare(held):
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        minor, doc, label, n = (table[c].to_numpy() for c in ("minor", "doc", "label", "n"))
        # Sketches of one length stand together; sizes that may link differ by a quarter, so by one length at most.
        length, raw = pc.binary_length(table["bits"]).to_numpy(), table["bits"].combine_chunks()
        classes = {}
        for width in np.unique(length).tolist():
            rows = np.flatnonzero(length == width)
            rows = rows[np.argsort(n[rows], kind="stable")]
            bits = np.frombuffer(b"".join(raw.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), -1)
            classes[width] = rows, bits
        for width, (rows, bits) in classes.items():
            for other in (width // 2, width, 2 * width):
                if other not in classes:
                    continue
                right, right_bits = classes[other]
                left, left_bits = rows[minor[rows]], bits[minor[rows]]
                right, right_bits = right[~minor[right]], right_bits[~minor[right]]
                narrow = min(width, other)
                near = _near(left, _narrowed(left_bits, narrow), right, _narrowed(right_bits, narrow), label, n, percent)
                yield from found((doc[x], doc[y]) for x, y in near)

    return (minor.unionByName(every).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(tidied(run), pair))


def _narrowed(bits: np.ndarray, width: int) -> np.ndarray:
    """Sketches as rows of 64-bit words, folded to ``width`` bytes."""
    while bits.shape[1] * 8 > width:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return np.ascontiguousarray(bits)


def _near(left, left_bits, right, right_bits, label, n, percent: int):
    """(rows, rows) of pairs with different labels whose sizes and sketches allow a link; both sides ascend by size.

    Sketches are compared half folded first, which only lowers distances, in blocks that stay in a core's cache; the few pairs
    left are then held against the bound of their own sizes.
    """
    short = max(left_bits.shape[1] // 2, 1)
    left_short, right_short = (np.ascontiguousarray(_narrowed(b, short * 8).T) for b in (left_bits, right_bits))
    sizes = n[right]
    shape = 64, NEAR_BLOCK
    differ, counts = np.empty(shape, np.uint64), np.empty(shape, np.uint8)
    apart = np.empty(shape, np.uint16 if short * 64 < 1 << 16 else np.uint32)
    for at in range(0, len(left), 64):
        x = left[at:at + 64]
        low = int(np.searchsorted(sizes, -(-percent * n[x[0]] // 100), "left"))
        high = int(np.searchsorted(sizes, 100 * n[x[-1]] // percent, "right"))
        for begin in range(low, high, NEAR_BLOCK):
            y = right[begin:min(begin + NEAR_BLOCK, high)]
            other = label[x][:, None] != label[y][None, :]
            if not other.any():
                continue
            d, c, total = (m[:len(x), :len(y)] for m in (differ, counts, apart))
            total[:] = 0
            for word in range(short):
                np.bitwise_xor(left_short[word, at:at + 64][:, None], right_short[word, begin:begin + len(y)][None, :], out=d)
                np.add(total, np.bitwise_count(d, out=c), out=total)
            widest = (100 - percent) * (n[x] + n[y[-1]]) // (100 + percent)          # sizes ascend
            i, j = np.nonzero(other & (total <= np.minimum(widest, np.iinfo(total.dtype).max).astype(total.dtype)[:, None]))
            a, b = n[x[i]], n[y[j]]
            bound = (100 - percent) * (a + b)
            fine = ((100 + percent) * total[i, j].astype(np.int64) <= bound) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
            i, j, bound = i[fine], j[fine], bound[fine]
            for part in range(0, len(i), 4096):
                p, q = i[part:part + 4096], j[part:part + 4096]
                whole = np.bitwise_count(left_bits[at + p] ^ right_bits[begin + q]).sum(axis=1, dtype=np.int64)
                fine = (100 + percent) * whole <= bound[part:part + 4096]
                if fine.any():
                    yield x[p[fine]], y[q[fine]]


def _near_in_small(table: pa.Table, of: np.ndarray, percent: int):
    """(documents, documents) of the pairs that ``_near`` finds, of many small blocks together; ``of``: each row's block, ascending."""
    minor, doc, label, n = (table[c].to_numpy() for c in ("minor", "doc", "label", "n"))
    left, right = np.flatnonzero(minor), np.flatnonzero(~minor)
    first, end = (np.searchsorted(of[right], of[left], side) for side in ("left", "right"))
    times = end - first
    x = np.repeat(left, times)
    y = right[np.arange(len(x)) + np.repeat(first - np.cumsum(times) + times, times)]
    fine = (label[x] != label[y]) & (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y]))
    x, y = x[fine], y[fine]
    used = np.unique(np.concatenate([x, y]))
    raw, length = table["bits"].combine_chunks(), pc.binary_length(table["bits"]).to_numpy()
    sketches, spot = {}, np.zeros(len(n), np.int64)
    for width in np.unique(length[used]).tolist():
        rows = used[length[used] == width]
        sketches[width] = np.frombuffer(b"".join(raw.take(pa.array(rows)).to_pylist()), np.uint64).reshape(len(rows), -1)
        spot[rows] = np.arange(len(rows))
    for a in sketches:
        for b in sketches:
            both = (length[x] == a) & (length[y] == b)
            if not both.any():
                continue
            p, q, narrow = x[both], y[both], min(a, b)
            one, two = _narrowed(sketches[a], narrow), _narrowed(sketches[b], narrow)
            for at in range(0, len(p), PAIRS):
                i, j = p[at:at + PAIRS], q[at:at + PAIRS]
                apart = np.bitwise_count(one[spot[i]] ^ two[spot[j]]).sum(axis=1, dtype=np.int64)
                fine = (100 + percent) * apart <= (100 - percent) * (n[i] + n[j])
                if fine.any():
                    yield doc[i[fine]], doc[j[fine]]


def _folded(bits: bytes, width: int) -> bytes:
    a = np.frombuffer(bits, np.uint8)
    while len(a) > width:
        a = a[:len(a) // 2] ^ a[len(a) // 2:]
    return a.tobytes()


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return (df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def link_components(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) of every row of ``df``.

    ``component_id``: the least key reachable by links, itself included. A text of 1 to ``size - 1``
    words is one shingle; null, empty and blank texts have none and link with nothing. Rows with a null key
    get their number and a null component, and link with nothing. Repeated rows are all returned; a
    key with several texts links as any of them. An empty frame gives no rows.
    """
    spark = df.sparkSession
    docs = df.select(F.col(key).cast("bigint").alias("doc"), text)
    stored = materialize(describe(docs, "doc", text, size), "sets")
    told = stored.where("n >= 0")
    common = common_shingles(stored, told.count())
    total = told.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    known = told.where(F.col("doc").isNotNull() & (F.col("n") > 0))
    classes = known.groupBy("n", "d1", "d2").agg(F.min("doc").alias("class"), F.count("*").alias("c")).where("c > 1").drop("c")
    member = materialize(told.join(classes, ["n", "d1", "d2"], "left").select(
        "doc", "n", F.coalesce("class", "doc").alias("class")), "classes")
    copies = member.where(F.col("doc") != F.col("class")).select("doc", "class").distinct()

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total * 16 // (3 * PART_BYTES)))
    raw = materialize(buckets(docs, "doc", text, size, percent, parts, common), "buckets")

    def to_class(frame, column):
        named = copies.select(F.col("doc").alias(column), F.col("class").alias("_c"))
        return frame.join(named, column, "left").withColumn(column, F.coalesce("_c", column)).drop("_c")

    shared = materialize(to_class(to_class(raw, "doc"), "pivot"), "shared")
    wanted = shared.select("doc").union(shared.select("pivot")).distinct()
    sets = materialize(wanted_sets(docs, wanted, "doc", text, size).join(wanted, "doc", "left_semi")
                       .dropDuplicates(["doc", "n", "d1", "d2"]), "hashes")

    # One pivot per document: the one it shares most keys with.
    counted = shared.where(F.col("doc") != F.col("pivot")).groupBy("doc", "pivot").count()
    best = counted.groupBy("doc").agg(F.max_by("pivot", F.struct("count", -F.col("pivot"))).alias("pivot"))
    tried = materialize(_pairs(best, "doc", "pivot"), "tried")
    label = _labels(materialize(verified(tried, sets, percent), "linked"))

    # All other pivots of documents that aren't connected with them yet.
    apart = _apart(_pairs(counted, "doc", "pivot"), label).join(tried, ["a", "b"], "left_anti")
    tried_too = materialize(apart, "tried")
    label = _labels(materialize(verified(tried_too, sets, percent), "linked"), label)
    tried = tried.unionByName(tried_too)

    # Within buckets of several components: the documents outside the pivot's component against all others.
    rows = shared.select("key", "doc").union(shared.select("key", "pivot")).distinct()
    named = rows.join(label.withColumnRenamed("node", "doc"), "doc", "left").withColumn("label", F.coalesce("component", "doc")).drop("component")
    rest = _pairs(near_in_buckets(named, sets, percent), "x", "y").join(tried, ["a", "b"], "left_anti")
    label = _labels(materialize(verified(rest, sets, percent), "linked"), label).withColumnRenamed("node", "class")
    return member.join(label, "class", "left").select(
        F.col("doc").cast(df.schema[key].dataType).alias(key), F.col("n").alias("n_shingles"),
        F.coalesce("component", "class").alias("component_id"))


def keep_representatives(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
                         percent: int = PERCENT) -> DataFrame:
    """``df`` with one row of each group of linked documents, that of the least key.

    Rows without words or without a key stay, as do different texts of the least key. Only rows whose key's hash is that of a document to be removed, or of one
    that occurs twice, are shuffled by key; all others pass a bitmap of fixed size where they are.
    """
    df = plain(df)
    found = materialize(link_components(df, key, text, size, percent), "components")
    gone = found.where(F.col(key) != F.col("component_id")).select(F.col(key).cast("bigint").alias("doc")).distinct()
    twice = found.where(F.col(key).isNotNull() & (F.col("n_shingles") > 0)).groupBy(F.col(key).cast("bigint").alias("doc")).count().where("count > 1")
    packed = df.sparkSession.sparkContext.broadcast(bitmap_of(gone.union(twice.select("doc"))))

    @F.pandas_udf(T.BooleanType())
    def suspect(places):
        return pd.Series(passed(packed.value, places.to_numpy(np.int64)))

    doc = F.col(key).cast("bigint")
    marked = df.withColumn("_suspect", F.coalesce(F.when(doc.isNotNull(), suspect(place(F.coalesce(doc, F.lit(0))))), F.lit(False)))
    sure = marked.where(~F.col("_suspect")).drop("_suspect")
    checked = marked.where("_suspect").drop("_suspect").withColumn("_doc", doc)
    checked = checked.join(gone, F.col("_doc") == gone["doc"], "left_anti")
    some = F.size(words(F.col(text))) > 0
    worded, blank = checked.where(some), checked.where(~some)
    return sure.unionByName(worded.dropDuplicates(["_doc", text]).unionByName(blank).drop("_doc"))


def _labels(links: DataFrame, label: DataFrame | None = None) -> DataFrame:
    """Components of ``links`` and those in ``label``, which stand for the links that made them; ``links`` is stored."""
    if label is not None:
        if links.isEmpty():
            return label
        links = links.unionByName(label.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return materialize(components(links), "labels")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose documents are in different components."""
    a, b = (label.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in")) for c in "ab")
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("a_in", "a") != F.coalesce("b_in", "b")).select("a", "b"))
