"""Spelling variants: words one insertion, deletion or replacement apart, found by composing acceptors.

The vocabulary's minimised acceptor A is composed with a one-edit transducer T and with A again: a state of A . T . A is a state of
A, whether the edit is done, and another state of A; it accepts the pairs of words one edit apart. All start from a
few initial states, so the work is parted by them. The edit of a pair lies in the first or in the second half of the
shorter word; the other half is the same in both, so words go, by length, to the group of their first half and to
that of their last half, and a group's words differ in the rest alone. Each group is an initial state of the acceptor that a task
builds of the rests it gets; groups of the same rests are one state and are enumerated once. A group of too many words is
halved again, at most until a single position is left.

States are numbered so that the offsets along a path add up to a word's rank, so composed paths are arrays of numbers that
numpy follows side by side.
"""

import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from zonepulse.llm.hashing import mix
from zonepulse.session import materialize

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
FORM_RATIO = 5              # a form is so many times as frequent as the word
EDIT_ONE_IN = 199           # runs that lose a code point
GROUP = 1 << 18             # words of a group; a larger one is halved
PATHS = 1 << 21             # composed paths followed at a time
LABEL_BITS = 21             # a code point
DONE = -1                   # the path may go on with any label


# --- the acceptor -----------------------------------------------------------------------

class Acceptor:
    """Minimal deterministic acceptor of words in groups, each with an initial state of its own.

    ``first``, ``degree``: a state's transitions; ``label``, ``target``, ``offset``: what they read, where they go, and how many of
    the state's words come before. ``initial``: state of each group; ``slots``: place of each word, by group and then rank.
    """

    def __init__(self, group: np.ndarray, points: np.ndarray, lengths: np.ndarray):
        self._trie(group, points, lengths)
        for seed in range(8):
            if self._minimised(np.uint64(seed)):
                return
        raise RuntimeError("states could not be told apart")

    def _trie(self, group, points, lengths):
        begin = np.cumsum(lengths) - lengths
        groups = int(group.max()) + 1
        at, self.levels, parents, labels = group.astype(np.int64), [(0, groups)], [np.full(groups, -1)], [np.zeros(groups, np.int64)]
        active = np.arange(len(group))
        for depth in range(int(lengths.max())):
            active = active[lengths[active] > depth]
            keys, place = np.unique(at[active] << LABEL_BITS | points[begin[active] + depth], return_inverse=True)
            low = self.levels[-1][1]
            at[active] = low + place
            self.levels.append((low, low + len(keys)))
            parents.append(keys >> LABEL_BITS)
            labels.append(keys & ((1 << LABEL_BITS) - 1))
        self.parent, self.read = np.concatenate(parents), np.concatenate(labels)
        n = len(self.parent)
        self.ends = np.zeros(n, bool)
        self.ends[at] = True
        self.words = self.ends.astype(np.int64)
        for low, high in self.levels[:0:-1]:
            np.add.at(self.words, self.parent[low:high], self.words[low:high])
        # Siblings stand together by label, so a node's offset follows from sums along its level.
        self.node_offset, rank = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for low, high in self.levels[1:]:
            parent, words = self.parent[low:high], self.words[low:high]
            sums = np.cumsum(words) - words
            run = np.concatenate([[True], parent[1:] != parent[:-1]])
            self.node_offset[low:high] = sums - sums[run][np.cumsum(run) - 1] + self.ends[parent]
            rank[low:high] = rank[parent] + self.node_offset[low:high]
        self.start = np.cumsum(self.words[:groups]) - self.words[:groups]
        self.slots = self.start[group] + rank[at]

    def _minimised(self, seed) -> bool:
        """Merges nodes that accept the same rests: equal hashes first, then a check that they are right."""
        n, groups = len(self.parent), self.levels[0][1]
        sums = mix(self.ends.astype(np.uint64) + np.uint64(3) + seed)
        for low, high in self.levels[:0:-1]:
            seen = mix(mix(sums[low:high]) + self.read[low:high].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            np.add.at(sums, self.parent[low:high], seen)
        _, chosen, state = np.unique(mix(sums), return_index=True, return_inverse=True)
        children = np.arange(groups, n)
        children = children[np.lexsort((self.read[children], self.parent[children]))]
        count = np.bincount(self.parent[children], minlength=n)
        start = np.cumsum(count) - count
        like = chosen[state]
        if (count != count[like]).any() or (self.ends != self.ends[like]).any():
            return False
        owner = self.parent[children]
        twin = children[start[like[owner]] + np.arange(len(children)) - start[owner]]
        if (self.read[children] != self.read[twin]).any() or (state[children] != state[twin]).any():
            return False
        self.degree = count[chosen]
        self.first = np.cumsum(self.degree) - self.degree
        edges = children[np.repeat(start[chosen], self.degree) + _within(self.degree)]
        self.label, self.target, self.offset = self.read[edges], state[edges], self.node_offset[edges]
        self.final = self.ends[chosen]
        self.keys = np.repeat(np.arange(len(chosen)), self.degree) << LABEL_BITS | self.label
        self.initial = state[:groups]
        return True

    def step(self, states: np.ndarray, labels: np.ndarray):
        """(there is one, which) of the transitions of states under labels."""
        wanted = states << LABEL_BITS | labels
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.keys[at] == wanted, at


def _within(counts: np.ndarray) -> np.ndarray:
    """0 to count - 1 for each count."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


# --- the composition --------------------------------------------------------------------

def one_edit_pairs(acceptor: Acceptor):
    """(initial state, rank, rank, last) of the pairs of words that A . T . A accepts, each once.

    The first word replaces one label of the second by a smaller one or has one more. Among equal labels in a row the last one is
    the one left out. ``last``: whether it ends the first word, nothing read after it by either.
    """
    a = acceptor
    roots = np.unique(a.initial)
    level = [(roots, roots, np.zeros(len(roots), np.int64))]
    while level:
        following = []
        for root, state, rank in level:
            if not len(root):
                continue
            degree = a.degree[state]
            for some in _pieces(degree * (degree + 1) // 2, PATHS):
                r, q, i, d = root[some], state[some], rank[some], degree[some]
                of = np.repeat(np.arange(len(r)), d)
                edge = a.first[q][of] + _within(d)
                child = r[of], a.target[edge], i[of] + a.offset[edge]
                following.append(child)
                # One label more on the left; it stays where it is on the right.
                yield from _followed(a, r[of], child[1], child[2], q[of], i[of], a.label[edge])
                # Another label on either side.
                later = d[of] - 1 - _within(d)
                left = np.repeat(np.arange(len(of)), later)
                right = left + 1 + _within(later)
                yield from _followed(a, r[of][left], child[1][left], child[2][left], child[1][right], child[2][right],
                                     np.full(len(left), DONE))
        level = _joined(following)


def _joined(parts):
    """Short arrays are put together, long ones stay apart."""
    out, held, size = [], [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size > PATHS:
            out.append(tuple(map(np.concatenate, zip(*held))))
            held, size = [], 0
    return out + ([tuple(map(np.concatenate, zip(*held)))] if size else [])


def _pieces(work: np.ndarray, most: int):
    """Slices of about ``most`` work."""
    ends = np.cumsum(work)
    begin = 0
    while begin < len(work):
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + most, "right")))
        yield slice(begin, end)
        begin = end


def _followed(a: Acceptor, root, p, i, q, j, left_out):
    """Accepted pairs of paths that read the same labels from states p and q on; ``left_out``: a label that must not come next."""
    while len(root):
        both = a.final[p] & a.final[q]
        if both.any():
            yield root[both], i[both], j[both], left_out[both] != DONE
        few = a.degree[p] <= a.degree[q]
        here, there = np.where(few, p, q), np.where(few, q, p)
        count = a.degree[here]
        of = np.repeat(np.arange(len(root)), count)
        edge = a.first[here][of] + _within(count)
        found, other = a.step(there[of], a.label[edge]) if len(edge) else (np.empty(0, bool), edge)
        found &= a.label[edge] != left_out[of]
        of, edge, other = of[found], edge[found], other[found]
        mine, yours = np.where(few[of], edge, other), np.where(few[of], other, edge)
        root, i, j = root[of], i[of] + a.offset[mine], j[of] + a.offset[yours]
        p, q, left_out = a.target[mine], a.target[yours], np.full(len(of), DONE)


# --- groups of words --------------------------------------------------------------------

KEYS = ["size", "low", "high", "fixed"]
KEY_TYPES = "size int, low int, high int"


def _rests(words: DataFrame) -> DataFrame:
    """Rows (size, low, high) of words with what is fixed and what isn't: of words of ``size`` letters or one more, the edit is at
    one of the positions ``low`` to ``high`` (excluded) of the shorter one."""
    return words.withColumns({
        "fixed": F.expr("concat(left(word, low), right(word, size - high))"),
        "rest": F.expr("substring(word, low + 1, length(word) - low - (size - high))")})


def _halves(words: DataFrame) -> DataFrame:
    """Both halves of (size, low, high), without empty ones."""
    return _rests(words.withColumn("half", F.explode(F.expr(
        "array(struct(low as low, div(low + high, 2) as high), struct(div(low + high, 2) as low, high as high))")))
        .drop("low", "high", *(c for c in ("fixed", "rest") if c in words.columns)).select("*", F.expr("cast(half.low as int) low"),
                                                                                       F.expr("cast(half.high as int) high"))
        .drop("half").where("low < high"))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n) of any two words of (word, n) that are one edit apart, both ways round; words must differ."""
    families = words.select("word", "n").withColumn("size", F.explode(F.expr("array(length(word) - 1, length(word))")))
    level = materialize(_halves(families.where("size > 0").withColumns({"low": F.lit(0), "high": F.col("size")})), "rests")
    found = []
    while True:
        large = materialize(level.groupBy(*KEYS).count().where((F.col("count") > GROUP) & (F.col("high") - F.col("low") > 1))
                            .select(*KEYS), "large-groups")
        if large.isEmpty():
            found.append(_composed(level))
            break
        found.append(_composed(level.join(large, KEYS, "left_anti")))
        level = materialize(_halves(level.join(large, KEYS, "left_semi")), "rests")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _composed(rows: DataFrame) -> DataFrame:
    pair = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()),
                         T.StructField("near", T.StringType()), T.StructField("near_n", T.LongType())])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if size + n > GROUP:
                # Rows before the last change of group are complete.
                table = pa.Table.from_batches([*held, batch]).combine_chunks()
                cut = _starts(table)[-1]
                if cut:
                    yield from solve(table.slice(0, cut))
                held = table.slice(cut).to_batches()
                size = table.num_rows - cut
            else:
                held.append(batch)
                size += n
        if held:
            yield from solve(pa.Table.from_batches(held).combine_chunks())

    def _starts(table):
        differ = np.zeros(table.num_rows - 1, bool)
        for k in KEYS:
            column = table[k].combine_chunks()
            differ |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(differ) + 1])

    def solve(table):
        starts = _starts(table)
        group = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, table.num_rows)))
        rests, word = table["rest"].combine_chunks(), table["word"].combine_chunks()
        lengths = pc.utf8_length(rests).to_numpy().astype(np.int64)
        points = np.frombuffer("".join(rests.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
        if not len(points):
            return
        acceptor = Acceptor(group, points, lengths)
        row_at = np.empty(len(group), np.int64)
        row_at[acceptor.slots] = np.arange(len(group))
        sizes, full = table["size"].to_numpy(), pc.utf8_length(word).to_numpy()
        open_end = table["high"].to_numpy()[starts] == sizes[starts]
        # Groups with the same initial state have the same rests, hence the same pairs.
        by_state = np.argsort(acceptor.initial, kind="stable")
        ordered = acceptor.initial[by_state]
        for root, i, j, last in one_edit_pairs(acceptor):
            low, high = np.searchsorted(ordered, root, "left"), np.searchsorted(ordered, root, "right")
            of = np.repeat(np.arange(len(root)), high - low)
            g = by_state[low[of] + _within(high - low)]
            x, y = row_at[acceptor.start[g] + i[of]], row_at[acceptor.start[g] + j[of]]
            # What ends at a fixed half belongs to that half; two longer words belong to their own length.
            right = (~last[of] | open_end[g]) & (np.minimum(full[x], full[y]) == sizes[x])
            x, y = pa.array(x[right]), pa.array(y[right])
            for a, b in ((x, y), (y, x)):
                if len(a):
                    yield pa.RecordBatch.from_arrays([word.take(a), table["n"].combine_chunks().take(a), word.take(b),
                                                      table["n"].combine_chunks().take(b)], names=pair.names)

    return (rows.select(*KEYS, "rest", "word", "n").repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(run, pair))


# --- words and their forms --------------------------------------------------------------

def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, edit_one_in: int | None = None) -> DataFrame:
    """(word, n) of runs of ``LETTERS``, A-Z lower-cased, of at least ``least_length`` code points and ``least_count`` occurrences.

    ``edit_one_in``: plants errors for evaluation. Of runs whose hash ``crc32(key:run)`` it divides, the code point at the hash
    modulo the run's length is left out. A null key is written as nothing. Null texts have no words.
    """
    # A run shorter than the least length has no result of that length.
    runs = df.select(F.col(key).cast("string").alias("key"), F.explode(F.regexp_extract_all(
        F.col(text), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    words = runs.withColumn("word", F.translate("run", string.ascii_uppercase, string.ascii_lowercase))
    if edit_one_in:
        words = words.withColumn("h", F.crc32(F.concat(F.coalesce("key", F.lit("")), F.lit(":"), F.col("word"))))
        shorter = F.expr("concat(left(word, cast(h % length(word) as int)), substring(word, cast(h % length(word) as int) + 2))")
        words = words.withColumn("word", F.when(F.col("h") % edit_one_in == 0, shorter).otherwise(F.col("word")))
    counted = words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
    return counted.where(F.length("word") >= least_length)


def spelling_forms(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each of (word, n).

    ``n_near``: words one edit apart. ``form``: the most frequent of these, of equal ones the least by code points, if it is at least
    ``ratio`` (above 1) times as frequent; else null. ``root``: the last word reached by following forms, the word itself without one. Words
    must differ and not be null; an empty frame gives no rows.
    """
    words = materialize(words.select("word", "n"), "words")
    # Least of (-n, word): strings are compared by bytes of UTF-8, which is the order of code points.
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first"))
    known = materialize(words.join(near, "word", "left").withColumn("frequent", -F.col("first.less") >= ratio * F.col("n")).select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("frequent"), F.col("first.near")).alias("form"),
        F.when(F.col("frequent"), -F.col("first.less")).alias("form_n")), "forms")
    # Each round doubles the steps taken; frequencies grow by the ratio with every step, so few rounds do.
    ways = known.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = materialize(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                F.col("further").isNotNull().alias("moved")), "roots")
        if ways.where("moved").isEmpty():
            break
        ways = ways.drop("moved")
    return known.join(ways.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
