"""Quality rules: plain text counts, then divergence from the language's usual distributions.

A document is compared with references of its own language by Jensen-Shannon distance (base 2,
0 to 1): the shares of eight character classes, and the shares of the language's common words
(and of bare signs and all other words). References are the mean shares over all documents of the language that
pass the base rules; a language with too few of them is compared with the mean character classes of
all languages. Short documents scatter, so a limit is widened by ``slack / sqrt(words)`` and
nothing is judged below ``min_words``. All of it is built-in expressions on one row at a time,
plus one small aggregation per language.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.llm.text import plain, window_hashes, words
from zonepulse.session import materialize

# Common words by language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "is", "that", "it", "for",
           "was", "on", "with", "as", "be", "by", "this", "are", "at", "from"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich",
           "des", "auf", "für", "ist", "im", "nicht", "eine", "dem", "ein", "als"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une",
           "est", "que", "pour", "dans", "qui", "au", "sur", "par", "pas", "avec"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "se", "del", "las",
           "un", "por", "con", "no", "una", "para", "su", "es", "al", "lo"),
}
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:'\"()-"
CLASSES = ("lower", "upper", "digit", "space", "mark", "shout", "symbol", "other")
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    min_words: int = 10             # base rule
    max_repeat_percent: int = 20    # base rule
    judged_words: int = 20          # below it no distance is judged
    reference_docs: int = 20        # a language with fewer good documents has no reference of its own
    char_limit: float = 0.22
    char_slack: float = 0.8
    word_limit: float = 0.30
    word_slack: float = 0.9
    common_words: dict = field(default_factory=lambda: dict(COMMON_WORDS))


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _removed(text: Column, characters: str) -> Column:
    """How many of these ASCII characters the text has."""
    return F.octet_length(text) - F.octet_length(_without(text, characters))


def repeated_words(words_column: str, thinned_column: str) -> Column:
    """Words in 5-word windows found twice or more in the text, the first occurrence included.

    ``thinned_column`` holds hashes of three of each window's words: only where two of these agree are
    whole windows hashed, sorted and compared.
    """
    ordered = F.sort_array(F.transform(window_hashes(words_column), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda at, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1), at + WINDOW) - at))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    def flagged(s: Column) -> Column:
        marked = F.transform(s, lambda x, i: F.when(
            (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]), x["i"]))
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    heavy = _let(_let(ordered, flagged), covered)
    suspicious = F.size(F.array_distinct(thinned_column)) < F.size(thinned_column)
    return F.when(suspicious, heavy).otherwise(0).cast("bigint")


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def base_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (bigint)."""
    clean = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(clean, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    thinned = ("transform(slice(_words, 1, greatest(size(_words) - 4, 0)),"
               " (w, i) -> xxhash64(w, get(_words, i + 2), get(_words, i + 4)))")
    return (df.withColumn("_words", words(F.col(text)))
            .withColumns({"_thinned": F.expr(thinned), "_lines": lines})
            .withColumns({
                "n_words": F.size("_words").cast("bigint"),
                "word_chars": F.length(_without(clean, " \t\n\x0b\x0c\r")).cast("bigint"),
                "n_symbols": _removed(clean, SYMBOLS).cast("bigint"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
                "n_repeat_words": repeated_words("_words", "_thinned")})
            .drop("_thinned", "_lines"))


def _class_counts(clean: Column) -> Column:
    """Array of the counts of ``CLASSES``; expects n_symbols and word_chars beside."""
    def counts(rest: Column) -> Column:      # rest: the text without a-z and white space
        def inner(rare: Column) -> Column:   # rare: without other lower-case letters too
            n = F.length(rare)
            upper = n - F.length(F.regexp_replace(rare, r"[\p{Lu}\p{Lt}]+", ""))
            digit, mark = _removed(rare, "0123456789"), _removed(rare, MARKS)
            shout = _removed(rare, "!?")
            space = F.length(clean) - F.col("word_chars")
            other = n - upper - digit - mark - shout - F.col("n_symbols")
            return F.array(*(c.cast("double") for c in (
                F.col("word_chars") - n, upper, digit, space, mark, shout, F.col("n_symbols"), other)))
        return _let(F.regexp_replace(rest, r"[\p{Ll}\p{Lo}\p{Lm}]+", ""), inner)
    return _let(F.regexp_replace(clean, r"[a-z\x20\x09-\x0D]+", ""), counts)


def _common_counts(lang: Column, limits: Limits) -> Column:
    """Array of the counts of the language's common words, of short words of signs only, and of all
    other words; null: no list."""
    every = sorted({w for ws in limits.common_words.values() for w in ws})
    listed = F.create_map(*(x for k, ws in limits.common_words.items()
                            for x in (F.lit(k), F.array(*map(F.lit, ws)))))

    def counts(joined: Column) -> Column:
        return _let(F.transform(F.element_at(listed, lang), lambda w: (
            (F.octet_length(joined) - F.octet_length(F.replace(joined, F.concat(F.lit(" "), w, F.lit(" ")), F.lit(""))))
            / (F.octet_length(w) + 2)).cast("double")), lambda c: F.concat(c, F.array(signs, (
                F.col("n_words") - signs - F.aggregate(c, F.lit(0.0), lambda a, x: a + x)))))

    signs = F.size(F.filter("_words", lambda w: (F.octet_length(w) <= 3) & w.rlike(r"^[^\p{L}\p{N}]+$"))).cast("double")
    kept = F.filter("_words", lambda w: w.isin(*every))
    return _let(F.concat(F.lit(" "), F.array_join(kept, "  "), F.lit(" ")), counts)


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares (each sums to 1), base 2; null if either is null."""
    def half(a: Column) -> Column:
        terms = F.zip_with(a, F.zip_with(p, q, lambda x, y: (x + y) / 2),
                           lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0))
        return F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)
    # ``greatest`` passes over nulls, so they are kept out of it.
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), (half(p) + half(q)) / 2)))


def _shares(counts: Column) -> Column:
    return _let(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x),
                lambda total: F.when(total > 0, F.transform(counts, lambda x: x / total)))


def features(df: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang",
             keep_text: bool = False) -> DataFrame:
    """``df``, without its text unless ``keep_text``, with the base counts, ``base_failed`` and both arrays of shares."""
    clean = F.coalesce(F.col(text), F.lit(""))
    counted = base_counts(plain(df, "char_distance", "word_distance", "kept"), text)
    return (counted.withColumns({"_chars": _class_counts(clean),
                                 "_common": _common_counts(F.coalesce(F.col(lang), F.lit("")), limits)})
            .withColumns({"_chars": _shares(F.col("_chars")), "_common": _shares(F.col("_common"))})
            .withColumn("base_failed", (F.col("n_words") < limits.min_words)
                        | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")))
            .drop("_words", *([] if keep_text else [text])))


def references(featured: DataFrame, limits: Limits = Limits(), lang: str = "lang") -> DataFrame:
    """One row per language, ``_docs`` and mean shares of its documents that pass the base rules."""
    sizes = {"_chars": len(CLASSES)}
    sizes["_common"] = max((len(w) for w in limits.common_words.values()), default=0) + 2
    good = featured.where(~F.col("base_failed") & (F.col("n_words") >= limits.judged_words))
    means = [F.avg(F.get(name, F.lit(i))).alias(f"{name}{i}") for name, n in sizes.items() for i in range(n)]
    table = good.groupBy(F.coalesce(F.col(lang), F.lit("")).alias("_lang")).agg(F.count("*").alias("_docs"), *means)
    packed = [F.filter(F.array(*(F.col(f"{name}{i}") for i in range(n))), lambda x: x.isNotNull()).alias(f"{name}_ref")
              for name, n in sizes.items()]
    return table.select("_lang", "_docs", *packed)


def pooled_reference(refs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One value: mean character-class shares over the good documents of all languages; null where these are too few."""
    docs = F.sum("_docs")
    means = F.array(*(F.sum(F.get("_chars_ref", F.lit(i)) * F.col("_docs")) / docs for i in range(len(CLASSES))))
    return refs.agg(F.when(docs >= limits.reference_docs, means).alias("_pooled"))


def judge(df: DataFrame, limits: Limits = Limits(), text: str = "text", lang: str = "lang",
          keep_text: bool = False) -> DataFrame:
    """``df``, without its text unless ``keep_text``, with base counts, base_failed, char_distance, word_distance, kept.

    ``kept`` is false where the base rules fail or a judged distance is over its limit. Null texts
    have no words, so they fail the base rules. A null language is a language of its own. One with too few good
    documents is judged by the character classes of all languages together, and not at all if these are too few too;
    it, and one without a word list, is not judged by words. Distances are null where not judged. Repeated rows are judged alike; an empty frame gives no rows.
    """
    featured = materialize(features(df, limits, text, lang, keep_text), "quality")
    refs = materialize(references(featured, limits, lang), "quality-references")     # a row of 30 doubles per language
    own = refs.where(F.col("_docs") >= limits.reference_docs).drop("_docs")
    root = F.sqrt(F.col("n_words"))
    judged = F.col("n_words") >= limits.judged_words
    joined = (featured.withColumn("_lang", F.coalesce(F.col(lang), F.lit(""))).join(own, "_lang", "left")
              .withColumn("_chars_ref", F.coalesce("_chars_ref", pooled_reference(refs, limits).scalar())))
    scored = joined.withColumns({
        "char_distance": F.when(judged, divergence(F.col("_chars"), F.col("_chars_ref"))),
        "word_distance": F.when(judged & (F.size("_common_ref") > 1), divergence(F.col("_common"), F.col("_common_ref")))})
    odd = (F.coalesce(F.col("char_distance") > limits.char_limit + limits.char_slack / root, F.lit(False))
           | F.coalesce(F.col("word_distance") > limits.word_limit + limits.word_slack / root, F.lit(False)))
    return (scored.withColumn("kept", ~F.col("base_failed") & ~odd)
            .drop("_lang", "_chars", "_common", "_chars_ref", "_common_ref"))
