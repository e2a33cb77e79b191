"""Expressions on texts shared by the operators: words, shingles and their hashes.

All of them are built-in functions; null texts count as empty.
"""

from pyspark.sql import Column, DataFrame, functions as F

#: White space that separates words: space and tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"
SHINGLE_WORDS = 5


def plain(df: DataFrame, *results: str) -> DataFrame:
    """``df`` without columns that begin with an underscore and without those that the operator will add."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns if not c.startswith("_") and c not in results))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; no words: empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def window_hashes(words_column: str, size: int = SHINGLE_WORDS) -> Column:
    """Hash of each run of ``size`` words, by position; fewer words: empty array.

    Takes a column name, so that the words are read from a column and not built once per window.
    """
    parts = ", ".join(f"get({words_column}, i + {k})" for k in range(1, size))
    return F.expr(f"transform(slice({words_column}, 1, greatest(size({words_column}) - {size - 1}, 0)),"
                  f" (w, i) -> xxhash64(w{', ' + parts if parts else ''}))")


def shingle_hashes(words_column: str, size: int = SHINGLE_WORDS) -> Column:
    """As ``window_hashes``, but a text of 1 to ``size - 1`` words is one shingle of all its words."""
    short = F.array(F.xxhash64(F.concat_ws(" ", F.col(words_column))))
    n = F.size(words_column)
    return (F.when(n >= size, window_hashes(words_column, size))
            .when(n > 0, short).otherwise(F.array().cast("array<bigint>")))
