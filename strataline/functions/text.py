"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a warehouse TRIM() removes (Unicode White_Space).
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The word delimiters INITCAP() honours besides whitespace.
WORD_DELIMITERS = r"""\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""

# Words a title keeps in lower case unless they open it.
TITLE_STOP_WORDS = ("and", "or", "at", "the", "a", "an", "in", "of", "to")


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_all(value: Column | str) -> Column:
    """Strip every kind of whitespace from both ends, not only blanks."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def has_outer_whitespace(value: Column | str, leading_only: bool = False) -> Column:
    """True when trimming would shorten the text.

    ``leading_only`` reproduces engines whose LEN() ignores trailing blanks, so
    that a length comparison can only ever notice leading ones.
    """
    text = as_column(value)
    if leading_only:
        return text.startswith(" ") & (F.length(F.trim(text)) > 0)
    return F.length(text) != F.length(trim_all(text))


def remove_text(value: Column | str, text: str) -> Column:
    return F.replace(as_column(value), F.lit(text), F.lit(""))


def capitalise_words(value: Column | str) -> Column:
    """INITCAP with the full delimiter set: 'n/a' -> 'N/A', 'bib-shorts' -> 'Bib-Shorts'.

    Spark's own ``initcap`` only breaks words at blanks. The text is cut into runs
    of word characters and runs of delimiters, each run gets an upper-case first
    character, and the runs are glued back together.
    """
    runs = F.regexp_extract_all(
        F.lower(as_column(value)),
        F.lit(f"[^{WORD_DELIMITERS}]+|[{WORD_DELIMITERS}]+"),
        F.lit(0),
    )
    return F.array_join(F.transform(runs, upper_first), "")


def upper_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def title_case(value: Column | str, keep_missing_marker: bool = True) -> Column:
    """Title case with stop words: 'the lord OF the rings' -> 'The Lord of the Rings'."""
    text = as_column(value)
    words = F.split(F.lower(text), " ")

    def shape(word: Column, position: Column) -> Column:
        keep_lower = (position > 0) & word.isin(*TITLE_STOP_WORDS)
        return F.when(keep_lower, word).otherwise(upper_first(word))

    titled = F.rtrim(F.array_join(F.transform(words, shape), " "))
    if not keep_missing_marker:
        return titled
    return F.when(F.lower(text) == "n/a", F.lit("n/a")).otherwise(titled)


def capitalise_first(value: Column | str, missing: str = "n/a") -> Column:
    """Upper-case the first character, lower-case the rest; NULL becomes ``missing``."""
    text = F.trim(as_column(value))
    return F.coalesce(
        F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2)))),
        F.lit(missing),
    )


def zero_padded(value: Column | str, width: int) -> Column:
    """Pad with leading zeros; longer numbers stay whole (``lpad`` would cut them)."""
    text = as_column(value).cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
