"""Column functions on lines and sentences. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The 29 characters that a Unicode-aware strip removes, and the
# same set as a regular-expression class.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = r"(?U)[\s\x1c-\x1f\x85]"

# Runs of line ends, and the token rule. A token is a word with inner
# apostrophes, a number with inner points or commas, or one other character that
# is not whitespace. Repeats are possessive: other repeats of a group take stack for
# every round, so a long list of numbers would overflow it.
LINE_ENDS = r"[\r\n]+"
TOKEN_RULE = (
    r"[\p{L}\p{M}]++(?:['’][\p{L}]++)*+"
    r"|\p{N}++(?:[.,]\p{N}++)*+"
    "|[^\\s\x0b\x1c-\x1f\x85\\p{Z}\\p{L}\\p{M}\\p{N}]"
)

# Penn Treebank tags of single-character tokens.
PUNCTUATION_TAGS = {
    ".": ".?!",
    ",": ",",
    ":": ":;…–—",
    "HYPH": "-",
    "-LRB-": "([{",
    "-RRB-": ")]}",
    "``": "“‘«",
    "''": "\"'”’»",
    "$": "$€£¥",
}


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends.

    Trimming against a character set walks the whole string, so a line whose
    first and last bytes are printable ASCII, which is most of them, skips it.
    """
    raw = text.cast("binary")
    printable = (F.lit(b"\x21"), F.lit(b"\x7f"))
    clean = F.substring(raw, 1, 1).between(*printable) & F.substring(raw, -1, 1).between(*printable)
    return F.when(clean, text).otherwise(F.trim(text, F.lit(WHITESPACE)))


def text_lines(text: Column) -> Column:
    """The stripped, non-empty lines of a multi-line string, in order."""
    stripped = F.transform(F.split(text, LINE_ENDS), strip)
    return F.filter(stripped, lambda line: line != "")


def split_tags(line: Column) -> Column:
    """Split on whitespace runs; no tag is empty, and a blank line has none."""
    return F.filter(F.split(line, WHITESPACE_CLASS + "+"), lambda tag: tag != "")


def tokens(text: Column) -> Column:
    """Token surface forms of a sentence, in order."""
    return F.regexp_extract_all(text, F.lit(TOKEN_RULE), 0)


def shape_lemma(token: Column) -> Column:
    """The lemma of a token that no lexicon knows."""
    return F.lower(token)


def shape_pos1(token: Column) -> Column:
    """The coarse part of speech that the first character of a token gives."""
    return (
        F.when(_is_ascii_word(token) | token.rlike(r"^[\p{L}\p{M}]"), "X")
        .when(token.rlike(r"^\p{N}"), "NUM")
        .when(token.rlike(r"^\p{P}"), "PUNCT")
        .when(token.rlike(r"^\p{S}"), "SYM")
        .otherwise("X")
    )


def shape_pos2(token: Column) -> Column:
    """The fine tag that the first character of a token gives."""
    tag = F.when(_is_ascii_word(token) | token.rlike(r"^[\p{L}\p{M}]"), "XX").when(token.rlike(r"^\p{N}"), "CD")
    for name, characters in PUNCTUATION_TAGS.items():
        tag = tag.when(token.isin(*characters), name)
    return tag.when(token.rlike(r"^[\p{P}\p{S}]"), "SYM").otherwise("XX")


def _is_ascii_word(token: Column) -> Column:
    # Most tokens are, and comparing strings is cheaper than matching a pattern.
    return ((token >= "a") & (token < "{")) | ((token >= "A") & (token < "["))


def explode_with_position(df: DataFrame, keep: Sequence[str], items: Column, position: str, item: str) -> DataFrame:
    """One row per array item with its 0-based position.

    From a plain explode the optimizer infers a filter on the array being
    non-empty, which computes `items` again for each of its two conditions. The
    outer form with a filter on the position computes it once.
    """
    exploded = df.select(*keep, F.posexplode_outer(items).alias(position, item))
    return exploded.filter(F.col(position).isNotNull())
