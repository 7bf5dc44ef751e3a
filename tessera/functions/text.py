"""Column expressions for splitting text into words (JVM-side, codegen'd)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's tokenizer) -------------------
# Delimiter characters of the normalising word count, in the reference's
# order: space * $ & # / TAB NEWLINE FORMFEED " ' \ , . : ; ? ! [ ] ( ) { } < > ~ - _
WORD_DELIMITERS = " *$&#/\t\n\f\"'\\,.:;?![](){}<>~-_"
# ---------------------------------------------------------------------------

# The same set as one regular-expression character class.
WORD_DELIMITER_REGEX = "[" + re.escape(WORD_DELIMITERS) + "]+"


def split_on_space(line: Column) -> Column:
    """Java ``String.split(" ")``: trailing empty strings dropped, inner and
    leading ones kept; an empty line is one empty word, an all-space line none.

    Spark's ``split`` keeps trailing empties, so trailing spaces are trimmed
    first and the two corner cases are spelled out.
    """
    trimmed = F.rtrim(line, F.lit(" "))
    return (
        F.when(line == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, " "))
    )


def delimited_pieces(line: Column) -> Column:
    """Pieces between runs of the fixed delimiters (may include empty pieces
    at the ends; callers drop them and lower-case each word)."""
    return F.split(line, WORD_DELIMITER_REGEX)


def whitespace_words(text: Column) -> Column:
    """Words separated by runs of space, tab, CR or LF; no empty words."""
    return F.array_remove(F.split(text, r"[ \t\r\n]+"), "")


def text_lines(text: Column) -> Column:
    """Lines of an in-table text: split on newline, empties kept."""
    return F.split(text, "\n")
