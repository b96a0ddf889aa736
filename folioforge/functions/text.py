"""Column functions over text: normal forms, line and cell kinds, pieces of text.

All are built-in expressions.  White space and figures are spelled out where regular
expression dialects differ: Java's \\s is ASCII only, so U+3000 is named.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes and marks.
LINE_PREFIX = r"^[ \t]*(#{1,6}[ \t]+|[-*+][ \t]+|[0-9]+[.)][ \t]+|>[ \t]*)?"
BLANK = r"[ \t\r\n\x0B\f　]+"
FINALS = ".!?。！？"
FULLWIDTH, ASCII_DIGITS = "０１２３４５６７８９", "0123456789"
CJK_DIGITS = "〇一二三四五六七八九"


def text_of(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def line_core(c: Column) -> Column:
    """A line's letters and figures, without Markdown marks."""
    return F.regexp_replace(F.regexp_replace(c, LINE_PREFIX, ""), r"[^\p{L}\p{N}]", "")


def compare_key(c: Column) -> Column:
    """What two readings are compared by: letters and figures in lower case."""
    return F.lower(line_core(c))


def squash(c: Column) -> Column:
    return F.regexp_replace(c, BLANK, "")


def fold_numerals(c: Column, mark: str = "#") -> Column:
    """Every run of figures as one mark."""
    return F.regexp_replace(c, r"[0-9０-９]+", mark)


def half_width(c: Column) -> Column:
    return F.translate(c, FULLWIDTH, ASCII_DIGITS)


def cjk_value(c: Column) -> Column:
    """The value of figures written digit by digit, else null."""
    plain = F.translate(half_width(c), CJK_DIGITS, ASCII_DIGITS)
    return F.when(plain.rlike("^[0-9]{1,18}$"), plain.cast("bigint"))


def line_kind(c: Column) -> Column:
    """blank, fence, heading, list, table, quote, rule, indented or prose."""
    return (
        F.when(F.trim(c) == "", "blank")
        .when(c.rlike(r"^ {0,3}(```|~~~)"), "fence")
        .when(c.rlike(r"^ {0,3}#{1,6}[ \t]"), "heading")
        .when(c.rlike(r"^ {0,3}([-*_][ \t]*){3,}$"), "rule")
        .when(c.rlike(r"^[ \t]*([-*+]|[0-9]+[.)])[ \t]+"), "list")
        .when(c.rlike(r"^[ \t]*\|") | c.rlike(r" \| "), "table")
        .when(c.rlike(r"^[ \t]*>"), "quote")
        .when(c.rlike(r"^(  |\t)"), "indented")
        .otherwise("prose")
    )


def is_structural(kind: Column) -> Column:
    return kind != "prose"


def gap_kind(c: Column) -> Column:
    """What stands in a gap: figure, dash, dot, mark or none."""
    return F.when(c.rlike(r"[0-9０-９]"), "figure").when(c.rlike(r"[—–―-]"), "dash").when(c.rlike(r"[·•・]"), "dot").when(c.rlike(r"[^\p{L}\p{N} \t\r\n]"), "mark").otherwise("none")


def cell_class(c: Column) -> Column:
    """blank, mark, figure, numeral or text."""
    s = squash(c)
    return F.when(s == "", "blank").when(~s.rlike(r"[\p{L}\p{N}]"), "mark").when(s.rlike(r"^[0-9][0-9,.]+$"), "figure").when(s.rlike(r"^[0-9]$"), "numeral").when(s.rlike(r"^[0-9][0-9,.]*$"), "figure").otherwise("text")


def sentence_finished(c: Column, finals: str = FINALS) -> Column:
    """Whether the last character that is no white space ends a sentence."""
    return F.instr(F.lit(finals), F.right(F.rtrim(c), F.lit(1))).cast("boolean") & (F.rtrim(c) != "")


def pieces(c: Column, size: int = 4) -> Column:
    """All substrings of `size` characters; a shorter text of two or more is one piece.

    A look-ahead match finds them in one pass; substr would count characters from the
    start again for each.
    """
    n = F.length(c)
    every = F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1))
    return F.when(n >= size, every).when(n >= 2, F.array(c)).otherwise(F.array().cast("array<string>"))


def sorted_chars(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, "")), "")


def wilson_lower(good: Column, n: Column, z: float = 1.96) -> Column:
    """Lower end of the Wilson interval of a share."""
    p, zz = good / n, z * z
    return (p + zz / (2 * n) - z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)
