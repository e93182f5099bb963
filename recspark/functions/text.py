"""Column functions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the characters the word tokenizer turns into blanks
TOKEN_FILTER = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"
# fixed value: the character range kept by the CJK cleaning
CJK = "一-鿿"
BLANK = "[\\s\\p{Z}]"


def words(text: Column, separator: str = " ") -> Column:
    """Lower-case words; filtered characters and `separator` split, empty words are dropped."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    if separator != " ":
        lowered = F.replace(lowered, F.lit(separator), F.lit(" "))
    plain = F.translate(lowered, TOKEN_FILTER, " " * len(TOKEN_FILTER))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def keep_characters(text: Column, kept: str = CJK) -> Column:
    """Other characters become blanks, runs of blanks one blank, ends are trimmed."""
    blanked = F.regexp_replace(text, f"[^{kept}]", " ")
    return F.trim(F.regexp_replace(blanked, " {2,}", " "))


def characters(text: Column, kept: str = CJK) -> Column:
    """The kept characters one by one; a text without any gives one empty token."""
    only = F.regexp_replace(text, f"[^{kept}]", "")
    return F.when(only == "", F.array(F.lit(""))).otherwise(F.split(only, ""))


def strip_lines(text: Column) -> Column:
    """Strip every line, drop the empty ones, join them again."""
    lines = F.transform(
        F.split(text, "\r\n|\r|\n"),
        lambda line: F.regexp_replace(line, f"^{BLANK}+|{BLANK}+$", ""),
    )
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def without_words(tokens: Column, stop: list[str]) -> Column:
    """Drop the listed words; order and repeats of the others stay. For short lists."""
    return F.filter(tokens, lambda w: ~w.isin(stop)) if stop else tokens
