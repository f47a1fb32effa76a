"""Text normal forms, word helpers and pattern predicates."""

from __future__ import annotations

import re
import string
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


# What ranges and short forms inside brackets stand for in Java patterns.
_CLASS_MEMBERS = {
    "A-Z": string.ascii_uppercase,
    "a-z": string.ascii_lowercase,
    "0-9": string.digits,
    r"\s": r" \t\n\x0B\f\r",
    r"\p{Alnum}": string.ascii_letters + string.digits,
}


def spelled_out(pattern: str) -> str:
    """The same pattern with the members of its bracket classes one by one.

    Java looks single characters up in one table, but asks several ranges one after another, through calls
    that it cannot inline: a search over ordinary text takes some ten times as long.
    """

    def members(found: re.Match) -> str:
        return re.sub(
            r"A-Z|a-z|0-9|\\p\{Alnum\}|\\.",
            lambda token: _CLASS_MEMBERS.get(token[0], token[0]), found[0],
        )

    return re.sub(r"\\.|\[(?:\\.|[^\]\\])+\]", lambda m: members(m) if m[0][0] == "[" else m[0], pattern)


def coalesce_trim(c: Column) -> Column:
    """NULL becomes empty text, blanks at both ends go (blanks only, not tabs)."""
    return F.trim(F.coalesce(c, F.lit("")))


def collapse_ws(c: Column) -> Column:
    """Every run of white space becomes one blank.

    Single blanks already are what they should become; leaving them out of the pattern lets ordinary
    text through without being rebuilt.
    """
    return F.regexp_replace(c, r"\s{2,}|[^\S ]", " ")


def strip_nondigit(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def strip_nonalnum(c: Column) -> Column:
    return F.regexp_replace(c, spelled_out("[^A-Za-z0-9]"), "")


def zip5(c: Column) -> Column:
    """First five letters or digits of a ZIP code."""
    return F.left(strip_nonalnum(c), F.lit(5))


def word_count(collapsed: Column) -> Column:
    """Number of words of a text whose white space is already collapsed.

    Counting the blanks between words avoids building an array of matches per row.
    """
    text = F.trim(collapsed)
    blanks = F.length(text) - F.length(F.replace(text, F.lit(" ")))
    return F.when(text == "", 0).otherwise(blanks + 1)


def first_word(collapsed: Column) -> Column:
    """Text before the first blank; NULL when there is none."""
    return F.nullif(F.substring_index(collapsed, " ", 1), F.lit(""))


def last_word(collapsed: Column) -> Column:
    """Text after the last blank; NULL when there is none."""
    return F.nullif(F.substring_index(collapsed, " ", -1), F.lit(""))


def mask_all_but_last(c: Column, n: int) -> Column:
    """``****1234``: all characters but the last ``n`` become stars."""
    return F.lpad(F.right(c, F.lit(n)), F.length(c), "*")


def contains_any(c: Column, texts: Iterable[str]) -> Column:
    """Plain, case-sensitive substring test; the same in either match mode."""
    return reduce(or_, [c.contains(t) for t in texts])


class Matcher:
    """Pattern predicates in one of two modes: search anywhere, or match the whole text."""

    def __init__(self, mode: str = "search"):
        self.full = mode == "full"

    def regex(self, c: Column, pattern: str, needs: Iterable[str] = ()) -> Column:
        """Pattern predicate.

        ``needs`` lists plain texts of which every match contains at least one. Texts without any
        are turned down by substring tests, which cost a small part of a pattern search.
        """
        pattern = spelled_out(pattern)
        found = c.rlike(rf"\A(?:{pattern})\z" if self.full else pattern)
        return contains_any(c, needs) & found if needs else found

    def cased_like(self, c: Column, cased: Column) -> Column:
        """Non-blank text with an ASCII letter that equals its own upper or lower form."""
        return (c != "") & (c == cased) & self.regex(c, "[A-Za-z]")

    def any_run(self, c: Column, runs: Iterable[str]) -> Column:
        """One of a list of plain texts, as the pattern ``(a|b|c)``.

        Substring tests do the same as the pattern search and are several times cheaper.
        """
        runs = list(runs)
        return c.isin(runs) if self.full else contains_any(c, runs)

    def any_word(self, c: Column, words: Iterable[str]) -> Column:
        r"""One of a list of plain words between word boundaries, as ``\b(a|b|c)\b``."""
        words = list(words)
        if self.full:
            return c.isin(words)
        pattern = r"\b(" + "|".join(re.escape(w).replace(r"\ ", " ") for w in words) + r")\b"
        return self.regex(c, pattern, needs=words)
