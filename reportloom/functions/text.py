"""Spark SQL expressions for picking text apart, as text to be put together and handed to ``F.expr``.

Every function takes an expression, a column name in the simplest case, and gives a larger one. A report's lines are
long expressions; written as SQL they cost one call to build where the Column API makes one for each of their parts.
"""

from __future__ import annotations

import re


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def before(text: str, delimiter: str) -> str:
    """Text before the first delimiter; the whole text where there is none."""
    return f"substring_index({text}, {literal(delimiter)}, 1)"


def after_last(text: str, delimiter: str) -> str:
    """Text after the last delimiter; the whole text where there is none."""
    return f"substring_index({text}, {literal(delimiter)}, -1)"


def through(text: str, delimiter: str) -> str:
    """Text up to and including the first character of the delimiter; empty where there is none."""
    return f"left({text}, locate({literal(delimiter)}, {text}))"


def tail(text: str, delimiter: str) -> str:
    """Text that starts two characters after the delimiter, so past a colon and its blank."""
    return f"substring({text}, locate({literal(delimiter)}, {text}) + 2)"


def swap(text: str, phrase: str, by: str = "") -> str:
    """Replace a literal phrase whatever its case."""
    return rewrite(text, re.escape(phrase), by.replace("$", "\\$"))


def rewrite(text: str, pattern: str, by: str = "") -> str:
    """Replace a pattern whatever its case; ``$1`` stands for its first group."""
    return f"regexp_replace({text}, {literal('(?i)' + pattern)}, {literal(by)})"


def extract(text: str, pattern: str) -> str:
    """The first group of a pattern whatever its case; empty where it does not match."""
    return f"regexp_extract({text}, {literal('(?i)' + pattern)}, 1)"


def drop(text: str, part: str) -> str:
    """Remove a text that may itself be an expression."""
    return f"replace({text}, {part}, '')"


def digits(text: str) -> str:
    """A count as written, without thousands separators and outer blanks."""
    return drop(f"trim({text})", "','")


def number(text: str, type_: str) -> str:
    """A count as a number; NULL where the text is none or does not fit the type."""
    return cast_to(digits(text), type_)


def cast_to(text: str, type_: str) -> str:
    return f"try_cast({text} AS {type_})"


def ends_with(text: str, suffix: str, lowered: bool = False) -> str:
    """Suffix match whatever the case; ``lowered`` says that the text is in lower case already."""
    return f"endswith({text if lowered else f'lower({text})'}, {literal(suffix.lower())})"


def starts_with(text: str, prefix: str) -> str:
    """Prefix match whatever the case."""
    return f"startswith(lower({text}), {literal(prefix.lower())})"


def shown(text: str) -> str:
    """An empty cell is printed as ``x``; a missing one stays NULL and so blanks its whole line."""
    return f"if({text} = '', 'x', {text})"
