"""Text functions with Python string semantics, kept on the JVM.

Spark's own ``trim``, ``initcap``, ``\\s`` and ``\\w`` differ from Python's
``str`` methods outside plain ASCII; these compositions agree with Python.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# A word is a run of anything else. (?U) makes \s the Unicode property.
WORD = r"(?U)[^\s\x1c-\x1f]+"

# The Unicode property "Cased": title casing restarts after anything else.
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{Lt}"
# A code point that is no character, for temporary use inside a text.
_MARK = "\ufdd0"

# Fixed value: what may stay in a phone number.
PHONE_NOISE = r"[^\d\+\-\(\) x]"


def strip(text: Column) -> Column:
    """Without leading and trailing Unicode whitespace; linear in the text."""
    return F.btrim(text, F.lit(WHITESPACE))


def title_case(text: Column) -> Column:
    """First letter of every run of letters upper, the rest lower.

    ``initcap`` starts words after blanks only, so a marked blank is put where
    a run starts otherwise, and taken out again. A text that holds the mark
    itself is cut into runs instead, which gives the same and takes longer.
    """
    start = f"([^{_CASED} ])(?=[{_CASED}])"
    spaced = F.regexp_replace(text, start, f"$1{_MARK} ")
    marked = replace_text(F.initcap(spaced), f"{_MARK} ", "")
    runs = F.regexp_extract_all(text, F.lit(f"[{_CASED}]+|[^{_CASED}]+"), F.lit(0))
    cut = F.array_join(F.transform(runs, F.initcap), "")
    return F.when(F.contains(text, F.lit(_MARK)), cut).otherwise(marked)


def word_count(text: Column) -> Column:
    """Whitespace-separated words; 0 for an empty or blank text."""
    return F.regexp_count(text, F.lit(WORD))


def remove_matches(text: Column, pattern: str) -> Column:
    """Delete every match, with Unicode ``\\d``, ``\\w`` and ``\\s``."""
    return F.regexp_replace(text, f"(?U){pattern}", "")


def clean_phone(text: Column) -> Column:
    return remove_matches(text, PHONE_NOISE)


def replace_text(text: Column, old: str, new: str) -> Column:
    """Literal replacement, no pattern."""
    return F.replace(text, F.lit(old), F.lit(new))


def length(text: Column) -> Column:
    """Length in code points."""
    return F.char_length(text)


def matches_from_start(text: Column, pattern: str) -> Column:
    """Whether the pattern matches at the first character.

    Unicode classes; ``$`` and ``.`` treat only a line feed as a line end. The
    pattern is a Java one: its ``\\s`` lacks the separators ``\\x1c`` to ``\\x1f``.
    """
    return text.rlike(f"(?Ud)^(?:{pattern})")


def map_values(value: Column, mapping: Mapping) -> Column:
    """Replace by lookup in a small literal mapping; unmapped gives null."""
    result = F.lit(None)
    for key, replacement in reversed(list(mapping.items())):
        result = F.when(value == F.lit(key), F.lit(replacement)).otherwise(result)
    return result
