"""Text cleaning, blank tests, assembly and tokens.

Java's ``\\s`` and ``\\w`` cover ASCII only, so the Unicode classes are spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Character classes and the patterns made of them.
SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"
URL_PATTERN = rf"https?://[^{SPACE}]+"
MENTION_PATTERN = rf"@[{WORD}]+"
SPACE_RUN_PATTERN = rf"[{SPACE}]+"
# The script starts at U+2E80; testing the range first spares Latin letters the script lookup.
HAN_PATTERN = r"([\x{2e80}-\x{10ffff}&&\p{IsHan}])"
# Everything but letters and digits of lower-case text; ASCII ranges first spare most characters the lookup.
TOKEN_GAP_PATTERN = r"[\x00-\x2f\x3a-\x60\x7b-\x7f[\x{80}-\x{10ffff}&&[^\p{L}\p{N}]]]+"


def strip_noise(text: Column) -> Column:
    """Drop links, then mentions. The order matters: a link may contain ``@``.

    Texts without the first letters of a pattern are not searched with it.
    """
    no_links = F.when(F.contains(text, F.lit("http")), F.regexp_replace(text, URL_PATTERN, "")).otherwise(text)
    no_mentions = F.regexp_replace(no_links, MENTION_PATTERN, "")
    return F.when(F.contains(text, F.lit("@")), no_mentions).otherwise(no_links)


def clean_text(text: Column) -> Column:
    """Drop links and mentions, collapse white space, strip both ends; NULL becomes an empty string."""
    return F.trim(F.regexp_replace(strip_noise(F.coalesce(text, F.lit(""))), SPACE_RUN_PATTERN, " "))


def tokens(text: Column) -> Column:
    """Lower-case letter/digit runs of the cleaned text, each Han character on its own.

    The white-space steps of ``clean_text`` are left out: splitting on everything that is not a
    letter or digit makes them redundant, and they cost a pass over the text. The array may hold
    empty pieces at its ends; no model contains the empty token.
    """
    stripped = strip_noise(text)
    not_ascii = F.octet_length(text) > F.length(text)
    spaced = F.when(not_ascii, F.regexp_replace(stripped, HAN_PATTERN, " $1 ")).otherwise(stripped)
    return F.split(F.lower(spaced), TOKEN_GAP_PATTERN)


def not_blank(text: Column) -> Column:
    """Present and not made of spaces alone (spaces only, as SQL ``trim`` sees them)."""
    return text.isNotNull() & (F.trim(text) != "")


def join_text(*parts: Column) -> Column:
    """Parts joined by one space; NULL parts are skipped, empty ones are not."""
    return F.concat_ws(" ", *parts)


def tag_pieces(text: Column) -> Column:
    """Pieces of a comma list as an array; empty pieces stay."""
    return F.split(F.trim(text), ",")
