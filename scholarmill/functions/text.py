"""Text measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The keywords whose presence becomes a flag.
KEYWORDS = ("survey", "benchmark", "state-of-the-art", "novel", "we propose")

# Unicode white space, plus the four separators U+001C..U+001F that a whitespace split also drops.
_WORD = r"(?U)[^\s\x1c-\x1f]+"
_WORD_WITHOUT_VOWEL = r"(?iU)(?<![^\s\x1c-\x1f])[^\s\x1c-\x1faeiouy]+(?![^\s\x1c-\x1f])"


def word_count(text: Column) -> Column:
    """Pieces between white space; 0 for the empty string, null for null."""
    return F.regexp_count(text, F.lit(_WORD))


def dollar_count(text: Column) -> Column:
    """How many ``$`` the text holds; 0 for null."""
    return F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("$"), F.lit(""))), F.lit(0))


def bracket_refs(text: Column) -> Column:
    """How many numbered references such as ``[12]`` the text holds; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\[\d+\]")), F.lit(0))


def syllable_count(text: Column) -> Column:
    """Vowel runs, which never span two words, and one for each word without a vowel."""
    return (F.regexp_count(text, F.lit("(?i)[aeiouy]+"))
            + F.regexp_count(text, F.lit(_WORD_WITHOUT_VOWEL)))


def sentence_count(text: Column) -> Column:
    return F.greatest(F.lit(1), F.regexp_count(text, F.lit("[.!?]+")))


def reading_ease(text: Column) -> Column:
    """Flesch reading ease with counted vowel runs as syllables; null for null."""
    words = word_count(text)
    per_sentence = words / sentence_count(text)
    per_word = F.coalesce(F.try_divide(syllable_count(text), words), F.lit(0.0))
    return F.when(text.isNotNull(), 206.835 - 1.015 * per_sentence - 84.6 * per_word)


def flag_name(keyword: str) -> str:
    return "has_" + keyword.replace("-", "_").replace(" ", "_")


def keyword_flags(title: Column, abstract: Column, keywords=KEYWORDS) -> dict[str, Column]:
    """One 0/1 column per keyword: literal containment in the lower-cased title and abstract."""
    lowered = F.lower(F.concat_ws(" ", title, abstract))
    return {flag_name(k): F.contains(lowered, F.lit(k.lower())).cast("int") for k in keywords}


def author_count(authors: Column) -> Column:
    """Comma-separated pieces; 1 for the empty string, null for null."""
    return F.size(F.split(authors, ","))
