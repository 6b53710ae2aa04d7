"""Column expressions over text: tokens, sentences, openings, envelopes, n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokenizers that gates count words with.
TOKENIZERS = {"blank": r"\S+", "word": r"[\p{L}\p{N}_'-]+", "plain": r"[a-z0-9']+", "strict": r"[a-z0-9]+"}


def tokens(text: Column, kind: str) -> Column:
    """Tokens of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({TOKENIZERS[kind]})"), F.lit(1))


def token_count(text: Column, kind: str) -> Column:
    return F.regexp_count(F.lower(text), F.lit(TOKENIZERS[kind]))


def sentence_count(text: Column) -> Column:
    """Sentences end in a mark and white space, or with the text."""
    return F.regexp_count(F.regexp_replace(text, r"\s+$", ""), F.lit(r"[.!?]\s+")) + 1


def opening(text: Column, n: int = 8) -> Column:
    """The first n plain tokens."""
    return F.array_join(F.slice(tokens(text, "plain"), 1, n), " ")


def ngrams(words: Column, n: int = 4) -> Column:
    """Distinct runs of n words; a shorter text is one gram, an empty one has none."""
    count = F.greatest(F.size(words) - n + 1, F.lit(0))
    many = F.slice(words, 1, count)
    for i in range(1, n):  # shifted copies side by side; `words` itself stays out of the lambdas, which would evaluate it for each gram
        many = F.zip_with(many, F.slice(words, i + 1, count), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) >= n, F.array_distinct(many)).when(F.size(words) > 0, F.array(F.array_join(words, " "))).otherwise(F.array().cast("array<string>"))


def gram_hashes(words: Column, n: int = 4) -> Column:
    """Distinct 64-bit hashes that stand for the grams of ngrams()."""
    count = F.greatest(F.size(words) - n + 1, F.lit(0))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    many = F.slice(hashes, 1, count)
    for i in range(1, n):
        many = F.zip_with(many, F.slice(hashes, i + 1, count), lambda a, b: F.xxhash64(a, b))
    return F.when(F.size(words) >= n, F.array_distinct(many)).when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(F.array().cast("array<bigint>"))


def json_keys(text: Column) -> Column:
    """Keys at every depth of a JSON text, repeats included: the strings that a colon follows. Strings are read whole, so one that is a
    value hides what looks like a key in it."""
    strings = F.regexp_extract_all(text, F.lit(r'("(?:[^"\\]|\\.)*"\s*:?)'), F.lit(1))
    return F.transform(F.filter(strings, lambda s: s.endswith(":")), lambda k: F.regexp_extract(k, r'(?s)^"(.*)"\s*:$', 1))
