"""Column expressions that turn a text column into terms; no Python code per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the delimiters that every term-based result depends on. All are single
# characters (matched as one class, which is several times faster than alternatives) but
# the last: a pipe followed by a slash. Neither of these two splits on its own.
DELIMITERS = r"""[\s\d.!?,;:()\[\]{}\-_"`~#&*%$]|\|/"""

# Variant in which a single pipe and a single slash split too.
DELIMITERS_PIPE_SLASH = DELIMITERS + r"|\||/"

# Short English list used by the registered queries; callers pass their own.
STOPWORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "had", "has", "he",
    "in", "is", "it", "its", "of", "on", "or", "that", "the", "this", "to", "was", "were",
    "will", "with",
]


def delimiter_pattern(split_pipe_slash: bool = False) -> str:
    return DELIMITERS_PIPE_SLASH if split_pipe_slash else DELIMITERS


def tokens(text: Column, split_pipe_slash: bool = False, fold: bool = True) -> Column:
    """All non-empty tokens in order, folded to lower case by default."""
    source = F.lower(text) if fold else text
    return F.array_remove(F.split(source, delimiter_pattern(split_pipe_slash)), "")


def without(words: Column, stopwords: list[str]) -> Column:
    """Distinct words that are not in the list."""
    if not stopwords:
        return F.array_distinct(words)
    return F.array_except(words, F.array(*[F.lit(w) for w in stopwords]))


def distinct_terms(text: Column, stopwords: list[str], stop_before_fold: bool = False,
                   split_pipe_slash: bool = False) -> Column:
    """Set of terms of one document. A null text has no terms."""
    if stop_before_fold:
        kept = without(tokens(text, split_pipe_slash, fold=False), stopwords)
        return F.array_distinct(F.transform(kept, F.lower))
    return without(tokens(text, split_pipe_slash), stopwords)
