"""Text helpers (C14, C31, J33 tokens, path and prefix parsing)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .casts import as_col

# Characters kept by the tokeniser (ASCII word and space classes).
NON_TOKEN = r"[^0-9A-Za-z_\t\n\f\r ]"


def initcap_words(c: str | Column) -> Column:
    """Title case that also starts a word after ``_`` (N6): NOT_OK -> Not_Ok."""
    pieces = F.split(as_col(c), "_")
    return F.array_join(F.transform(pieces, lambda x: F.initcap(x)), "_")


def blank_to_null(c: str | Column) -> Column:
    """Empty string counts as missing."""
    return F.nullif(as_col(c), F.lit(""))


def phrase_text(headline: str | Column, body: str | Column, placeholder: str) -> Column:
    """``headline body``; ``placeholder`` when both are missing."""
    h, b = as_col(headline), as_col(body)
    return (F.when(h.isNull() & b.isNull(), F.lit(placeholder))
            .otherwise(F.concat(F.coalesce(h, F.lit("")), F.lit(" "), F.coalesce(b, F.lit("")))))


def tokens(c: str | Column, min_length: int, stop_words: Sequence[str]) -> Column:
    """Array of lower-cased tokens, symbols removed, short and stop words out."""
    words = F.split(F.regexp_replace(F.lower(as_col(c)), NON_TOKEN, ""), " ")
    stop = list(stop_words)
    return F.filter(words, lambda w: (F.length(w) >= min_length) & ~w.isin(stop))


def shorten(c: str | Column, width: int, mark: str = "...") -> Column:
    """First ``width`` characters plus ``mark`` when the text is longer."""
    col = as_col(c)
    return F.when(F.length(col) > width, F.concat(F.left(col, F.lit(width)), F.lit(mark))).otherwise(col)


def path_tail(c: str | Column, sep: str = "~", empty_as_null: bool = False) -> Column:
    """Last piece of a resource path."""
    tail = F.substring_index(as_col(c), sep, -1)
    return blank_to_null(tail) if empty_as_null else tail


def hour_of_range(c: str | Column) -> Column:
    """Hour of ``HH:MM:SS - HH:MM:SS``; missing text is hour 0."""
    return F.coalesce(F.split(as_col(c), ":")[0], F.lit("00")).try_cast("int")


def remove_all(c: str | Column, piece: str) -> Column:
    """Remove every occurrence of a literal (account id prefixes)."""
    return F.replace(as_col(c), F.lit(piece), F.lit(""))


def replace_in_order(c: str | Column, replacements: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements applied one after another."""
    col = as_col(c)
    for old, new in replacements:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col
