"""Text helpers built from Spark's own column functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def qcol(name: str) -> Column:
    """Column reference that is safe for names holding dots, brackets or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def dash_date(c: Column) -> Column:
    """``YYYYMMDD`` text as ``YYYY-MM-DD``; NULL stays NULL."""
    text = c.cast("string")
    return F.concat(
        F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"), F.substring(text, 7, 2)
    )


def base_name(path: Column) -> Column:
    """Text after the last slash; NULL when nothing follows it."""
    return F.regexp_substr(path, F.lit("[^/]+$"))


def text_after(text: Column, part: Column) -> Column:
    """``/`` plus the text after the first occurrence of ``part``; the whole text when absent."""
    pos = F.position(part, text)
    return F.when(
        part.isNotNull() & text.isNotNull() & (pos > 0),
        F.concat(F.lit("/"), F.substr(text, pos + F.length(part))),
    ).otherwise(text)


def event_id(path: Column, row_number: Column) -> Column:
    """Surrogate key: hex SHA-256 over ``path|row``; NULL when either part is NULL."""
    return F.sha2(F.concat(path, F.lit("|"), row_number.cast("string")), 256)


def null_tokens(c: Column, tokens: Iterable[str]) -> Column:
    """NULL for any of the null spellings, otherwise the text itself."""
    tokens = list(tokens)
    return F.when(~c.isin(tokens), c) if tokens else c


def split_target(name: str) -> tuple[str, str, str]:
    """``DB.SCHEMA.TABLE`` into its parts; missing parts are empty text."""
    parts = (name or "").split(".")
    return tuple((parts + ["", "", ""])[:3])
