"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_on_space(col) -> Column:
    """Tokens of a line split on single spaces, with the reference's split rules.

    Inner and leading empty tokens are kept, trailing empty tokens are dropped,
    and a line of spaces only yields no token (an empty line yields one empty
    token).  ``rtrim`` removes trailing spaces only, which is exactly the set of
    trailing empty tokens.
    """
    c = F.col(col) if isinstance(col, str) else col
    trimmed = F.rtrim(c)
    return F.when((trimmed == "") & (c != ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, " "))
