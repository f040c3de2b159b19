"""Column expressions reproducing the Java string behaviour the jobs rely on.

``String.split`` drops trailing empty strings, while
Spark's ``split`` keeps them. The rules (all JVM-side, no UDF):

* empty input             -> one empty token
* input made only of separators -> no token
* otherwise               -> strip trailing separators, then split

Patterns end in ``\\z``: ``$`` would also match before a last line terminator.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c, sep: str) -> Column:
    """Java ``s.split(sep)`` for a literal one-character separator."""
    s = _col(c)
    esc = re.escape(sep)
    # SQL rtrim strips spaces only, and needs no regex
    stripped = F.rtrim(s) if sep == " " else F.regexp_replace(s, rf"(?:{esc})+\z", "")
    return (
        F.when(s.isNull(), F.lit(None))
        .when(s == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, esc))
    )


def half_up(c) -> Column:
    """``Math.round`` for doubles (ties towards positive infinity), as double."""
    return F.floor(_col(c) + F.lit(0.5)).cast("double")


def text_lines(c) -> Column:
    """Lines of a text value the way a line reader sees a file.

    Terminators are ``\\n``, ``\\r`` and ``\\r\\n``; a final terminator does not
    start an empty line and an empty text has no lines.
    """
    s = _col(c)
    body = F.regexp_replace(s, r"(?:\r\n|\r|\n)\z", "")
    return (
        F.when(s.isNull() | (s == ""), F.array().cast("array<string>"))
        .otherwise(F.split(body, r"\r\n|\r|\n"))
    )
