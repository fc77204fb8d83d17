"""Small string expressions: anchors, year prefix, archive predicate, path stem, templates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def end_anchored(pattern: str) -> str:
    """Make ``^``/``$`` anchor at the very start/end of the text.

    Java's ``$`` also matches before a final newline; the data-test engine's does not.
    Unescaped leading ``^`` becomes ``\\A`` and unescaped trailing ``$`` becomes ``\\z``.
    """
    out = pattern
    if out.startswith("^"):
        out = "\\A" + out[1:]
    if out.endswith("$") and not re.search(r"(?<!\\)(\\\\)*\\\$$", out):
        out = out[:-1] + "\\z"
    return out


def matches(col: Column, pattern: str) -> Column:
    """Search-style regex match with text-end anchors."""
    return col.rlike(end_anchored(pattern))


def year_prefix(col: Column) -> Column:
    """First four characters as int when they are all ASCII digits, else NULL."""
    return F.when(col.rlike("\\A[0-9]{4}"), F.substring(col, 1, 4).cast("int"))


def path_stem(col: Column) -> Column:
    """Last path component without its last suffix (``/api/glossary.json`` -> ``glossary``).

    As for POSIX path objects: trailing slashes are ignored, a leading dot is not a suffix
    (``.hidden`` stays), and a final ``.`` with nothing after it is kept.
    """
    name = F.regexp_extract(col, "([^/]*)/*$", 1)
    return F.regexp_replace(name, "(?<=.)\\.[^.]+$", "")
