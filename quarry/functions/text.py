"""String column expressions (JVM-side, codegen-friendly).

Spark's ``trim`` strips only spaces and Java's ``\\s`` misses several characters
Python's ``str.strip`` removes, so whitespace is an explicit class built from
``config.PY_WHITESPACE``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.config import PY_WHITESPACE

# Java regex character class body with every Python whitespace character.
WS_CLASS = "".join(f"\\u{ord(c):04x}" for c in PY_WHITESPACE)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col: Column | str) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(_c(col), f"^[{WS_CLASS}]+|[{WS_CLASS}]+$", "")


def has_text(col: Column | str) -> Column:
    """True when the string holds any non-whitespace character (``bool(s.strip())``)."""
    return _c(col).rlike(f"[^{WS_CLASS}]")


def normalise_newlines(col: Column | str) -> Column:
    """Universal-newline read: ``\\r\\n`` and lone ``\\r`` become ``\\n``."""
    return F.regexp_replace(_c(col), "\r\n?", "\n")


def basename(path: Column | str) -> Column:
    """``os.path.basename`` for '/'-separated paths (also URIs)."""
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)


def extension(name: Column | str) -> Column:
    """``os.path.splitext(name)[1].lstrip('.')``; leading dots never start an extension."""
    return F.regexp_extract(_c(name), r"^\.*[^.].*\.([^.]*)$", 1)


def preview(col: Column | str, n: int) -> Column:
    """Prefix slice ``s[:n]`` in code points."""
    return F.substring(_c(col), 1, n)
