"""Text functions whose meaning is that of Python's str methods, as Spark columns and as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 29 code points that Python's str.strip() removes.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
NOT_SPACE = SPACE.replace("[", "[^", 1)


def strip(c: Column | str) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def lstrip(c: Column | str) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+", "")


def words(c: Column) -> Column:
    """Python's str.split()."""
    return F.regexp_extract_all(c, F.lit(f"{NOT_SPACE}+"), 0)


def portable_hash(*parts: Column | str) -> Column:
    """A 32-bit number from the md5 of the parts joined by colons: the same in Spark, DuckDB and Python."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 8), 16, 10).cast("long")


def sql_strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def sql_hash(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)"
