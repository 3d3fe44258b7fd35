"""Text rules shared by the silver and gold layers (all JVM-side expressions)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, the no-break space included. As character lists these
# are several times faster than a regular expression on every cell.
_WS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_whitespace(c: Column) -> Column:
    # Trimming by a list costs a search per end; most values begin and end with plain ASCII.
    plain = F.ascii(c).between(33, 126) & F.ascii(F.substring(c, -1, 1)).between(33, 126)
    return F.when(plain, c).otherwise(F.btrim(c, F.lit(_WS)))


def normalize_household_id(c: Column) -> Column:
    """Upper case, no white space anywhere."""
    return F.upper(F.translate(c, _WS, ""))


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def clean_label(c: Column) -> Column:
    """A choice label without square brackets and outer blanks."""
    return F.trim(F.regexp_replace(c, r"[\[\]]", ""))


def match_key(c: Column) -> Column:
    """Case- and punctuation-free key for comparing names or labels."""
    return F.regexp_replace(F.lower(c), r"[^a-z0-9]", "")


def normalize_header(name: str) -> str:
    return re.sub(r"\s+", " ", name.strip())


def column_base(c: Column, pattern: str) -> Column:
    """The name in front of a numeric suffix; NULL when there is no suffix."""
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))
