"""Record ids: 32 hexadecimal digits in whatever spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The 8-4-4-4-12 spelling, for texts that hold other hexadecimal digits around the id.
CANONICAL = r"(?i)(?<![0-9a-f])[0-9a-f]{8}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{4}-?[0-9a-f]{12}(?![0-9a-f])"
#: The usual spelling, which needs no change.
USUAL = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"


def id_hex(c: Column | str) -> Column:
    """The 32 lower-case digits of an id, null where the text names nothing.

    Everything that is no digit is dropped; where other digits stand around the id (as in a prefix
    ``uuid:``), the one run in canonical spelling counts. Null, empty and digitless texts give null.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(USUAL), F.replace(c, F.lit("-"), F.lit(""))).otherwise(_any_hex(c))


def _any_hex(c: Column) -> Column:
    digits = F.lower(F.regexp_replace(c, "[^0-9A-Fa-f]", ""))
    inner = F.lower(F.regexp_replace(F.regexp_extract(c, CANONICAL, 0), "-", ""))
    return F.when(F.length(digits) == 32, digits).when((F.length(digits) > 32) & (F.length(inner) == 32), inner)


def norm_id(c: Column | str) -> Column:
    """An id in lower case as 8-4-4-4-12, or null. Ids that are so already take the short way."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(USUAL), c).otherwise(F.regexp_replace(_any_hex(c), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def sql_hex(c: str) -> str:
    """The same digits in DuckDB's SQL."""
    d = f"lower(regexp_replace({c}, '[^0-9A-Fa-f]', '', 'g'))"
    h = "[0-9A-Fa-f]"
    inner = f"lower(replace(regexp_extract({c}, '(?:^|[^0-9A-Fa-f])({h}{{8}}-?{h}{{4}}-?{h}{{4}}-?{h}{{4}}-?{h}{{12}})(?:[^0-9A-Fa-f]|$)', 1), '-', ''))"
    return f"(case when length({d}) = 32 then {d} when length({d}) > 32 and length({inner}) = 32 then {inner} end)"


def sql_id(c: str) -> str:
    d = sql_hex(c)
    return f"(substr({d},1,8)||'-'||substr({d},9,4)||'-'||substr({d},13,4)||'-'||substr({d},17,4)||'-'||substr({d},21,12))"
