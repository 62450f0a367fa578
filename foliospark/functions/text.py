"""Text functions with the semantics of Python's str methods, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what counts as white space.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"


def strip(c: Column | str) -> Column:
    """Without white space of any kind at both ends; null stays null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def words(c: Column | str) -> Column:
    """The words between white space; empty and null texts give no words."""
    c = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(F.coalesce(c, F.lit("")), f"{SPACE}+"), lambda x: x != "")


def bucket_10000(c: Column | str) -> Column:
    """int(sha256(text)) modulo 10,000, by Horner's rule over eight words of 32 bits."""
    c = F.col(c) if isinstance(c, str) else c
    h = F.sha2(c, 256)
    acc = F.lit(0).cast("bigint")
    for i in range(8):
        acc = (acc * 4294967296 + F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")) % 10000
    return acc


def uuid5_dns(name: Column) -> Column:
    """uuid5 of a name in the DNS namespace; null gives null."""
    digest = F.sha1(F.concat(F.unhex(F.lit("6ba7b8109dad11d180b400c04fd430c8")), F.encode(name, "utf-8")))
    variant = F.substring(F.lit("89ab"), F.pmod(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1, F.lit(1))
    dashed = F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))
    return F.when(digest.isNotNull(), dashed)


def sql_bucket(expr: str) -> str:
    acc = "0"
    for i in range(8):
        acc = f"(({acc}) * 4294967296 + cast('0x' || substr(sha256({expr}), {8 * i + 1}, 8) as bigint)) % 10000"
    return f"({acc})"
