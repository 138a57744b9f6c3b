"""Pseudonyms and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def salted_sha256(col: Column, salt: str, required: bool = False) -> Column:
    """Lower-case hex SHA-256 of ``salt:id``; one identifier keeps one key per salt.

    A NULL identifier gives NULL. With ``required`` the caller vouches that there is
    none: the optimizer then knows the key is not NULL either, and joins do not hash
    every row a second time to test it.
    """
    prefix = F.lit(f"{salt}:")
    text = F.concat_ws("", prefix, col) if required else F.concat(prefix, col)
    return F.sha2(text, 256)


def md5_key(*parts: Column, separator: str = "|", null_token: str | None = None) -> Column:
    """MD5 over the joined parts.

    Without ``null_token`` a NULL part gives a NULL key. With it the part is hashed
    as that token, so NULL and the literal token share a key.
    """
    texts = [p.cast("string") for p in parts]
    if null_token is not None:
        texts = [F.coalesce(t, F.lit(null_token)) for t in texts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit(separator), text]
    return F.md5(F.concat(*joined))


# Behind this many zero bytes stands a text that is no digest; digests are shorter.
_PLAIN = bytes(33)


def packed(col: Column) -> Column:
    """A text key as bytes for shuffles and joins, half as long where it is a hex digest.

    Equal texts, and only those, have equal bytes: MD5 and SHA-256 in lower-case hex take 16 and 32
    bytes, any other text more. NULL stays NULL. ``unpacked`` gives the text back.
    """
    digest = col.rlike("^([0-9a-f]{32}|[0-9a-f]{64})\\z")
    return F.when(digest, F.unhex(col)).otherwise(F.concat(F.lit(_PLAIN), col.cast("binary")))


def unpacked(col: Column) -> Column:
    plain = F.substring(col, len(_PLAIN) + 1, 2**31 - 1).cast("string")
    return F.when(F.length(col) < len(_PLAIN), F.lower(F.hex(col))).otherwise(plain)


def date_key(col: Column) -> Column:
    """``YYYYMMDD`` as INT by arithmetic, which stays in generated code."""
    return F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)
