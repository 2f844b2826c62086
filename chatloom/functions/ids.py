"""Identifiers: trimming, blank tests, salted hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as blank around identifiers.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200E))) + "\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"

#: Java pattern of a visible character: not white space, separator, control or format character,
#: nor one of the letters that print as nothing.
VISIBLE = r"[^\s\p{Z}\p{Cc}\p{Cf}\x{115F}\x{1160}\x{2800}\x{3164}\x{FFA0}]"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_id(c: Column | str) -> Column:
    """The identifier without blanks around it; NULL for a null or empty one."""
    return F.nullif(F.trim(_column(c), F.lit(BLANKS)), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for null, empty, and text without a visible character."""
    return ~F.coalesce(_column(c).rlike(VISIBLE), F.lit(False))


def hash_author(raw: Column | str, salt: str) -> Column:
    """the first 16 hex digits of sha256("salt:id")."""
    return F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), _column(raw).cast("string")), 256), 1, 16)


def hash_stream_user(raw: Column | str, salt: str) -> Column:
    """"u_" and 12 hex digits of sha256(salt + id); "unknown" for a null or empty id."""
    raw = _column(raw).cast("string")
    hashed = F.concat(F.lit("u_"), F.substring(F.sha2(F.concat(F.lit(salt), raw), 256), 1, 12))
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit("unknown")).otherwise(hashed)


def content_hash(text: Column | str) -> Column:
    """the first 16 hex digits of sha256(text)."""
    return F.substring(F.sha2(_column(text), 256), 1, 16)


def export_key(path: str) -> str:
    """the key of an export: the first 16 hex digits of sha256 of its path, made absolute."""
    import hashlib
    from pathlib import Path

    return hashlib.sha256(str(Path(path).resolve()).encode()).hexdigest()[:16]
