"""Keyed pseudonyms as native expressions: HMAC-SHA-256 cut to 16 bytes.

RFC 2104 is composed from ``sha2``, ``unhex`` and ``concat``, so keys stay in
generated code. The two pads are equivalent to the secret: keep them out of logs
with ``spark.sql.redaction.string.regex`` (see ``REDACTION``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Value for ``spark.sql.redaction.string.regex``: hides binary literals in plans.
REDACTION = r"(?i)0x[0-9a-f]{128}|X'[0-9A-F]{128}'"


def _pads(secret: bytes) -> tuple[bytes, bytes]:
    block = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def hmac16(message: Column, secret: bytes) -> Column:
    """First 32 hex characters of HMAC-SHA-256(secret, message); null for null."""
    inner, outer = _pads(secret)
    lit = lambda b: F.unhex(F.lit(b.hex()))
    first = F.sha2(F.concat(lit(inner), F.encode(message, "UTF-8")), 256)
    return F.left(F.sha2(F.concat(lit(outer), F.unhex(first)), 256), F.lit(32))


def hmac16_sql(message: str, secret: bytes) -> str:
    """The same key as DuckDB SQL, for oracles."""
    inner, outer = _pads(secret)
    return (
        f"left(sha256(from_hex('{outer.hex()}') || from_hex(sha256(from_hex('{inner.hex()}') || encode({message})))), 32)"
    )


def national_id(text: Column) -> Column:
    """Canonical national id: no dots and blanks, no leading zeros, empty is ``0``."""
    return F.coalesce(F.nullif(F.ltrim(F.translate(text, ". ", ""), F.lit("0")), F.lit("")), F.lit("0"))


def person_name(text: Column) -> Column:
    """Upper case, blanks collapsed."""
    return F.upper(F.trim(F.regexp_replace(text, r"\s+", " ")))


def bridge_name(text: Column) -> Column:
    """``SURNAME|FIRST GIVEN NAME`` of ``SURNAME, GIVEN`` or ``SURNAME GIVEN``."""
    name = person_name(text)
    comma = name.contains(",")
    surname = F.trim(F.when(comma, F.substring_index(name, ",", 1)).otherwise(F.split(name, " ")[0]))
    rest = F.trim(F.when(comma, F.substring_index(name, ",", -1)).otherwise(F.regexp_replace(name, r"^\S+\s*", "")))
    return F.concat(surname, F.lit("|"), F.split(rest, " ")[0])


def licence(text: Column) -> Column:
    """Lower case licence without a leading ``mp``."""
    return F.trim(F.regexp_replace(F.lower(F.trim(text)), r"^mp\s*", ""))


def patient_key(dni: Column, secret: bytes) -> Column:
    return hmac16(national_id(dni), secret)


def alternative_key(name: Column, birth: Column, secret: bytes) -> Column:
    return hmac16(F.concat(F.lit("alt|"), bridge_name(name), F.lit("|"), birth), secret)


def physician_key(name: Column, secret: bytes) -> Column:
    return hmac16(F.concat(F.lit("medico|"), person_name(name)), secret)


def licence_key(text: Column, secret: bytes) -> Column:
    return hmac16(F.concat(F.lit("matricula_medico|"), licence(text)), secret)


def document_key(sha: Column, secret: bytes) -> Column:
    return hmac16(F.concat(F.lit("documento|"), F.lower(sha)), secret)


def episode_key(patient: Column, anchor: Column, secret: bytes) -> Column:
    return hmac16(F.concat(patient, F.lit("|"), F.date_format(anchor, "yyyy-MM-dd")), secret)
