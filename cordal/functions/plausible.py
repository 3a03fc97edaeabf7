"""Deterministic plausible stand-ins for the values of a text.

Every token is replaced by one of the same shape drawn from its own hash: digits by
digits, letters by alternating consonants and vowels in the same case, dates and
times by valid ones, ages by ages. Allowed terms stay.
"""

from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"\d{1,2}/\d{1,2}/\d{4}|\d{1,2}-[A-Za-z]{3}-\d{4}|\d{1,2}:\d{2}(?::\d{2})?|\d+|[^\W\d_]+")
_MONTHS = "JAN FEB MAR APR MAY JUN JUL AUG SEP OCT NOV DEC".split()
_CONSONANTS, _VOWELS = "bcdfghjklmnpqrtvwxyz", "aeiou"


def _draw(token: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}|{token}".encode()).digest()[:8], "big")


def _letters(token: str, salt: str) -> str:
    n, out = _draw(token.lower(), salt), []
    for i, c in enumerate(token):
        pool = _CONSONANTS if (i + n) % 2 else _VOWELS
        n, r = divmod(n * 6364136223846793005 + 1442695040888963407, len(pool))
        n &= (1 << 64) - 1
        out.append(pool[r].upper() if c.isupper() else pool[r])
    return "".join(out)


def stand_in(token: str, salt: str) -> str:
    """The stand-in of one token; the same token always gets the same one."""
    n = _draw(token, salt)
    if "/" in token or re.fullmatch(r"\d{1,2}-[A-Za-z]{3}-\d{4}", token):
        day = date(1950, 1, 1) + timedelta(days=n % 25_000)
        if "/" in token:
            return day.strftime("%d/%m/%Y")
        return f"{day.day:02d}-{_MONTHS[day.month - 1]}-{day.year}"
    if ":" in token:
        clock = f"{n % 24:02d}:{n // 24 % 60:02d}"
        return clock + (f":{n // 1440 % 60:02d}" if token.count(":") == 2 else "")
    if token.isdigit():
        first = str(1 + n % 9) if token[0] != "0" else "0"
        return (first + str(n // 9).zfill(len(token)))[: len(token)]
    return _letters(token, salt)


def plausible_text(text: str, allowed: frozenset[str], salt: str) -> str:
    return _TOKEN.sub(lambda m: m.group() if m.group().upper() in allowed else stand_in(m.group(), salt), text)


def plausible(text: Column, allowed: list[str], salt: str) -> Column:
    """Texts with stand-ins; ``allowed`` words (any case) stay as they are."""
    keep = frozenset(w.upper() for a in allowed for w in a.split())

    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: None if t is None else plausible_text(t, keep, salt))

    return F.pandas_udf(run, "string", F.PandasUDFType.SCALAR)(text)
