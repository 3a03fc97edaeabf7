"""Pieces of printed text as patterns, made from plain label texts.

A label is written as it is printed: a blank stands for any number of blanks, what
is in parentheses may be missing, a closing ``:?`` says that the colon may be missing.
Accented vowels match with or without their accent, ``º`` also as ``o`` or ``°``.
"""

from __future__ import annotations

import re

DIGITS = "[0-9]+"
#: A number with sign and decimal mark, both optional.
NUMBER = rf"[+-]?{DIGITS}(?:[.,]{DIGITS})?"
#: The rest of a line, one word.
LINE, WORD = "(.+)", r"(\S+)"

_TOLERANT = {"á": "[aá]", "é": "[eé]", "í": "[ií]", "ó": "[oó]", "ú": "[uú]", "º": "[ºo°]"}


def only(*parts: str) -> str:
    """A pattern of texts that are the parts in a row and nothing else."""
    return "^" + "".join(parts) + "$"


def optional(part: str) -> str:
    return f"(?:{part})?"


def literal(text: str) -> str:
    """A printed text as a pattern, tolerant of accents."""
    return "".join(_TOLERANT.get(c, re.escape(c)) for c in text)


def label(text: str) -> str:
    """A printed label as a pattern; see the module's description."""
    colon = ""
    if text.endswith(":?"):
        text, colon = text[:-2], r"\s*:?"
    out = ""
    for part in re.findall(r" *(?:\([^()]*\)|[^ ()]+)", text):
        words = part.strip().strip("()")
        found = (r"\s*" if " " in part and out else "") + literal(words.strip())
        out += optional(found) if "(" in part else found
    return out + colon


def behind(text: str, value: str = LINE) -> str:
    """The value behind a printed label, as group 1."""
    return label(text) + r"\s*" + value
