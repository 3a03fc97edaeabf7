"""Text decoded with the wrong encoding: find it and restore the original.

A hidden Markov model labels the characters of a text. There is one clean state
and one state per encoding pair (the encoding the bytes were in, the encoding
they were read with). ASCII is the same in every state, so only the other
characters and some question marks carry evidence. A state emits a character run with the probability
that clean text would show the *restored* character between its neighbours;
changing the state costs a fixed log probability. The best labelling is found
by Viterbi search, and every labelled run gets the inverse transform of its state.
Runs of several characters (UTF-8 lead and continuation bytes) are emitted as one
unit. A further state stands for losses: it emits replacement characters and
question marks where words have letters, which the clean state does not expect
there outside addresses and queries. A unit of that state, or one whose
continuation is missing, is a loss that the text no longer determines.

The clean state knows the letters of the language whose function words prevail,
so clean German, French or Italian is no evidence of a wrong encoding.

Each text is handled alone and whole; the operator is one scan without shuffle.

Defined results
---------------
* null or empty text, and clean text in any of the languages: not affected.
* affected and determined: ``restaurado`` holds the whole restored text.
* affected with a loss: ``perdida`` true and ``restaurado`` null.
* repeated rows: one result per distinct (doc_id, text).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cordal.session import ship

#: True encoding, encoding it was read with, how often in a row.
PAIRS = [
    ("utf-8", "cp1252", 1),
    ("utf-8", "cp1252", 2),
    ("utf-8", "mac_roman", 1),
    ("utf-8", "cp850", 1),
    ("utf-8", "cp437", 1),
    ("utf-8", "cp1251", 1),
    ("utf-8", "iso8859_15", 1),
    ("utf-8", "cp1250", 1),
    ("cp1252", "cp850", 1),
    ("cp1252", "cp437", 1),
    ("cp1252", "mac_roman", 1),
    ("cp1252", "cp1251", 1),
    ("cp1252", "cp1250", 1),
    ("cp850", "cp1252", 1),
    ("cp437", "cp1252", 1),
    ("mac_roman", "cp1252", 1),
]

#: log10 weight of the characters of clean Spanish, Portuguese,
#: Guaraní and English text.
_WEIGHTS = [
    (-0.9, "óí"),
    (-1.0, "áé"),
    (-1.3, "úñ"),
    (-1.7, "ÁÉÍÓÚÑ°º¿"),
    (-2.0, "ãõçâêôà²±µ½«»¡³"),
    (-2.4, "ÃÕÇÂÊÔÀüẽĩũỹýª"),
    (-2.8, "–—“”‘’…•≤≥·×®©"),
    (-3.2, "ÜẼĨŨỸÝ€→¼¾èìòùïöäëîûåøæ ­​‑"),
]
_WEIGHT = {c: w * math.log(10) for w, cs in _WEIGHTS for c in cs}
_RARE = -7.0 * math.log(10)
_ODD = -3.0 * math.log(10)
_STRANGE = -4.0 * math.log(10)
_ENTER = -3.5 * math.log(10)
_CHANGE = -4.5 * math.log(10)
_LEAVE = -0.7 * math.log(10)
_LOST = -2.0 * math.log(10)
_KEPT = -7.0 * math.log(10)
_NOTHING = -1e9
_USUAL = -2.5 * math.log(10)
_FITTING = -1.5 * math.log(10)
_MARKED = -6.0 * math.log(10)
_BROKEN = -9.0 * math.log(10)
_GONE = -1.0 * math.log(10)

LOSS = len(PAIRS)  # index of the state of losses behind those of the pairs
_LONGEST = 12  # characters of one unit: four bytes, each read as up to three

_LETTER = -1.5 * math.log(10)

#: Function words and further letters of languages beside those of the weights.
_LANGUAGES = {
    "es": ("el la los las de del que en con por para una se no y su al es como lo más", ""),
    "pt": ("o os as de da do que em com por para uma se não e ao na no dos das", ""),
    "en": ("the of and to in is that for with was on are as at be this", ""),
    "de": ("der die das und ist für mit den dem ein eine von zu auf nicht im des als bei nach oder über sind wird", "äöüßÄÖÜ"),
    "fr": ("le la les des et est dans pour une que qui sur avec pas au aux du ce cette sont à il elle", "àâçéèêëîïôùûüœæÀÂÇÉÈÊËÎÏÔÙÛŒ"),
    "it": ("il lo la di che e in per una con del della non sono gli le è nel alla", "àèéìòùÀÈÉÌÒÙ"),
}
_FUNCTION_WORDS = {name: frozenset(words.split()) for name, (words, _) in _LANGUAGES.items()}
_WORDS = re.compile(r"[^\W\d_]+")

#: Question marks that stand where a letter or sign was lost, unless in an address or query.
_MARK = re.compile(
    r"(?<=[a-záéíóúñ])\?(?=[a-záéíóúñ])|(?<=[A-ZÁÉÍÓÚÑ])\?(?=[A-ZÁÉÍÓÚÑ])|(?<=\bN)\?(?=\s*[0-9])|(?<![\w?])\?(?=[A-Za-z])"
)
_SEEN = re.compile(r"[^\x00-\x7f]|" + _MARK.pattern)
_ADDRESS = re.compile(r"://|www\.|[/=&#]|\.[a-z]{2,}\?")

#: Rows that restore() can report, a superset of _SEEN in the JVM's syntax.
_MAY_BE = r"[^\x00-\x7f]|\p{L}\?\p{L}|N\?[\s\x1c-\x1f]*[0-9]|\?[A-Za-z]"

SCHEMA = "doc_id bigint, pares string, perdida boolean, restaurado string, md5_texto string"


def _bytes_of(text: str, encoding: str) -> bytes | None:
    """Bytes that ``encoding`` reads as ``text``; unused codes stand for themselves."""
    out = bytearray()
    for c in text:
        try:
            out += c.encode(encoding)
        except UnicodeEncodeError:
            if not 0x80 <= ord(c) <= 0x9F or not encoding.startswith(("cp125", "iso8859")):
                return None
            out.append(ord(c))
    return bytes(out)


@lru_cache(maxsize=200_000)
def undo(text: str, pair: int) -> str | None:
    """``text`` as it was before it was read with the pair's wrong encoding."""
    true, wrong, times = PAIRS[pair]
    for _ in range(times):
        raw = _bytes_of(text, wrong)
        if raw is None:
            return None
        try:
            text = raw.decode(true)
        except UnicodeDecodeError:
            return None
    return text


def _kind(c: str) -> str:
    if not c or c.isspace():
        return "s"
    if c.isalpha():
        return "u" if c.isupper() else "l"
    return "d" if c.isdigit() else "p"


@lru_cache(maxsize=200_000)
def plausible(char: str, left: str, right: str) -> float:
    """Log weight of a character of clean text between neighbours of those kinds."""
    score = _WEIGHT.get(char, _ODD if char >= "\U0001f000" else _RARE)
    if score == _RARE or char >= "\U0001f000":
        return score
    a, b = left in "lu", right in "lu"
    if char.isalpha() and char not in "ºªµ":
        if not (a or b):
            score += _ODD
        elif char.isupper() and left == "l" or char in "ÃÂ" and left not in "lu" and right == "l":
            score += _STRANGE
        elif char.islower() and left == "u" and right == "u":
            score += _ODD
    elif char in "¿¡“‘«":
        if a and b:
            score += _STRANGE
        elif a or not (b or right == "d" or right == "p"):
            score += _ODD
    elif char == "­" or char == "​":
        score += 0.0 if a and b else _ODD
    elif char == "’" or char == "‘":
        pass
    elif a and b:
        score += _STRANGE
    elif char in "°²³ºª" and right == "l":
        score += _ODD
    return score


@lru_cache(maxsize=400_000)
def _unit(run: str, pair: int, left: str, right: str) -> tuple[float, str] | None:
    original = undo(run, pair)
    if original is None or len(original) != 1 or original < "\x80":
        return None
    return plausible(original, left, right), original


def _main_language(text: str) -> str | None:
    """The language whose function words prevail; None without any or with a tie."""
    found = _WORDS.findall(text.lower())
    counts = sorted(((sum(w in words for w in found), name) for name, words in _FUNCTION_WORDS.items()), reverse=True)
    return counts[0][1] if counts[0][0] > counts[1][0] else None


def _token_at(text: str, i: int) -> str:
    """The run without blanks around a position, up to 200 characters each way."""
    left, right = text[max(0, i - 200) : i].split(), text[i : i + 200].split()
    before = left[-1] if left and not text[i - 1].isspace() else ""
    return before + (right[0] if right else "")


def _clean_weight(text: str, i: int, left: str, right: str, letters: str) -> float:
    """Log weight of the character at ``i`` in clean text."""
    char = text[i]
    if char == "?":
        return _WEIGHT["¿"] if _ADDRESS.search(_token_at(text, i)) else _MARKED
    if char == "�":
        return _BROKEN
    score = plausible(char, left, right)
    before, after = text[i - 1 : i].lower(), text[i + 1 : i + 2].lower()
    if char == "ß" and before and before in "aeiouyäöü" and (after in "aeiouyäöütbkpwhfz" or not after.isalpha()):
        if before != "i" or text[i - 2 : i - 1].lower() == "e":
            score = max(score, _FITTING)  # behind a vowel only, behind i in "ei"
    if char == "œ" and after == "u":
        score = max(score, _FITTING)
    if char in letters and not (char.isupper() and left == "l") and not (char.islower() and left == "u" and right == "u"):
        score = max(score, _LETTER)
    return score


@lru_cache(maxsize=1000)
def _leads(pair: int) -> frozenset[str]:
    """What the lead bytes of two-byte Latin characters look like in this pair."""
    true, wrong, times = PAIRS[pair]
    if true != "utf-8" or times > 1:
        return frozenset()
    return frozenset(bytes([b]).decode(wrong, "ignore") for b in (0xC2, 0xC3)) - {""}


def _loss(text: str, i: int) -> float:
    """Log weight of a lead character whose continuation was lost at ``i``."""
    left, after = _kind(text[i - 1]) if i else "s", text[i + 1 : i + 2]
    right = _kind(after)
    if left not in "lu" and right not in "lu":
        return _NOTHING
    if text[i] == "Ã" and left == "u" and (after in ("O", "E") or right not in "lu"):
        return _KEPT  # Portuguese capitals end so
    return _LOST


def label(text: str) -> list[tuple[int, int, int, str | None]]:
    """Units not labelled clean: (start, end, pair or LOSS, restored character or None if lost)."""
    at = [m.start() for m in _SEEN.finditer(text)]
    n = len(at)
    if not n:
        return []
    kind = lambda i: _kind(text[i]) if 0 <= i < len(text) else "s"
    clean = [_clean_weight(text, i, kind(i - 1), kind(i + 1), "") for i in at]
    if min(clean) > _USUAL:
        return []
    letters = _LANGUAGES.get(_main_language(text) or "", ("", ""))[1]
    if letters:
        clean = [_clean_weight(text, i, kind(i - 1), kind(i + 1), letters) for i in at]
    states = range(len(PAIRS) + 2)  # 0 is clean, the last one is for losses
    best = [[_NOTHING] * len(states) for _ in range(n + 1)]
    back: list[list[tuple | None]] = [[None] * len(states) for _ in range(n + 1)]
    best[0][0] = 0.0
    for s in states[1:]:
        best[0][s] = _ENTER
    for k in range(n):
        here = best[k]
        top = max(states, key=here.__getitem__)
        reach = []
        for s in states:
            options = [(here[s], s)]
            if s == 0:
                if top != 0:
                    options.append((here[top] + _LEAVE, top))
            else:
                options.append((here[0] + _ENTER, 0))
                if top not in (0, s):
                    options.append((here[top] + _CHANGE, top))
            reach.append(max(options))
        i = at[k]
        run = 1
        while run < _LONGEST and k + run < n and at[k + run] == i + run:
            run += 1
        for s in states:
            base, source = reach[s]
            if base <= _NOTHING / 2:
                continue
            if s == 0:
                if base + clean[k] > best[k + 1][0]:
                    best[k + 1][0], back[k + 1][0] = base + clean[k], (k, source, text[i])
                continue
            if s - 1 == LOSS:
                if text[i] in "?�" and base + _GONE > best[k + 1][s]:
                    best[k + 1][s], back[k + 1][s] = base + _GONE, (k, source, None)
                continue
            true, _, times = PAIRS[s - 1]
            sizes = (1,) if true != "utf-8" else (range(2, 5) if times == 1 else range(4, _LONGEST + 1))
            for size in sizes:
                if size > run:
                    break
                found = _unit(text[i : i + size], s - 1, kind(i - 1), kind(i + size))
                if found and base + found[0] > best[k + size][s]:
                    best[k + size][s], back[k + size][s] = base + found[0], (k, source, found[1])
            if text[i] in _leads(s - 1) and (lost := base + _loss(text, i)) > best[k + 1][s]:
                best[k + 1][s], back[k + 1][s] = lost, (k, source, None)
    out = []
    k, s = n, max(states, key=best[n].__getitem__)
    while k > 0:
        before, source, original = back[k][s]
        if s and original != text[at[before] : at[k - 1] + 1]:  # the same in both encodings: nothing to undo
            out.append((at[before], at[k - 1] + 1, s - 1, original))
        k, s = before, source
    return out[::-1]


def restore(text: str) -> tuple[str, bool, str | None] | None:
    """(pairs found, lost, restored text) of an affected text; None if it is clean."""
    units = label(text)
    if not units:
        return None
    names = ",".join(sorted({"{}>{}x{}".format(*PAIRS[u[2]]) for u in units if u[2] != LOSS}))
    if any(u[3] is None for u in units):
        return names, True, None
    parts, end = [], 0
    for a, b, _, original in units:
        parts += [text[end:a], original]
        end = b
    return names, False, "".join(parts) + text[end:]


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch["doc_id"], batch["text"]):
            found = restore(text)
            if found:
                names, lost, whole = found
                digest = "" if lost else hashlib.md5(whole.encode("utf-8", "surrogatepass")).hexdigest()
                rows.append((doc, names, lost, whole, digest))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def garbled(documents: DataFrame) -> DataFrame:
    """The affected rows of ``documents`` (doc_id, text), see ``SCHEMA``."""
    ship(documents.sparkSession)
    source = documents.where(F.col("text").isNotNull() & F.col("text").rlike(_MAY_BE))
    return source.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(_run, SCHEMA).distinct()
