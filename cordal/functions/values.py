"""Scalar normalisers and parsers of dates, times, numbers and labels (F, D, M rows)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_ACCENTS = "ÁÉÍÓÚáéíóúÜüÀÈÌÒÙàèìòù"
_NO_ACCENTS = "AEIOUaeiouUuAEIOUaeiou"

#: Sections of the laboratory layout and their alias.
SECTIONS = ["HEMATOLOGIA", "HEMOSTASIA", "QUIMICA CLINICA", "IONOGRAMA"]
SECTION_ALIAS = {"IONOGRAMA SERICO": "IONOGRAMA"}


#: Fixed value: a blank of any script, as Unicode counts them.
BLANK = r"[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@cache
def _folds() -> tuple[str, str, dict[str, str]]:
    """What case folding changes in lower-case letters: single characters from, to; one to several.

    The micro sign stays: its SQL counterpart keeps it.
    """
    changed = {c: c.casefold() for c in map(chr, range(0x80, 0x110000)) if c != "µ" and c.lower() == c != c.casefold()}
    single = [c for c in changed if len(changed[c]) == 1]
    return "".join(single), "".join(changed[c] for c in single), {c: to for c, to in changed.items() if len(to) > 1}


def case_folded(text: Column) -> Column:
    """Lower case without the forms that only differ in writing, as ß or a final sigma."""
    source, target, several = _folds()
    lower = F.lower(text)
    expanded = F.translate(lower, source, target)
    for c, to in several.items():
        expanded = F.replace(expanded, F.lit(c), F.lit(to))
    return F.when(lower.rlike(f"[{source}{''.join(several)}]"), expanded).otherwise(lower)


def normal_text(text: Column) -> Column:
    """Bars are blanks, blanks collapsed, trimmed, case folded."""
    return F.trim(F.regexp_replace(case_folded(F.replace(text, F.lit("|"), F.lit(" "))), f"{BLANK}+", " "))


def normal_number(text: Column, max_decimals: int | None = None) -> Column:
    """``12,5`` to ``12.5``; null when it is not digits with one decimal mark."""
    decimals = "+" if max_decimals is None else f"{{1,{max_decimals}}}"
    value = F.trim(text)
    return F.when(value.rlike(rf"^[0-9]+([.,][0-9]{decimals})?$"), F.replace(value, F.lit(","), F.lit(".")))


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` or ``d/M/yyyy`` as a date, else null."""
    value = F.trim(text)
    slashed = F.when(value.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), F.try_to_date(value, "d/M/yyyy"))
    dashed = F.when(value.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), F.try_to_date(value, "yyyy-MM-dd"))
    return F.coalesce(dashed, slashed)


def iso_time(text: Column) -> Column:
    """``HH:mm`` or ``HH:mm:ss`` with leading zero, padded to seconds; else null."""
    value = F.trim(text)
    valid = value.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?$")
    return F.when(valid, F.when(F.length(value) == 5, F.concat(value, F.lit(":00"))).otherwise(value))


def time_precision(text: Column) -> Column:
    """``segundo``, ``minuto`` or, for a missing time, ``ausente``; null if unreadable."""
    value = F.trim(text)
    return (
        F.when(text.isNull() | (value == ""), F.lit("ausente"))
        .when(iso_time(text).isNull(), F.lit(None).cast("string"))
        .when(F.length(value) == 5, F.lit("minuto"))
        .otherwise(F.lit("segundo"))
    )


def ecg_instant(text: Column) -> Column:
    """``DD-MON-YYYY HH:MM[:SS]`` with English month names as a timestamp."""
    value = F.regexp_replace(F.trim(text), r"\s+", " ")
    return F.coalesce(
        F.try_to_timestamp(value, F.lit("dd-MMM-yyyy HH:mm:ss")), F.try_to_timestamp(value, F.lit("dd-MMM-yyyy HH:mm"))
    )


def birth_date(text: Column) -> Column:
    """Birth date as ISO text; unreadable is null, never the raw text."""
    value = F.trim(text)
    english = F.when(value.rlike(r"^[0-9]{2}-[A-Za-z]{3}-[0-9]{4}$"), F.try_to_timestamp(value, F.lit("dd-MMM-yyyy")))
    return F.date_format(F.coalesce(iso_date(text), english.cast("date")), "yyyy-MM-dd")


def lab_float(text: Column) -> Column:
    """Signed decimal with comma or point as double, else null."""
    value = F.replace(F.trim(text), F.lit(","), F.lit("."))
    return F.when(value.rlike(r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)$"), value.try_cast("double"))


def reference_range(text: Column) -> Column:
    """struct(ref_min, ref_max) of ``min - max``; a negative bound makes both null."""
    parts = F.split(text, "-")
    both = F.size(parts) == 2
    low, high = lab_float(F.get(parts, F.lit(0))), lab_float(F.get(parts, F.lit(1)))
    known = both & low.isNotNull() & high.isNotNull()
    return F.struct(F.when(known, low).alias("ref_min"), F.when(known, high).alias("ref_max"))


def without_accents(text: Column) -> Column:
    """Spanish accents removed (F05); ñ stays, as in section titles."""
    return F.translate(text, _ACCENTS, _NO_ACCENTS)


def lab_section(line: Column) -> Column:
    """Canonical section title: no accents, no dashes around, upper case, alias."""
    key = F.upper(F.trim(F.regexp_replace(F.trim(without_accents(line)), "^-+|-+$", "")))
    for long, short in SECTION_ALIAS.items():
        key = F.when(key == long, F.lit(short)).otherwise(key)
    return key


def first_segment(text: Column) -> Column:
    """Text before two or more blanks."""
    return F.trim(F.split(F.trim(text), f"{BLANK}{{2,}}")[0])


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def label(text: Column) -> Column:
    """Upper case label without a closing colon."""
    return F.upper(F.trim(F.regexp_replace(F.trim(text), ":+$", "")))


def value_and_unit(text: Column) -> Column:
    """struct(valor, unidad) of ``36 mm``; a text that is no number stays whole."""
    pattern = r"^\s*([+-]?[0-9]+(?:[.,][0-9]+)?)\s*(\S.*)?$"
    numeric = text.rlike(pattern)
    unit = F.nullif(F.trim(F.regexp_extract(text, pattern, 2)), F.lit(""))
    return F.struct(
        F.when(numeric, F.regexp_extract(text, pattern, 1)).otherwise(F.trim(text)).alias("valor"),
        F.when(numeric, unit).alias("unidad"),
    )


def extra_columns(tokens: Column) -> Column:
    """struct(referencia, unidad): the first ``min - max`` token, the first other one."""
    is_range = lambda t: t.rlike(r"^[+-]?[0-9]+(?:[.,][0-9]+)?\s*-\s*[+-]?[0-9]+(?:[.,][0-9]+)?$")
    return F.struct(
        F.get(F.filter(tokens, is_range), F.lit(0)).alias("referencia"),
        F.get(F.filter(tokens, lambda t: ~is_range(t)), F.lit(0)).alias("unidad"),
    )


def header_field(text: Column, pattern: str) -> Column:
    """First match of a header pattern's first group, first segment; null on a miss.

    A line ends at its line feed alone.
    """
    return F.nullif(first_segment(F.regexp_extract(text, f"(?d){pattern}", 1)), F.lit(""))


def sorted_json(extras: Column, personal: list[str]) -> Column:
    """A string map as JSON with sorted keys, personal keys removed; empty is null."""
    kept = F.map_filter(extras, lambda k, v: ~k.isin(personal))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(kept)))
    return F.when(F.size(kept) > 0, F.to_json(ordered, {"ignoreNullFields": "false"}))


def mebibytes(size: Column) -> Column:
    """Bytes as whole MiB text."""
    return F.format_string("%.0f", size / F.lit(1048576.0))


def qualitative_result(text: Column) -> Column:
    """A short upper-case cell of at most four words is a structured result."""
    value = F.trim(text)
    return (
        (F.size(F.split(value, r"\s+")) <= 4)
        & value.rlike(r"^[A-ZÁÉÍÓÚÜÑ][A-ZÁÉÍÓÚÜÑ .+/<>()-]{0,39}$")
    )


def national_id_valid(text: Column) -> Column:
    """6 to 8 digits between 100,000 and 99,999,999 (P20)."""
    digits = F.translate(text, ".", "")
    return digits.rlike("^[0-9]{6,8}$") & digits.try_cast("long").between(100_000, 99_999_999)


def literal_prefix(pattern: str) -> str:
    """The text every match of a simple pattern begins with, up to its first metacharacter.

    Runs on the driver: patterns are code, not data.
    """
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            c, i = pattern[i + 1], i + 1
        elif c in ".^$*+?{}[]()|\\":
            break
        if i + 1 < len(pattern) and pattern[i + 1] in "*?{":
            break
        out.append(c)
        i += 1
    return "".join(out)


def html_escaped(text: Column) -> Column:
    """Text for HTML content and attributes."""
    for mark, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(mark), F.lit(name))
    return text


def script_json(text: Column) -> Column:
    """JSON text that may stand inside a script element: nothing in it can end or open markup."""
    for mark, escape in (("<", r"\u003c"), (">", r"\u003e")):
        text = F.replace(text, F.lit(mark), F.lit(escape))
    return text


def duration_text(seconds: Column) -> Column:
    """``2 h 5 min``, or minutes alone under an hour; null counts as none."""
    total = F.coalesce(seconds.cast("long"), F.lit(0).cast("long"))
    hours, minutes = F.floor(total / 3600), F.floor(total % 3600 / 60)
    short = F.concat(minutes.cast("string"), F.lit(" min"))
    return F.when(hours > 0, F.concat(hours.cast("string"), F.lit(" h "), short)).otherwise(short)
