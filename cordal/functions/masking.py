"""Redaction layers and shape masks as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what stands for a redacted datum.
REDACTED = "[REDACTADO]"
#: Fixed value: shapes of national ids (dotted 7-8 digits, dotted 6 digits, bare 6-8 digits).
ID_SHAPES = r"(?<![\d.])\d{1,2}\.\d{3}\.\d{3}(?!\d)|(?<![\d.])\d{3}\.\d{3}(?!\d)|(?<!\d)\d{6,8}(?!\d)"
MIN_NAME_TOKEN = 3

_FOLDS = {"a": "[aáàäâAÁÀÄÂ]", "e": "[eéèëêEÉÈËÊ]", "i": "[iíìïîIÍÌÏÎ]", "o": "[oóòöôOÓÒÖÔ]", "u": "[uúùüûUÚÙÜÛ]", "n": "[nñNÑ]"}


def redact_ids(text: Column) -> Column:
    """Layer 1: national ids by shape."""
    return F.regexp_replace(text, ID_SHAPES, REDACTED.replace("$", r"\$"))


def name_pattern(names: Column) -> Column:
    """One pattern per row for its known names: whole names and their tokens of three
    letters and more, longest first, accent tolerant (R02, U02, O04)."""
    clean = F.transform(F.array_compact(names), lambda n: F.trim(F.regexp_replace(n, r"[\s,]+", " ")))
    tokens = F.flatten(F.transform(clean, lambda n: F.split(n, " ")))
    parts = F.array_distinct(F.concat(clean, tokens))
    parts = F.filter(parts, lambda p: F.length(p) >= MIN_NAME_TOKEN)
    longest = F.array_sort(parts, lambda a, b: F.length(b) - F.length(a))
    plain = F.transform(
        longest, lambda p: F.lower(F.translate(F.regexp_replace(p, r"([^\p{L}\p{N} ])", r"\\$1"), "áéíóúüñÁÉÍÓÚÜÑ", "aeiouunAEIOUUN"))
    )

    def tolerant(p: Column) -> Column:
        for letter, group in _FOLDS.items():
            p = F.replace(p, F.lit(letter), F.lit(f"<{ord(letter)}>"))
        for letter, group in _FOLDS.items():
            p = F.replace(p, F.lit(f"<{ord(letter)}>"), F.lit(group))
        return F.replace(p, F.lit(" "), F.lit(r"\s+"))

    body = F.array_join(F.transform(plain, tolerant), "|")
    return F.when(F.size(parts) > 0, F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), body, F.lit(r")(?![\p{L}\p{N}])")))


def redact_names(text: Column, names: Column) -> Column:
    """Layer 2: the known names of this row."""
    pattern = name_pattern(names)
    return F.when(pattern.isNull(), text).otherwise(F.regexp_replace(text, pattern, F.lit(REDACTED)))


def redact_spans(text: Column, spans: Column) -> Column:
    """Layer 3: detected (inicio, fin) spans, overlapping ones merged first."""
    merged = merge_spans(spans)
    cut = F.aggregate(
        merged,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("pos")),
        lambda acc, s: F.struct(
            F.concat(acc["out"], F.substring(text, acc["pos"] + 1, s["inicio"] - acc["pos"]), F.lit(REDACTED)).alias("out"),
            s["fin"].cast("int").alias("pos"),
        ),
    )
    return F.concat(cut["out"], F.substring(text, cut["pos"] + 1, F.length(text)))


def merge_spans(spans: Column) -> Column:
    """Union of overlapping or touching spans, in order."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["inicio"].cast("int").alias("inicio"), s["fin"].cast("int").alias("fin"))))
    return F.aggregate(
        ordered,
        F.array().cast("array<struct<inicio:int,fin:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["fin"] >= s["inicio"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(
                    F.struct(
                        F.element_at(acc, -1)["inicio"].alias("inicio"),
                        F.greatest(F.element_at(acc, -1)["fin"], s["fin"]).alias("fin"),
                    )
                ),
            ),
        ).otherwise(F.concat(acc, F.array(s))),
    )


def redact(text: Column, names: Column, spans: Column | None = None) -> Column:
    """All layers in their fixed order; without a detector the third is left out."""
    out = redact_names(redact_ids(text), names)
    return out if spans is None else redact_spans(out, spans)


def shape_mask(text: Column, allowed: list[str] | None = None) -> Column:
    """Letter runs become X, digit runs 0; allowed terms stay as they are."""
    if not allowed:
        return F.regexp_replace(F.regexp_replace(text, r"\p{L}+", "X"), r"[0-9]+", "0")
    terms = "|".join(sorted((r"\Q" + a + r"\E" for a in allowed), key=len, reverse=True))
    token = rf"(?:{terms})|\p{{L}}+|[0-9]+|[^\p{{L}}0-9]"
    pieces = F.regexp_extract_all(text, F.lit(token), F.lit(0))
    masked = F.transform(
        pieces,
        lambda p: F.when(p.isin(allowed), p).when(p.rlike(r"^\p{L}"), F.lit("X")).when(p.rlike("^[0-9]"), F.lit("0")).otherwise(p),
    )
    return F.array_join(masked, "")
