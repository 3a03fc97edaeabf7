"""Several values packed in one field: one row per value, with its position.

The plan has three steps.

1. *Skeleton.* Ordinary characters are masked (numbers, words), delimiters,
   quotes and placeholders stay. This is a chain of JVM regular expressions.
2. *Rule.* The distinct skeletons are few (they depend on the grammar of the
   writers, not on the number of rows). Each gets one splitting rule; the rules are made once
   and broadcast when their size is bounded, else joined.
3. *Extraction.* The rule names ordinals of the extracted places; values are
   cut out with ``regexp_extract_all`` / ``split`` and exploded with position.

Defined results
---------------
* null, empty or blank field, single value, only placeholders: no row.
* an empty or placeholder place: no row, but the next place keeps its number.
* repeated input rows (same id and text): one set of rows.
* two different texts under one id: the values of both.
* null id: rows with null id, as written.
"""

from __future__ import annotations

from collections.abc import Iterator
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cordal.session import checkpoint, lookup, ship

#: Words that state a limit and are therefore no label of a band.
RELATION_WORDS = "hasta|desde|a|de|mayor|menor|entre|y"
#: Ways of writing "no value here".
PLACEHOLDER = r"(?i)n/d|s/d|n/a"

RULE_SCHEMA = "skeleton string, mode string, delim string, places array<struct<posicion:int,nth:int>>"

_INTEGER = r"(?<![0-9])[-−]?[0-9]+"
_QUOTED = r'"((?:[^"]|"")*)"|\'((?:[^\']|\'\')*)\''
#: What a text with two places has at least, found in one pass: two numbers; or
#: quotes, or a number, a delimiter, and behind it a label with its number.
_MAY_PACK = {
    "integers": "[0-9][^0-9]+[0-9]",
    "bands": r"[\"']|^[^0-9]*+[0-9][^\n\r\t|;/,]*+[\n\r\t|;/,]\P{L}*+\p{L}[^0-9]*+[0-9]",
}
_HARD = ["/", ";", "|", "\t", "\n", "\\", "⁄", ","]


def integer_skeleton(text: Column) -> Column:
    """Mask of a field that packs integers: 9 number, w word, x placeholder."""
    out = F.regexp_replace(text, r"\r\n?", "\n")
    out = F.regexp_replace(out, PLACEHOLDER, "\u0001")
    out = F.regexp_replace(out, r"[0-9]+", "9")
    out = F.regexp_replace(out, r"\p{L}+", "w")
    return F.regexp_replace(out, "\u0001", "x")


def band_skeleton(text: Column) -> Column:
    """Mask of a field that packs labelled bands: b band, # limits, w words."""
    out = F.regexp_replace(text, r"\r\n?", "\n")
    out = F.regexp_replace(out, PLACEHOLDER, "\u0001")
    out = F.regexp_replace(out, r"(?<![\p{L}0-9])(?i:" + RELATION_WORDS + r")(?![\p{L}0-9])", "\u0002")
    out = F.regexp_replace(out, r"[0-9]*\p{L}[\p{L}0-9]*\.?", "w")
    out = F.regexp_replace(out, r"[0-9]+(?:[.,][0-9]+)*", "9")
    out = F.regexp_replace(out, "\u0002", "r")
    # limits: "<= 9", "r 9", "9 - 9", "9 r 9", "r 9 r 9"
    out = F.regexp_replace(out, r"(?:(?:[<>]=?|=|[≤≥]|r)[  ]*)*9(?:[  ]*(?:-|–|r)[  ]*9)*", "#")
    out = F.regexp_replace(out, r"w(?:[  ]+w)*", "w")
    out = F.regexp_replace(out, r"w[  ]*[:=]?[  ]*#", "b")
    return F.regexp_replace(out, "\u0001", "x")


def _blank(part: str) -> bool:
    return re.fullmatch(r"[\s ]*(?:-+|−+|\*+|x|–+|\.+)?[\s ]*", part) is not None


def integer_rule(skeleton: str) -> tuple[str, str, list[tuple[int, int]]]:
    """Places of an integer skeleton: (position, ordinal of the integer)."""
    bare = re.sub(r"[\"'()\[\]]", "", skeleton)
    delim = next((d for d in _HARD if d in bare), None)
    places: list[tuple[int, int]] = []
    nth = 0
    if delim is not None:
        for position, part in enumerate(bare.split(delim), 1):
            count = part.count("9")
            for _ in range(count):
                places.append((position, nth))
                nth += 1
    else:
        position = 0
        for token in re.findall(r"9|(?<![^\s])(?:--+|−−+|\*+|x)(?![^\s])", bare):
            position += 1
            if token == "9":
                places.append((position, nth))
                nth += 1
    if len(places) < 2 or len({p for p, _ in places}) != len(places):
        if len(places) < 2:
            return "single", "", []
        places = [(i + 1, n) for i, (_, n) in enumerate(places)]
    return "integers", "", places


def band_rule(skeleton: str) -> tuple[str, str, list[tuple[int, int]]]:
    """Places of a band skeleton: quoted list, else the first delimiter whose
    parts are all labelled bands or empty; with fewer than two bands, single."""
    text = skeleton.strip()
    quoted = r"(?:\"(?:[^\"]|\"\")*\"|'(?:[^']|'')*')"
    if re.fullmatch(quoted + r"(?:\s*[;,|/\t]\s*" + quoted + r")+", text):
        parts = [m[0][1:-1] for m in re.finditer(quoted, text)]
        places = [(i + 1, i) for i, part in enumerate(parts) if not _blank(part)]
        return ("quoted", "", places) if len(places) > 1 else ("single", "", [])
    for delim in ["\n", "\t", "|", ";", "/", ","]:
        parts = skeleton.split(delim)
        if len(parts) < 2:
            continue
        real = [(i + 1, i) for i, part in enumerate(parts) if not _blank(part)]
        if len(real) > 1 and all(re.match(r"[\s ]*b", parts[i]) for _, i in real):
            return "split", delim, real
    return "single", "", []


def _resolve(rule):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(s, *rule(s)) for s in batch["skeleton"]]
            yield pd.DataFrame(
                {
                    "skeleton": [r[0] for r in rows],
                    "mode": [r[1] for r in rows],
                    "delim": [r[2] for r in rows],
                    "places": [[{"posicion": p, "nth": n} for p, n in r[3]] for r in rows],
                }
            )

    return run


def split_packed(df: DataFrame, id_col: str, text_col: str, campo: str, kind: str) -> DataFrame:
    """One row per packed value: campo, id_fila, posicion, valor.

    ``kind`` is ``integers`` (signed integers, any separator) or ``bands``
    (labelled reference bands, possibly quoted).
    """
    return split_fields(df, id_col, {campo: text_col}, kind)


def split_fields(df: DataFrame, id_col: str, fields: dict[str, str], kind: str) -> DataFrame:
    """``split_packed`` of several fields (campo: column) of a table in one scan.

    The texts that can hold two values are written once with their skeletons; rules
    and values are taken from there, so the regular expressions run once per row.
    """
    ship(df.sparkSession)
    skeleton = {"integers": integer_skeleton, "bands": band_skeleton}[kind]
    rule = {"integers": integer_rule, "bands": band_rule}[kind]
    places = [F.struct(F.lit(campo).alias("campo"), F.col(c).cast("string").alias("texto")) for campo, c in fields.items()]
    rows = df.select(F.col(id_col).cast("long").alias("id_fila"), F.inline(F.array(*places)))
    rows = rows.where(F.col("texto").isNotNull() & (F.trim("texto") != "") & F.col("texto").rlike(_MAY_PACK[kind]))
    rows = checkpoint(rows.withColumn("skeleton", skeleton(F.col("texto"))))
    rules = rows.select("skeleton").distinct().mapInPandas(_resolve(rule), RULE_SCHEMA).where("size(places) > 1")
    hits = rows.join(lookup(rules), "skeleton").select("campo", "id_fila", "texto", "mode", "delim", "places").distinct()
    if kind == "integers":
        found = F.regexp_extract_all("texto", F.lit(_INTEGER), F.lit(0))
    else:
        normal = F.regexp_replace("texto", r"\r\n?", "\n")
        quoted = F.transform(
            F.regexp_extract_all("texto", F.lit(_QUOTED), F.lit(0)),
            lambda q: F.replace(
                F.substring(q, F.lit(2), F.length(q) - 2),
                F.concat(F.substring(q, 1, 1), F.substring(q, 1, 1)),
                F.substring(q, 1, 1),
            ),
        )
        plain = F.split(normal, F.concat(F.lit("\\Q"), F.col("delim"), F.lit("\\E")))
        found = F.when(F.col("mode") == "quoted", quoted).otherwise(plain)
    out = hits.select("campo", "id_fila", found.alias("found"), F.explode("places").alias("place")).select(
        "campo",
        "id_fila",
        F.col("place.posicion").alias("posicion"),
        F.get("found", F.col("place.nth")).alias("valor"),
    )
    if kind == "integers":
        return out.withColumn("valor", F.translate("valor", "−", "-"))
    return out.withColumn("valor", F.regexp_replace("valor", r"^[\s ]+|[\s ]+$", ""))


def clinical_packed_values(ecg: DataFrame, lab: DataFrame) -> DataFrame:
    """Values of ``qt_qtc``, ``ejes`` (by id_estudio) and ``valores_referencia`` (by id_fila)."""
    integers = split_fields(ecg, "id_estudio", {"qt_qtc": "qt_qtc", "ejes": "ejes"}, "integers")
    return integers.unionByName(split_packed(lab, "id_fila", "valores_referencia", "valores_referencia", "bands"))
