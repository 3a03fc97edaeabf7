"""Keys that bring loosely typed analyte, section and unit names together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ACCENTED = "áàäâãéèëêíìïîóòöôõúùüûñçÁÀÄÂÃÉÈËÊÍÌÏÎÓÒÖÔÕÚÙÜÛÑÇ"
_PLAIN = "aaaaaeeeeiiiiooooouuuuncAAAAAEEEEIIIIOOOOOUUUUNC"

#: Longer section titles of the laboratory layout.
SECTION_ALIASES = {
    "ionograma serico": "ionograma",
    "hemostasia y coagulacion": "hemostasia",
    "orina completa": "orina",
}


def plain(text: Column) -> Column:
    """Lower case without Spanish accents, blanks collapsed and trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, _ACCENTED, _PLAIN)), r"[\s ]+", " "))


def name_key(text: Column) -> Column:
    """Key of an analyte or measure name: no bullets, no closing dots or colon."""
    return F.regexp_replace(plain(text), r"^[-*•\s]+|[\s.:]+$", "")


def section_key(text: Column) -> Column:
    """Key of a section title: no dashes around it, long titles shortened."""
    key = F.regexp_replace(plain(text), r"^[-\s]+|[-\s:.]+$", "")
    for long, short in SECTION_ALIASES.items():
        key = F.when(key == long, F.lit(short)).otherwise(key)
    return key


def unit_key(text: Column) -> Column:
    """Key of a unit: lower case, no blanks, µ as u, powers as 10^n, no closing dot."""
    key = F.lower(F.translate(text, "µμ³²⁶⁹×", "uu3269x"))
    key = F.regexp_replace(key, r"[\s ]+", "")
    key = F.translate(key, "áéíóú", "aeiou")
    key = F.regexp_replace(key, r"^[(\[]+|[)\]]+$|\.+$", "")
    key = F.regexp_replace(key, r"\.+$", "")
    key = F.regexp_replace(key, r"^x?10(?:\*\*?|e|\^)([0-9]+)", "10^$1")
    key = F.regexp_replace(key, r"^mc(g|mol|kat|l|m)", "u$1")
    return key


def analyte_names(ref: DataFrame) -> DataFrame:
    """(codigo, orden, seccion_key, nombre_key, …): one row per accepted name."""
    names = F.array_distinct(F.concat(F.array("nombre"), F.coalesce("sinonimos", F.array().cast("array<string>"))))
    return (
        ref.select(
            "codigo",
            "ambito",
            section_key(F.col("seccion")).alias("seccion_key"),
            unit_key(F.col("unidad_comun")).alias("comun_key"),
            "masa_molar",
            F.explode(names).alias("un_nombre"),
        )
        .withColumn("nombre_key", name_key(F.col("un_nombre")))
        .drop("un_nombre")
        .dropDuplicates(["codigo", "ambito", "seccion_key", "nombre_key"])
    )


_UNIT_TAIL = r"^(.*\S)\s*(?:\[([^\[\]]+)\]|\(([^()]+)\)|\sen\s+(\S.*?))[\s.:]*$"


def name_base(text: Column) -> Column:
    """The name before a closing ``(unit)``, ``[unit]`` or ``en unit``; else null."""
    return F.nullif(F.regexp_extract(text, _UNIT_TAIL, 1), F.lit(""))


def name_tail(text: Column) -> Column:
    """The text of a closing ``(unit)``, ``[unit]`` or ``en unit``; else null."""
    parts = [F.nullif(F.regexp_extract(text, _UNIT_TAIL, i), F.lit("")) for i in (2, 3, 4)]
    return F.coalesce(*parts)
