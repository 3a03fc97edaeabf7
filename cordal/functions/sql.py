"""The engine's functions for SQL users, as session functions with SQL bodies."""

from __future__ import annotations

from pyspark.sql import SparkSession

from cordal.functions.keys import _pads
from cordal.functions.masking import ID_SHAPES, REDACTED
from cordal.operators.classify import SIGNATURES


def register(spark: SparkSession, secret: bytes) -> list[str]:
    """Create ``hmac16``, ``redact_ids``, ``shape_mask``, ``detect_type`` and ``national_id``.

    Bodies are SQL, so calls are inlined and optimised. ``hmac16`` holds a
    key-equivalent secret: it lives in the session only and is never persisted.
    """
    inner, outer = (p.hex() for p in _pads(secret))
    shapes = ID_SHAPES.replace("\\", "\\\\")
    score = {
        kind: " + ".join(f"CAST(contains(upper(t), '{m}') AS INT)" for m in markers) for kind, markers in SIGNATURES.items()
    }
    a, b, c = (f"({score[k]})" for k in ("ecg", "laboratorio", "ecocardiograma"))
    bodies = {
        "hmac16(m STRING) RETURNS STRING": f"left(sha2(concat(unhex('{outer}'), unhex(sha2(concat(unhex('{inner}'), encode(m, 'UTF-8')), 256))), 256), 32)",
        "redact_ids(t STRING) RETURNS STRING": f"regexp_replace(t, '{shapes}', '{REDACTED}')",
        "shape_mask(t STRING) RETURNS STRING": r"regexp_replace(regexp_replace(t, '\\p{L}+', 'X'), '[0-9]+', '0')",
        "detect_type(t STRING) RETURNS STRING": f"CASE WHEN {a} > greatest({b}, {c}) THEN 'ecg' WHEN {b} > greatest({a}, {c}) THEN 'laboratorio' WHEN {c} > greatest({a}, {b}) THEN 'ecocardiograma' ELSE 'desconocido' END",
        "national_id(t STRING) RETURNS STRING": "coalesce(nullif(ltrim('0', translate(t, '. ', '')), ''), '0')",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in bodies]
