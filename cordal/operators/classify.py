"""Layout signatures: scores, arg-max with rejection of zero and ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers that the three layouts print.
SIGNATURES = {
    "ecg": ["MORTARA", "12SL", "P-R-T AXES", "VENT. RATE"],
    "laboratorio": ["HEMATOLOGIA", "HEMOSTASIA", "QUIMICA CLINICA", "QUÍMICA CLÍNICA", "IONOGRAMA"],
    "ecocardiograma": [
        "SERVICIO DE ECOCARDIOGRAFIA",
        "ECOGRAFIA DOPPLER COLOR CARDIACA",
        "EVALUACION DE FLUJOS POR DOPPLER",
        "DOPPLER TISULAR",
        "S.C.",
    ],
}
UNKNOWN = "desconocido"


def scores(text: Column, signatures: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """Number of markers of each layout that occur in the upper-cased text."""
    upper = F.upper(F.coalesce(text, F.lit("")))
    out = {}
    for kind, markers in (signatures or SIGNATURES).items():
        total = F.lit(0)
        for marker in markers:
            total = total + F.when(upper.contains(marker), 1).otherwise(0)
        out[kind] = total
    return out


def with_kind(df: DataFrame, text: str, signatures: dict[str, list[str]] | None = None) -> DataFrame:
    """``df`` with one score column per layout and ``tipo``."""
    kinds = list(signatures or SIGNATURES)
    # lambdas hold the text and the scores as values: inlined into every use, and into filters on
    # ``tipo`` pushed below, they would outgrow a generated method
    counted = F.transform(F.array(text), lambda t: F.array(*scores(t, signatures).values()))[0]

    def winner(points: Column) -> Column:
        best = F.array_max(points)
        tied = F.size(F.filter(points, lambda x: x == best))
        names = F.array(*[F.lit(k) for k in kinds])
        return F.when((best > 0) & (tied == 1), names[F.array_position(points, best).cast("int") - 1]).otherwise(F.lit(UNKNOWN))

    df = df.withColumn("_puntajes", counted)
    df = df.withColumns({f"puntaje_{k}": F.col("_puntajes")[i] for i, k in enumerate(kinds)})
    return df.withColumn("tipo", F.transform(F.array("_puntajes"), winner)[0]).drop("_puntajes")
