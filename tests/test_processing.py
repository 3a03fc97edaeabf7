"""The whole run over a seeded corpus: documents, episodes, codes, child rows, no leaks."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpus import corpus
from cordal.operators import leaks
from cordal.plans.processing import process

SECRET = b"k"


def run(spark, cases):
    rows, literals = corpus(**cases)
    own = lambda d, p: "".join(p) or d.removeprefix("z-copia-")
    schema = "documento string, huella string, paginas array<string>, paginas_orden array<string>"
    docs = spark.createDataFrame([(d, own(d, p), p, p) for d, p in rows], schema).repartition(8)
    return rows, literals, process(docs, SECRET)


@pytest.mark.parametrize(
    ("cases", "inputs", "episodes", "published", "codes"),
    [
        (
            {"whole": 36, "limit": 4, "split": 3, "missing": 3, "ambiguous": 2, "corrupt": 2, "copies": 5},
            154, 40, 120, {"episodio_ambiguo": 8, "episodio_incompleto": 19, "pdf_ilegible": 2},
        ),
        (
            {"whole": 320, "limit": 4, "split": 3, "missing": 3, "ambiguous": 2, "corrupt": 1, "copies": 2},
            1000, 324, 972, {"episodio_ambiguo": 8, "episodio_incompleto": 17, "pdf_ilegible": 1},
        ),
    ],
)
def test_golden_outcome(spark, cases, inputs, episodes, published, codes):
    rows, literals, done = run(spark, cases)
    assert len(rows) == inputs
    out = done.publicados.collect()
    assert len(out) == published and len({r.id_episodio for r in out}) == episodes
    held = done.cuarentena.collect()
    assert Counter(r.codigo for r in held) == codes
    assert all(r.etapa for r in held)
    results = done.resultados.collect()
    assert len(results) == 2 * episodes and {r.prueba for r in results} == {"Hemoglobina", "Urea"}
    assert done.mediciones_ecg.where("vent_rate IS NOT NULL").count() == done.medidas_eco.count() == episodes
    texts = done.textos_eco
    assert texts.where("seccion = 'CONCLUSIONES'").count() == episodes
    whole = [done.publicados, done.mediciones_ecg, done.resultados, done.medidas_eco, texts]
    said = [df.select(F.to_json(F.struct(*df.columns)).alias("j")) for df in whole]
    records = said[0].union(said[1]).union(said[2]).union(said[3]).union(said[4]).withColumn("id", F.monotonically_increasing_id())
    known = spark.createDataFrame([(x,) for x in [*literals, "Ruiz", "Pedro"]], "l string")
    assert leaks.count_leaks(records, "id", "j", known, "l").count() == 0
