"""Late documents of a stream at the default lateness."""

from datetime import datetime, timedelta

from cordal.streaming.episodes import closing_episodes


def test_late_documents_are_kept(spark, tmp_path):
    d = datetime(2024, 1, 1, 12)
    batches = [
        [("a", 0, "ecg"), ("b", 0, "ecg"), ("b", 0, "lab")],
        [("c", 20, "ecg")],  # closes the episodes of day 0
        [("a", 1, "lab"), ("e", 2, "lab"), ("e", 3, "ecg")],  # late: the episode of a is out, e has none open
        [("f", 25, "lab")],
        [("c", 21, "lab"), ("c", 5, "ecg")],  # late: day 21 joins the open episode of c, day 5 does not
        [("z", 400, "ecg")],
        [("z", 800, "ecg")],
    ]
    schema = "p string, t timestamp, k string, d string"
    out = None
    for i, rows in enumerate(batches):
        docs = [(p, d + timedelta(days=n), k, f"{p}{n}{k}") for p, n, k in rows]
        spark.createDataFrame(docs, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        out = closing_episodes(stream, "p", "t", "k", "d", ["ecg", "lab"])
        sink = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", str(tmp_path / "cp"))
        query = sink.start(str(tmp_path / "out"))
        query.processAllAvailable()
        query.stop()
    got = sorted((r.paciente, (r.ancla - d.date()).days, r.documentos, r.faltantes, r.motivo) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [
        ("a", 0, 1, "lab", "estudios_faltantes"), ("a", 1, 1, "", "documento_tardio"), ("b", 0, 2, "", None),
        ("c", 5, 1, "", "documento_tardio"), ("c", 20, 2, "", None), ("e", 2, 1, "", "documento_tardio"), ("e", 3, 1, "", "documento_tardio"),
        ("f", 25, 1, "ecg", "estudios_faltantes"), ("z", 400, 1, "lab", "estudios_faltantes"),
    ]
    assert sum(r[2] for r in got) == sum(map(len, batches)) - 1  # all but the one that is still open
