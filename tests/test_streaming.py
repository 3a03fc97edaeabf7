"""Streamed episodes against the batch fold; idempotent sink."""

from datetime import datetime, timedelta

from cordal.operators import episodes
from cordal.streaming.episodes import OUT, closing_episodes, idempotent_sink


def test_stream_equals_batch(spark, tmp_path):
    d = datetime(2024, 1, 1, 12)
    docs = [("a", d + timedelta(days=n), k, f"a{n}{k}") for n, k in [(0, "ecg"), (7, "lab"), (8, "ecg"), (20, "ecg"), (21, "ecg")]]
    docs += [("b", d + timedelta(days=3), "lab", "b1"), ("z", d + timedelta(days=90), "lab", "z1")]
    schema = "p string, t timestamp, k string, d string"
    for i in range(0, len(docs), 3):
        spark.createDataFrame(docs[i : i + 3], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = closing_episodes(stream, "p", "t", "k", "d", ["ecg", "lab"], lateness="100 days")
    # one late marker moves the watermark past every window
    spark.createDataFrame([("y", d + timedelta(days=400), "lab", "y1")], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    query = out.writeStream.format("memory").queryName("cerrados").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    query.processAllAvailable()
    query.stop()
    got = sorted((r.paciente, str(r.ancla), r.documentos, r.faltantes, r.estado) for r in spark.table("cerrados").collect())
    batch = spark.createDataFrame(docs, schema)
    linked = episodes.anchor_episodes(batch.withColumn("f", batch["t"].cast("date")), "p", "f")
    want = sorted((r.p, str(r.ancla), r.documentos, r.faltantes, r.estado) for r in episodes.gate(linked, "p", "k", ["ecg", "lab"]).collect())
    assert got == want
    assert len(OUT.split(", ")) == 6


def test_sink_replaces_its_own_batch(spark, tmp_path):
    write = idempotent_sink(str(tmp_path / "out"), "k")
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    write(df, 0)
    write(df, 0)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    for _ in range(2):
        write(spark.createDataFrame([("b",), ("c",), (None,), (None,)], "k string"), 1)  # b came before
    got = [r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got, key=str) == [None, None, "a", "b", "c"]
