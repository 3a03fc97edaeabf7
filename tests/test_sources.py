"""Scans, text pages, configuration, command line, SQL functions."""

import pytest
from pyspark.sql import functions as F

from cordal.__main__ import main
from cordal.functions import sql
from cordal.functions.keys import hmac16
from cordal.functions.values import literal_prefix
from cordal.operators import output, reconcile
from cordal.sources import config, files


def test_scan(spark, tmp_path):
    for name, text in {"g1/a.pdf": "x", "g2/b.PDF": "x", "c.pdf": "yy", "g1/n.txt": "z", "g1/.h.pdf": "h", "g1/big.pdf": "b" * 50}.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text)
    rows = {r.path.rsplit("/", 1)[-1]: r for r in files.scan(spark, str(tmp_path), ["pdf"], cap=49).collect()}
    assert set(rows) == {"a.pdf", "b.PDF", "c.pdf", "n.txt", "big.pdf"}
    assert rows["a.pdf"].huella == rows["b.PDF"].huella != rows["c.pdf"].huella
    assert (rows["a.pdf"].grupo, rows["c.pdf"].grupo) == ("g1", "__raiz__")
    assert (rows["n.txt"].codigo, rows["big.pdf"].codigo, rows["big.pdf"].huella) == ("formato_no_soportado", "artefacto_sobretamano", None)


def test_text_pages_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([("d.txt", ["uno\ndos", "tres"], ["dos\nuno", "tres"])], "documento string, paginas array<string>, paginas_orden array<string>")
    text = files.formatted_pages(pages, note="nota").first().value
    (tmp_path / "d.txt").write_text(text)
    (tmp_path / "vacio.txt").write_text("# solo notas\n")
    got = {r.documento: r for r in files.readable(files.text_pages(spark, str(tmp_path))).collect()}
    assert (got["d.txt"].paginas, got["d.txt"].paginas_orden, got["d.txt"].codigo) == (["uno\ndos", "tres"], ["dos\nuno", "tres"], None)
    assert got["vacio.txt"].codigo == "pdf_ilegible"


def test_content_hash_is_verified(spark):
    df = spark.createDataFrame([("a", "ca978112ca1bbdcafac231b39a23dc4da786eff8147c4e72b9807785afee48bb")], "c string, h string")
    assert files.verified(df, "c", "h").count() == 1
    with pytest.raises(Exception, match="recorded hash"):
        files.verified(df.withColumn("h", F.lit("0")), "c", "h").collect()


def test_config(tmp_path, monkeypatch):
    path = tmp_path / "c.toml"
    path.write_text('entrada = "x"\ntope_bytes = 5\nextensiones = ["pdf", "txt"]\n')
    assert config.load_config(str(path)) == config.Config(entrada="x", tope_bytes=5, extensiones=("pdf", "txt"))
    for bad in ('otra = 1', 'mi_password = "x"', 'tope_bytes = "5"', "tope_bytes = true"):
        path.write_text(bad)
        with pytest.raises(ValueError):
            config.load_config(str(path))
    monkeypatch.delenv("CORDAL_SECRET", raising=False)
    monkeypatch.delenv("CORDAL_SECRET_FILE", raising=False)
    with pytest.raises(RuntimeError):
        config.load_secret()
    assert [ok for _, ok, _ in config.doctor(config.Config())] == [False, False]
    monkeypatch.setenv("CORDAL_SECRET", "s")
    assert config.load_secret() == b"s"
    path.write_text(f'entrada = "{tmp_path}"')
    assert main(["--config", str(path), "doctor"]) == 0


def test_sql_functions_agree(spark):
    sql.register(spark, b"k")
    spark.createDataFrame([("Hola 12.345.678",)], "t string").createOrReplaceTempView("textos")
    row = spark.sql("SELECT hmac16(t) AS h, redact_ids(t) AS r, shape_mask(t) AS s, detect_type('mortara') AS d, national_id('00.7') AS n FROM textos").first()
    assert row.h == spark.table("textos").select(hmac16(F.col("t"), b"k")).first()[0]
    assert (row.r, row.s, row.d, row.n) == ("Hola [REDACTADO]", "X 0.0.0", "ecg", "7")


def test_literal_prefix():
    assert literal_prefix(r"Edad:\s*(.+)") == "Edad:" and literal_prefix(r"F\.Nac") == "F.Nac" and literal_prefix(r"ab?c") == "a"


def test_associations(spark):
    df = spark.createDataFrame([(["49", "Vent. rate", "x", "y", "z", "77"], "49", "77")], "l array<string>, a string, b string")
    row = df.select(
        reconcile.beside_label(F.col("l"), r"Vent\. rate", F.col("a")),
        reconcile.beside_label(F.col("l"), r"Vent\. rate", F.col("b")),
        reconcile.in_order(F.lit("uno dos tres"), F.array(F.lit("uno"), F.lit("tres"))),
        reconcile.in_order(F.lit("uno dos tres"), F.array(F.lit("tres"), F.lit("uno"))),
        reconcile.follows_label(F.lit("Hora: 08:05 hs"), "Hora:", F.lit("08:05")),
        reconcile.in_one_line(F.array(F.lit("AO 36 mm"), F.lit("36 AI")), F.lit("AI"), F.lit("36")),
    ).first()
    assert list(row) == [True, False, True, False, True, False]


def test_relational_options():
    options = output.jdbc_options("jdbc:x", "t", "id", (1, 9, 4))
    assert options["numPartitions"] == "4" and "partitionColumn" not in output.jdbc_options("jdbc:x", "t")


def test_command_line_processes_text_pages(spark, tmp_path, monkeypatch):
    from corpus import echo, ecg, laboratory
    from cordal.operators.output import exported

    monkeypatch.setenv("CORDAL_SECRET", "k")
    day = __import__("datetime").date(2024, 5, 6)
    (tmp_path / "in").mkdir()
    for make in (laboratory, ecg, echo):
        page = make(3, day)
        text = f"# nota\n## pagina 1 (orden de dibujado)\n{page}\n## pagina 1 (orden geometrico)\n{page}\n"
        (tmp_path / "in" / f"{make.__name__}.txt").write_text(text, encoding="utf-8")
    folders = ["--entrada", str(tmp_path / "in"), "--salida"]
    assert main(["process", *folders, str(tmp_path / "out")]) == 0
    tables = exported(spark, str(tmp_path / "out"))
    assert {n: t.count() for n, t in tables.items()} == {
        "publicados": 3, "cuarentena": 0, "mediciones_ecg": 1, "resultados": 2, "medidas_eco": 1, "textos_eco": 1
    }
    assert main(["skeleton", *folders, str(tmp_path / "mask")]) == 0
    masked = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "mask")).collect())
    assert "X X: 0" in masked and "## pagina 1" in masked and "Tarfolde" not in masked
    assert main(["run", "nothing", str(tmp_path), "--salida", str(tmp_path / "x")]) == 1
