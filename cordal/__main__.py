"""Command line: checks, scan, whole runs over text pages, skeletons, registered queries.

Exit codes: 0 done, 1 a check or a query failed, 2 wrong arguments.
"""

from __future__ import annotations

import argparse
import importlib
import sys

from cordal.sources.config import doctor, load_config, load_secret


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="cordal")
    parser.add_argument("--config")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("doctor", help="report all checks at once")
    scan = commands.add_parser("scan", help="list, route and hash the files of a folder")
    scan.add_argument("--entrada")
    scan.add_argument("--salida", required=True)
    process = commands.add_parser("process", help="text pages through all stages; publish the tables, keep the quarantine")
    skeleton = commands.add_parser("skeleton", help="the text pages with letters and digits masked")
    for command in (process, skeleton):
        command.add_argument("--entrada")
        command.add_argument("--salida")
    run = commands.add_parser("run", help="write the result of a registered query")
    run.add_argument("name")
    run.add_argument("folder")
    run.add_argument("--salida", required=True)
    run.add_argument("--catalogo", action="append", default=[], help="further modules with queries()")
    args = parser.parse_args(argv)
    config = load_config(args.config)
    if args.command == "doctor":
        found = doctor(config)
        for name, passed, advice in found:
            print(f"{'ok  ' if passed else 'FAIL'} {name} {advice}".rstrip())
        return int(not all(passed for _, passed, _ in found))
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("cordal").getOrCreate()
    if args.command == "scan":
        from cordal.sources.files import scan as listing

        root = args.entrada or config.entrada  # the flag wins over the file
        if not root:
            parser.error("no input folder")
        listing(spark, root, list(config.extensiones), config.tope_bytes).write.mode("overwrite").parquet(args.salida)
        return 0
    if args.command in ("process", "skeleton"):
        source, target = args.entrada or config.entrada, args.salida or config.salida
        if not source or not target:
            parser.error("no input or output folder")
        return _process(spark, source, target) if args.command == "process" else _skeleton(spark, source, target)
    modules = ["cordal.plans.catalogue", "cordal.plans.fields", *args.catalogo]
    queries = {name: f for m in modules for name, f in importlib.import_module(m).queries().items()}
    if args.name not in queries:
        print(f"unknown query {args.name}", file=sys.stderr)
        return 1
    queries[args.name](spark, args.folder).write.mode("overwrite").parquet(args.salida)
    return 0


def _process(spark, source: str, target: str) -> int:
    """Run all stages; the tables of the run become visible at once."""
    from cordal.operators import output
    from cordal.plans.processing import process
    from cordal.sources.files import text_pages

    done = process(text_pages(spark, source), load_secret())
    tables = {name: getattr(done, name) for name in done.__dataclass_fields__}
    whitelist = {name: df.columns for name, df in tables.items()}
    manifest = output.export(tables, whitelist, target, {"esquema": 1, "formato": "parquet"})
    for name, entry in manifest["tablas"].items():
        print(f"{name} {entry['filas']}")
    return 0


def _skeleton(spark, source: str, target: str) -> int:
    """The pages with every letter run as X and every digit run as 0."""
    from pyspark.sql import functions as F

    from cordal.functions.masking import shape_mask
    from cordal.sources.files import formatted_pages, text_pages

    masked = lambda c: F.transform(c, lambda page: shape_mask(page)).alias(c)
    pages = text_pages(spark, source).select("documento", masked("paginas"), masked("paginas_orden"))
    formatted_pages(pages).select("value").write.mode("overwrite").text(target)
    return 0


if __name__ == "__main__":
    sys.exit(main())
