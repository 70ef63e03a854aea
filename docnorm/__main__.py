"""Command line: ``spark-submit -m docnorm <command> ...`` or ``python -m docnorm``.

  load      --store ROOT --input PATH --collection NAME [--incremental]   (or --all DIR)
  validate  --store ROOT --collection NAME
  profile   --input PATH --out DIR
  sample    --input PATH --out PATH [--n 200]
The source collection at PATH is JSON lines (one document per line).
"""
from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from .operators import profile as G
from .plans import load as L
from .session import ensure_checkpoint_dir
from .sources import documents as D


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="docnorm")
    ap.add_argument("command", choices=["load", "validate", "profile", "sample"])
    ap.add_argument("--store")
    ap.add_argument("--input")
    ap.add_argument("--all", help="folder with one sub-folder of JSON lines per collection")
    ap.add_argument("--collection")
    ap.add_argument("--incremental", action="store_true")
    ap.add_argument("--out")
    ap.add_argument("--n", type=int, default=200)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"docnorm-{a.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if a.command == "load":
        store = L.Store(spark, a.store)
        names = L.load_order() if a.all else [a.collection]
        for name in names:
            path = os.path.join(a.all, name) if a.all else a.input
            docs, unparsed = D.read_documents(spark, path, with_rejects=True)
            L.load_collection(spark, name, docs, store, refresh=not a.incremental, unparsed=unparsed).show(100, False)
    elif a.command == "validate":
        L.validate_collection(L.Store(spark, a.store), a.collection).where("violations > 0").show(200, False)
    elif a.command == "profile":
        for section, df in G.report(D.read_documents(spark, a.input)).items():
            D.write_report(df, os.path.join(a.out, section))
    elif a.command == "sample":
        D.export_sample(D.read_documents(spark, a.input), a.out, a.n)


if __name__ == "__main__":
    main()
