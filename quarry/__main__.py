"""Command line: ``python -m quarry ingest|ask|clear|export-ledger ...``.

    python -m quarry ingest --pdf data/pdfs --txt data/texts --state /shared/kb
    python -m quarry ask --state /shared/kb --k 3 --threshold 0.7 "What is AI?" "Who?"
    python -m quarry ask --state /shared/kb --questions questions.parquet --out prompts/
    python -m quarry export-ledger --state /shared/kb --out ledger_json/
    python -m quarry clear --state /shared/kb

On a cluster run it through ``spark-submit``; the session and its
``spark.checkpoint.dir`` come from the platform.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from quarry.session import ensure_checkpoint_dir, ship_package
    spark = SparkSession.getActiveSession() or SparkSession.builder.appName("quarry").getOrCreate()
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    from quarry import api
    from quarry import config as C
    p = argparse.ArgumentParser(prog="quarry")
    sub = p.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--pdf")
    ing.add_argument("--txt")
    ing.add_argument("--state", required=True)
    a = sub.add_parser("ask")
    a.add_argument("--state", required=True)
    a.add_argument("--k", type=int, default=C.TOP_K)
    a.add_argument("--threshold", type=float, default=C.SCORE_THRESHOLD)
    a.add_argument("--questions", help="Parquet table (query_id, text)")
    a.add_argument("--out", help="write prompts here (Parquet) instead of printing")
    a.add_argument("text", nargs="*")
    c = sub.add_parser("clear")
    c.add_argument("--state", required=True)
    e = sub.add_parser("export-ledger")
    e.add_argument("--state", required=True)
    e.add_argument("--out", required=True)
    args = p.parse_args(argv)
    spark = _session()
    if args.cmd == "ingest":
        out = api.ingest_folders(spark, args.pdf, args.txt, args.state)
        for r in out["status"].groupBy("status").count().orderBy("status").collect():
            print(f"{r['status']}: {r['count']}")
    elif args.cmd == "ask":
        qs = spark.read.parquet(args.questions) if args.questions else args.text
        prompts = api.ask(spark, args.state, qs, k=args.k, threshold=args.threshold)
        if args.out:
            from quarry.operators.prompts import write_prompts
            write_prompts(prompts, args.out)
        else:
            for r in prompts.orderBy("query_id").toLocalIterator():
                print(f"--- {r.query_id} ({r.n_hits} hits)\n{r.prompt}\n")
    elif args.cmd == "clear":
        api.clear(spark, args.state)
    elif args.cmd == "export-ledger":
        from quarry.operators.scan import export_ledger_json
        export_ledger_json(spark, args.state, args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
