"""python -m strandline: list queries, run one over a folder of tables, or a sub-command over files.

    python -m strandline list
    python -m strandline run a7_coverage_per_scaffold /data/tables [--out /data/result] [--explain]
    python -m strandline chop contigs.fasta --size 10000 --out pieces
"""

from __future__ import annotations

import argparse


def main() -> None:
    from . import commands
    from .catalog import ORACLES, QUERIES

    p = argparse.ArgumentParser(prog="strandline")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("query", choices=sorted(QUERIES), metavar="query")
    r.add_argument("tables")
    r.add_argument("--out")
    r.add_argument("--explain", action="store_true")
    for name, f in commands.COMMANDS.items():
        c = sub.add_parser(name, help=f.__doc__)
        c.add_argument("paths", nargs="+")
        c.add_argument("--size", type=int, default=1)
        c.add_argument("--out")
    a = p.parse_args()
    if a.command == "list":
        for name in sorted(QUERIES):
            print(name, "" if name in ORACLES else "(no SQL)")
        return
    from pyspark.sql import SparkSession

    if a.command in commands.COMMANDS:
        df = commands.run(SparkSession.builder.getOrCreate(), a.command, a.paths, a.size, a.out)
        if not a.out:
            df.show(50, truncate=False)
        return
    df = QUERIES[a.query](SparkSession.builder.getOrCreate(), a.tables)
    if a.explain:
        df.explain("formatted")
    elif a.out:
        df.write.parquet(a.out)
    else:
        df.show(50, truncate=False)


if __name__ == "__main__":
    main()
