"""Command line: list the registered queries or write one to a path.

    python -m riskweave list
    python -m riskweave run <query> --sf-dir DIR --out PATH [--overwrite]
    spark-submit -m riskweave run ...   (on a cluster; master comes from spark-submit)
"""

from __future__ import annotations

import argparse

from .operators.load import materialize
from .plans.bound import REGISTRY
from .session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="riskweave")
    sub = ap.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    run = sub.add_parser("run")
    run.add_argument("query", choices=sorted(REGISTRY))
    run.add_argument("--sf-dir", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--overwrite", action="store_true",
                     help="replace an existing output (default: keep it, CREATE IF NOT EXISTS)")
    run.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    if a.cmd == "list":
        for name in sorted(REGISTRY):
            print(name)
        return 0
    spark = build_session(a.master)
    materialize(REGISTRY[a.query](spark, a.sf_dir), a.out, if_absent=not a.overwrite)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
