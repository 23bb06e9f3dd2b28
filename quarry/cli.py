"""Command line: run a registered query and print a bounded sample.

    python -m quarry.cli list
    python -m quarry.cli show <query> [--sf DIR] [-n 20] [--master local[8]]
    python -m quarry.cli write <query> <out_path> [--sf DIR] [--format parquet]
    python -m quarry.cli explain <query> [--sf DIR]
"""

from __future__ import annotations

import argparse


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="quarry")
    ap.add_argument("cmd", choices=["list", "show", "write", "explain"])
    ap.add_argument("query", nargs="?")
    ap.add_argument("out", nargs="?")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("-n", type=int, default=20)
    ap.add_argument("--master", default=None)
    ap.add_argument("--format", default="parquet")
    a = ap.parse_args(argv)

    from quarry.plans import queries
    from quarry.plans.registry import REGISTRY

    if a.cmd == "list":
        for name, e in REGISTRY.items():
            print(f"{name:32s} {e.ops}")
        return
    from quarry.session import get_session

    spark = get_session(a.master)
    df = queries()[a.query](spark, a.sf)
    if a.cmd == "show":
        df.show(a.n, truncate=60)
    elif a.cmd == "explain":
        df.explain("formatted")
    else:
        if not a.out:
            raise SystemExit("write needs an output path")
        df.write.mode("overwrite").format(a.format).save(a.out)


if __name__ == "__main__":
    main()
