"""Print the formatted physical plan of registered queries.

usage: python tools/explain.py [--sf DIR] key [key ...]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimforge.plans import load_all  # noqa: E402
from dimforge.session import build_session  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="+")
    a = ap.parse_args()
    reg = load_all()
    spark = build_session()
    for k in a.keys:
        print(f"===== {k}")
        reg[k][0](spark, a.sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
