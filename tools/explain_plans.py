"""Print the physical plan of registered queries (simple mode), for review.

Usage: python tools/explain_plans.py SF_DIR name [name ...]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from raincheck.plans.registry import QUERIES  # noqa: E402
from raincheck.session import build_session  # noqa: E402


def main():
    sf, names = sys.argv[1], sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=16)
    for n in names:
        print(f"==== {n} @ {sf}")
        QUERIES[n](spark, sf).explain()
    spark.stop()


if __name__ == "__main__":
    main()
