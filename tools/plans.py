"""Print the physical plans of the headline queries, as a reviewer would read them.

Usage: python tools/plans.py [sf_dir] [query ...]

Broadcast joins are switched off (``autoBroadcastJoinThreshold=-1``) so that the
plans show what a large input gets: which exchanges move text and which only
move small per-document rows.  Steps the job materialises eagerly (vocabulary,
checkpoints) have already run; their plans are not part of the final one.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from textmill import get_session  # noqa: E402
from textmill.plans.catalog import QUERIES  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or ["q_process_corpus", "q_dedup_exact", "q_vocab_topk", "q_lang_filter"]
    spark = get_session("local[8]", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    for n in names:
        print("=" * 20, n)
        QUERIES[n](spark, sf).explain("formatted")


if __name__ == "__main__":
    main()
