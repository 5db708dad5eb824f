"""Write PLANS.md: the final (post-AQE) physical plan of every registered query.

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.1)
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadsmith.registry import queries  # noqa: E402
from loadsmith.session import local_session  # noqa: E402

HEADER = """# Physical plans

Final (post-AQE) physical plans of every registered query, executed at {sf} on
local[8], with the settings of `loadsmith.session.RECOMMENDED_CONF`.  Generated
by `tools/plan_report.py`.  Only the plan tree and the scan lines are kept.

How to read them for scale:

* Only the query's last plan is shown.  Queries that load twice (the incremental plans, the
  `*_roundtrip` and `change_tag` queries) write scratch or target tables before it; the
  jobs that made those are not in this file.
* `BroadcastHashJoin`: a side whose files hold less than `autoBroadcastJoinThreshold`, or
  that AQE measured as small; the other side is not shuffled (in the first case).
* `Union` under an upsert: target rows with a null key go around the join.
* `Scan parquet` of a `loadsmith-*` folder: data written once under
  `spark.checkpoint.dir` (a batch, a first-run target, a key set) and read back.
* `PushedFilters` / `ReadSchema`: predicates and columns that reach the Parquet
  reader.  On the stand-in inputs most source columns are computed, so their
  filters cannot be pushed; `tests/test_plans_shape.py` checks pushdown on the
  same plans over stored sources.
"""


def final_tree(text: str) -> str:
    tree = text.split("\n\n\n")[0]
    if "== Final Plan ==" in tree:
        tree = tree.split("+- == Initial Plan ==")[0]
    return tree.rstrip()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    out = [HEADER.format(sf=os.path.basename(sf))]
    for name, fn in queries().items():
        df = fn(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        scans = sorted({line.strip()[:220] for line in text.splitlines()
                        if line.startswith(("PushedFilters", "ReadSchema"))})
        out.append(f"## {name}\n\n```\n{final_tree(text)}\n```\n")
        if scans:
            out.append("```\n" + "\n".join(scans) + "\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
