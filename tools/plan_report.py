"""Write PLANS.md: the shape of every checked query's physical plan (before
AQE re-planning): exchanges, windows, pre-limited windows, forbidden
operators and the columns each Parquet scan reads.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from vaultsmith.catalog import registry
    from vaultsmith.plans.explain import plan_summary
    from vaultsmith.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, shuffle_partitions=16)
    print("# Plan shapes of the checked queries\n")
    print(f"Generated by `tools/plan_report.py` at `{os.path.basename(sf_dir)}` with the session settings of "
          "`vaultsmith/session.py` (static broadcasts off; AQE decides joins at run time from measured sizes). "
          "Counts are for the initial physical plan of the whole query, *including the earlier loads the query "
          "builds its target from*. `WGL` = `WindowGroupLimit` (a pre-limited rank).\n")
    print("| query | exchanges | windows | WGL | forbidden | widest scan |")
    print("|---|---|---|---|---|---|")
    for name, fn in registry.queries().items():
        s = plan_summary(fn(spark, sf_dir))
        widest = max(s["read_schemas"], key=lambda x: x.count(","), default="")
        ncols = widest.count(",") + 1 if widest else 0
        print(f"| `{name}` | {s['exchanges']} | {s['windows']} | {s['window_group_limits']} | "
              f"{', '.join(s['forbidden']) or '—'} | {ncols} cols |")
    spark.stop()


if __name__ == "__main__":
    main()
