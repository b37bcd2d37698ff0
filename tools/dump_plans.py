"""Write PLANS.md: the physical plan shape of the headline queries (operator tree plus
the scan lines that show partition pruning, pushed filters and column pruning).

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

HEADLINE = ["trailing_windows", "trailing_windows_incremental", "song_features", "song_influence", "top_influence",
            "singer_influence", "machine_dim", "machine_location", "machine_stats", "merchant_share", "active_users",
            "newly_active_users", "client_log_parse", "fanout_by_key"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from encore.registry import build
    from encore.session import build_session

    spark = build_session("local[8]", 16)
    q = build().queries
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/dump_plans.py` on `{sf}` (`local[8]`, 16 shuffle partitions, AQE on; the plan "
           "before AQE's run-time changes). Scan lines show partition filters, pushed filters and the columns read.", ""]
    for name in HEADLINE:
        df = q[name](spark, sf)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0].strip()
        scans = [ln.strip() for ln in text.splitlines()
                 if re.match(r"\s*(PartitionFilters|PushedFilters|ReadSchema):", ln)]
        out += [f"## {name}", "", "```", tree, "```", ""]
        if scans:
            out += ["```", *[s[:300] for s in scans], "```", ""]
    open(__file__.rsplit("/tools/", 1)[0] + "/PLANS.md", "w").write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
