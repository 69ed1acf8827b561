"""Print the physical plan of every registered batch query as a compact operator tree.

Expressions are dropped; scans keep their pushed filters and read schema so
pushdown and pruning stay visible.  Usage: python tools/plan_shapes.py [sf_dir] [name ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowdex.session import build_session  # noqa: E402

STREAMING = {"histogram_stream", "feed_to_index", "feed_to_index_plain", "log_report_stream", "report_to_index",
             "mail_stream", "index_write"}
KEEP = re.compile(r"(PushedFilters: \[[^\]]*\]|ReadSchema: \S+)")


def shape(line: str) -> str:
    indent = len(line) - len(line.lstrip(" :+-"))
    body = line.strip(" :+-")
    name = re.split(r"[\[(]", body, maxsplit=1)[0].strip()
    if name.startswith("FileScan"):
        name += " " + " ".join(KEEP.findall(body))
    return " " * indent + name


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from flowdex.plans import catalog
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[2:] or sorted(n for n in catalog.QUERIES if n not in STREAMING)
    for name in names:
        df = catalog.QUERIES[name](spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        raw = [ln for ln in buf.getvalue().splitlines()[1:] if ln.strip()]
        # Continuation lines of multi-line literals start at column 0: not tree nodes.
        lines = raw[:1] + [ln for ln in raw[1:] if ln[:1] in (" ", "+", ":")]
        print(f"### {name}\n```")
        print("\n".join(shape(ln) for ln in lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
