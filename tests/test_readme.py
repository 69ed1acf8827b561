"""The README's usage block runs as printed."""

import os
import re


def test_usage_block(spark, capsys):
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")
    block = re.search(r"```python\n(.*?)```", open(path, encoding="utf-8").read(), re.DOTALL)[1]
    names = {}
    exec(block, names)
    assert names["enriched"].count() == 2 and [r["host"] for r in names["report"].collect()] == ["a"]
    shown = capsys.readouterr().out
    assert "histo_supp -> 2" in shown and "n -> 2" in shown and "count -> 1" in shown
