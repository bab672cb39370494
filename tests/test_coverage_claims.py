import inspect
import os
import re


def test_sequence_ratio_is_claimed_only_where_it_runs():
    from tessera.plans import catalog
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    with open(os.path.join(top, "COVERAGE.md"), encoding="utf-8") as f:
        row = next(x for x in f if x.startswith("| S28 |"))
    for name in re.findall(r"\w+", row.split("|")[3]):
        source = inspect.getsource(catalog.QUERIES[name])
        assert "seq=" not in source, name     # another scorer takes its place
