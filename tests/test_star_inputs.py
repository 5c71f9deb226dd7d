import functools
from pathlib import Path

import pytest

from workload import derive as d

SF = "/root/testdata/sf0.001"


def test_events_are_parsed_once(spark, monkeypatch):
    """The inputs of the star share one stored table of edits."""
    if not Path(SF).exists():
        pytest.skip("no test data")
    real, calls = d._edits, []

    @functools.wraps(real)
    def counted(*args):
        calls.append(args)
        return real(*args)

    monkeypatch.setattr(d, "_PREPARED", {})
    monkeypatch.setattr(d, "_edits", counted)
    for build in (d.base_rows, d.star_base, d.star_central_log, d.star_clone_log):
        d.prepared(spark, SF, build)
    assert len(calls) == 1
