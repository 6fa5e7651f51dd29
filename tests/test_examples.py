"""The quickstart tour runs end to end on the smallest tables."""

import importlib.util
import os

from tests.conftest import SF0001


def test_quickstart_runs(spark, capsys):
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples", "quickstart.py")
    spec = importlib.util.spec_from_file_location("quickstart", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    mod.main(SF0001)
    out = capsys.readouterr().out
    assert "response rows:" in out and "route" in out
