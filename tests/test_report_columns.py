"""Reports count pairs: their names are not joined, shuffled or written for that."""

from __future__ import annotations

from editloom.plans import file_queries  # noqa: F401  (it registers its queries)
from editloom.plans.fixtures import Fixtures
from editloom.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"


def test_reports_take_no_names_along(spark, monkeypatch):
    stages = {}
    stage = Fixtures.stage

    def watched(self, name, make):
        stages[name] = stage(self, name, make)
        return stages[name]

    monkeypatch.setattr(Fixtures, "stage", watched)
    assert QUERIES["write_split_reports"](spark, SF).where("report = 'totals' AND measure = 'total'").first()["n"] == 6000
    table = next(df for name, df in stages.items() if name != "aligned_pairs")
    assert not {"qname", "primer1", "primer2", "pos1", "pos2"} & set(table.columns)
