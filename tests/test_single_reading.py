"""Costly steps are done once: the fields of a message in one look-up, the events of a history in one pass over the lines."""

from tallybrook.operators import history
from tallybrook.plans import catalog

from conftest import SF


def test_a_merge_does_not_make_its_events_again(spark, monkeypatch):
    plans, merge = [], history.History.merge

    def seen(self, updates):
        plans.append(updates._jdf.queryExecution().optimizedPlan().toString() + "".join(updates.inputFiles()))
        merge(self, updates)

    monkeypatch.setattr(history.History, "merge", seen)
    assert catalog.QUERIES["status_asof"](spark, SF).count() > 0
    assert len(plans) == 2 and not any("l_shipdate" in p or "lineitem" in p for p in plans)
