from __future__ import annotations

from bazaar.plans import registry
from conftest import TESTDATA


def test_the_second_run_updates_stored_users(spark, monkeypatch):
    """Two runs; the second one meets users that the first one stored."""
    stored = []

    def counted(spark, landing, schema, users, **more):
        found = upsert(spark, landing, schema, users, **more)
        stored.append({r.user_id: r.event_type for r in found.select("user_id", "event_type").collect()})
        return found

    upsert = registry.upsert_new_files
    monkeypatch.setattr(registry, "upsert_new_files", counted)
    registry.incremental_upsert(spark, TESTDATA)
    assert len(stored) == 2 and any(stored[1][u] != kind for u, kind in stored[0].items())
