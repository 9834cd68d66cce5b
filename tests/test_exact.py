"""One query, two tables: every message once in one of them, wherever a run is cut off."""

import pytest

from terrane import schemas
from terrane.plans import bronze
from terrane.sources import Lake, file_source

from .helpers import rows
from .test_streaming import message, put

TABLE = "bronze.bronze_pos_transaction_events"
REJECTS, LEDGER = f"{TABLE}_rejects", f"{TABLE}_ledger"


def start(lake, folder):
    queries = bronze.ingest_topic(lake, "POS_topic", file_source(lake.spark, str(folder / "in"), 1), str(folder / "ck"))
    assert len(queries) == 1
    return queries[0]


def finish(query):
    assert query.awaitTermination(120)
    assert query.exception() is None


@pytest.mark.parametrize("broken", ["before good", "after good", "before bad", "after bad", "ledger"])
def test_cut_off_anywhere_and_restarted(lake, tmp_path, monkeypatch, broken):
    put(tmp_path / "in", "0.json", message(1), message(1), "no json", "no json", message(None))
    append, failed = Lake.append, []

    def fragile(self, table, df):
        when = {"before good": TABLE, "after good": TABLE, "before bad": REJECTS, "after bad": REJECTS}.get(broken)
        ledger = broken == "ledger" and table == LEDGER and df.where("sink is not null").count()
        if not failed and (table == when or ledger):
            failed.append(table)
            if broken.startswith("after"):
                append(self, table, df)
            raise RuntimeError("cut off")
        append(self, table, df)

    monkeypatch.setattr(Lake, "append", fragile)
    with pytest.raises(Exception, match="cut off"):
        start(lake, tmp_path).awaitTermination(120)
    assert failed
    finish(start(lake, tmp_path))
    assert rows(lake.load(TABLE), "transaction_id") == [("1",), ("1",)]
    assert rows(lake.load(REJECTS), "value") == [("no json",), ("no json",), (message(None),)]
    put(tmp_path / "in", "1.json", message(2))
    finish(start(lake, tmp_path))
    finish(start(lake, tmp_path))
    assert rows(lake.load(TABLE), "transaction_id") == [("1",), ("1",), ("2",)]
    assert lake.load(REJECTS).count() == 3
    assert lake.load(TABLE).select(schemas.LANDED).distinct().count() == 2


def test_a_half_written_sink_gets_the_rest(lake, tmp_path, monkeypatch):
    put(tmp_path / "in", "0.json", message(1), message(1), message(2))
    append, failed = Lake.append, []

    def fragile(self, table, df):
        if table == TABLE and not failed:
            failed.append(1)
            append(self, table, df.where("transaction_id = '1'").limit(1))
            raise RuntimeError("cut off")
        append(self, table, df)

    monkeypatch.setattr(Lake, "append", fragile)
    with pytest.raises(Exception, match="cut off"):
        start(lake, tmp_path).awaitTermination(120)
    finish(start(lake, tmp_path))
    assert rows(lake.load(TABLE), "transaction_id") == [("1",), ("1",), ("2",)]
