from __future__ import annotations

import json
import pathlib

import pytest

from stationhour.sources.versions import Folder
from stationhour.streaming import windows

SCHEMA = "ts TIMESTAMP, kind STRING, value DOUBLE"


@pytest.fixture
def feed(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def add(name, rows):
        (folder / name).write_text("\n".join(json.dumps({"ts": f"2024-01-{t}:00", "kind": k, "value": v}) for t, k, v in rows))

    def run(table="t", mark="m", **options):
        events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(folder))
        counts = windows.windowed_value_counts(events, "ts", ["kind"], "value", delay="2 hours")
        windows.upsert_counts(counts, str(tmp_path / table), str(tmp_path / mark), **options)
        current = windows.current_counts(spark, str(tmp_path / table), counts.schema)
        return current, sorted((str(r.window_start)[5:16], r.kind, r.rows, r.mean_value, r.median_value) for r in windows.window_summary(current, ["kind"]).collect())
    add.run, add.folder, add.tmp = run, folder, tmp_path
    return add


def test_open_windows_come_from_the_state(spark, feed):
    """After every run the table equals a batch over the rows that were in time; open windows are there, rows behind the watermark are not."""
    feed("a.json", [("01 00:10", "x", 1.0), ("01 00:20", "x", 3.0), ("01 01:30", "y", None)])
    assert feed.run()[1] == [("01-01 00:00", "x", 2, 2.0, 2.0), ("01-01 01:00", "y", 1, None, None)]
    feed("b.json", [("01 00:50", "x", 8.0), ("01 09:00", "x", 5.0)])  # late, but in time
    current, got = feed.run()
    assert got == [("01-01 00:00", "x", 3, 4.0, 3.0), ("01-01 01:00", "y", 1, None, None), ("01-01 09:00", "x", 1, 5.0, 5.0)]
    feed("c.json", [("01 00:55", "x", 100.0), ("01 09:30", "x", 7.0), ("01 09:30", "x", 7.0)])  # the first comes too late
    current, got = feed.run()
    assert got == [("01-01 00:00", "x", 3, 4.0, 3.0), ("01-01 01:00", "y", 1, None, None), ("01-01 09:00", "x", 3, 19 / 3, 7.0)]
    assert feed.run()[1] == got
    assert not any(str(feed.folder) in f for f in current.inputFiles())  # no event is read again
    assert sorted((str(r.window_start)[5:16], r.kind, r.rows, r.mean_value, r.median_value) for r in
                  windows.window_summary(current, ["kind"], refine=True).collect()) == got


def test_parts_are_merged_and_replays_change_nothing(spark, feed, monkeypatch):
    for i in range(6):
        feed(f"{i}.json", [(f"01 00:{10 + i}", "x", float(i)), (f"01 0{i}:30", "y", 1.0)])
    one = feed.run(table="one", mark="one", merge_after=100)[1]
    real, failed = Folder.create, []

    def fail_once(self, *args):  # written, not published; the restart replays the batch
        if "batch=3" in args[0] and not failed:
            failed.append(1)
            raise OSError("cut off")
        return real(self, *args)
    with monkeypatch.context() as m:
        m.setattr(Folder, "create", fail_once)
        with pytest.raises(Exception, match="cut off"):
            feed.run(merge_after=2)
    assert feed.run(merge_after=2)[1] == one and failed
    parts = windows._parts(Folder(spark, str(feed.tmp / "t")))
    assert len(parts) <= 2 and any(p.startswith("merged=") for p in parts)
    assert len(list(pathlib.Path(feed.tmp / "t" / "_batches").glob("*.json"))) >= 6


def test_nothing_yet(spark, feed):
    assert windows.current_counts(spark, str(feed.tmp / "none"), spark.createDataFrame([], "window_start TIMESTAMP, n LONG").schema).count() == 0
