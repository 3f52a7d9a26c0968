"""Merging into the monthly table: only the months that later parts name are written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skylane.operators import serving

KEYS = ["cam_id", "ts"]


def rows_of(spark, rows):
    """(cam, month of 2025, day, value) as serving rows."""
    data = [(c, dt.datetime(2025, m, d, 12), v) for c, m, d, v in rows]
    return spark.createDataFrame(data, "cam_id string, ts timestamp, value int").withColumn("dt", F.to_date("ts"))


def files_of(root):
    return {p: p.stat().st_mtime_ns for p in root.rglob("*.parquet")}


def values(spark, root):
    return sorted((r.cam_id, r.ts.month, r.value) for r in spark.read.parquet(str(root)).collect())


@pytest.fixture
def year(spark, tmp_path):
    """A table of twelve months, made of one part."""
    parts, root = str(tmp_path / "p"), tmp_path / "t"
    serving.append_part(rows_of(spark, [(c, m, 5, m) for c in "ab" for m in range(1, 13)]), parts, 0)
    assert serving.merge_months(spark, parts, str(root), KEYS, days=None) == 0
    return parts, root


def test_a_late_part_rewrites_its_month_only(spark, year):
    parts, root = year
    before = files_of(root)
    serving.append_part(rows_of(spark, [("a", 3, 5, 33), ("c", 3, 6, 34)]), parts, 1)
    assert serving.merge_months(spark, parts, str(root), KEYS, days=None, after=0) == 1
    after = files_of(root)
    assert {p.parent.name for p, _ in set(before.items()) ^ set(after.items())} == {"yyyymm=202503"}
    expected = [(c, m, m) for c in "ab" for m in range(1, 13) if (c, m) != ("a", 3)] + [("a", 3, 33), ("c", 3, 34)]
    assert values(spark, root) == sorted(expected)


def test_expired_months_go_unread_and_the_rest_stays(spark, year):
    parts, root = year
    before = files_of(root)
    for p in before:
        if p.parent.name == "yyyymm=202501":
            p.write_bytes(b"no parquet")
    # The limit is 10 March: January and February are gone, March is looked at, the others stay.
    now = F.lit(dt.datetime(2025, 3, 17))
    assert serving.merge_months(spark, parts, str(root), KEYS, now, after=0) == 0
    assert sorted(p.name for p in root.glob("yyyymm=*")) == [f"yyyymm=2025{m:02d}" for m in range(4, 13)]
    assert all(before[p] == t for p, t in files_of(root).items())


def test_the_month_at_the_limit_is_rewritten_if_it_has_expired_rows(spark, tmp_path):
    parts, root = str(tmp_path / "p"), tmp_path / "t"
    serving.append_part(rows_of(spark, [("a", 3, d, d) for d in (1, 10, 20)] + [("a", 4, 1, 1)]), parts, 0)
    serving.merge_months(spark, parts, str(root), KEYS, days=None)
    before = files_of(root)
    serving.merge_months(spark, parts, str(root), KEYS, F.lit(dt.datetime(2025, 3, 9)), after=0)
    assert values(spark, root) == [("a", 3, 10), ("a", 3, 20), ("a", 4, 1)]
    again = files_of(root)
    assert {p.parent.name for p, _ in set(before.items()) ^ set(again.items())} == {"yyyymm=202503"}
    serving.merge_months(spark, parts, str(root), KEYS, F.lit(dt.datetime(2025, 3, 9)), after=0)
    assert files_of(root) == again


def test_merging_the_same_parts_again_changes_nothing(spark, year):
    parts, root = year
    serving.append_part(rows_of(spark, [("a", 7, 5, 70)]), parts, 1)
    for _ in range(2):
        serving.merge_months(spark, parts, str(root), KEYS, days=None, after=0)
        assert len(values(spark, root)) == 24 and ("a", 7, 70) in values(spark, root)
    serving.append_part(rows_of(spark, [("a", 7, 5, 71)]), parts, 2)
    assert serving.merge_months(spark, parts, str(root), KEYS, days=None, after=1, live=True) == 1
    assert ("a", 7, 70) in values(spark, root)


def test_a_merge_that_broke_off_is_finished_by_the_next(spark, year, monkeypatch):
    parts, root = year
    serving.append_part(rows_of(spark, [("a", 7, 5, 70)]), parts, 1)
    whole = serving.finish_merge
    calls = []

    def lost(session, table_root):
        if calls:
            raise RuntimeError("driver lost")
        calls.append(1)
        whole(session, table_root)

    monkeypatch.setattr(serving, "finish_merge", lost)
    with pytest.raises(RuntimeError):
        serving.merge_months(spark, parts, str(root), KEYS, days=None, after=0)
    monkeypatch.undo()
    # The old month may be half gone by then.
    for p in root.glob("yyyymm=202507/*.parquet"):
        p.unlink()
    serving.finish_merge(spark, str(root))
    assert len(values(spark, root)) == 24 and ("a", 7, 70) in values(spark, root)


def test_rows_without_a_date_go_by_their_time(spark, tmp_path):
    parts, root = str(tmp_path / "p"), tmp_path / "t"
    df = rows_of(spark, [("a", 2, 1, 1)]).withColumn("dt", F.lit(None).cast("date"))
    none = df.withColumns({"ts": F.lit(None).cast("timestamp"), "cam_id": F.lit("z")})
    serving.append_part(df.unionByName(none), parts, 0)
    serving.merge_months(spark, parts, str(root), KEYS, days=None)
    assert sorted(p.name for p in root.glob("yyyymm=*")) == ["yyyymm=000000", "yyyymm=202502"]
    serving.append_part(none.withColumn("value", F.lit(9)), parts, 1)
    serving.merge_months(spark, parts, str(root), KEYS, days=None, after=0)
    assert sorted(r.value for r in spark.read.parquet(str(root)).collect()) == [1, 9]


def test_all_rows_of_a_touched_month_may_expire(spark, year):
    parts, root = year
    serving.append_part(rows_of(spark, [("a", 12, 6, 1)]), parts, 1)
    serving.merge_months(spark, parts, str(root), KEYS, F.lit(dt.datetime(2025, 12, 12)), after=0)
    assert values(spark, root) == [("a", 12, 1), ("a", 12, 12), ("b", 12, 12)]
    serving.merge_months(spark, parts, str(root), KEYS, F.lit(dt.datetime(2025, 12, 20)), after=1)
    assert not list(root.glob("yyyymm=*"))
