"""A lookup that is kept between micro-batches: what is read, when, and what comes out."""

import pytest

from skylane.streaming import cached_lookup, queries

DISTRICTS = [("a", "Quận 1"), ("b", "Quận 2"), ("c", "Quận 3")]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


class Table:
    """A lookup table that grows, and counts how often it is read."""

    def __init__(self, spark, rows):
        self.spark, self.rows, self.reads = spark, list(rows), 0

    def __call__(self):
        self.reads += 1
        return self.spark.createDataFrame(self.rows, "cam_id string, district string")


class Clock:
    now = 0.0

    def __call__(self):
        return self.now


def batch(spark, *keys):
    return spark.createDataFrame(list(enumerate(keys)), "id int, cam_id string")


def known(rows):
    return sorted((r.cam_id, r.district) for r in rows.collect())


def test_kept_rows_serve_until_they_are_too_old(spark, tmp_path):
    table, clock = Table(spark, DISTRICTS[:2]), Clock()
    cache = cached_lookup.CachedLookup(table, ["cam_id"], str(tmp_path), 300, clock)
    assert known(cache.rows_for(batch(spark, "a", "b", None))) == DISTRICTS[:2]
    clock.now = 299
    cache.rows_for(batch(spark, "b", "a", "a"))
    assert table.reads == 1
    table.rows = [("a", "Quận 9")]
    clock.now = 300
    assert known(cache.rows_for(batch(spark, "a"))) == [("a", "Quận 9")]
    assert table.reads == 2


def test_a_new_key_falls_through_to_the_table_once(spark, tmp_path):
    table = Table(spark, DISTRICTS[:2])
    cache = cached_lookup.CachedLookup(table, ["cam_id"], str(tmp_path), clock=Clock())
    cache.rows_for(batch(spark, "a"))
    table.rows = [*DISTRICTS, ("d", "Quận 4"), ("a", "changed")]
    assert known(cache.rows_for(batch(spark, "a", "c", "c"))) == DISTRICTS
    assert known(cache.rows_for(batch(spark, "c", "b"))) == DISTRICTS
    assert table.reads == 2


def test_a_key_that_the_table_lacks_is_asked_for_again(spark, tmp_path):
    table = Table(spark, DISTRICTS[:1])
    cache = cached_lookup.CachedLookup(table, ["cam_id"], str(tmp_path), clock=Clock())
    cache.rows_for(batch(spark, "z"))
    assert known(cache.rows_for(batch(spark, "z"))) == DISTRICTS[:1]
    table.rows.append(("z", "Quận 26"))
    assert known(cache.rows_for(batch(spark, "z"))) == [DISTRICTS[0], ("z", "Quận 26")]


@pytest.mark.parametrize("named", [0, 1000])
def test_few_and_many_missing_keys_find_the_same(spark, tmp_path, named, monkeypatch):
    monkeypatch.setattr(cached_lookup, "NAMED_KEYS", named)
    rows = [(k, n, k * 10 + n) for k in range(6) for n in range(2)]
    read = [spark.createDataFrame(rows[:4], "k long, n int, v int"), spark.createDataFrame(rows, "k long, n int, v int")]
    cache = cached_lookup.CachedLookup(lambda: read.pop(0), ["k", "n"], str(tmp_path), clock=Clock())
    asked = spark.createDataFrame([(0, 0), (4, 1), (5, 0), (9, 9)], "k long, n int")
    cache.rows_for(asked)
    assert sorted(map(tuple, cache.rows_for(asked).collect())) == [*rows[:4], (4, 1, 41), (5, 0, 50)]


def test_missing_keys_reach_the_source_as_a_filter(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "dim")
    spark.createDataFrame(DISTRICTS, "cam_id string, district string").write.parquet(table)
    class_ = type(spark.range(1))
    plans, join = [], class_.join

    def watched(self, other, *args):
        joined = join(self, other, *args)
        if args[-1] == "left_semi":
            plans.append(plan_of(joined))
        return joined

    monkeypatch.setattr(class_, "join", watched)
    reads = [spark.read.parquet(table).where("cam_id = 'a'"), spark.read.parquet(table)]
    cache = cached_lookup.CachedLookup(lambda: reads.pop(0), ["cam_id"], str(tmp_path / "kept"), clock=Clock())
    cache.rows_for(batch(spark, "a"))
    cache.rows_for(batch(spark, "b", "c"))
    assert len(plans) == 1 and "PushedFilters: [In(cam_id" in plans[0]


def test_empty_table_and_empty_batch(spark, tmp_path):
    table = Table(spark, [])
    cache = cached_lookup.CachedLookup(table, ["cam_id"], str(tmp_path), clock=Clock())
    assert known(cache.rows_for(batch(spark, "a").limit(0))) == []
    assert known(cache.rows_for(batch(spark, "a").limit(0))) == [] and table.reads == 1


def test_three_batches_read_the_table_once_and_once_for_a_new_key(spark, tmp_path):
    table = Table(spark, DISTRICTS[:2])
    source = str(tmp_path / "in")
    for keys in (["a", "b"], ["b", None], ["a", "c"]):
        batch(spark, *keys).coalesce(1).write.mode("append").parquet(source)

    def read():
        rows = table()
        table.rows = DISTRICTS
        return rows

    stream = queries.file_stream(spark, source, batch(spark, "a").schema, "parquet", 1)
    cached_lookup.lookup_cached(
        stream, read, ["cam_id"], str(tmp_path / "out"), str(tmp_path / "mark"), str(tmp_path / "kept"), clock=Clock()
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch_id").distinct().count() == 3
    rows = sorted((r.cam_id or "", r.district or "") for r in got.drop("batch_id").collect())
    assert rows == [("", ""), ("a", "Quận 1"), ("a", "Quận 1"), ("b", "Quận 2"), ("b", "Quận 2"), ("c", "Quận 3")]
    assert table.reads == 2
