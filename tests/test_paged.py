"""Paged sources over files: short pages, pushed filters, errors, and streams that go on from their marks."""

import json
from pathlib import Path

import pytest
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo

from fieldlens.sources.paged import Endpoint, PagedReader, Pages, PagedStream, use_pages

SCHEMA = "season int, week int, k long, v string"


def put(root: Path, season, week, rows, size=3):
    """The pages of one endpoint, the last one short or missing."""
    folder = root / f"{season}-{week}"
    folder.mkdir(parents=True, exist_ok=True)
    for number in range(-(-len(rows) // size)):
        page = rows[number * size : (number + 1) * size]
        (folder / f"{number}.json").write_text(json.dumps(page if number % 2 else {"data": page}))


def options(root):
    return {"url": f"file://{root}/{{season}}-{{week}}/{{page}}.json", "seasons": "2023,2024", "weeks": "1,2", "pageSize": "3", "wait": "0"}


@pytest.fixture
def pages(tmp_path):
    put(tmp_path, 2023, 1, [{"k": i, "v": {"x": i}} for i in range(7)])  # 3, 3, 1
    put(tmp_path, 2023, 2, [{"k": i, "v": "a"} for i in range(6)])  # 3, 3, missing
    put(tmp_path, 2024, 1, [{"k": i, "season": 1999} for i in range(2)])
    return tmp_path


def test_scan(spark, pages):
    use_pages(spark)
    df = spark.read.format("paged").schema(SCHEMA).options(**options(pages)).load()
    got = sorted(tuple(r)[:3] for r in df.collect())
    assert got == sorted([(2023, 1, i) for i in range(7)] + [(2023, 2, i) for i in range(6)] + [(1999, 1, i) for i in range(2)])
    assert df.rdd.getNumPartitions() == 4 and df.where("season = 2023 and week in (2)").rdd.getNumPartitions() == 1
    assert df.where("season = 2023 and k = 4").orderBy("week").select("week", "v").collect() == [(1, '{"x": 4}'), (2, "a")]
    assert df.where("season = 1990").count() == 0


class Counted(Pages):
    def page(self, at, number):
        self.asked = getattr(self, "asked", []) + [(at.season, at.week, number)]
        return super().page(at, number)


def test_pages_asked(pages):
    schema = T.StructType([T.StructField("k", T.LongType())])
    counted = Counted(schema, options(pages))
    reader = PagedReader(counted)
    list(reader.pushFilters([EqualTo(("season",), 2023)]))
    rows = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(rows) == 13 and counted.asked == [(2023, 1, 0), (2023, 1, 1), (2023, 1, 2), (2023, 2, 0), (2023, 2, 1), (2023, 2, 2)]
    counted.asked = []
    assert [r[0] for r in counted.tuples(Endpoint(2023, 1, 4, 6))] == [4, 5] and counted.asked == [(2023, 1, 1)]


def test_a_broken_page_fails_after_retries(pages):
    (pages / "2024-1" / "0.json").write_text("{broken")
    counted = Counted(T.StructType([T.StructField("k", T.LongType())]), options(pages) | {"retries": "2"})
    with pytest.raises(ValueError):
        list(counted.tuples(Endpoint(2024, 1)))


def test_stream_goes_on_from_its_marks(spark, pages, tmp_path):
    use_pages(spark)
    out = []

    def run():
        stream = spark.readStream.format("paged").schema(SCHEMA).options(**options(pages)).load()
        query = stream.writeStream.foreachBatch(lambda df, _: out.extend((r["season"], r["week"], r["k"]) for r in df.collect())).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(once=True).start()
        assert query.awaitTermination(60)
        got = sorted(out)
        out.clear()
        return got

    assert len(run()) == 15
    put(pages, 2023, 1, [{"k": i} for i in range(11)])  # the short page fills up, and another comes
    put(pages, 2024, 2, [{"k": 5}])
    assert run() == [(2023, 1, i) for i in range(7, 11)] + [(2024, 2, 5)]
    assert run() == []


def test_marks(pages):
    stream = PagedStream(Pages(T.StructType([T.StructField("k", T.LongType())]), options(pages) | {"pagesPerTrigger": "1"}))
    assert stream.latestOffset() == {"2023/1": 3, "2023/2": 3, "2024/1": 2, "2024/2": 0}
    end = stream.latestOffset()
    assert end == {"2023/1": 6, "2023/2": 6, "2024/1": 2, "2024/2": 0}
    assert [(p.name, p.first, p.last) for p in stream.partitions({"2023/1": 3, "2023/2": 6, "2024/1": 0}, end)] == [("2023/1", 3, 6), ("2024/1", 0, 2)]
