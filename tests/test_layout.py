"""The clustered layout: what a window pushes down, and what it reads."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sparkraster.sources import layout as L


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """Three scenes of 512 x 512 pixels, shuffled, in cells of 32 and small row groups."""
    path = str(tmp_path_factory.mktemp("layout") / "px")
    px = spark.range(3 * 512 * 512).selectExpr("id % 3 AS scene_id", "(id div 3) div 512 AS y", "(id div 3) % 512 AS x", "id * 0.5 AS v").orderBy("v").repartition(4)
    L.write_clustered(px, path, cell=32, group=64 << 10, parts=6)
    return path, px


def rows_of(df):
    return sorted(map(tuple, df.select("scene_id", "y", "x", "v").collect()))


@pytest.mark.parametrize("window", [(0, 1, 0, 1), (100, 164, 300, 340), (500, 600, 0, 20), (31, 33, 31, 33)])
def test_windows_equal_a_filter(spark, clustered, window):
    path, px = clustered
    y0, y1, x0, x1 = window
    want = px.where(f"scene_id = 1 AND y >= {y0} AND y < {y1} AND x >= {x0} AND x < {x1}")
    got = L.scan_clustered(spark, path, 1, window, cell=32)
    assert got.columns == ["scene_id", "y", "x", "v"] and rows_of(got) == rows_of(want)


def test_whole_tables_and_scenes(spark, clustered):
    path, px = clustered
    assert L.scan_clustered(spark, path).count() == 3 * 512 * 512
    assert L.scan_clustered(spark, path, 2).count() == 512 * 512
    assert L.scan_clustered(spark, path, None, (0, 2, 0, 3), cell=32).count() == 18
    assert L.scan_clustered(spark, path, 9).count() == 0


def test_ranges_reach_the_reader_and_few_row_groups_are_read(spark, clustered):
    path, _ = clustered
    df = L.scan_clustered(spark, path, 1, (96, 160, 320, 352), cell=32)
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    for part in ("EqualTo(scene_id,1)", "GreaterThanOrEqual(cell_y,3)", "LessThanOrEqual(cell_y,4)", "GreaterThanOrEqual(cell_x,10)", "LessThanOrEqual(cell_x,10)", "LessThan(x,352)"):
        assert part in pushed, pushed
    groups = hit = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stat = {n: meta.row_group(g).column(i).statistics for i, n in enumerate(names)}
            within = lambda n, lo, hi: stat[n].min <= hi and stat[n].max >= lo  # noqa: B023, E731
            groups += 1
            hit += within("scene_id", 1, 1) and within("cell_y", 3, 4) and within("cell_x", 10, 10)
    assert groups >= 60 and hit <= groups / 10


def test_morton_codes(spark):
    got = {(r.a, r.b): r.m for r in spark.range(64).selectExpr("id div 8 AS a", "id % 8 AS b").select("a", "b", L.morton(F.col("a"), F.col("b")).alias("m")).collect()}
    assert sorted(got.values()) == list(range(64))
    assert [got[k] for k in ((0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (7, 7))] == [0, 1, 2, 3, 8, 63]
