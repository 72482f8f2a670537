import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from curvelake.functions import draws
from curvelake.sources import generators, readers, sinks


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()] if cols else [tuple(r) for r in df.collect()]


def test_list_files_filters_by_suffix(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("x\n")
    (tmp_path / "sub" / "b.csv").write_text("x,y\n")
    (tmp_path / "c.txt").write_text("z")
    assert sorted(r["size"] for r in readers.list_files(spark, str(tmp_path), ".csv").collect()) == [2, 4]
    assert readers.list_files(spark, str(tmp_path)).count() == 3


def test_list_files_does_not_read_content(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    assert "content" not in readers.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()


def test_head_text_cuts_at_last_full_line(spark, tmp_path):
    f = tmp_path / "d.csv"
    f.write_text("a,b\n1,2\n3,4\n")
    assert rows(readers.head_text(spark, str(f), 9)) == [(0, "a,b"), (1, "1,2")]
    assert readers.head_text(spark, str(f)).count() == 3


def test_head_text_of_many_lines(spark, tmp_path):
    f = tmp_path / "d.txt"
    f.write_text("".join(f"{i:04d}\n" for i in range(5000)))
    got = rows(readers.head_text(spark, str(f), 5003))
    assert len(got) == 1000 and got[-1] == (999, "0999")


def test_parse_delimited_is_a_plain_split(spark):
    df = spark.createDataFrame([("a|b",), ("1|2",), ('"x|y"',), ("7",), ("8|",)], "line string")
    got = rows(readers.parse_delimited(df, "line", ["a", "b"], "|"))
    assert got == [("1", "2"), ('"x', 'y"'), ("7", None), ("8", "")]


def test_csv_inferred_and_text(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Type,MPG.city\nSmall,31\nVan,NA\n")
    assert readers.read_csv(spark, str(tmp_path)).dtypes == [("Type", "string"), ("MPG.city", "string")]
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "c.csv").write_text("Type,Price\nSmall,31.5\n")
    assert readers.read_csv(spark, str(tmp_path / "n"), infer=True).dtypes[1] == ("Price", "double")
    assert readers.read_csv(spark, str(tmp_path / "n"), schema="Type string, Price float").dtypes[1] == ("Price", "float")


def test_read_glob_takes_matching_files(spark, tmp_path):
    for i in (0, 1):
        spark.range(i * 10, i * 10 + 5).coalesce(1).write.parquet(str(tmp_path / f"part-{i}"))
    assert readers.read_glob(spark, str(tmp_path / "part-0*")).agg(F.max("id")).first()[0] == 4


def test_from_local_registers_and_replaces_view(spark):
    readers.from_local(spark, [(1,)], "a int", "local_view")
    readers.from_local(spark, [(1,), (2,)], "a int", "local_view")
    assert readers.sql(spark, "SELECT count(*) FROM local_view").first()[0] == 2


def test_extract_points(spark):
    html = "<script>var h = L.heatLayer(\n [[41.8, -87.7], [41.7, -87.6]],\n {\"radius\": 30}).addTo(m);</script>"
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "page int, html string")
    assert rows(readers.extract_points(df, "html", ["page"])) == [(1, 0, 41.8, -87.7), (1, 1, 41.7, -87.6)]


def test_linspace_has_both_ends(spark):
    xs = [r["x"] for r in generators.linspace(spark, -5, 5, 11).orderBy("grid_id").collect()]
    assert xs == pytest.approx([-5 + i for i in range(11)])


def test_polynomial_data(spark):
    got = {r["x"]: r["y"] for r in generators.polynomial_data(spark).collect()}
    assert all(y == 5 + 10 * x - 3 * x**2 + 6 * x**3 for x, y in got.items()) and len(got) == 11


def test_generators_moments(spark):
    sine = generators.sine_data(spark, 20000, 1.0, 5)
    noise = sine.agg(F.avg(F.col("y") - 3 * F.sin("x")), F.stddev(F.col("y") - 3 * F.sin("x")), F.max("x")).first()
    assert abs(noise[0]) < 0.03 and abs(noise[1] - 1) < 0.03 and noise[2] == pytest.approx(2 * math.pi)
    box = generators.uniform_box(spark, 20000, 2, 3)
    lo, hi, corr = box.agg(F.min("x1"), F.max("x2"), F.corr("x1", "x2")).first()
    assert -1 < lo < -0.99 and 0.99 < hi < 1 and abs(corr) < 0.03
    normal = generators.normal_box(spark, 20000, 2, 3)
    assert normal.agg(F.stddev("x1")).first()[0] == pytest.approx(1, abs=0.03)
    moons = generators.two_moons(spark, 5000, 0.0, 1)
    on_upper = moons.where("moon = 0").agg(F.max(F.abs(F.col("x1") ** 2 + F.col("x2") ** 2 - 1))).first()[0]
    on_lower = moons.where("moon = 1").agg(F.max(F.abs((1 - F.col("x1")) ** 2 + (0.5 - F.col("x2")) ** 2 - 1))).first()[0]
    assert on_upper < 1e-9 and on_lower < 1e-9
    banana = generators.banana_data(spark, 20000, 1).withColumn("r", F.col("x1") * 40 - (F.col("x2") * 40) ** 2 / 4)
    sd2, mean, sd = banana.agg(F.stddev(F.col("x2") * 40), F.avg("r"), F.stddev("r")).first()
    assert sd2 == pytest.approx(4, abs=0.1) and abs(mean) < 0.03 and sd == pytest.approx(1, abs=0.03)


def test_draws_are_uniform_and_equal_in_arrays(spark):
    keys = [0, 1, -1, 7, 2**31 - 1, 2**31, 2**62, -(2**62), *range(100, 5100)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    got = [r["u"] for r in df.select(draws.uniform("k", F.lit(3), seed=5).alias("u")).collect()]
    assert got == draws.uniform_array(np.array(keys), 3, seed=5).tolist()
    assert 0 < min(got) and max(got) < 1 and len(set(got)) == len(got)
    u = draws.uniform_array(np.arange(200_000)[:, None], np.arange(4)[None, :])
    for column in u.T:
        assert np.abs(np.histogram(column, 100, (0, 1))[0] - 2000).max() < 250  # over five deviations
    assert np.abs(np.corrcoef(u.T) - np.eye(4)).max() < 0.01
    assert abs(np.corrcoef(u[:-1, 0], u[1:, 0])[0, 1]) < 0.01
    low = np.floor(u[:, 0] * 2**40) % 2**8  # bits 33 to 40
    assert np.abs(np.bincount(low.astype(int), minlength=256) - 200_000 / 256).max() < 170


def test_keys_of_draws_of_any_type(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 2)], "s string, n int")
    for key in ("s", "n"):
        drawn = generators.uniform_box_over(df, key, 1).collect()
        assert len({r["x1"] for r in drawn}) == 3 and all(-1 < r["x1"] < 1 for r in drawn)


def test_draws_do_not_depend_on_partitioning(spark):
    ids = spark.range(1000)
    a = generators.normal_box_over(ids.repartition(7), "id").orderBy("id").collect()
    b = generators.normal_box_over(ids.coalesce(1), "id").orderBy("id").collect()
    assert a == b


# --- writers and catalog --------------------------------------------------------------

@pytest.fixture
def people(spark):
    return spark.createDataFrame([(1, "F", 10.0), (2, "M", 20.0), (3, "F", 30.0), (4, None, 1.0)], "id int, gender string, salary double")


def test_partitioned_external_table(spark, people, tmp_path):
    path = str(tmp_path / "p")
    sinks.write_partitioned(people, path, ["gender"])
    sinks.drop_table(spark, "ext_people")
    sinks.register_external(spark, "ext_people", path, partitioned=True)
    assert spark.table("ext_people").count() == 4
    detail = sinks.table_detail(spark, "ext_people").first()
    assert detail["partition_columns"] == ["gender"] and detail["files"] >= 3 and detail["bytes"] > 0
    assert detail["format"] == "parquet"
    sinks.drop_table(spark, "ext_people")
    assert spark.read.parquet(path).count() == 4  # the files stay


def test_managed_table_goes_with_its_files(spark, people):
    sinks.save_managed(people, "managed_people")
    location = sinks.table_detail(spark, "managed_people").first()["location"]
    assert spark.table("managed_people").count() == 4
    assert "managed_people" in [r["name"] for r in sinks.list_tables(spark).collect()]
    sinks.drop_table(spark, "managed_people")
    assert "managed_people" not in [r["name"] for r in sinks.list_tables(spark).collect()]
    from pathlib import Path

    assert not Path(location.removeprefix("file:")).exists()
    sinks.drop_table(spark, "managed_people")  # absent: no error


def test_view_must_be_registered_again(spark, people):
    sinks.register_view(people, "people_view")
    derived = people.withColumn("twice", F.col("salary") * 2)
    assert "twice" not in spark.table("people_view").columns
    sinks.register_view(derived, "people_view")
    assert "twice" in spark.table("people_view").columns


def test_compact_plain_and_partitioned(spark, tmp_path):
    df = spark.range(2000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 5)))
    path = str(tmp_path / "small")
    df.repartition(20).write.parquet(path)
    assert sinks.compact(spark, path, str(tmp_path / "one")) == 1
    assert readers.list_files(spark, str(tmp_path / "one"), ".parquet").count() == 1
    tasks = sinks.compact(spark, path, str(tmp_path / "by"), 10_000, ["g"])
    back = spark.read.parquet(str(tmp_path / "by"))
    assert tasks > 1 and back.count() == 2000 and back.agg(F.sum("id")).first()[0] == 1999000
    with pytest.raises(Exception):
        sinks.compact(spark, path, str(tmp_path / "one"))  # never overwrites


def test_compact_moves_the_table(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "old"))
    sinks.register_external(spark, "moving", str(tmp_path / "old"))
    sinks.compact(spark, str(tmp_path / "old"), str(tmp_path / "new"), table="moving")
    assert sinks.table_detail(spark, "moving").first()["location"].endswith("new")
    assert spark.table("moving").count() == 10
    sinks.drop_table(spark, "moving")


def test_compact_moves_every_partition(spark, tmp_path):
    data = spark.range(300).select("id", F.concat(F.lit("it's "), F.col("id") % 3).alias("g"))
    data.repartition(6).write.partitionBy("g").parquet(str(tmp_path / "old"))
    sinks.register_external(spark, "moving_parts", str(tmp_path / "old"))
    sinks.compact(spark, str(tmp_path / "old"), str(tmp_path / "new"), by=["g"], table="moving_parts")
    files = {r[0] for r in spark.table("moving_parts").select(F.input_file_name()).distinct().collect()}
    assert files and all("/new/" in f for f in files)
    assert spark.table("moving_parts").count() == 300
    sinks.drop_table(spark, "moving_parts")


def test_journal_is_newest_first(spark, people, tmp_path):
    path, journal = str(tmp_path / "t"), str(tmp_path / "j")
    sinks.write_journal(people, path, journal)
    sinks.write_journal(people, path, journal, "append")
    assert [(r["mode"], r["rows"]) for r in sinks.history(spark, journal).collect()] == [("append", 8), ("overwrite", 4)]


def test_to_local_refuses_large_tables(spark):
    assert len(sinks.to_local(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        sinks.to_local(spark.range(6), 5)


def test_profile(spark, people):
    assert rows(sinks.profile(people)) == [(0, "id", "int", 4), (1, "gender", "string", 4), (2, "salary", "double", 4)]
