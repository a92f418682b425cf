"""Dedupe, keys, incremental storage, profile, metadata and indicators."""

import datetime
import random
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from concordat.functions.casts import namespace_uuid
from concordat.names import Names, generic_fields
from concordat.operators import dedupe as D
from concordat.operators import incremental as I
from concordat.operators import keys, kpi, meta, profile
from concordat.plans import models
from concordat.sources.tables import GroupedTable, write_table

DAY = lambda n: datetime.datetime(2022, 1, n)


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_dedupe_places_nulls_as_the_database_does(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", 5, 2), ("k", 7, 3), (None, 1, 4), (None, 2, 5)], "id string, a int, n int")
    assert sorted_rows(D.dedupe(df, "id", "a").select("n")) == [(2,), (4,)]
    assert sorted_rows(D.dedupe(df, "id", "a desc").select("n")) == [(1,), (5,)]
    assert sorted_rows(D.dedupe(df, "id", "a desc nulls last").select("n")) == [(3,), (5,)]
    assert sorted_rows(D.dedupe(df, ["id"], "a", where="id is not null").select("n")) == [(2,)]
    for order in ("a", "a desc"):
        assert sorted_rows(D.dedupe_agg(df, "id", order)) == sorted_rows(D.dedupe(df, "id", order))
    with pytest.raises(ValueError):
        D.dedupe_agg(df, "id", "a, n desc")


def test_dedupe_without_order_is_deterministic(spark):
    rows = [(i % 7, random.Random(i).choice("abc"), i) for i in range(200)]
    one = D.dedupe(spark.createDataFrame(rows, "k int, c string, n int").repartition(5), "k")
    two = D.dedupe(spark.createDataFrame(rows[::-1], "k int, c string, n int").repartition(3), "k")
    assert sorted_rows(one) == sorted_rows(two)


def test_dedupe_limits_hot_keys_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = D.dedupe(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_generic_fields(spark):
    names = Names("ABC_")
    df = spark.createDataFrame([("osm", "o1", "t", "7")], "ABC_SOURCE_NOM string, data_owner_id string, import_table string, p_src_id string")
    row = keys.add_generic_fields(df, "p_", "ns", "0", names).first()
    assert (row.p_src_kind, row.p_src_name, row.p_src_table) == ("osm", "osm_o1", "t")
    assert (row.p_src_priority, row.p_id) == ("0_osm_o1", "osm_o1_7")
    assert row.p_uuid == str(uuid.uuid5(namespace_uuid("ns"), "osm_o1_7"))
    assert set(generic_fields("p_")) <= set(row.asDict())
    assert keys.add_generic_fields(df, "p_", "ns", names=names).first().p_src_priority == "osm_o1"
    same = models.perimeters_translated(df.drop("p_src_id"), "apcom", "ns", names=names).first()
    assert same.apcompercomp_id == "osm_o1_1"


def test_replace_by_key(spark):
    target = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, n int")
    batch = spark.createDataFrame([("a", 9), (None, 8)], "k string, n int")
    done = I.replace_by_key(target, batch, "k")
    assert sorted_rows(done) == sorted([("a", 9), ("b", 3), (None, 4), (None, 8)], key=str)


@pytest.mark.parametrize("partitioned", [False, True])
def test_incremental_run(spark, tmp_path, partitioned):
    path = str(tmp_path / "t")
    schema = "use_case string, owner string, name string, last_changed timestamp_ntz"
    first = [("u", "01", "p1", DAY(1)), ("u", "01", "p2", DAY(2)), ("u", "2A", "q", DAY(2)), ("u", None, "n", DAY(1))]
    second = [("u", "01", "new", DAY(3)), ("u", "2A", "equal stamp", DAY(2)), ("u", None, "n2", DAY(3))]
    options = {"partitioned": partitioned}
    I.run_incremental(spark.createDataFrame(first, schema), path, ["use_case", "owner"], **options)
    done = I.run_incremental(spark.createDataFrame(first + second, schema), path, ["use_case", "owner"], **options)
    assert done.columns == ["use_case", "owner", "name", "last_changed"]
    assert sorted(r.name for r in done.collect()) == ["n", "n2", "new", "q"]
    assert sorted({str(r.owner) for r in done.collect()}) == ["01", "2A", "None"]
    # Nothing newer: a replay changes nothing.
    again = I.run_incremental(spark.createDataFrame(first + second, schema), path, ["use_case", "owner"], **options)
    assert sorted(r.name for r in again.collect()) == ["n", "n2", "new", "q"]
    full = I.run_incremental(spark.createDataFrame(second, schema), path, ["use_case", "owner"], mode="full", **options)
    assert sorted(r.name for r in full.collect()) == ["equal stamp", "n2", "new"]
    with pytest.raises(ValueError):
        I.run_incremental(full, path, "owner", mode="half")


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_run_that_failed_is_repeated(spark, tmp_path, monkeypatch, partitioned):
    path, schema = str(tmp_path / "t"), "owner string, name string, last_changed timestamp_ntz"
    first = [("a", "a1", DAY(1)), (None, "n1", DAY(1))]
    second = first + [("a", "a2", DAY(2)), (None, "n2", DAY(2)), (None, "n2", DAY(2)), ("b", "b1", DAY(2))]
    I.run_incremental(spark.createDataFrame(first, schema), path, "owner", partitioned=partitioned)

    def die(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(GroupedTable, "_note", die)
        I.run_incremental(spark.createDataFrame(second, schema), path, "owner", partitioned=partitioned)
    done = I.run_incremental(spark.createDataFrame(second, schema), path, "owner", partitioned=partitioned)
    assert sorted(r.name for r in done.collect()) == ["a2", "b1", "n1", "n2", "n2"]


def _files(path):
    found = {}
    for file in path.rglob("*.parquet"):
        found.setdefault(file.parent.name, set()).add(file.name)
    return found


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    schema = "k long, n long, last_changed timestamp_ntz"
    rows = [(k, n, DAY(1)) for k in range(300) for n in range(2)]
    path = str(tmp_path / "t")
    I.run_incremental(spark.createDataFrame(rows, schema), path, "k", buckets=32)
    before = _files(tmp_path / "t" / "data")
    newer = [(7, 100, DAY(2)), (7, 101, DAY(2)), (1000, 1, DAY(2))]
    # The number of buckets is the table's; another one is not looked at.
    done = I.run_incremental(spark.createDataFrame(rows + newer, schema), path, "k", buckets=5)
    after = _files(tmp_path / "t" / "data")
    assert len(before) > 25 and before.keys() <= after.keys()
    assert sum(before[b] != after[b] for b in before) <= 2 and len(after.keys() - before.keys()) <= 1
    assert sorted_rows(done) == sorted([r for r in rows if r[0] != 7] + newer, key=str)


def test_a_group_that_is_gone_leaves_an_empty_bucket(spark, tmp_path):
    table = GroupedTable(spark, str(tmp_path / "t"), ["k"], buckets=64)
    assert table.read() is None and table.mark() is None and table.group("a") is None
    table.store(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"))
    gone = spark.createDataFrame([("a",), ("c",)], "k string")
    table.replace(spark.createDataFrame([("c", 3)], "k string, n int"), replaced=gone)
    assert sorted_rows(table.read()) == [("b", 2), ("c", 3)]
    assert sorted_rows(table.group("c")) == [("c", 3)]
    plan = table.group("c")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__bucket_of_64" in plan


def test_tables_without_rows(spark, tmp_path):
    none = spark.createDataFrame([], "k string, n int, last_changed timestamp_ntz")
    for partitioned in (False, True):
        path = str(tmp_path / str(partitioned))
        assert I.run_incremental(none, path, "k", partitioned=partitioned).columns == ["k", "n", "last_changed"]
        assert I.run_incremental(none, path, "k", partitioned=partitioned).count() == 0
        one = spark.createDataFrame([("a", 1, DAY(1))], none.schema)
        assert sorted_rows(I.run_incremental(one, path, "k", partitioned=partitioned)) == [("a", 1, DAY(1))]


def test_links_follow_objects_that_move(spark, tmp_path):
    from concordat.functions import geometry as G
    square = "POLYGON((0 0,2 0,2 2,0 2,0 0))"
    areas = spark.createDataFrame([("A", square), ("B", square.replace("0", "5").replace("2", "7"))], "com_code string, wkt string").select(
        "com_code", G.from_wkt(F.col("wkt"), 4326).alias("geometry"))

    def points(*rows):
        df = spark.createDataFrame(rows, "id long, x double, last_changed timestamp_ntz")
        return df.select("id", "last_changed", G.point(F.col("x"), F.lit(1.0) + F.when(F.col("x") > 4, 5).otherwise(0), 4326).alias("geometry"))

    options = {"carry": ()}
    first = [(1, 1.0, DAY(1)), (2, 1.0, DAY(1)), (3, 1.0, DAY(1))]
    models.commune_links(points(*first), areas, str(tmp_path / "l"), "id", **options)
    second = [(1, 1.0, DAY(1)), (2, 6.0, DAY(2)), (3, 3.0, DAY(2))]
    done = models.commune_links(points(*second), areas, str(tmp_path / "l"), "id", **options)
    assert sorted_rows(models.links_only(done).select("id", "com_code")) == [("1", "A"), ("2", "B")]
    assert done.count() == 3


def test_population_is_stored_by_code(spark, tmp_path):
    schema = "Code string, `Population municipale 2019` string, last_changed timestamp_ntz"
    first = models.population_typed(spark.createDataFrame([("1", "50", DAY(1)), ("2A", "7", DAY(1))], schema))
    models.population_standard(first, str(tmp_path / "p"))
    newer = models.population_typed(spark.createDataFrame([("2A", "8", DAY(2))], schema))
    done = models.population_standard(newer, str(tmp_path / "p"))
    assert sorted((r.Code, int(r["Population municipale 2019"])) for r in done.collect()) == [("1", 50), ("2A", 8)]


def test_inclusive_watermark(spark):
    df = spark.createDataFrame([(1, DAY(1)), (2, DAY(2))], "n int, last_changed timestamp_ntz")
    target = df.filter("n = 1")
    assert [r.n for r in I.changed_since(df, target).collect()] == [2]
    assert sorted(r.n for r in I.changed_since(df, target, inclusive=True).collect()) == [1, 2]
    assert I.changed_since(df, None).count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 5)), max_size=12),
       st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5)), max_size=6))
def test_replacing_twice_is_replacing_once(spark, old, new):
    target = spark.createDataFrame(old, "k string, n int")
    batch = spark.createDataFrame(new, "k string, n int")
    once = I.replace_by_key(target, batch, "k")
    assert sorted_rows(I.replace_by_key(once, batch, "k")) == sorted_rows(once)
    keys_ = {k for k, _ in new}
    assert sorted_rows(once) == sorted([r for r in old if r[0] not in keys_] + new, key=str)


def test_profile_from_sketches(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 10).alias("n"), F.concat(F.lit("x"), F.col("id")).alias("key"),
        F.lit(None).cast("string").alias("none"), F.array(F.col("id") % 2).alias("list"), F.lit(1).alias("a-b"))
    exact = {r.column_name: r.asDict() for r in profile.profile(spark, {"t": df}).collect()}
    approx = {r.column_name: r.asDict() for r in profile.profile(spark, {"t": df, "empty": df.limit(0)}, approx=True).collect()}
    assert set(approx) == set(exact) == {"n", "key", "none", "list"}
    for name, row in exact.items():
        unsure = {"count_distinct_values", "pct_unique"} | ({"_most_frequent_value"} if name == "key" else set())
        assert {k: v for k, v in row.items() if k not in unsure} == {k: approx[name][k] for k in row if k not in unsure}
        assert abs(approx[name]["count_distinct_values"] - row["count_distinct_values"]) <= 4 * profile.DISTINCT_ERROR * row["count_distinct_values"]
    # Every value of the key is met once, so any of them may be named; its count is too high by the bound at most.
    assert approx["key"]["_quartiles"] is None
    assert (approx["key"]["_most_frequent_count"] or 0) <= 1 + profile.FREQUENT_ERROR * 3000
    assert all(abs(a - b) <= 1 for a, b in zip(approx["n"]["_quartiles"], [2, 4.5, 7]))
    parts = [profile.profile_sketches(spark, {"t": df.filter(p)}) for p in ("n < 4", "n >= 4", "n IS NULL", "false")]
    merged = {r.column_name: r.asDict() for r in profile.profile_from_sketches(profile.merge_sketches(parts)).collect()}
    for name, row in merged.items():
        same = [k for k in row if k not in ("_quartiles", "count_distinct_values", "pct_unique") and "frequent" not in k]
        assert [row[k] for k in same] == [approx[name][k] for k in same]
        assert row["count_distinct_values"] == pytest.approx(exact[name]["count_distinct_values"], rel=4 * profile.DISTINCT_ERROR)
    assert merged["n"]["_most_frequent_value"] == exact["n"]["_most_frequent_value"]
    # One row of sketches per task and table is shuffled, and no cell is.
    plan = profile.profile_sketches(spark, {"t": df})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.index("Generate") < plan.index("partial_hll_sketch_agg(v0") and "SortAggregate" not in plan


def test_profile(spark):
    df = spark.createDataFrame([("a", "1", None), ("b", "2", None), ("b", "x", None), ("a", None, None)], "t string, n string, v string")
    odd = df.select("t", F.col("n").alias("with-dash"))
    rows = {(r.table_name, r.column_name): r for r in profile.profile(spark, {"one": df, "two": odd}).collect()}
    assert set(rows) == {("one", "t"), ("one", "n"), ("one", "v"), ("two", "t")}
    t, n, v = (rows["one", c] for c in "tnv")
    assert (t.table_rows, t.count_distinct_values, t._most_frequent_value, t.pct_unique) == (4, 2, "b", 0.5)
    assert (n.count_nulls, n.count_not_nulls, n.pct_not_null, n._avg_value, n._min_length) == (1, 3, 0.75, 1.5, 1)
    assert (v.count_distinct_values, v._most_frequent_value, v._avg_value, v.pct_not_null) == (0, None, None, 0.0)
    assert t.is_recommended_not_nullable_column and not n.is_recommended_not_nullable_column
    assert (n.ordinal_position, n.data_type, n.is_not_nullable_column) == (2, "string", False)


def test_node_indicators(spark):
    nodes = spark.createDataFrame(
        [("appuiscommuns_supportaerien_definition", [], "{}"), ("appuiscommuns_equipement", ["sample", "kpi"], "{}"),
         ("definition", None, "{}"), ("autre_indicators_x", [], "{}"), ("autre_enriched", [], "{}")],
        "name string, tags array<string>, node_json string")
    rows = {r["name"]: r for r in meta.node_indicators(nodes, "appuiscommuns").collect()}
    first = rows["appuiscommuns_supportaerien_definition"]
    assert (first.type, first.definition, first["sample"]) == ("supportaerien", 1, 0)
    assert (rows["appuiscommuns_equipement"].type, rows["appuiscommuns_equipement"]["sample"]) == ("equipement", 1)
    assert (rows["definition"].definition, rows["autre_indicators_x"].indicators, rows["autre_indicators_x"].type) == (0, 1, None)
    assert rows["autre_enriched"].type is None and rows["autre_enriched"].enriched == 1
    by_type = {r.type: r for r in meta.node_indicators_by_type(meta.node_indicators(nodes, "appuiscommuns")).collect()}
    assert by_type[None].indicators == 1 and by_type["supportaerien"].definition == 1


def test_light_points(spark):
    points = spark.createDataFrame(
        [("r1", 10.0, "g", "c", "1"), (None, 5.0, "g", "c", "1"), ("r3", None, "g", "c", "2"), ("r4", 1.0, "g", "c", "9")],
        "reference string, puissance double, gestionnaire_title string, est_dans_commune_com_nom string, insee string")
    population = spark.createDataFrame([("1", 100), ("2", 100)], "Code string, `Population municipale 2019` int")
    assert sorted_rows(kpi.light_points_by_commune(points, population)) == [("g", "c", 100, 2, 15.0)]


def test_write_table(spark, tmp_path):
    df = spark.range(3)
    write_table(df, "n", path=str(tmp_path))
    write_table(df, "n", "append", path=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/n").count() == 6
    write_table(df, "n", "replace", path=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/n").count() == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(df, "n", "fail", path=str(tmp_path))


def test_communes_and_regions(spark, tmp_path):
    from concordat.functions import geometry as G
    communes = spark.createDataFrame([("1", [46.5, 3.0], DAY(1)), ("2A", None, DAY(1))],
                                     "com_code string, geo_point_2d array<double>, last_changed timestamp_ntz")
    communes = communes.withColumn("geometry", G.point(F.lit(3.0), F.lit(46.5), 4326))
    population = models.population_typed(spark.createDataFrame([("1", "50")], "Code string, `Population municipale 2019` string"))
    demography = models.demography_typed(spark.createDataFrame([("2A", "7", "t")], "CODGEO string, Population string, import_table string"))
    enriched = models.communes_enriched(communes, population, demography)
    done = models.communes_standard(enriched, str(tmp_path / "c"))
    rows = {r.com_code: r for r in done.collect()}
    assert rows["1"]["Population municipale 2019"] == 50 and rows["1"].Population is None
    assert rows["2A"].Population == 7 and rows["2A"].geometry_center is None
    centre = rows["1"].geometry_center_2154.parts[0][0][0]
    assert rows["1"].geometry_center_2154.srid == 2154 and abs(centre.x - 700000) < 1e-3
    assert "geo_point_2d" not in done.columns and "import_table" not in done.columns
    regions = communes.withColumnRenamed("com_code", "reg_code")
    assert models.regions_standard(regions, str(tmp_path / "r")).count() == 2


def test_perimeter_example_is_the_definition(spark):
    from concordat.operators.conform import definition
    example = models.perimeter_example(spark)
    assert [r.geom.srid for r in example.collect()] == [2154, 2154]
    assert definition(example).schema == models.PERIMETER


def test_perimeters(spark, tmp_path):
    from concordat.sources.raw import FrameTables
    names = Names("ABC_")
    row = lambda owner, use_case, at: (
        use_case, "perimetre", "perimetre", "prod", "success", "s", f"{use_case}_raw_perimetre_{owner}", owner, f"Org {owner}",
        use_case, at, at, "2100-01-01T00:00:00", at)
    columns = [*names.fields, "status", "schema", "table", "data_owner_id", "org_name", "use_case_prefix", "last_changed",
               "added", "removed", "imported"]
    known = spark.createDataFrame([row("a", "apcom", "2022-01-01T00:00:00"), row("b", "eau", "2022-01-02T00:00:00")],
                                  ", ".join(f"`{c}` string" for c in columns))
    shape = "POLYGON((3.8 48.5,3.8 48.6,3.9 48.6,3.8 48.5))"
    raw = spark.createDataFrame([(shape, "x"), (shape, "y")], "geom string, nom string")
    tables = FrameTables({"s.apcom_raw_perimetre_a": raw, "s.eau_raw_perimetre_b": raw.limit(1)})
    every = models.perimeters_parsed(spark, known, tables, names=names)
    assert every.columns == ["import_table", "geom", *names.provenance[1:]]
    assert sorted(r.data_owner_id for r in every.collect()) == ["a", "a", "b"]
    one = models.perimeters_parsed(spark, known, tables, "eau", names)
    assert [r.geom.srid for r in one.collect()] == [2154]
    stored = models.perimeters_standard(every, str(tmp_path / "p"), names=names)
    assert stored.count() == 3
