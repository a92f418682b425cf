import pytest
from pyspark.sql import types as T

from concordat.names import Names
from concordat.operators import union as U
from concordat.sources.raw import FrameTables, ParquetTables

N = Names("ABC_")
COLUMNS = [*N.fields, "status", "schema", "table", "data_owner_id", "org_name", "use_case_prefix",
           "last_changed", "added", "removed", "imported"]
TARGET = T.StructType([T.StructField("x_nom", T.StringType()), T.StructField("x_valeur", T.IntegerType())])


def row(source, owner, table, status="success", target="prod", use_case="eau", role="source"):
    return (use_case, role, source, target, status, "s", table, owner, f"Org {owner}", use_case[:3],
            "2022-05-01T10:00:00", "2022-01-01T00:00:00.123456", "2100-01-01T00:00:00", None)


@pytest.fixture(scope="module")
def registry(spark):
    rows = [
        row("can", "a", "eau_raw_can_a"), row("can", "b", "eau_raw_can_b"), row("can", "c", "eau_raw_can_c", status="error"),
        row("can", "d", "eau_raw_can_d", target="archive"), row("rep", "a", "eau_raw_rep_a"),
        row("eau_dict", "b", "eau_raw_dict_b"), row("can", "e", "gaz_raw_can_e", use_case="gaz"),
    ]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


@pytest.fixture(scope="module")
def frames(spark):
    words = [("nom", "libelle", None, "can"), ("nom", "L1", "C1", "can")]
    return {
        "s.eau_raw_can_a": spark.createDataFrame([("n1", "1"), ("n2", "x")], "nom string, valeur string"),
        "s.eau_raw_can_b": spark.createDataFrame([("3", "L1"), ("4", "L2")], "VALEUR string, libelle string"),
        "s.eau_raw_rep_a": spark.createDataFrame([("r", 1.5)], "nom string, ABC_TARGET double"),
        "s.eau_raw_dict_b": spark.createDataFrame(words, "Champs string, Valeur string, Code string, ABC_SOURCE_NOM string"),
        "s.gaz_raw_can_e": spark.createDataFrame([("g", "9")], "nom string, valeur string"),
    }


def test_union_with_dictionary_and_provenance(spark, registry, frames):
    done = U.union_by_name(spark, registry, FrameTables(frames), "can", "eau", TARGET, names=N)
    assert done.columns == ["import_table", "x_nom", "x_valeur", *N.provenance[1:]]
    got = sorted(((r.import_table, r.x_nom, r.x_valeur, r.data_owner_label) for r in done.collect()), key=str)
    # Owner b writes its names as VALEUR and libelle, and its labels have codes.
    assert got == [
        ("s.eau_raw_can_a", "n1", 1, "Org a"), ("s.eau_raw_can_a", "n2", None, "Org a"),
        ("s.eau_raw_can_b", "C1", None, "Org b"), ("s.eau_raw_can_b", None, None, "Org b"),
    ]
    first = done.filter("import_table = 's.eau_raw_can_a'").first()
    assert str(first.last_changed) == "2022-05-01 10:00:00" and str(first.added) == "2022-01-01 00:00:00.123456"
    assert first.imported is None and first["ABC_CAS_USAGE"] == "eau"


def test_or_criteria_stay_within_the_guards(spark, registry, frames):
    criteria = "ABC_SOURCE_NOM = 'can' or ABC_SOURCE_NOM = 'rep'"
    tables = sorted(r["table"] for r in U.matching_tables(registry, criteria, names=N).collect())
    assert tables == ["eau_raw_can_a", "eau_raw_can_b", "eau_raw_rep_a", "gaz_raw_can_e"]
    done = U.union_sources(spark, registry, FrameTables(frames), criteria, TARGET, names=N)
    # All use cases take part, not only the first group.
    assert sorted({r[0] for r in done.select("ABC_CAS_USAGE").collect()}) == ["eau", "gaz"]


def test_nothing_matches(spark, registry, frames):
    empty = U.union_by_name(spark, registry, FrameTables(frames), "nope", "eau", TARGET, names=N)
    full = U.union_by_name(spark, registry, FrameTables(frames), "can", "eau", TARGET, names=N)
    assert empty.count() == 0
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in full.schema]
    with pytest.raises(ValueError):
        U.union_by_name(spark, registry, FrameTables(frames), "nope", "eau", names=N)
    # A table the registry knows but nobody stored gives the same as no table.
    assert U.union_by_name(spark, registry, FrameTables({}), "rep", "eau", TARGET, names=N).count() == 0


def test_groups_and_mixed_types_without_target(spark, registry, frames):
    groups = U.union_groups(spark, registry, FrameTables(frames), names=N)
    assert set(groups) == {"eau_src_can", "eau_src_rep", "eau_src_eau_dict", "gaz_src_can"}
    rep = groups["eau_src_rep"]
    # A raw column named like a provenance column is set aside.
    assert rep.first()["ABC_TARGET"] == "prod" and rep.first()["ABC_TARGET__src"] == 1.5
    # Columns that differ only by case are one column, as Spark resolves names.
    assert set(groups["eau_src_can"].columns) == {"libelle", "nom", "valeur", *N.provenance}
    assert groups["eau_src_can"].count() == 4


def test_mixed_types_become_text(spark):
    one = spark.createDataFrame([(1, "a")], "k int, v string")
    two = spark.createDataFrame([("x", [1])], "K string, v array<int>")
    done = U.fold_union(U._same_types([one, two]))
    assert sorted(map(tuple, done.collect())) == [("1", "a"), ("x", "[1]")]


def test_stored_tables_of_one_shape_are_one_scan(spark, registry, frames, tmp_path):
    for name, frame in frames.items():
        frame.write.parquet(f"{tmp_path}/{name.replace('.', '/')}")
    store = ParquetTables(spark, str(tmp_path))
    opened = store.open(["s.eau_raw_can_a", "s.gaz_raw_can_e", "s.eau_raw_can_b"])
    assert len(opened) == 2
    by_frames = U.union_sources(spark, registry, FrameTables(frames), "ABC_SOURCE_NOM = 'can'", TARGET, names=N)
    by_files = U.union_sources(spark, registry, store, "ABC_SOURCE_NOM = 'can'", TARGET, names=N)
    as_rows = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert as_rows(by_files) == as_rows(by_frames)


def test_forced_names(registry):
    rows = U.matching_tables(registry, "ABC_ROLE = 'source'", "perimetre", "tous", N).collect()
    assert {(r.group_source, r.group_prefix) for r in rows} == {("perimetre", "tous")}


def test_many_inputs_fold_into_a_shallow_plan(spark):
    frames = [spark.range(1).withColumnRenamed("id", f"c{i % 3}") for i in range(40)]
    done = U.fold_union(frames)
    assert sorted(done.columns) == ["c0", "c1", "c2"] and done.count() == 40


def _many_owners(spark, root, count):
    """A store in which every owner calls the columns its own way and has its own dictionary."""
    store, rows, headers = ParquetTables(spark, str(root)), [], {}

    def write(key, data, columns):
        frame = spark.createDataFrame(data, columns)
        frame.coalesce(1).write.parquet(f"{root}/{key.replace('.', '/')}")
        headers[key] = frame.schema

    for i in range(count):
        write(f"s.eau_raw_can_{i}", [(f"L{i}", str(i)), ("?", "x")], f"nom{i} string, valeur string")
        words = [("nom", f"nom{i}", None, "can"), ("nom", f"L{i}", f"C{i}", "can"), ("nom", f"L{i + 1}", "other", "can")]
        write(f"s.eau_raw_dict_{i}", words, "Champs string, Valeur string, Code string, ABC_SOURCE_NOM string")
        rows += [row("can", str(i), f"eau_raw_can_{i}"), row("eau_dict", str(i), f"eau_raw_dict_{i}")]
    store.note(headers)
    return store, spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))


def test_jobs_and_scans_do_not_grow_with_owners(spark, tmp_path):
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.threshold", "1000")  # a listing of many paths is a job of its own
    seen = {}
    for count in (2, 50):
        store, known = _many_owners(spark, tmp_path / str(count), count)
        spark.sparkContext.setJobGroup(f"build {count}", "")
        done = U.union_by_name(spark, known, store, "can", "eau", TARGET, names=N)
        spark.sparkContext.setJobGroup("rest", "")
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build {count}"))
        plan = done._jdf.queryExecution().executedPlan().toString()
        seen[count] = jobs, plan.count("FileScan"), plan.count("Join")
        got = sorted((r.import_table, r.x_nom, r.x_valeur) for r in done.collect() if r.x_nom)
        assert got == sorted((f"s.eau_raw_can_{i}", f"C{i}", i) for i in range(count))
        groups = U.union_groups(spark, known, store, TARGET, N)
        assert set(groups) == {"eau_src_can", "eau_src_eau_dict"} and groups["eau_src_can"].count() == 2 * count
    spark.conf.unset("spark.sql.sources.parallelPartitionDiscovery.threshold")
    assert seen[2] == seen[50]


def test_labels_without_match_field_and_uncoded_owners(spark, registry, frames):
    words = frames["s.eau_raw_dict_b"].union(spark.createDataFrame([("autre", "L1", "D1", "can")], "a string, b string, c string, d string"))
    done = U.union_by_name(spark, registry, FrameTables(frames | {"s.eau_raw_dict_b": words}), "can", "eau", TARGET, names=N, match_field=False)
    got = sorted((r.import_table, r.x_nom) for r in done.collect() if r.x_nom)
    assert got == [("s.eau_raw_can_a", "n1"), ("s.eau_raw_can_a", "n2"), ("s.eau_raw_can_b", "C1"), ("s.eau_raw_can_b", "D1")]


def test_raw_columns_of_other_types(spark, registry, frames, tmp_path):
    typed = frames | {"s.eau_raw_can_b": spark.createDataFrame([(2.0, "L1")], "valeur double, libelle string")}
    for name, frame in typed.items():
        ParquetTables(spark, str(tmp_path)).write(name, frame)
    as_rows = lambda df: sorted((tuple(r) for r in df.select("import_table", "x_nom", "x_valeur").collect()), key=str)
    by_files, by_frames = (U.union_by_name(spark, registry, t, "can", "eau", TARGET, names=N) for t in (ParquetTables(spark, str(tmp_path)), FrameTables(typed)))
    assert as_rows(by_files) == as_rows(by_frames)
    assert ("s.eau_raw_can_b", "C1", 2) in as_rows(by_files)


def test_stored_tables_are_told_by_their_folders(spark, registry, frames, tmp_path):
    """The cost of a row does not rise with its path, and no row is shuffled to meet what is known of its table."""
    store = ParquetTables(spark, f"{tmp_path}/100%25 a+b")
    for name, frame in frames.items():
        store.write(name, frame)
    store.write("s.c+d%2Be f", frames["s.eau_raw_can_a"])
    (odd,) = store.open(["s.c+d%2Be f"])
    assert [r[0] for r in odd.select("import_table").collect()] == ["s.c+d%2Be f"] * 2
    done = U.union_by_name(spark, registry, store, "can", "eau", TARGET, names=N)
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract" not in plan and "SortMergeJoin" not in plan
    kept = U.union_by_name(spark, registry, FrameTables(frames), "can", "eau", TARGET, names=N)
    assert sorted(map(str, done.collect())) == sorted(map(str, kept.collect()))
