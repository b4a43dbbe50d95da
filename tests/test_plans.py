"""Deliveries as files, through every pipeline, to exports."""

import base64
import datetime as dt
from dataclasses import replace
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from longhouse import config, schemas as S
from longhouse.config import IngestConfig, SourceConfig, UserIngestConfig
from longhouse.operators import checks, reshape
from longhouse.operators.checks import IntegrityError
from longhouse.plans import dataset, dictionary, export, metadata, registry
from longhouse.session import shared_dir
from longhouse.sources.archive import Archive
from longhouse.sources.arrow_ipc import read_arrow

DAY = dt.date(2024, 2, 3)
SOURCE = SourceConfig(
    name="SRC",
    site_data="demo.csv",
    site_col="site",
    country_col="country",
    protocols={"p1.pdf": "First", "p2.pdf": "Second"},
    instruments={"form.pdf": "visits.csv"},
    ethics={"e1.pdf": ("E one", "Board", "p1.pdf"), "e2.pdf": ("E two", "Board", "p1.pdf")},
)
INGEST = IngestConfig(
    source=SOURCE,
    id_col="pid",
    domain_name="SRC",
    death_file="demo.csv",
    datasets={"Demographics": "demo.csv", "Visits": "visits.csv"},
    datadictionaries=["demo.csv", "visits.xlsx"],
    author="someone",
    as_of=DAY,
)
VISITS = "pid,when,weight,result,row_id\nA1,2020-01-02,1.5,M,5\nA1,2020-02-02,,F,6\nB9,,3.25,,7\nA2,2020-03-01,4.0,M,8\n"


@pytest.fixture(scope="module")
def delivery(tmp_path_factory):
    root = tmp_path_factory.mktemp("delivery")

    def put(path, text):
        file = root / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)

    put("SRC/De_identified_data/demo.csv", "pid,site,country\nA1,North,ke\nA2,South,ke\nA1,South,ke\nA3,North,ke\n")
    put("SRC/De_identified_data/visits.csv", VISITS)
    put("iso.csv", "country,iso2,iso3\nKenya,KE,KEN\nMali,ML,MLI\n")
    for folder, names in (("Protocols", SOURCE.protocols), ("Instruments", SOURCE.instruments), ("Ethics", SOURCE.ethics)):
        for n in names:
            put(f"SRC/{folder}/{n}", f"document {n}")
    put(
        "dict/SRC/demo.csv",
        "Column_Name;Key;Description;Note;DataType\npid;Yes;Person;;3\nsite;;\"Site of death\nNorth,up\nSouth,down\";n;7\n"
        "country;;Country;n;3\n",
    )
    put(
        "dict/SRC/visits/variables.csv",
        "Column_Name,DataType,Description,Note\npid,3,Person again,note\nwhen,4,Day,n\nweight,2,Weight,n\nresult,7,Result,n\nrow_id,1,Own id,n\n",
    )
    put("dict/SRC/visits/vocabularies.csv", "Column_Name,Items,Description\nresult,M,male\nresult,F,female\n")
    return str(root)


@pytest.fixture(scope="module")
def archive(spark, delivery):
    made = Archive.create(spark, f"{delivery}/archive")
    metadata.ingest_source(made, SOURCE, delivery, f"{delivery}/iso.csv")
    registry.ingest_deaths(made, INGEST, delivery)
    dictionary.ingest_dictionary(made, INGEST, f"{delivery}/dict")
    assert dataset.ingest_data(made, INGEST, delivery) == [1, 2]
    return made


def test_source_is_described(archive):
    assert rows(archive.table("sources")) == [(1, "SRC", 1)]
    assert rows(archive.table("sites")) == [(1, "North", "Kenya", "KEN", 1), (2, "South", "Kenya", "KEN", 1)]
    assert rows(archive.table("protocols")) == [(1, "p1.pdf", "First", 2), (2, "p2.pdf", "Second", None)]
    assert rows(archive.table("site_protocols")) == [(1, 1), (1, 2), (2, 1), (2, 2)]
    assert rows(archive.table("ethics")) == [(1, 1, "e1.pdf", "Board", "p1.pdf"), (2, 1, "e2.pdf", "Board", "p1.pdf")]
    assert rows(archive.table("ethics_documents"), "ethics_id", "name", "description") == [
        (1, "e1.pdf", "E one"), (2, "e2.pdf", "E two")
    ]
    assert rows(archive.table("instruments"), "instrument_id", "name", "description") == [(1, "form.pdf", "visits.csv")]
    for table in ("protocol_documents", "instrument_documents", "ethics_documents"):
        for r in archive.table(table).collect():
            assert base64.b64decode(r.document).decode() == f"document {r.name}"


def test_individuals_are_registered_at_their_sites(archive):
    assert sorted(r.death_id for r in archive.table("deaths").collect()) == [1, 2, 3, 4]
    assert rows(archive.table("deaths"), "site_id", "external_id", "data_ingestion_id") == [
        (1, "A1", 1), (1, "A3", 1), (2, "A1", 1), (2, "A2", 1)
    ]
    assert rows(archive.table("data_ingestions"), "data_ingestion_id", "source_id", "date_received") == [(1, 1, DAY), (2, 1, DAY)]


def test_dictionaries_are_folded_in_order(archive):
    got = rows(archive.table("variables").drop("domain_id"))
    assert got == [
        (1, "pid", 3, None, "Person again", "note", "id"),
        (2, "site", 7, 1, "Site of death", "n", "site_name"),
        (3, "country", 3, None, "Country", "n", None),
        (4, "when", 4, None, "Day", "n", None),
        (5, "weight", 2, None, "Weight", "n", None),
        (6, "result", 7, 2, "Result", "n", None),
        (7, "row_id", 1, None, "Own id", "n", None),
    ]
    assert rows(archive.table("vocabularies")) == [(1, "site", "Site of death"), (2, "result", "Result")]
    assert rows(archive.table("vocabulary_items"), "vocabulary_id", "value", "code", "description") == [
        (1, "1", "North", "up"), (1, "2", "South", "down"), (2, "1", "M", "male"), (2, "2", "F", "female")
    ]


def test_datasets_and_lineage(archive):
    assert rows(archive.table("datasets"), "dataset_id", "name", "description", "unit_of_analysis_id", "date_created") == [
        (1, "demo.csv", "Demographics", 1, DAY), (2, "visits.csv", "Visits", 1, DAY)
    ]
    assert rows(archive.table("ingest_datasets")) == [(1, 2, 1, 1), (2, 2, 1, 2)]
    assert rows(archive.table("transformation_outputs")) == [(1, 1), (1, 2)]
    transformation = archive.table("transformations").first()
    assert (transformation.transformation_type_id, transformation.transformation_status_id, transformation.created_by) == (1, 2, "someone")
    assert rows(archive.table("datarows")) == [(i, 1) for i in range(1, 5)] + [(i, 2) for i in range(5, 9)]
    assert archive.table("data").count() == 4 * 3 + 4 * 5
    assert rows(archive.table("dataset_variables")) == [(1, 1), (1, 2), (1, 3)] + [(2, v) for v in (1, 4, 5, 6, 7)]
    assert rows(archive.table("instrument_datasets")) == [(1, 2)]


def test_rows_are_linked_by_external_id(archive):
    links = archive.table("death_rows").join(archive.table("deaths"), "death_id")
    linked = links.join(archive.table("datarows").where("dataset_id = 2"), "row_id")
    assert rows(linked.groupBy("external_id").count()) == [("A1", 4), ("A2", 1)]


def test_wide_forms_equal_the_delivery(archive):
    text = export.dataset_to_dataframe(archive, 2)
    assert text.columns == ["__row_id", "pid", "when", "weight", "result", "row_id"]
    assert rows(text) == [
        (5, "A1", "2020-01-02", "1.5", "M", "5"),
        (6, "A1", "2020-02-02", None, "F", "6"),
        (7, "B9", None, "3.25", None, "7"),
        (8, "A2", "2020-03-01", "4.0", "M", "8"),
    ]
    typed = export.dataset_to_typed(archive, 1)
    assert rows(typed, "pid", "site", "country") == [
        ("A1", "North", "ke"), ("A1", "South", "ke"), ("A2", "South", "ke"), ("A3", "North", "ke")
    ]


def test_only_the_files_of_a_dataset_are_read(archive):
    plan = export.dataset_cells(archive, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dataset_id" in plan
    files = export.dataset_to_dataframe(archive, 1).inputFiles()
    assert files and all("/dataset_id=1/" in f for f in files)


def test_everything_declared_holds(archive):
    assert archive.audit() == []


def test_audit_finds_broken_links(spark, archive, delivery):
    broken = Archive(spark, f"{delivery}/archive")
    table = broken.table
    links = table("death_rows")
    bad = links.unionByName(links.limit(1)).unionByName(links.limit(1).withColumn("row_id", F.lit(999).cast("long")))
    broken.table = lambda name: bad if name == "death_rows" else table(name)
    assert [p.split(" (")[0] for p in sorted(broken.audit())] == [
        "death_rows: duplicate death_id, row_id", "death_rows: row_id is not in datarows"
    ]


def test_exports(spark, archive, tmp_path):
    path = export.dataset_to_csv(archive, 1, str(tmp_path), compress=True)
    assert path.endswith("csvfiles/demo.csv.gz") and list(Path(path).glob("*.csv.gz"))
    plain = export.dataset_to_csv(archive, 1, str(tmp_path))
    assert plain.endswith("csvfiles/demo.csv.csv")
    assert spark.read.option("header", True).csv(plain).count() == 4
    arrow = export.dataset_to_arrow(archive, 1, str(tmp_path))
    assert arrow.endswith("arrowfiles/demo.csv.arrow")
    assert rows(read_arrow(spark, arrow)) == rows(export.dataset_to_dataframe(archive, 1))
    parquet = export.dataset_to_parquet(archive, 1, str(tmp_path))
    assert rows(spark.read.parquet(parquet)) == rows(export.dataset_to_typed(archive, 1))
    with pytest.raises(LookupError):
        export.dataset_to_csv(archive, 99, str(tmp_path))


def test_linking_again_adds_nothing(archive):
    before = archive.table("death_rows").count()
    dataset.link_dataset(archive, 2, 1, "pid", 1)
    assert archive.table("death_rows").count() == before
    with pytest.raises(LookupError):
        dataset.link_dataset(archive, 2, 1, "nope", 1)


def test_registering_again_breaks_the_key_and_publishes_nothing(archive, delivery):
    before, last = archive.table("deaths").count(), archive.last_batch()
    with pytest.raises(IntegrityError, match="duplicate site_id, external_id"):
        registry.ingest_deaths(archive, INGEST, delivery)
    assert (archive.table("deaths").count(), archive.last_batch()) == (before, last)
    assert archive.table("data_ingestions").count() == 2


def test_column_missing_in_the_dictionary_publishes_nothing(spark, archive, delivery):
    extra = Path(delivery) / "SRC/De_identified_data/extra.csv"
    extra.write_text("pid,mystery\nA1,1\n")
    last = archive.last_batch()
    bad = replace(INGEST, datasets={"Extra": "extra.csv"}, source=replace(SOURCE, instruments={}))
    with pytest.raises(ValueError, match="mystery"):
        dataset.ingest_data(archive, bad, delivery)
    assert archive.last_batch() == last and archive.table("datasets").count() == 2


def test_unknown_instrument_dataset(archive, delivery):
    bad = replace(INGEST, source=replace(SOURCE, instruments={"form.pdf": "nothing.csv"}))
    with pytest.raises(LookupError, match="Data file nothing.csv is not ingested."):
        dataset.ingest_data(archive, bad, delivery)


def test_dictionary_again_changes_no_ids(archive, delivery):
    before = rows(archive.table("variables"))
    items = archive.table("vocabulary_items").count()
    dictionary.ingest_dictionary(archive, INGEST, f"{delivery}/dict")
    assert [r[:4] for r in rows(archive.table("variables"))] == [r[:4] for r in before]
    assert archive.table("vocabulary_items").count() == items


def test_typed_store_and_declared_types(archive, delivery):
    only = replace(INGEST, datasets={"Visits": "visits.csv"}, source=replace(SOURCE, instruments={}))
    (dataset_id,) = dataset.ingest_data(archive, only, delivery, typed=True, declared_types=True)
    wide = export.dataset_to_typed(archive, dataset_id, typed=True)
    assert rows(wide.drop("__row_id")) == [
        ("A1", dt.date(2020, 1, 2), 1.5, "M", 5),
        ("A1", dt.date(2020, 2, 2), None, "F", 6),
        ("A2", dt.date(2020, 3, 1), 4.0, "M", 8),
        ("B9", None, 3.25, None, 7),
    ]
    assert rows(archive.table("datarows").agg(F.max("row_id"))) == [(12,)]


def test_derived_datasets_record_their_inputs(spark, archive):
    domain = S.TABLES["variables"].schema
    batch = archive.begin()
    dictionary.add_domain(batch, "user", "derived")
    batch.publish()
    domain_id = archive.table("domains").where("name = 'user'").first().domain_id
    batch = archive.begin()
    row = (100, domain_id, "n", S.INTEGER, None, None, None, None)
    batch.write("variables", archive.table("variables").unionByName(spark.createDataFrame([row], domain)))
    batch.publish()
    derived = UserIngestConfig("n", "user", {"counts": spark.range(3).toDF("n")}, {"counts": [1, 2]}, as_of=DAY)
    (dataset_id,) = dataset.ingest_derived(archive, derived)
    made = archive.table("transformation_outputs").where(F.col("dataset_id") == dataset_id).first()
    inputs = archive.table("transformation_inputs")
    assert rows(inputs) == [(made.transformation_id, 1), (made.transformation_id, 2)]
    entry = archive.table("transformations").where(F.col("transformation_id") == made.transformation_id).first()
    assert (entry.transformation_type_id, entry.transformation_status_id) == (2, 1)
    assert rows(export.dataset_to_typed(archive, dataset_id), "n") == [(0,), (1,), (2,)]


def test_user_dictionaries_mark_only_the_id(archive, delivery):
    folder = Path(delivery) / "dict/team"
    folder.mkdir()
    (folder / "team.csv").write_text("Column_Name;Key;Description;Note;DataType\nk;Yes;Key;n;1\nsite;;Place;n;3\n")
    ingest = UserIngestConfig("k", "team", {}, {}, {"team": "team.csv"})
    dictionary.ingest_dictionary(archive, ingest, f"{delivery}/dict")
    domain_id = archive.table("domains").where("name = 'team'").first().domain_id
    added = archive.table("variables").where(F.col("domain_id") == domain_id)
    assert rows(added, "name", "keyrole") == [("k", "id"), ("site", None)]


def test_variable_report_files(spark, archive, tmp_path):
    first, second = dictionary.write_variable_report(archive, str(tmp_path))
    read = spark.read.option("header", True)
    assert rows(read.csv(first)) == rows(read.option("sep", ";").csv(second))
    assert ("pid", "Person again") in rows(read.option("sep", ",").csv(first))


def test_no_deaths_is_an_error(spark, delivery):
    other = Archive.create(spark, f"{delivery}/other")
    metadata.ingest_source(other, SOURCE, delivery, f"{delivery}/iso.csv")
    dictionary.ingest_dictionary(other, INGEST, f"{delivery}/dict")
    with pytest.raises(LookupError, match="have not been ingested"):
        dataset.ingest_data(other, INGEST, delivery)
    with pytest.raises(FileExistsError):
        Archive.create(spark, f"{delivery}/other")


def test_dictionary_formats(archive, delivery):
    with pytest.raises(ValueError, match="must be an .xlsx"):
        dictionary.read_dictionary_tables(archive, delivery, "x.json")


def test_presets_are_consistent():
    for ingest in (config.champs_ingest(), config.comsa_mozambique_ingest(), config.heal_sierra_leone_ingest()):
        assert ingest.domain_name == ingest.source.name
        assert all(entry[2] in ingest.source.protocols for entry in ingest.source.ethics.values())
        assert set(ingest.source.instruments.values()) <= set(ingest.datasets.values())
        assert ingest.csv == ingest.source.csv


def tiny(spark, root, delivery, name="visits.csv", types=(("pid", 3), ("note", 3), ("n", 1)), **ingest):
    """An archive with one delivered dataset."""

    def put(path, text):
        file = Path(root) / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(text)

    put("in/S/De_identified_data/demo.csv", "pid,site\nA1,North\nA2,North\n")
    put(f"in/S/De_identified_data/{name}", delivery)
    put("in/iso.csv", "country,iso2,iso3\nKenya,KE,KEN\n")
    lines = "\n".join(f"{c};{c};n;{t}" for c, t in [*types, ("site", 3)])
    put("dict/S/d.csv", f"Column_Name;Description;Note;DataType\n{lines}\n")
    source = SourceConfig("S", "demo.csv", "site", country_name="Kenya")
    setup = IngestConfig(source, "pid", "S", "demo.csv", {"Visits": name}, ["d.csv"], as_of=DAY, **ingest)
    made = Archive.create(spark, f"{root}/archive")
    metadata.ingest_source(made, source, f"{root}/in", f"{root}/in/iso.csv")
    registry.ingest_deaths(made, setup, f"{root}/in")
    dictionary.ingest_dictionary(made, setup, f"{root}/dict")
    return made, setup, f"{root}/in"


def test_line_breaks_and_blanks_survive_ingest_and_export(spark, tmp_path):
    made, setup, path = tiny(spark, tmp_path, 'pid,note,n\nA1,"two\nlines",1\nA2," pad ",2\n')
    dataset.ingest_data(made, setup, path)
    want = [("A1", "two\nlines", "1"), ("A2", " pad ", "2")]
    assert rows(export.dataset_to_dataframe(made, 1).drop("row_id")) == want
    assert rows(made.table("death_rows"), "row_id") == [(1,), (2,)]
    for _ in range(2):  # a second export replaces the first
        out = export.dataset_to_csv(made, 1, str(tmp_path))
        back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out)
        assert rows(back.drop("row_id")) == want
        assert rows(read_arrow(spark, export.dataset_to_arrow(made, 1, str(tmp_path))).drop("row_id")) == want
        assert spark.read.parquet(export.dataset_to_parquet(made, 1, str(tmp_path))).count() == 2
    assert made.audit() == []


def test_a_broken_row_stops_an_ingest_of_single_lines(spark, tmp_path):
    one_line = config.CsvFormat(multiline=False)
    made, setup, path = tiny(spark, tmp_path, 'pid,note,n\nA1,"two\nlines",1\nA2,ok,2\n', csv=one_line)
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        dataset.ingest_data(made, setup, path)
    assert made.table("datasets").count() == 0


def test_times_stand_as_delivered(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        types = (("pid", 3), ("at", 5))
        made, setup, path = tiny(spark, tmp_path, "pid,at\nA1,2021-03-14T02:30:00\nA2,2021-03-14T03:30:00\n", types=types)
        for declared in (True, False):
            (made_id,) = dataset.ingest_data(made, setup, path, declared_types=declared)
            assert [r["at"] for r in export.dataset_to_dataframe(made, made_id).orderBy("pid").collect()] == [
                "2021-03-14T02:30:00.000", "2021-03-14T03:30:00.000"
            ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_a_typed_dataset_is_linked_afterwards(spark, tmp_path):
    made, setup, path = tiny(spark, tmp_path, "pid,note,n\nA1,x,1\nA2,y,2\nB9,z,3\n")
    other = replace(setup, id_col="n")
    dataset.ingest_data(made, other, path, typed=True)
    assert made.table("death_rows").count() == 0
    dataset.link_dataset(made, 1, 1, "pid", 1)
    assert rows(made.table("death_rows"), "row_id", "dataset_id") == [(1, 1), (2, 1)]


def test_texts_of_another_type_are_errors_or_null(spark, tmp_path):
    made, setup, path = tiny(spark, tmp_path, "pid,note,n\nA1,x,1.5\nA2,y,2.0\n")
    dataset.ingest_data(made, setup, path, declared_types=False)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        export.dataset_to_typed(made, 1).collect()
    assert rows(export.dataset_to_typed(made, 1, strict=False), "pid", "n") == [("A1", None), ("A2", None)]
    with pytest.raises(Exception, match="not a whole number"):
        dataset.ingest_data(made, setup, path, typed=True, declared_types=False)


def test_a_cell_that_is_twice_is_an_error(spark):
    variables = [reshape.Variable(i, n, S.STRING) for i, n in ((1, "p"), (2, "q"), (3, "r"))]
    cells = [(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (2, 1, "x"), (2, 1, "x"), (2, 2, "y")]
    for row in (1, 2):
        frame = spark.createDataFrame([c for c in cells if c[0] == row], "row_id long, variable_id long, value string")
        with pytest.raises(Exception, match=f"row {row} holds a variable twice"):
            reshape.pivot_text(frame, variables).collect()


def test_cells_are_told_by_their_rows_before_they_are_published(spark, tmp_path):
    lines = "".join(f"A{i},x,{i}\n" for i in range(1, 6))
    made, setup, path = tiny(spark, tmp_path, "pid,note,n\n" + lines)
    dataset.ingest_data(made, setup, path)
    cells, datarows, variables = made.table("data"), made.table("datarows"), made.table("dataset_variables")
    assert checks.cell_problems("data", cells, datarows, variables).count() == 0

    def told(bad):
        return [r.problem for r in checks.cell_problems("data", bad, datarows, variables).collect()]

    lacking = cells.where("NOT (row_id = 2 AND variable_id = 1)")
    twice = cells.unionByName(cells.where("row_id = 1 AND variable_id = 2"))
    swapped = lacking.unionByName(cells.where("row_id = 1 AND variable_id = 1"))
    others = cells.where("variable_id <> 1")
    missing = others.where("row_id > 0")
    layouts = [[1, 3, 3, 3, 5], [1, 2, 2, 5, 5], [1, 2, 3, 4, 6], [1, 2, 3, 4, 5, 5]]
    layouts = [others.unionByName(spark.createDataFrame([(i, 1, "x", 1) for i in ids], cells.schema)) for ids in layouts]
    for bad in (lacking, swapped, missing, *layouts):
        assert told(bad) == ["data: variable 1 of dataset 1 lacks cells or has some twice"]
    assert told(twice) == ["data: variable 2 of dataset 1 lacks cells or has some twice"]
    strange = cells.unionByName(spark.createDataFrame([(1, 77, "x", 1)], cells.schema))
    assert told(strange) == ["data: variable 77 is not one of dataset 1"]
    nothing = checks.cell_problems("data", cells.limit(0), datarows.limit(0), variables)
    assert nothing.count() == 0


def test_a_pipeline_leaves_nothing_but_the_archive(spark, tmp_path):
    folder = Path(shared_dir(spark).removeprefix("file:")) / "longhouse"
    before = set(folder.iterdir()) if folder.exists() else set()
    made, setup, path = tiny(spark, tmp_path, "pid,note,n\nA1,x,1\n")
    dataset.ingest_data(made, setup, path)
    assert (set(folder.iterdir()) if folder.exists() else set()) == before


def test_one_column_reads_few_rows(spark, tmp_path):
    """Cells lie by variable, so row groups of other variables are skipped."""
    names = [f"v{i}" for i in range(20)]
    frame = spark.range(0, 40_000, 1, 1).select(F.col("id").alias("row_id"), *[F.col("id").cast("string").alias(n) for n in names])
    cells = reshape.unpivot_text(frame, reshape.variables_from_schema(frame, ["row_id"]))
    path = str(tmp_path / "cells")
    cells.sortWithinPartitions("variable_id", "row_id").write.option("parquet.block.size", 1 << 20).parquet(path)
    read = reshape.dataset_column(spark.read.parquet(path), reshape.Variable(3, "v2", S.STRING))
    assert len(read.collect()) == 40_000
    assert max(scanned_rows(read)) < 400_000


def test_export_moves_no_cells(spark, tmp_path):
    """A row's cells lie in one bucket, so the pivot has no exchange, from either store."""
    lines = "".join(f"A{i},x{i},{i}\n" for i in range(500))
    for typed in (False, True):
        folder = tmp_path / str(typed)
        folder.mkdir()
        made, setup, path = tiny(spark, folder, "pid,note,n\n" + lines)
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(dataset, "LEAST_CELLS", 100)
            dataset.ingest_data(made, setup, path, typed=typed)
        wide = export.dataset_to_typed(made, 1, typed=typed)
        assert rows(wide, "pid", "note", "n") == sorted((f"A{i}", f"x{i}", i) for i in range(500))
        assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
        assert wide.rdd.getNumPartitions() > 1
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("longhouse")]
        # rows of a column are still found by row group
        assert made.table("typed_data" if typed else "data").count() == 1500


def test_one_id_reads_few_row_groups(spark, tmp_path):
    """Ids in no order: only Bloom filters can tell where one is."""
    made = Archive.create(spark, str(tmp_path / "made"))
    rows_ = spark.range(0, 200_000, 1, 1).select(
        (F.col("id") + 1).alias("death_id"), F.lit(1).cast("long").alias("site_id"), F.md5(F.col("id").cast("string")).alias("external_id"),
    )
    cells = rows_.select(F.col("death_id").alias("row_id"), F.lit(1).cast("long").alias("variable_id"), F.col("external_id").alias("value"))
    batch = made.begin()
    spark.conf.set("parquet.block.size", 1 << 20)
    try:
        batch.write("deaths", rows_, partition=1)
        batch.write("data", cells, partition=1)
    finally:
        spark.conf.unset("parquet.block.size")
    batch.publish(check=False)
    wanted = rows_.where("death_id = 777").first().external_id
    for name, column in (("deaths", "external_id"), ("data", "value")):
        found = made.table(name).where(F.col(column) == wanted)
        assert len(found.collect()) == 1
        assert max(scanned_rows(found)) < 100_000


def scanned_rows(df):
    found = []

    def walk(node):
        metrics = node.metrics()
        if "Scan" in node.nodeName() and metrics.contains("numOutputRows"):
            found.append(metrics.apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    assert found
    return found


def test_an_ingest_is_few_jobs(spark):
    """Source, registry, dictionary and one dataset; most jobs are the writes of some twenty tables."""
    import __spark_entry__ as entry

    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    entry.customer_archive(spark, "/root/testdata/sf0.001")
    assert len(tracker.getJobIdsForGroup(None)) - before < 120


def test_datasets_are_stored_side_by_side_and_numbered_in_order(spark, tmp_path):
    made, setup, path = tiny(spark, tmp_path, "pid,note,n\nA1,x,1\nA2,y,2\n")
    name = next(iter(setup.datasets.values()))
    source = next(Path(path).rglob(name))
    for k in range(5):
        (source.parent / f"more{k}.csv").write_text("pid,note,n\n" + "".join(f"A{i},m{k},{i}\n" for i in range(k + 1)))
    several = replace(setup, datasets={f"d{k}": f"more{k}.csv" for k in range(5)})
    ids = dataset.ingest_data(made, several, path)
    assert ids == [1, 2, 3, 4, 5]
    assert rows(made.table("datarows"), "row_id") == [(i,) for i in range(1, 16)]
    first = made.table("datarows").groupBy("dataset_id").agg(F.min("row_id").alias("first"))
    assert rows(first) == [(1, 1), (2, 2), (3, 4), (4, 7), (5, 11)]
    assert rows(export.dataset_to_dataframe(made, 5), "note", "n") == [("m4", str(i)) for i in range(5)]
    (source.parent / "bad.csv").write_text("pid,unknown\nA1,1\n")
    last = made.last_batch()
    with pytest.raises(ValueError, match="unknown"):
        dataset.ingest_data(made, replace(several, datasets={**several.datasets, "e": "bad.csv"}), path)
    assert made.last_batch() == last
