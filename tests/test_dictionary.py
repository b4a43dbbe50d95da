import pytest
from conftest import rows

from longhouse import schemas as S
from longhouse.operators import checks, upsert
from longhouse.plans import dictionary as D

VARIABLES = "variable_id long, domain_id long, name string, value_type_id int, vocabulary_id long, description string, note string, keyrole string"
INCOMING = "domain_id long, name string, value_type_id int, vocabulary_id long, description string, note string, pos long"


def fold(existing, incoming, overwrite):
    """Row by row, as a table with a key would take them."""
    table = {(r[1], r[2]): list(r) for r in existing}
    next_id = max((r[0] for r in existing), default=0) + 1
    for domain, name, kind, voc, desc, note, _ in sorted(incoming, key=lambda r: r[6]):
        row = table.get((domain, name))
        if row is None:
            table[domain, name] = [next_id, domain, name, kind, voc, desc, note, None]
            next_id += 1
        elif overwrite or None in row[4:7]:
            row[4:7] = [voc, desc, note]
    return sorted(tuple(r) for r in table.values())


@pytest.mark.parametrize("overwrite", [False, True])
def test_upsert_equals_the_row_by_row_fold(spark, overwrite):
    existing = [
        (3, 1, "complete", 1, 9, "d", "n", "id"),
        (4, 1, "open", 2, None, "d", None, None),
        (8, 2, "complete", 3, None, None, None, None),
    ]
    incoming = [
        (1, "complete", 5, 7, "x", "y", 0),
        (1, "open", 5, 7, "x", None, 1),
        (1, "open", 5, 8, "full", "full", 2),
        (1, "open", 5, 9, "late", "late", 3),
        (1, "new", 1, None, "first", None, 4),
        (1, "new", 2, None, None, "last", 5),
        (2, "new", 3, 1, "a", "b", 6),
        (2, "new", 3, None, None, None, 7),
        (2, "complete", 3, None, None, None, 8),
    ]
    got = upsert.upsert_variables(
        spark.createDataFrame(existing, VARIABLES), spark.createDataFrame(incoming, INCOMING), overwrite
    )
    assert rows(got.select(*[c.split()[0] for c in VARIABLES.split(", ")])) == fold(existing, incoming, overwrite)


def test_insert_if_absent_keeps_known_names_and_first_rows(spark):
    known = spark.createDataFrame([(5, "a", "old")], "id long, name string, d string")
    incoming = spark.createDataFrame(
        [("b", "second", 2), ("b", "first", 1), ("a", "new", 0), ("c", None, 3)], "name string, d string, pos long"
    )
    got = upsert.insert_if_absent(known, incoming, "id")
    assert rows(got, "id", "name", "d") == [(6, "b", "first"), (7, "c", None)]
    everything = known.unionByName(got)
    assert upsert.insert_if_absent(everything, incoming, "id").count() == 0


def test_vocabulary_lines(spark):
    texts = [("one", "only a title"), ("v", "title\n1,yes\n2\n3,no,extra\n\n4,\r"), ("none", None)]
    df = spark.createDataFrame(texts, "Column_Name string, Description string")
    got = rows(D.vocabulary_from_lines(df), "Column_Name", "value", "code", "description", "vocabulary_description")
    assert got == [
        ("v", 1, "1", "yes", "title"),
        ("v", 2, "2", None, "title"),
        ("v", 3, "3", "no", "title"),
        ("v", 4, "", None, "title"),
        ("v", 5, "4", "\r", "title"),
    ]
    assert {r.Column_Name: r.Description for r in D.first_line(df).collect()} == {
        "one": "only a title", "v": "title", "none": None
    }


def test_sheet_vocabularies_are_described_by_their_variable(spark):
    variables = spark.createDataFrame(
        [("sex", 7, "Sex", "", 0), ("age", 1, "Age", "", 1)],
        "Column_Name string, DataType int, Description string, Note string, pos long",
    )
    items = spark.createDataFrame(
        [("sex", "M", "male", 0), ("other", "X", "x", 1), ("sex", "F", "female", 2)],
        "Column_Name string, Items string, Description string, pos long",
    )
    marked, found = D.read_variables(variables, items)
    assert rows(marked, "Column_Name", "Vocabulary") == [("age", None), ("sex", "sex")]
    assert rows(found, "Column_Name", "value", "code", "description", "vocabulary_description", "source") == [
        ("sex", 1, "M", "male", "Sex", 0), ("sex", 2, "F", "female", "Sex", 0)
    ]


def test_vocabulary_names_are_shared_between_domains(spark):
    schema = "Column_Name string, vocabulary_description string, value long, code string, description string, source long"
    items = spark.createDataFrame(
        [("sex", "first", 1, "M", "male", 10), ("sex", "second", 1, "0", "man", 20), ("sex", "second", 2, "1", "woman", 20)],
        schema,
    )
    none = spark.createDataFrame([], S.TABLES["vocabularies"].schema)
    fresh, owned = D.new_vocabularies(none, items)
    assert rows(fresh, "vocabulary_id", "name", "description") == [(1, "sex", "first")]
    assert rows(owned, "vocabulary_id", "value", "code") == [(1, 1, "M")]
    again, more = D.new_vocabularies(fresh, items)
    assert again.count() == 0 and more.count() == 0


def test_missing_dictionary_columns_are_named(spark):
    df = spark.createDataFrame([("a",)], "Column_Name string")
    with pytest.raises(ValueError, match="DataType, Description, Note, Vocabulary"):
        checks.require_columns(df)


def test_like_ignores_case_and_knows_wildcards(spark):
    df = spark.createDataFrame(
        [(1, 1, "A_code_x", None), (2, 1, "AcodeX", None), (3, 2, "a_code", 4)],
        "variable_id long, domain_id long, name string, vocabulary_id long",
    )
    got = upsert.assign_vocabulary(df, "_CODE", 1, 9)
    assert rows(got, "variable_id", "vocabulary_id") == [(1, 9), (2, 9), (3, 4)]


def test_key_roles_prefer_the_site(spark):
    df = spark.createDataFrame([(1, "x", None), (1, "y", None), (2, "x", "id")], "domain_id long, name string, keyrole string")
    got = upsert.set_key_roles(df, 1, "x", "x")
    assert rows(got) == [(1, "x", "site_name"), (1, "y", None), (2, "x", "id")]


def test_latest_ethics_approval_counts(spark):
    protocols = spark.createDataFrame([(1, "p", None), (2, "q", 5)], "protocol_id long, name string, ethics_id long")
    ethics = spark.createDataFrame([(7, "p"), (9, "p"), (8, "unknown")], "ethics_id long, ethics_reference string")
    assert rows(upsert.assign_ethics(protocols, ethics)) == [(1, "p", 9), (2, "q", 5)]


def test_lab_dictionary(spark):
    columns = ["champs_deid", "TA_CH_00001", "TA_CH_00001_1", "ta_Ch_pcr", "rb_ch_none", "zz_ch_00001"]
    samples = [("TA", "Tracheal, aspirate"), ("rb", "Rectal"), ("ta", "lower"), ("champs_deid", "Id")]
    vocabulary = [("CH_00001", "Virus A", 0), ("00001", "Number", 1), ("PCR", None, 2), ("CH", "Test", 3)]
    got = D.lab_dictionary(
        spark.createDataFrame([(c,) for c in columns], "Column_Name string"),
        spark.createDataFrame(samples, "Sample_code string, Desc string"),
        spark.createDataFrame(vocabulary, "champs_local_code string, c_pref_name string, pos long"),
        "champs_deid",
    )
    by_name = {r.Column_Name: r for r in got.collect()}
    assert by_name["TA_CH_00001"].Description == "Tracheal^ aspirate: Virus A^ Number^ Test"
    assert by_name["TA_CH_00001_1"].Description == "Tracheal^ aspirate: Virus A^ Number^ Test^  result 1"
    assert by_name["rb_ch_none"].Description == "Rectal: Test"
    assert by_name["zz_ch_00001"].Description is None
    assert {n: r.Key for n, r in by_name.items() if r.Key} == {"champs_deid": "Yes"}
    assert {r.DataType for r in by_name.values()} == {3}


def test_panel_vocabulary(spark):
    panels = spark.createDataFrame(
        [("P", "\tpos\n", 1.0, None, 0), ("P", "neg", 2.0, "a b", 1), ("P", "pos", 3.0, "c", 2), ("Q", "neg", 4.0, "d", 3)],
        "pathogen string, Interpretation string, ct double, note string, pos long",
    )
    assert rows(D.panel_vocabulary(panels, ["ct", "note"])) == [
        ("P", 1, "pos", "ct:1.0;note:missing|ct:3.0;note:c"),
        ("P", 2, "neg", "ct:2.0;note:ab"),
        ("Q", 1, "neg", "ct:4.0;note:d"),
    ]


def test_harmonised_types(spark):
    df = spark.createDataFrame(
        [
            ("a", "Please RECORD the date", 3), ("b", "How many?", 3), ("b_unit", "How many units", 3),
            ("c", "enter length of stay", 1), ("d", None, 5), ("a", "other", 3),
        ],
        "Column_Name string, Description string, DataType int",
    )
    assert rows(D.harmonise_types(df), "Column_Name", "DataType") == [
        ("a", 4), ("a", 4), ("b", 2), ("b_unit", 7), ("c", 2), ("d", 5)
    ]


def test_named_types(spark):
    df = spark.createDataFrame(
        [
            ("id10011", "start", "text"), ("id10021", "born", "text"), ("w", "What was the weight, kg", "integer"),
            ("w_unit", "unit", "integer"), ("two", "x", "integer"), ("two", "x", "text"), ("rowid", "key", "integer"),
            ("odd", "x", "blob"), ("w", "What was the weight, kg", "text"),
        ],
        "column_name string, description string, type string",
    )
    assert rows(D.harmonise_named_types(df), "Column_Name", "Key", "Description", "DataType") == [
        ("id10011", "", "start", 5),
        ("id10021", "", "born", 4),
        ("odd", "", "x", None),
        ("rowid", "Yes", "key", 1),
        ("two", "", "x", 3),
        ("w", "", "What was the weight^ kg", 2),
        ("w_unit", "", "unit", 3),
    ]


def test_report_is_distinct_and_limited(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (4, "b", "x")], "domain_id long, name string, description string")
    assert rows(D.variable_report(df)) == [("a", None)]
