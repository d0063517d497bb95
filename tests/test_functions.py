import datetime as dt
import random
from xml.etree import ElementTree

import pytest
from pyspark.errors import DateTimeException, NumberFormatException
from pyspark.sql import functions as F

from lakeloom.functions import hashing, names, nested, paths, responses, typed
from lakeloom.roles import TypedColumn


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- names ---


def test_clean_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["a.b", "c d-e!"])
    assert names.clean_names(df).columns == ["a_b", "cde"]
    with pytest.raises(ValueError):
        names.clean_names(spark.createDataFrame([(1, 2)], ["a.b", "a_b"]))


def test_names_that_vanish_are_refused(spark):
    with pytest.raises(ValueError):
        names.clean_names(spark.createDataFrame([(1,)], ["!?"]))


def test_stringify(spark):
    df = spark.sql("select 1 a, array(1, 2) b, map('k', 1) c, named_struct('x', 1) d, date'2024-01-02' e")
    assert rows(names.stringify(df)) == [("1", "[1,2]", '{"k":1}', '{"x":1}', "2024-01-02")]


# --- nested ---


def test_empty_and_null_arrays_keep_their_row(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, a array<int>")
    assert rows(nested.flatten_once(df, ["a"])) == [(1, 1), (1, 2), (2, None), (3, None)]


def test_sibling_arrays_multiply(spark):
    df = spark.createDataFrame([([1, 2], ["x", "y"])], "a array<int>, b array<string>")
    assert rows(nested.flatten_all(df)) == [(1, "x"), (1, "y"), (2, "x"), (2, "y")]


def test_columns_called_pos_and_col_survive(spark):
    df = spark.createDataFrame([(7, 8, [1])], "pos int, col int, a array<int>")
    flat = nested.flatten_all(df)
    assert flat.columns == ["pos", "col", "a"] and rows(flat) == [(7, 8, 1)]


def test_field_that_would_hide_a_column_is_refused(spark):
    df = spark.sql("select 1 a_b, named_struct('b', 2) a")
    with pytest.raises(ValueError):
        nested.flatten_once(df, ["a"])


def test_names_with_dots(spark):
    df = spark.sql("select named_struct('x.y', array(1)) as `a.b`")
    assert nested.flatten_all(df).columns == ["a.b_x.y"]


def test_one_level_only(spark):
    df = spark.sql("select array(named_struct('x', 1)) a")
    assert nested.flatten_once(df, ["a"]).dtypes == [("a", "struct<x:int>")]


def test_flatten_modes(spark):
    df = spark.sql("select named_struct('x', 1) a, named_struct('y', 2) b")
    assert nested.flatten(df, " Recursive ").columns == ["a_x", "b_y"]
    assert nested.flatten(df, "column", '[{"depth":1,"column":"b"}]').columns == ["a", "b_y"]
    with pytest.raises(ValueError):
        nested.flatten(df, "none")
    with pytest.raises(ValueError):
        nested.flatten(df, "column", [{"depth": 1, "column": "zz"}])


def test_null_struct_gives_null_fields(spark):
    df = spark.createDataFrame([(None,), ((1,),)], "a struct<x:int>")
    assert rows(nested.flatten_all(df)) == [(1,), (None,)]


def test_a_document_as_a_service_gives_it(spark):
    document = spark.sql("""
      select '7' id, 'oran' name, named_struct('name', 'hard', 'url', 'u1') firmness,
        array(named_struct('potency', '10', 'flavor', named_struct('name', 'dry', 'url', 'u2')),
              named_struct('potency', '0', 'flavor', named_struct('name', 'hot', 'url', 'u3'))) flavors
    """)
    flat = nested.flatten_all(document)
    assert flat.columns == [
        "id", "name", "firmness_name", "firmness_url",
        "flavors_potency", "flavors_flavor_name", "flavors_flavor_url",
    ]
    assert rows(flat.drop("id", "name", "firmness_url")) == [
        ("hard", "0", "hot", "u3"), ("hard", "10", "dry", "u2"),
    ]


# --- typed ---


@pytest.mark.parametrize("text", [None, "", "#datetime1", "#datetime1()", "#other(a)", "datetime1(a)"])
def test_bad_shorthands(text):
    with pytest.raises(ValueError):
        typed.shorthand(text)


def test_shorthands(spark):
    df = spark.createDataFrame(
        [("2024-07-01 12:00:00", "2024-07-01T12:00:00.123Z"), ("junk", None)], ["a", "b"]
    )
    columns = [
        TypedColumn(f"#{name}({source})", "timestamp", name)
        for name, source in (("datetime1", "a"), ("datetime2", "a"), ("datetime3", "b"))
    ]
    noon = dt.datetime(2024, 7, 1, 12)
    got = typed.select_typed(df, columns).select(
        *[F.date_format(c.name, "yyyy-MM-dd HH:mm:ss") for c in columns]
    )
    assert rows(got) == [(str(noon), str(noon.replace(hour=8)), str(noon)), (None, None, None)]


def test_strict_casts_fail_where_others_give_null(spark):
    df = spark.createDataFrame([("x",)], ["a"])
    number = [TypedColumn("a", "int", "n")]
    assert rows(typed.select_typed(df, number)) == [(None,)]
    with pytest.raises(NumberFormatException):
        typed.select_typed(df, number, strict=True).collect()
    with pytest.raises(DateTimeException):
        typed.select_typed(df, [TypedColumn("#datetime1(a)", "date", "d")], strict=True).collect()


def test_expression_and_exact_names(spark):
    df = spark.createDataFrame([("1", "2")], ["a.b", "c"])
    columns = [TypedColumn("a.b", "int", "n"), TypedColumn("@cast(`a.b` as int) + cast(c as int)", "decimal(10,2)", "s")]
    assert typed.select_typed(df, columns).dtypes == [("n", "int"), ("s", "decimal(10,2)")]


# --- hash ---


def test_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame(
        [(None, "a"), ("a", None), ("", None), (None, None)], "x string, y string"
    )
    assert df.select(hashing.row_hash(["x", "y"])).distinct().count() == 4


# --- paths ---


def test_paths(spark):
    texts = [
        ("deltalake:w/lake/tables/s/t",), ("LAKEFILES:w/lake/files/a/b/c",), ("warehouse:w/wh/s/t",),
        ("database:w/d",), ("other:w/d",), ("no path",), ("deltalake:w/lake/tables/s",),
    ]
    df = paths.split_paths(spark.createDataFrame(texts, ["p"]), "p")
    got = {r.p: r for r in df.collect()}
    assert [got[t[0]].path_status for t in texts] == [
        "ok", "ok", "ok", "not implemented", "unrecognized", "malformed", "malformed",
    ]
    files = got["LAKEFILES:w/lake/files/a/b/c"]
    assert (files.path_type, files.area, files.directory) == ("lakefiles", "files", "a/b/c")
    warehouse = got["warehouse:w/wh/s/t"]
    assert (warehouse.store, warehouse.schema_name, warehouse.table_name) == ("wh", "s", "t")
    assert warehouse.area is None

    form = {f: dict(df.select("p", paths.physical_path(f, "h")).collect())
            for f in ("api", "catalog", "relative", "abfss")}
    table, folder = texts[0][0], texts[1][0]
    assert [form[f][table] for f in form] == [
        "lake.s.t", "lake.t", "Tables/s/t", "abfss://w@h/lake.Lakehouse/Tables/s/t",
    ]
    assert [form[f][folder] for f in form] == [
        "/lakehouse/default/Files/a/b/c", None, "Files/a/b/c",
        "abfss://w@h/lake.Lakehouse/Files/a/b/c",
    ]
    assert form["api"]["warehouse:w/wh/s/t"] is None
    with pytest.raises(ValueError):
        paths.physical_path("ftp")


# --- responses ---


@pytest.mark.parametrize("code, kind, body, reason", [
    (500, "text/xml", "<r/>", "Status code is not 200."),
    (200, "application/json", "{", None),
    (200, None, "{", None),
    (200, "text/XML", "garbage", "Response xml is unexpected."),
    (200, "text/xml", None, "Response xml is unexpected."),
    (200, "text/xml", "<r><status>ok</status></r>trailing", "Response xml is unexpected."),
    (200, "text/xml", "<r><a><errorno>XL03000006</errorno></a></r>", "Session expired."),
    (200, "text/xml", "<r><a><errorno/></a></r>", "Response has an error."),
    (200, "text/xml", "<r/>", "Response missing status."),
    (200, "text/xml", "<r><x><status>failure</status></x></r>", "Response failed status."),
    (200, "text/xml", "<r><status>success</status><status>failure</status></r>", None),
    (200, "text/xml", "<r><status><![CDATA[failure]]></status></r>", "Response failed status."),
    (200, "text/xml", "<r><status>fail<![CDATA[ure]]></status></r>", "Response failed status."),
    (200, "text/xml", "<r><status>fail<!-- <status/> -->ure</status></r>", "Response failed status."),
    (200, "text/xml", "<r><status>failure<a/>not</status></r>", "Response failed status."),
    (200, "text/xml", "<r><errorno>XL0300000&#54;</errorno></r>", "Session expired."),
    (200, "text/xml", "<r><note><![CDATA[<errorno>1</errorno>]]></note><status>ok</status></r>", None),
    (200, "text/xml", "<r><!-- <errorno>1</errorno> --><status>ok</status></r>", None),
    (200, "text/xml", "<r xmlns:x='u'><x:errorno>1</x:errorno><status>ok</status></r>", None),
    (200, "text/xml", "<r xmlns='u'><errorno>1</errorno></r>", "Response missing status."),
    (200, "text/xml", "<r><x:errorno>1</x:errorno><status>ok</status></r>", None),
    (200, "text/xml", "<?xml version='1.0'?><!DOCTYPE r><r><status>ok</status></r>", None),
    (200, "text/xml", " <?xml version='1.0'?><r><status>ok</status></r>", "Response xml is unexpected."),
    (200, "text/xml", "<r><!-- a -- b --><status>ok</status></r>", "Response xml is unexpected."),
    (200, "text/xml", "<r><status>success</status></r><errorno/>", "Response xml is unexpected."),
    (None, "text/xml", "<r><status>ok</status></r>", "Status code is not 200."),
])
def test_response_status(spark, code, kind, body, reason):
    df = spark.createDataFrame([(code, kind, body)], "c int, k string, b string")
    assert responses.response_status(df, "c", "k", "b").first().response_error == reason


def python_status(code, kind, body):
    """The rules, with Python's parser."""
    if code != 200:
        return "Status code is not 200."
    if "xml" not in (kind or "").lower():
        return None
    try:
        root = ElementTree.fromstring(body or "")
    except ElementTree.ParseError:
        return "Response xml is unexpected."
    error, status = root.find(".//errorno"), root.find(".//status")
    if error is not None:
        return "Session expired." if error.text == "XL03000006" else "Response has an error."
    if status is None:
        return "Response missing status."
    return "Response failed status." if status.text == "failure" else None


def test_response_status_is_that_of_a_parser(spark):
    """Texts put together from parts that matter."""
    rng = random.Random(7)
    parts = ["<status>", "</status>", "<errorno>", "</errorno>", "<errorno/>", "<a>", "</a>", "failure", "XL03000006",
             "fail", "ure", "<![CDATA[failure]]>", "<![CDATA[<a>]]>", "<!-- c -->", "<!-- <errorno/> -->", "&#54;", "&lt;",
             "XL0300000", " ", "<status>failure</status>", "<status>ok</status>", "<a xmlns='u'>", "<x:a xmlns:x='u'/>"]
    texts = {f"<r>{''.join(rng.choices(parts, k=rng.randint(0, 5)))}</r>" for _ in range(1500)}
    df = spark.createDataFrame([(200, "xml", t) for t in texts], "c int, k string, b string")
    for r in responses.response_status(df, "c", "k", "b").collect():
        assert r.response_error == python_status(r.c, r.k, r.b), r.b


def test_field_identifiers_in_odd_markup(spark):
    bodies = [
        "<r><Field><ID><![CDATA[A]]></ID><ID>second</ID></Field></r>", "<r><Field><ID>A<!-- c -->B</ID></Field></r>",
        "<r><Field><ID>A<![CDATA[B]]></ID></Field></r>", "<r><Field><ID>A&amp;&#66;<x/>C</ID></Field></r>",
        "<r><Field><x><ID>deep</ID></x></Field></r>", "<r xmlns='u'><Field><ID>A</ID></Field></r>",
        "<r><![CDATA[<Field><ID>A</ID></Field>]]></r>", "<r><Field><ID/></Field></r>", "<r/><r/>", "<r>", "<Field><ID>1</ID></Field>",
        "<r><Field><ID>A</ID></Field></r><Field><ID>B</ID></Field>",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], ["b"])
    got = {}
    for r in responses.response_fields(df, "b").collect():
        got.setdefault(r.b, []).append((r.body_status, r.field_id))
    for body in bodies:
        try:
            found = [f.find("ID") for f in ElementTree.fromstring(body).findall(".//Field")]
        except ElementTree.ParseError:
            assert got[body] == [("unreadable", None)]
            continue
        if body.startswith("<Field"):  # the top element counts too
            found = [ElementTree.fromstring(body).find("ID")]
        ids = [("ok", i.text) for i in found if i is not None and i.text]
        assert got[body] == (ids or [("empty", None)]), body


def test_response_fields_and_items(spark):
    df = spark.createDataFrame(
        [("<r><Field><ID>A</ID></Field><x><Field><ID>B</ID></Field><Field/></x></r>",), ("bad",)],
        ["b"],
    )
    found = responses.response_fields(df, "b").collect()
    assert [(r.body_status, r.field_id) for r in found] == [
        ("ok", "A"), ("ok", "B"), ("unreadable", None),
    ]
    pages = spark.createDataFrame(
        [(1, '{"next":"u2","results":[{"url":"a"},{"url":"b"}]}'), (2, '{"next":null,"results":[]}'),
         (3, '{"next":null,"results":[{"url":"c"}]}')], ["n", "b"])
    got = responses.response_items(pages, "b").drop("b")
    assert rows(got) == [(1, False, "ok", "a"), (1, False, "ok", "b"), (2, True, "empty", None),
                         (3, True, "ok", "c")]
    bad = spark.createDataFrame([("{cut",), (None,)], "b string")
    assert {tuple(r)[1:] for r in responses.response_items(bad, "b").collect()} == {
        (None, "unreadable", None)
    }


@pytest.mark.parametrize("text", [
    "<r/>", "<r/>tail", "<a/><b/>", "<a></a><a></a>", "<a><a>1</a></a>", "<a><b></a>", "", "plain", None,
    '<?xml version="1.0"?>\n<!-- c --><a x="1">2</a>\n', "<a>&bad;</a>", "<a>1 &amp; 2</a>",
    "<a></a><a><b></a>", "<a", "<a>x</a >", "&amp;<a/>",
])
def test_well_formed_is_what_a_parser_says(spark, text):
    try:
        ElementTree.fromstring(text or "")
        expected = True
    except ElementTree.ParseError:
        expected = False
    df = spark.createDataFrame([(text,)], "b string")
    assert df.select(responses.well_formed(F.col("b"))).first()[0] is expected
