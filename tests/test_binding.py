import pytest

from sluice.functions.binding import bind_sql, check_not_empty, exclude_list, render_parameters, source_tables


def test_parameters_numeric_bound_predicates_substituted():
    text, args = render_parameters("SELECT SHA2(x, ${BITS}) FROM t WHERE ${F}", {"BITS": "256", "F": "a = 'b'"})
    assert text == "SELECT SHA2(x, :BITS) FROM t WHERE a = 'b'" and args == {"BITS": 256}


def test_missing_parameter_names_it_and_the_file():
    with pytest.raises(ValueError, match=r"my\.sql uses parameters without a value: EMAIL_FILTER"):
        render_parameters("SELECT 1 WHERE ${EMAIL_FILTER}", {"OTHER": 1}, "my.sql")


def test_placeholder_binding_identifier_boundary(spark):
    t = spark.createDataFrame([(1,)], "a int")
    tx = spark.createDataFrame([(2,)], "a int")
    df = bind_sql(spark, "SELECT a FROM __silver__.t UNION ALL SELECT a FROM __silver__.t_x",
                  {"silver": {"t": t, "t_x": tx}})
    assert sorted(r.a for r in df.collect()) == [1, 2]


def test_unresolved_placeholder_is_an_error(spark):
    t = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="__silver__.missing"):
        bind_sql(spark, "SELECT * FROM __silver__.missing", {"silver": {"t": t}})
    with pytest.raises(ValueError, match="__gold__.g"):
        bind_sql(spark, "SELECT * FROM __silver__.t JOIN __gold__.g", {"silver": {"t": t}})


def test_regex_braces_survive_binding(spark):
    t = spark.createDataFrame([("ACC12345678",), ("ACC1",)], "id string")
    df = bind_sql(spark, "SELECT id FROM __silver__.t WHERE id RLIKE '^ACC[0-9]{8}$'", {"silver": {"t": t}})
    assert [r.id for r in df.collect()] == ["ACC12345678"]


def test_binding_keeps_streams_streaming(spark, tmp_path):
    spark.createDataFrame([(1,)], "a int").write.parquet(str(tmp_path / "s"))
    s = spark.readStream.schema("a int").parquet(str(tmp_path / "s"))
    assert bind_sql(spark, "SELECT a FROM __bronze__.s", {"bronze": {"s": s}}).isStreaming


def test_empty_sql_detection():
    for text in ["", "   ", "-- only a comment"]:
        with pytest.raises(ValueError, match="holds no query"):
            check_not_empty(text, "x.sql")
    assert check_not_empty("-- c\nSELECT 1") == "-- c\nSELECT 1"


def test_source_tables_resolution():
    assert source_tables("g", {"source_tables": ["a", "b"]}) == ["a", "b"]
    assert source_tables("g", {"source_table": "a"}) == ["a"]
    assert source_tables("g", {}) == ["g"]


def test_exclude_list():
    assert exclude_list(" a, ,b ,") == ["a", "b"]
    assert exclude_list("") == [] and exclude_list(None) == []
    assert exclude_list(["x", " y "]) == ["x", "y"]


def test_parameters_inside_text_lists_and_names():
    """Only a number standing alone is bound; the rest is the text given."""
    text, args = render_parameters("SELECT 'v${N}', a_${SFX}, ${N} -- ${N}\nFROM t WHERE x IN ${L}",
                                   {"N": 256, "SFX": "1", "L": "('A1','B')"})
    assert text == "SELECT 'v256', a_1, :N -- 256\nFROM t WHERE x IN ('A1','B')" and args == {"N": 256}


def test_parameters_give_the_right_rows(spark):
    df = spark.createDataFrame([("A1", 1), ("B", 2), ("C", 3)], "x string, a_1 int")
    got = bind_sql(spark, "SELECT 'v${N}' AS v, a_${SFX} AS a FROM __silver__.t WHERE x IN ${L} AND a_1 < ${N}",
                   {"silver": {"t": df}}, {"N": "2", "SFX": "1", "L": "('A1','B')"}).collect()
    assert [tuple(r) for r in got] == [("v2", 1)]
