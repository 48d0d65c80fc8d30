import pytest
from pyspark.sql import functions as F

from tidemark.operators import mapping
from tidemark.operators.mapping import Rule, map_fields


def visit(spark):
    return spark.sql(
        """SELECT 'buy' AS kind, 'r' AS internal_run, 1 AS id, named_struct('visitor', u, 'guest', v, 'asked', 'tv', 'x', 'X', 'sent_by', 'h', 'deep',
           named_struct('z', 5)) AS details FROM VALUES ('u1', CAST(NULL AS STRING)), (CAST(NULL AS STRING), 'u2'), ('u1', 'u2') AS t(u, v)"""
    )


def test_copy_move_delete_keep_and_patterns(spark):
    rules = [
        Rule("/^internal_/", operation="delete"),
        Rule("kind", "kind_s", "copy"),
        Rule("details.asked", "asked_s", "copy"),
        Rule("details.asked", "asked_t", "move"),
        Rule("details.visitor", "person", "move"),
        Rule("details.guest", "person", "move"),
        Rule("id", "id", "keep"),
        Rule("/^details[.]([a-z.]+)$/", "visit.$1_s", "move"),
    ]
    out = map_fields(visit(spark), rules)
    assert set(out.columns) == {"kind", "id", "details.sent_by", "kind_s", "asked_s", "asked_t", "person", "visit.x_s", "visit.deep.z_s"}
    assert [r["person"] for r in out.collect()] == ["u1", "u2", "u1"]  # the first that is not null


def test_unmapped_rule_and_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert map_fields(df, [Rule("a", "a", "keep")], Rule("/./", operation="delete")).columns == ["a"]
    assert map_fields(df, [Rule("a", "z", "move"), Rule("a", "y", "copy")]).columns == ["b", "c", "z"]  # a is gone by then
    assert map_fields(df, [Rule("a", "y", "copy"), Rule("a", "z", "move")]).columns == ["b", "c", "y", "z"]
    assert map_fields(df, [], Rule("/^(.)$/", "$1_i", "move")).columns == ["a_i", "b_i", "c_i"]


def test_target_that_exists_keeps_its_value_first(spark):
    df = spark.createDataFrame([("old", "new"), (None, "new")], "a string, b string")
    assert [r["a"] for r in map_fields(df, [Rule("b", "a", "move")]).collect()] == ["old", "new"]


def test_multi_valued_and_mixed_types(spark):
    df = spark.createDataFrame([(44.9, -93.2, "a", 1), (None, -93.2, None, 2)], "home_north double, home_east double, p string, q int")
    rules = [
        Rule("/^([a-z]+)_north$/", "$1_lat_lon", "move"), Rule("/^([a-z]+)_east$/", "$1_lat_lon", "move"),
        Rule("p", "r", "move"), Rule("q", "r", "move"),
    ]
    rows = map_fields(df, rules).collect()
    assert [r["home_lat_lon"] for r in rows] == [[44.9, -93.2], [-93.2]]
    assert [r["r"] for r in rows] == ["a", "2"]


def test_bad_rules():
    with pytest.raises(ValueError):
        Rule("a", "b", "swap")
    with pytest.raises(ValueError):
        Rule("a", operation="move")


def test_one_projection(spark):
    plan = map_fields(visit(spark), [Rule("kind", "kind_s", "copy"), Rule("details.asked", "q", "move")])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") <= 1


def test_suffix_names(spark):
    df = spark.sql("SELECT 'abc' AS s, repeat('x', 101) AS long, 1 AS i, 2L AS l, 1.5D AS d, true AS b, array('p') AS tags, 'k' AS done_s, 9 AS id")
    out = mapping.suffix_names(df)
    assert out.columns == ["s_s", "s_t", "long_s", "long_t", "i_i", "l_l", "d_d", "b_b", "tags_ss", "done_s", "id"]
    row = out.first()
    assert row["long_s"] is None and len(row["long_t"]) == 101 and row["s_s"] == "abc"


def test_suffixes_of_other_types(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(9,2)) AS price, CAST(2 AS SHORT) AS sh, map('a', 1) AS m, named_struct('x', 1) AS st, 'u' AS url_is, array(1.5) AS ps, X'41' AS raw")
    out = mapping.suffix_names(df)
    assert out.columns == ["price_d", "sh_i", "m_s", "m_t", "st_s", "st_t", "url_is_s", "url_is_t", "ps_dd", "raw_s", "raw_t"]
    assert tuple(out.first()) == (1.5, 2, '{"a":1}', '{"a":1}', '{"x":1}', '{"x":1}', "u", "u", [1.5], "A", "A")


def test_signals(spark):
    df = spark.createDataFrame([(None, '{"docId":"d1","count":2}'), ("click", '{"docId":"d2"}'), ("other", "{}")], "type string, params string")
    out = mapping.format_signals(df, params_schema="docId string, count int", allowed_types=["general", "click"])
    assert sorted(tuple(r) for r in out.collect()) == [("click", "d2", None), ("general", "d1", 2)]


def test_mark_clicks_and_pairs(spark):
    df = spark.createDataFrame([("s", "a"), ("", "a"), (None, "a"), ("s", None)], "song string, artist string")
    assert [r["doc_id_s"] for r in mapping.mark_clicks(df, "song", "artist").collect()] == ["a-s", None, None, None]
    pairs = df.select(mapping.to_pairs(df).alias("p")).collect()
    assert [(p["name"], p["value"]) for p in pairs[3]["p"]] == [("song", "s")]


def test_json_field(spark):
    df = spark.createDataFrame([('{"LOC":["Rome","Oslo"]}',), ("{}",), (None,)], "j string")
    out = mapping.parse_json_field(df, "j", {"LOC": "location", "PER": "person"}).collect()
    assert out[0]["location"] == ["Rome", "Oslo"] and out[0]["person"] is None and out[1]["location"] is None


def test_row_id_and_reshape(spark):
    df = mapping.with_row_id(spark.range(100).repartition(5).withColumnRenamed("id", "n"))
    assert df.select("id").distinct().count() == 100
    out = mapping.reshape(df, add={"m": F.col("n") + 1}, drop=["id"], rename={"n": "k"})
    assert out.columns == ["k", "m"]
