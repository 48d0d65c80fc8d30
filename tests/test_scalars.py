import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, geo, scalars as s, text


def one(spark, col, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(col.alias("y")).first()["y"]


@pytest.mark.parametrize("given,want", [("3.9", 3), ("-3.9", -3), ("7", 7), ("x", None), (None, None)])
def test_to_int(spark, given, want):
    assert one(spark, s.to_int("x"), given) == want


def test_iso_has_three_digits(spark):
    assert one(spark, s.ms_to_iso("x"), 0, "bigint") == "1970-01-01T00:00:00.000Z"
    assert one(spark, s.ms_to_iso("x"), -1, "bigint") == "1969-12-31T23:59:59.999Z"


@pytest.mark.parametrize("given,want", [("x, y,z", ["x", "y", "z"]), ("x,", ["x"]), ("", []), (None, None), ("a,,b", ["a", "", "b"])])
def test_split_list(spark, given, want):
    assert one(spark, s.split_list("x"), given) == want


def test_split_list_pipe(spark):
    assert one(spark, s.split_list("x", "|"), "Drama|Sci-Fi||") == ["Drama", "Sci-Fi"]


def test_flags(spark):
    names = list("abc")
    df = spark.createDataFrame([("0", "1", "0"), ("0", "0", "0"), ("1", "1", "1"), (None, "1", "1")], "p string, q string, r string")
    assert [r[0] for r in df.select(s.flags_to_array(["p", "q", "r"], names)).collect()] == [["b"], [], ["a", "b", "c"], ["b", "c"]]
    with pytest.raises(ValueError):
        s.flags_to_array(["p"], names)


def test_relabel_and_id(spark):
    assert one(spark, s.relabel("x", {"5": "excellent"}), "5") == "excellent"
    assert one(spark, s.relabel("x", {"5": "excellent"}), "4") == "4"
    assert one(spark, s.make_id(["x", F.lit(None).cast("string"), F.lit(2)], "-"), "a") == "a-2"


def test_regex_group(spark):
    assert one(spark, s.regex_group("x", "([a-z]+)-([0-9]+)", 2), "north-east-17") == "17"
    assert one(spark, s.regex_group("x", "([a-z]+)-([0-9]+)", 2), "17") is None
    assert one(spark, s.regex_group("x", "k=(\\d+)", 1, "none"), "q") == "none"


def test_clean_control_chars(spark):
    assert one(spark, s.clean_control_chars("x"), "a\x00b\tc\x1fd\ne") == "a b\tc d\ne"


def test_hash_bucket_does_not_depend_on_partitions(spark):
    ids = spark.range(1000)
    a = ids.repartition(7).select("id", s.hash_bucket("id", 100, 3).alias("b"))
    assert a.exceptAll(ids.select("id", s.hash_bucket("id", 100, 3).alias("b"))).isEmpty()
    share = a.where("b < 30").count() / 1000
    assert 0.25 < share < 0.35


@pytest.mark.parametrize(
    "given,want",
    [
        ("Thursd, 3 Feb 2000 04:05:06 GMT", "2000-02-03T04:05:06.000Z"),
        ("9 Aug 88 21:30 EDT", "1988-08-10T01:30:00.000Z"),
        ("9 Aug 88 21:30:00 -0700 (-0700)", "1988-08-10T04:30:00.000Z"),
        ("04/20/93", "1993-04-20T00:00:00.000Z"),
        ("Sun, 2 May 99 08:09:10 EDT(-0500)", "1999-05-02T12:09:10.000Z"),
        ("7 Jul 95 18:00:01 +3000", "1995-07-07T14:00:01.000Z"),
        ("20 Apr 93 16:15 +0230", "1993-04-20T13:45:00.000Z"),
        ("Thursday 1 Jan  20", "1920-01-01T00:00:00.000Z"),
        ("1 Jan 19", "2019-01-01T00:00:00.000Z"),
        ("Apr 20, 1993", "1993-04-20T00:00:00.000Z"),
        ("1993-04-20 16:15:19", "1993-04-20T16:15:19.000Z"),
        ("Apr 20 16:15:19 93", "1993-04-20T16:15:19.000Z"),
        ("20 Apr 93 16:15:19 GMT+12", "1993-04-21T04:15:19.000Z"),
        ("20 Apr 93 (Tuesday)", "1993-04-20T00:00:00.000Z"),
        ("20 Jan 93 16:15:19 (pst)", "1993-01-21T00:15:19.000Z"),
        ("31 Apr 93", None),
        ("20 Xyz 93", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, given, want):
    assert one(spark, s.iso(dates.normalize_date("x")), given) == want


def test_distance_and_box(spark):
    point = (44.9609, -93.2642)
    rows = spark.createDataFrame([(44.9609, -93.2642), (45.9609, -93.2642), (90.0, 0.0), (0.0, -180.0)], "lat double, lon double")
    km = [r[0] for r in rows.select(geo.distance_km("lat", "lon", point)).collect()]
    assert km[0] == 0 and abs(km[1] - 111.195) < 0.01 and km[2] > 4000
    assert abs(rows.where("lat = 0").select(geo.distance_km("lat", "lon", (0.0, 180.0))).first()[0]) < 1e-6


@pytest.mark.parametrize("point", [(0.0, 0.0), (44.96, -93.26), (89.7, 10.0), (-89.9, -170.0), (10.0, 179.9), (0.0, -180.0)])
@pytest.mark.parametrize("km", [1.0, 50.0, 900.0])
def test_box_never_loses_a_point(spark, point, km):
    grid = spark.sql(
        "SELECT CAST(y AS DOUBLE) / 2 AS lat, CAST(x AS DOUBLE) / 2 AS lon FROM (SELECT explode(sequence(-180, 180)) AS y) "
        "LATERAL VIEW explode(sequence(-360, 360)) AS x"
    )
    near = grid.where(geo.distance_km("lat", "lon", point) <= km)
    assert near.where(~geo.bounding_box("lat", "lon", point, km)).isEmpty()


def test_tokens(spark):
    assert one(spark, text.tokens("x"), "Love, actually: 2nd été!") == ["love", "actually", "2nd", "été"]
    assert one(spark, text.tokens("x", "whitespace"), " Love,  it ") == ["Love,", "it"]
    assert one(spark, text.tokens("x", "standard_stop"), "The love of it") == ["love"]
    assert one(spark, text.tokens("x", "html_standard_stop"), "<p class='a'>Love<script>var the;</script> &amp; war</p>") == ["love", "war"]
    assert one(spark, text.tokens("x"), None) == []
    assert one(spark, text.analyze(["x"], prefix=True), "a b") == ["x_a", "x_b"]
    with pytest.raises(ValueError):
        text.tokens("x", "klingon")


@pytest.mark.parametrize("given,want", [("Love, actually", True), ("glove", False), ("LOVE", True), ("in love", True), ("loved", False), (None, None)])
def test_has_term(spark, given, want):
    assert one(spark, text.has_term("x", "Love"), given) == want


def test_sentences(spark):
    assert one(spark, text.sentences("x"), "One. Two!  Three\nFour 3.5 ?") == ["One.", "Two!", "Three", "Four 3.5 ?"]
