import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from tallyframe.functions import columns as C
from tallyframe.operators import relational as R
from tallyframe.operators import text as X


def test_mixed_type_key(spark):
    u = spark.createDataFrame([("00704",), ("T8H1N",), ("99999",), (None,)], "zipcode string")
    z = spark.createDataFrame([(704, "PR"), (10, "NY")], "zipcode int, state string")
    got = R.left_join_numeric_key(u, z, "zipcode").select("udf.zipcode", "state").collect()
    assert {tuple(r) for r in got} == {("00704", "PR"), ("T8H1N", None), ("99999", None), (None, None)}


def test_filter_on_the_nullable_side_is_an_inner_join(spark, tables):
    tables.users().createOrReplaceTempView("u")
    tables.zipcodes().createOrReplaceTempView("z")
    df = spark.sql(
        "SELECT u.* FROM u LEFT JOIN z ON try_cast(u.zipcode AS int) = z.zipcode WHERE z.state = 'NATION_7'"
    )
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Inner" in plan and "LeftOuter" not in plan


def test_a_hot_key_keeps_all_rows(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "7").otherwise(F.col("id").cast("string")).alias("k"))
    right = spark.createDataFrame([(7, "seven"), (8, "eight")], "k int, name string")
    joined = R.left_join_numeric_key(left, right, "k")
    assert joined.count() == 3000
    assert joined.filter("name = 'seven'").count() == 1000 + 1  # the hot key and id 7 itself


def test_crosstab(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "r string, c string")
    table = R.crosstab(df, "r", "c")
    assert table.columns == ["r_c", "x", "y"]
    assert sorted(map(tuple, table.collect())) == [("a", 2, 0), ("b", 0, 1)]
    assert R.crosstab(df, "r", "c", ["y"]).columns == ["r_c", "y"]


def test_crosstab_counts_null_columns(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", None)], "r string, c string")
    ours = {tuple(r) for r in R.crosstab(df, "r", "c").select("r_c", "null", "x").collect()}
    assert ours == {tuple(r) for r in df.stat.crosstab("r", "c").select("r_c", "null", "x").collect()}


def test_share_sums_to_a_hundred(spark, tables):
    rows = R.group_share(tables.users(), "occupation").collect()
    assert sum(r.percent for r in rows) == pytest.approx(100)


def test_lookup_and_missing_keys(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    table = spark.createDataFrame([(2, "two")], "code int, text string")
    assert [tuple(r) for r in R.lookup(df, table, "k", "code").collect()] == [(2, "two")] * 2
    assert [r.k for r in R.missing_keys(df, table, "k", "code").collect()] == [1]
    with pytest.raises(KeyError):
        R.require_keys(df, table, "k", "code")
    R.require_keys(df.filter("k = 2"), table, "k", "code")


def test_extents_of_null_column(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 4.0)], "a double, b double")
    got = {r.name: r for r in R.extents(df, "a", "b").collect()}
    assert got["a"].mean is None and got["b"].spread == 3.0


def test_missing_token(spark):
    df = spark.createDataFrame([("?",), ("2.5",), (None,)], "v string")
    assert [r[0] for r in df.select(C.missing_to_zero("v")).collect()] == [0.0, 2.5, None]
    junk = spark.createDataFrame([("x",)], "v string")
    assert junk.select(C.missing_to_zero("v", lenient=True)).first()[0] is None
    with pytest.raises(NumberFormatException):
        junk.select(C.missing_to_zero("v")).collect()


def test_clamp_and_codes(spark):
    df = spark.createDataFrame([(-1.0, 0), (2.0, 1), (None, 9)], "v double, k int")
    assert [r[0] for r in df.select(C.clamp_nonnegative("v")).collect()] == [0.0, 2.0, None]
    assert [r[0] for r in df.select(C.code_to_text("k", {0: "no", 1: "yes"})).collect()] == ["no", "yes", None]


def test_residuals_cut_the_prediction(spark):
    df = spark.createDataFrame([(3.0, 3.9), (3.0, 5.2)], "label double, prediction double")
    got = df.select(C.absolute_error("label", "prediction"), C.is_hit("label", "prediction")).collect()
    assert [tuple(r) for r in got] == [(0.0, True), (2.0, False)]


def test_two_ways_to_split_words(spark):
    lines = spark.createDataFrame([("a  b ",), ("\tb\r\fc",), ("",)], "value string")
    space = {r.word: r.counts for r in X.word_count(lines).collect()}
    assert space == {"a": 1, "": 3, "b": 1, "\tb\r\fc": 1}
    assert {r.word: r.counts for r in X.word_count(lines, X.token_words).collect()} == {"a": 1, "b": 2, "c": 1}
    assert X.vocabulary_size(lines).first()[0] == 4


def test_filters_and_columns_reach_the_scan(spark, tables):
    df = tables("customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_pair_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", None), (None, 1), (None, None)], "x string, y int")
    rows = {(r["x"], r["y"]): (r["counts"], r["x_counts"], r["y_counts"]) for r in R.pair_counts(df, "x", "y").collect()}
    assert rows == {("a", 1): (2, 3, 3), ("a", None): (1, 3, 2), (None, 1): (1, 2, 3), (None, None): (1, 2, 2)}
    assert R.pair_counts(df.limit(0), "x", "y").count() == 0


def test_crosstab_of_too_many_values(spark):
    df = spark.range(20).select(F.lit("a").alias("x"), F.col("id").alias("y"))
    before = spark.conf.get("spark.sql.pivotMaxValues")
    spark.conf.set("spark.sql.pivotMaxValues", "19")
    try:
        with pytest.raises(ValueError, match="pair_counts"):
            R.crosstab(df, "x", "y")
        assert len(R.crosstab(df, "x", "y", values=range(20)).columns) == 21
        assert len(R.crosstab(df.filter("id > 0"), "x", "y").columns) == 20
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", before)
