import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyframe.sources import layouts, sinks, text


def put(folder, name, content):
    path = folder / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_lines_keep_blank_ones(spark, tmp_path):
    lines = text.read_lines(spark, put(tmp_path, "a.txt", "one\n\ntwo  2\n"))
    assert sorted(r.value for r in lines.collect()) == ["", "one", "two  2"]


def test_every_line_equal_to_the_header_goes(spark, tmp_path):
    lines = text.read_lines(spark, put(tmp_path, "a.txt", "h,x\n1,2\nh,x\n3,4\n"))
    assert sorted(r.value for r in text.strip_header(lines).collect()) == ["1,2", "3,4"]


def test_header_of_no_lines(spark):
    none = spark.createDataFrame([], "value string")
    assert text.strip_header(none).count() == 0


def test_quotes_go_before_the_split(spark):
    df = spark.createDataFrame([('"a,b","c"',)], "value string")
    (row,) = df.select(text.split_fields(text.strip_quotes(), ",").alias("a")).collect()
    assert row.a == ["a", "b", "c"]


@pytest.mark.parametrize("sep", ["|", "\t", ",", "."])
def test_separator_is_literal_and_trailing_fields_stay(spark, sep):
    df = spark.createDataFrame([(sep.join(["a", "", "b", ""]),)], "value string")
    assert df.select(text.split_fields("value", sep).alias("a")).first().a == ["a", "", "b", ""]


def test_positional_columns_follow_the_first_record(spark, tmp_path):
    path = put(tmp_path, "a.csv", "1,2,3\n4,5,6\n")
    for df in (text.positional_fields(text.read_lines(spark, path), ","), text.read_positional(spark, path)):
        assert df.columns == ["f0", "f1", "f2"]
        assert sorted(map(tuple, df.collect())) == [("1", "2", "3"), ("4", "5", "6")]


def test_users_and_zipcodes(spark, tmp_path):
    users = layouts.load_users(spark, put(tmp_path, "u", "7|57|M|administrator|91344\n8|36|M|student|T8H1N\n"))
    assert sorted(map(tuple, users.collect())) == [
        (7, 57, "M", "administrator", "91344"), (8, 36, "M", "student", "T8H1N"),
    ]
    zips = layouts.load_zipcodes(
        spark, put(tmp_path, "z", '"Zipcode","ZipCodeType","City","State","Lat"\n"00704","STANDARD","A, B","PR",1.5\n')
    )
    assert zips.first().asDict() == {"zipcode": 704, "zipCodeType": "STANDARD", "city": "A, B", "state": "PR"}


def test_ratings_and_titles(spark, tmp_path):
    ratings = layouts.load_ratings(spark, put(tmp_path, "r", "1\t2\t5\t874965758\n"))
    assert tuple(ratings.first()) == (1, 2, 5.0)
    titles = layouts.load_titles(spark, put(tmp_path, "t", "2|Some Film (1995)|01-Jan-1995||http://x|0|1\n"))
    assert tuple(titles.first()) == (2, "Some Film (1995)")


def test_pages_cover_hours(spark, tmp_path):
    page = '"url"\t"id"\t"text"\t"alchemy_category"\t"score"\t"label"\n"u"\t"1"\t"t"\t"arts"\t"?"\t"1"\n'
    assert tuple(layouts.load_pages(spark, put(tmp_path, "p", page)).first()) == ("u", "arts", 0.0, 1.0)
    assert tuple(layouts.load_cover(spark, put(tmp_path, "c", "3,4,7\n")).first()) == (3.0, 4.0, 6.0)
    head = "instant,dteday,season,yr,mnth,hr,casual,registered,cnt"
    hours = layouts.load_hourly(spark, put(tmp_path, "h", head + "\n1,2011-01-01,1,0,1,5,3,13,16\n"))
    assert hours.columns == ["season", "mnth", "hr", "cnt"]
    assert tuple(hours.first()) == (1.0, 1.0, 5.0, 16.0)


def test_existing_output_is_kept(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("a", 1)], "w string, n int")
    assert sinks.write_lines_once(df, path, ["w", "n"])
    assert not sinks.write_lines_once(df.withColumn("n", F.lit(2)), path, ["w", "n"])
    assert [r.value for r in text.read_lines(spark, path).collect()] == ["a\t1"]
    with pytest.raises(AnalysisException):
        sinks.write_lines(df, path, ["w"])


def test_other_write_errors_are_raised(spark, tmp_path):
    with pytest.raises(AnalysisException):
        sinks.write_lines_once(spark.range(1), str(tmp_path / "x"), ["absent"])


def test_width_of_the_first_record(spark, tmp_path):
    found = text.read_positional(spark, put(tmp_path, "w", '"a, b",c\nd,"e, f"\n'))
    assert list(map(tuple, found.collect())) == [("a, b", "c"), ("d", "e, f")]
    empty = text.read_positional(spark, put(tmp_path, "none", ""))
    assert empty.columns == [] and empty.count() == 0
