import random

import pytest
from pyspark.sql import functions as F

from tallyframe import jobs
from tallyframe.operators import evaluate as E
from tallyframe.operators import gradient as G
from tallyframe.operators import models as M


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng, at = random.Random(12), tmp_path_factory.mktemp("files")
    pages = ['"url"\t"id"\t"text"\t"alchemy_category"\t"score"\t"size"\t"label"']
    for i in range(300):
        size = rng.randint(1, 100)
        score = "?" if i % 9 == 0 else str(rng.random())
        fields = [f"http://p{i}", str(i), "t", rng.choice(["arts", "news", "?"]), score, str(size), str(int(size > 50))]
        pages.append("\t".join(f'"{f}"' for f in fields))
    (at / "labelled.tsv").write_text("\n".join(pages) + "\n")
    bare = ["\t".join(line.split("\t")[:-1]) for line in pages]
    (at / "unlabelled.tsv").write_text("\n".join(bare) + "\n")
    cover = [(rng.randint(0, 9), rng.randint(0, 9), i) for i in range(200)]
    (at / "records.csv").write_text("".join(f"{a},{b},{i},{1 + a // 4}\n" for a, b, i in cover))
    head = "instant,dteday,season,yr,hr,casual,registered,cnt\n"
    (at / "hours.csv").write_text(head + "".join(f"{i},d,1,0,{i % 24},1,2,{10 * (i % 24) + i % 3}\n" for i in range(300)))
    ratings = [(u, i, 1 + (u * i) % 5, 1000 + u) for u in range(1, 31) for i in range(1, 26)]
    rng.shuffle(ratings)
    (at / "ratings.tsv").write_text("".join("\t".join(map(str, r)) + "\n" for r in ratings))
    (at / "ordered.tsv").write_text("".join("\t".join(map(str, (n, *r))) + "\n" for n, r in enumerate(ratings)))
    (at / "items.txt").write_text("".join(f"{i}|film {i}|x\n" for i in range(1, 26)))
    (at / "text").write_text("a b\na  a\n")
    return at


def test_page_jobs(spark, folder):
    path = str(folder / "labelled.tsv")
    done = jobs.classify_pages(spark, path, M.tree_classifier("entropy", 5, 5))
    assert done.metric.first()[0] == pytest.approx(E.binary_evaluator().evaluate(done.scored)) and done.metric.first()[0] > 0.7
    told = jobs.describe_pages(spark, str(folder / "unlabelled.tsv"), done.model)
    assert told.count() == 300 and told.filter("description IS NULL").count() == 0
    assert jobs.classify_pages_linearly(spark, path).metric.first()[0] > 0.8
    assert jobs.classify_pages_linearly(spark, path, G.svm_sgd).metric.first()[0] > 0.7
    assert jobs.classify_pages_by_bayes(spark, path, 1.0).metric.first()[0] >= 0.4


def test_sweep(spark, folder):
    done = jobs.sweep_page_trees(spark, str(folder / "labelled.tsv"), {"impurity": ["gini"], "depth": [1, 3], "bins": [10]})
    assert done.trials.count() == 2
    assert done.best().stages


def test_cover_and_rentals(spark, folder):
    cover = jobs.classify_cover(spark, str(folder / "records.csv"))
    assert cover.metric.first()[0] > 0.9
    told = jobs.describe_cover(cover.scored)
    assert told.columns == ["海拔", "方位", "斜率", "label", "prediction", "hit"]
    assert told.filter("hit").count() == cover.scored.filter("label = prediction").count()
    rentals = jobs.predict_rentals(spark, str(folder / "hours.csv"))
    assert rentals.metric.first()[0] < 30
    told = jobs.describe_rentals(rentals.scored.withColumn("temp", F.lit(0.5)))
    assert told.filter("season = '春' AND temp = 20.5").count() == told.count() > 0
    assert told.filter("error IS NULL").count() == 0


def test_recommender(spark, folder, tmp_path):
    model = str(tmp_path / "model")
    assert jobs.train_recommender(spark, str(folder / "ratings.tsv"), model, blocks=2)
    assert not jobs.train_recommender(spark, str(folder / "ratings.tsv"), model, blocks=2)
    items = jobs.recommend(spark, model, str(folder / "items.txt"), user=7).collect()
    assert len(items) == 10 and all(r.title == f"film {r.item}" for r in items)
    assert jobs.recommend(spark, model, str(folder / "items.txt"), item=3, k=4).count() == 4
    with pytest.raises(ValueError):
        jobs.recommend(spark, model, str(folder / "items.txt"))


def test_split_files(spark, folder):
    ratings = jobs.load_ordered_ratings(spark, str(folder / "ordered.tsv"))
    parts = jobs.split_ratings(ratings, ["position"])
    whole = sorted(ratings.collect())
    for name in ("fold1", "fold5", "first", "second"):
        test, base = parts[f"{name}.test"].collect(), parts[f"{name}.base"].collect()
        assert sorted(test + base) == whole
        assert [(r.user, r.item) for r in test] == sorted((r.user, r.item) for r in test)
    assert parts["fold2.test"].count() == 150
    assert parts["first.test"].count() == 300 and parts["second.test"].count() == 300


def test_words(spark, folder, tmp_path):
    out = str(tmp_path / "counts")
    assert jobs.count_words(spark, str(folder / "text"), out)
    assert not jobs.count_words(spark, str(folder / "text"), out)
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["\t1", "a\t3", "b\t1"]


def test_user_views(spark, tmp_path):
    (tmp_path / "u").write_text("1|24|M|technician|00501\n2|30|F|other|T8H1N\n")
    (tmp_path / "z").write_text('"Zipcode","Type","City","State"\n"00501","UNIQUE","HOLTSVILLE","NY"\n')
    jobs.register_users(spark, str(tmp_path / "u"), str(tmp_path / "z"))
    rows = spark.sql(
        "SELECT z.state, count(*) counts FROM user_table u LEFT JOIN zipcode_table z "
        "ON try_cast(u.zipcode AS int) = z.zipcode GROUP BY z.state"
    ).collect()
    assert {tuple(r) for r in rows} == {("NY", 1), (None, 1)}
