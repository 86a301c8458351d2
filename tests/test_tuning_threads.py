import threading

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallyframe.operators import evaluate as E
from tallyframe.operators import models as M
from tallyframe.operators import tuning as U

KEY = "tallyframe.test"


def test_jobs_have_properties_of_their_own(spark):
    """What one thread sets or clears, the others don't see."""
    together, properties = threading.Barrier(2), spark.sparkContext

    def job(name):
        def run():
            properties.setLocalProperty(KEY, name)
            together.wait(30)
            seen = properties.getLocalProperty(KEY)
            together.wait(30)
            return seen

        return run

    assert U.in_threads(spark, [job("a"), job("b")], 2) == ["a", "b"]


def test_sweep_threads_do_not_share_properties(spark):
    together, sc, rows = threading.Barrier(2), spark.sparkContext, spark.range(4)
    seen = []

    class Same:
        def transform(self, df):
            return df

    def train_one(df, name):
        sc.setLocalProperty(KEY, name)
        together.wait(30)
        seen.append((name, sc.getLocalProperty(KEY)))
        together.wait(30)
        return Same()

    U.sweep(rows, rows, [{"name": "a"}, {"name": "b"}], train_one, lambda df: df.agg(F.count("*")), parallelism=2)
    assert sorted(seen) == [("a", "a"), ("b", "b")]


def test_folds_as_sparks_tuner(spark):
    """The metrics of Spark's own tuners, run one fit at a time."""
    from pyspark.ml.tuning import CrossValidator, TrainValidationSplit

    rows = spark.createDataFrame([(float(i % 7), float(i * 37 % 11), float(i * i % 5 < 2)) for i in range(300)], "a double, b double, label double")
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows.coalesce(1))
    tree, grid, evaluator = M.tree_classifier(), {"maxDepth": [1, 4], "maxBins": [4, 12]}, E.binary_evaluator()
    maps = U.param_maps(tree, grid)
    more = {"estimator": tree, "estimatorParamMaps": maps, "evaluator": evaluator, "seed": 17, "parallelism": 1}
    model, trials = U.train_validation([], tree, grid, evaluator, rows)
    assert [r.metric for r in trials.orderBy("trial").collect()] == TrainValidationSplit(trainRatio=0.8, **more).fit(rows).validationMetrics
    model, trials = U.cross_validation([], tree, grid, evaluator, rows)
    assert [r.metric for r in trials.orderBy("trial").collect()] == CrossValidator(numFolds=3, **more).fit(rows).avgMetrics
    assert model.transform(rows).count() == 300
