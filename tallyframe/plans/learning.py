"""Training, scoring and tuning queries."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.columns import PAGE_KINDS, cast_columns, clamp_nonnegative, shift_label
from tallyframe.operators import evaluate as E
from tallyframe.operators import features as V
from tallyframe.operators import gradient as G
from tallyframe.operators import models as M
from tallyframe.operators import tuning as U
from tallyframe.operators.splits import halves, hash_split, key_bucket
from tallyframe.plans import features as P
from tallyframe.plans.features import SCORED
from tallyframe.plans.registry import query
from tallyframe.plans.relational import HOURS, PAGES
from tallyframe.plans.splits import bucket_sql
from tallyframe.plans.tables import ALL_PAGES_SQL, HOUR_FEATURES, PAGE_NUMBERS, PAGES_SQL, VECTOR_SIZE, Tables
from tallyframe.session import staged
from tallyframe.sources.layouts import HOURLY_UNUSED

VECTOR_FEATURES = [f"f{i}" for i in range(VECTOR_SIZE)]


def two_parts(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """70/30 by key hash."""
    return halves(df, [key], 70)


def three_parts(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """80/10/10 by key hash."""
    parts = {"train": 80, "validation": 10, "test": 10}
    parted = hash_split(df, [key], parts)
    return tuple(parted.filter(F.col("part") == p).drop("part") for p in parts)


def page_stages() -> list:
    return V.category_stages("alchemy_category", PAGE_NUMBERS)


def clean_pages(t: Tables) -> DataFrame:
    """Page features, written once: fitting and scoring then do not scan the texts again."""
    return staged(P.clean_pages(t), "pages")


def classes(t: Tables) -> DataFrame:
    """Embedding values as features, classes from 0 as label."""
    last = f"f{VECTOR_SIZE}"
    return t.vectors().withColumn("label", shift_label(last)).drop(last)


def hourly(t: Tables) -> DataFrame:
    hours = t.hours()
    kept = [c for c in hours.columns if c not in HOURLY_UNUSED]
    return staged(cast_columns(hours.select("instant", *kept), kept), "hours")


def _page_scores(model, test: DataFrame) -> DataFrame:
    scored = M.describe(model.transform(test), PAGE_KINDS)
    score = vector_to_array("probability")[1] if "probability" in scored.columns else vector_to_array("rawPrediction")[1]
    return scored.select("url", "label", "prediction", F.round(score, 6).alias("score"), "description")


def _page_classifier(t: Tables, estimator, extra_stages: tuple = ()) -> DataFrame:
    train, test = two_parts(clean_pages(t), "url")
    return _page_scores(M.fit([*page_stages(), *extra_stages], estimator, train), test)


@query("cls_tree_binary")
def cls_tree_binary(t: Tables) -> DataFrame:
    return _page_classifier(t, M.tree_classifier("gini", 10, 14))


@query("cls_tree_binary_entropy")
def cls_tree_binary_entropy(t: Tables) -> DataFrame:
    return _page_classifier(t, M.tree_classifier("entropy", 5, 5))


@query("cls_forest")
def cls_forest(t: Tables) -> DataFrame:
    return _page_classifier(t, M.forest_classifier(10))


@query("cls_logistic")
def cls_logistic(t: Tables) -> DataFrame:
    return _page_classifier(t, M.logistic_classifier(), (V.scaler(),))


@query("cls_svm")
def cls_svm(t: Tables) -> DataFrame:
    return _page_classifier(t, M.svm_classifier(), (V.scaler(),))


def _class_scores(t: Tables, estimator) -> DataFrame:
    train, test = two_parts(classes(t), "vec_id")
    model = M.fit(V.numeric_stages(VECTOR_FEATURES), estimator, train)
    return model.transform(test).select("vec_id", "label", "prediction", (F.col("label") == F.col("prediction")).alias("hit"))


@query("cls_tree_multi")
def cls_tree_multi(t: Tables) -> DataFrame:
    return _class_scores(t, M.tree_classifier("gini", 5, 20))


@query("cls_tree_multi_entropy")
def cls_tree_multi_entropy(t: Tables) -> DataFrame:
    return _class_scores(t, M.tree_classifier("entropy", 15, 50))


def _hour_scores(t: Tables, stages: list, estimator) -> DataFrame:
    train, test = two_parts(hourly(t), "instant")
    scored = M.fit(stages, estimator, train).transform(test)
    return E.residuals(scored, label="cnt").select("instant", "cnt", "prediction", "error", "hit")


@query("reg_tree")
def reg_tree(t: Tables) -> DataFrame:
    return _hour_scores(t, V.indexed_stages(HOUR_FEATURES, unseen="keep"), M.tree_regressor())


@query("reg_tree_variance")
def reg_tree_variance(t: Tables) -> DataFrame:
    return _hour_scores(t, V.numeric_stages(HOUR_FEATURES), M.tree_regressor(maxDepth=10, maxBins=100))


@query("reg_gbt")
def reg_gbt(t: Tables) -> DataFrame:
    return _hour_scores(t, V.indexed_stages(HOUR_FEATURES, unseen="keep"), M.boosted_regressor(maxDepth=5, maxBins=25, maxIter=10))


def pages_once(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The labelled pages and all of them, from one pass over the texts."""
    pages = staged(P.labelled_or_not(t), "pages")
    return pages.filter(F.col("label").isNotNull()), pages.drop("label")


@query("prd_scored")
def prd_scored(t: Tables) -> DataFrame:
    """A model of the labelled pages applied to every page; a category without labelled pages is one of its own."""
    stages = V.category_stages("alchemy_category", PAGE_NUMBERS, unseen="keep")
    labelled, pages = pages_once(t)
    model = M.fit(stages, M.tree_classifier("entropy", 5, 5), two_parts(labelled, "url")[0])
    return M.describe(model.transform(pages), PAGE_KINDS).select("url", "prediction", "description")


# Gradient steps in SQL: one CTE pair per step, weights start at 0.
def _descent_sql(slope: str, iterations: int, step: float, reg: float) -> str:
    names = PAGE_NUMBERS
    moments = ", ".join(f"({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () AS {c}" for c in names)
    ctes = [
        f"x AS MATERIALIZED (SELECT {moments}, label FROM pages_)",
        "w0 AS MATERIALIZED (SELECT " + ", ".join(f"CAST(0 AS DOUBLE) AS {c}" for c in names) + ")",
    ]
    for t in range(1, iterations + 1):
        margin = " + ".join(f"x.{c} * w.{c}" for c in names)
        ctes.append(
            f"m{t} AS MATERIALIZED (SELECT {slope.format(m='m', y='label')} AS slope, "
            + ", ".join(names)
            + f" FROM (SELECT {margin} AS m, label, {', '.join('x.' + c for c in names)} FROM x, w{t - 1} w))"
        )
        rate = f"({step!r} / sqrt({t}))"
        ctes.append(
            f"w{t} AS MATERIALIZED (SELECT "
            + ", ".join(f"w.{c} * (1 - {rate} * {reg!r}) - {rate} * g.{c} AS {c}" for c in names)
            + f" FROM w{t - 1} w, (SELECT "
            + ", ".join(f"sum(slope * {c}) / count(*) AS {c}" for c in names)
            + f" FROM m{t}) g)"
        )
    final = " UNION ALL ".join(f"SELECT '{c}' AS feature, round({c}, 6) AS weight FROM w{iterations}" for c in names)
    return PAGES + ", " + ", ".join(ctes) + " " + final


def _scaled_pages(t: Tables) -> DataFrame:
    return V.scaled_columns(clean_pages(t).select("url", *PAGE_NUMBERS, "label"), PAGE_NUMBERS)


@query("cls_logistic_sgd_fullbatch", _descent_sql("1 / (1 + exp(-{m})) - {y}", 15, 10.0, 0.01))
def cls_logistic_sgd_fullbatch(t: Tables) -> DataFrame:
    pages = _scaled_pages(t)
    model = G.logistic_sgd(pages, PAGE_NUMBERS, iterations=15, step=10.0, fraction=1.0, tolerance=0.0)
    return model.as_rows(pages).withColumn("weight", F.round("weight", 6))


@query(
    "cls_svm_sgd_fullbatch",
    _descent_sql("CASE WHEN (2 * {y} - 1) * {m} < 1 THEN -(2 * {y} - 1) ELSE 0 END", 3, 50.0, 1.0),
)
def cls_svm_sgd_fullbatch(t: Tables) -> DataFrame:
    pages = _scaled_pages(t)
    model = G.svm_sgd(pages, PAGE_NUMBERS, iterations=3, step=50.0, reg=1.0, tolerance=0.0)
    return model.as_rows(pages).withColumn("weight", F.round("weight", 6))


BAYES_FITTED = (
    PAGES
    + f""", parted AS (SELECT *, {bucket_sql('url')} < 70 AS train FROM pages_),
    spread AS (SELECT {', '.join(f'stddev_samp({c}) AS s_{c}' for c in PAGE_NUMBERS)} FROM parted WHERE train),
    scaled AS (SELECT url, label, train, {', '.join(f'{c} / s_{c} AS {c}' for c in PAGE_NUMBERS)} FROM parted, spread),
    sums AS (SELECT label, count(*) AS n, {', '.join(f'sum({c}) AS {c}' for c in PAGE_NUMBERS)}
             FROM scaled WHERE train GROUP BY label),
    totals AS (SELECT sum(n) AS n, count(*) AS k FROM sums),
    params AS (SELECT s.label, ln((s.n + 60.0) / (t.n + 60.0 * t.k)) AS pi,
               {', '.join(f"ln((s.{c} + 60.0) / (s.{' + s.'.join(PAGE_NUMBERS)} + 60.0 * {len(PAGE_NUMBERS)})) AS {c}" for c in PAGE_NUMBERS)}
               FROM sums s, totals t) """
)


def _bayes(pages: DataFrame):
    train, test = two_parts(pages.withColumns({c: clamp_nonnegative(c) for c in PAGE_NUMBERS}), "url")
    stages = [*V.numeric_stages(PAGE_NUMBERS), V.scaler(with_mean=False)]
    return M.fit(stages, M.bayes_classifier(60.0), train), train, test


@query(
    "cls_naive_bayes_params",
    BAYES_FITTED
    + " UNION ALL ".join(
        f"SELECT label, '{c}' AS feature, round(pi, 8) AS pi, round({c}, 8) AS theta FROM params" for c in PAGE_NUMBERS
    ),
)
def cls_naive_bayes_params(t: Tables) -> DataFrame:
    model, _, test = _bayes(clean_pages(t))
    rows = M.bayes_parameters(model.stages[-1], PAGE_NUMBERS, test)
    return rows.withColumns({"pi": F.round("pi", 8), "theta": F.round("theta", 8)})


@query(
    "cls_naive_bayes",
    BAYES_FITTED
    + f"""SELECT url, s.label AS label, arg_max(p.label, p.pi + {' + '.join(f's.{c} * p.{c}' for c in PAGE_NUMBERS)}) AS prediction
          FROM scaled s, params p WHERE NOT train GROUP BY url, s.label""",
)
def cls_naive_bayes(t: Tables) -> DataFrame:
    model, _, test = _bayes(clean_pages(t))
    return model.transform(test).select("url", "label", "prediction")


@query(
    "prd_scored_bayes",
    BAYES_FITTED
    + f"""SELECT url, prediction, CASE prediction WHEN 0 THEN '{PAGE_KINDS[0]}' WHEN 1 THEN '{PAGE_KINDS[1]}' END AS description
          FROM (SELECT url, arg_max(p.label, p.pi + {' + '.join(f's.{c} * p.{c}' for c in PAGE_NUMBERS)}) AS prediction
                FROM (SELECT url, {', '.join(f'{c} / s_{c} AS {c}' for c in PAGE_NUMBERS)} FROM ({ALL_PAGES_SQL}), spread) s,
                     params p GROUP BY url)""",
)
def prd_scored_bayes(t: Tables) -> DataFrame:
    labelled, pages = pages_once(t)
    model, _, _ = _bayes(labelled)
    pages = pages.withColumns({c: clamp_nonnegative(c) for c in PAGE_NUMBERS})
    return M.describe(model.transform(pages), PAGE_KINDS).select("url", "prediction", "description")


# One split: hours in the order of their mean count, cut where the variance falls most.
HOUR_ROOT = (
    HOURS
    + """, g AS (SELECT hr, count(*) AS n, sum(cnt) AS s FROM hours GROUP BY hr),
    o AS (SELECT hr, row_number() OVER w AS place, sum(n) OVER w AS ln, sum(s) OVER w AS ls
          FROM g WINDOW w AS (ORDER BY s::DOUBLE / n, hr)),
    t AS (SELECT sum(n) AS n, sum(s) AS s FROM g),
    b AS (SELECT place AS cut, ls::DOUBLE / ln AS low, (t.s - ls)::DOUBLE / (t.n - ln) AS high FROM o, t WHERE ln < t.n
          ORDER BY ls::DOUBLE * ls / ln + (t.s - ls)::DOUBLE * (t.s - ls) / (t.n - ln) DESC, place LIMIT 1)
    SELECT instant, cnt, round(CASE WHEN place <= cut THEN low ELSE high END, 6) AS prediction
    FROM hours JOIN o USING (hr), b"""
)


def _hour_root(t: Tables, estimator) -> DataFrame:
    hours = hourly(t)
    scored = M.fit(V.indexed_stages(["hr"]), estimator, hours).transform(hours)
    return scored.select("instant", "cnt", F.round("prediction", 6).alias("prediction"))


@query("reg_tree_root", HOUR_ROOT)
def reg_tree_root(t: Tables) -> DataFrame:
    return _hour_root(t, M.tree_regressor(maxDepth=1))


@query("reg_gbt_root", HOUR_ROOT)
def reg_gbt_root(t: Tables) -> DataFrame:
    return _hour_root(t, M.boosted_regressor(maxDepth=1, maxIter=1))


ROLES = ["assistant", "user", "system"]


def _role_root_sql(impurity: str) -> str:
    """One split on the turn number: the one whose separation lowers the impurity most.

    Spark merges two leaves that predict the same class, so such a split leaves the shares as they are.
    """

    def mixed(parts: list[str], size: str) -> str:
        return "(" + " + ".join(impurity.format(p=f"(({part}) / ({size}))") for part in parts) + ")"

    def top(parts: list[str]) -> str:
        return f"list_position([{', '.join(parts)}], greatest({', '.join(parts)}))"

    inside, all_ = [f"i{k}" for k in range(3)], [f"a{k}" for k in range(3)]
    outside = [f"a{k} - i{k}" for k in range(3)]
    counted = ", ".join(f"count(*) FILTER (role = '{r}')::DOUBLE AS i{k}" for k, r in enumerate(ROLES))
    summed = ", ".join(f"sum(i{k}) AS a{k}" for k in range(3))
    shares = ", ".join(
        f"round(CASE WHEN {top(inside)} = {top(outside)} THEN a{k} / a WHEN g.turn = c.turn THEN i{k} / i ELSE (a{k} - i{k}) / (a - i) END, 6) AS p_{r}"
        for k, r in enumerate(ROLES)
    )
    return f"""WITH g AS (SELECT turn, count(*)::DOUBLE AS i, {counted} FROM conversations GROUP BY turn),
    t AS (SELECT sum(i) AS a, {summed} FROM g),
    b AS (SELECT * FROM g, t
          ORDER BY i * {mixed(inside, 'i')} + (a - i) * {mixed(outside, 'a - i')} LIMIT 1)
    SELECT conv_id, c.turn, role, {shares} FROM conversations c, b g"""


def _role_root(t: Tables, impurity: str) -> DataFrame:
    turns = t("conversations").select(
        "conv_id", "turn", "role", F.col("turn").cast("string").alias("at"),
        (F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1).cast("double").alias("label"),
    )
    model = M.fit(V.category_stages("at", []), M.tree_classifier(impurity, depth=1), turns)
    shares = vector_to_array("probability")
    each = [F.round(shares[k], 6).alias(f"p_{r}") for k, r in enumerate(ROLES)]
    return model.transform(turns).select("conv_id", "turn", "role", *each)


@query("cls_tree_root_gini", _role_root_sql("(-{p} * {p})"))
def cls_tree_root_gini(t: Tables) -> DataFrame:
    return _role_root(t, "gini")


@query("cls_tree_root_entropy", _role_root_sql("(CASE WHEN {p} > 0 THEN -{p} * log2({p}) ELSE 0 END)"))
def cls_tree_root_entropy(t: Tables) -> DataFrame:
    return _role_root(t, "entropy")


def _with_test(trials: DataFrame, test_metric: float | None, larger: bool) -> DataFrame:
    """The trials, and beside the best one the score of its model on the test part."""
    best = U.best_trial(trials, larger_is_better=larger).first()["trial"]
    return trials.withColumn("test_metric", F.when(F.col("trial") == best, F.lit(test_metric).cast("double")))


def _search(tuner, stages: list, estimator, grid: dict, evaluator, parts: tuple) -> DataFrame:
    """All settings of ``grid`` on the training part."""
    model, trials = tuner(stages, estimator, grid, evaluator, parts[0])
    return _with_test(trials, evaluator.evaluate(model.transform(parts[1])), evaluator.isLargerBetter())


def _page_search(t: Tables, tuner, estimator, grid: dict) -> DataFrame:
    return _search(tuner, page_stages(), estimator, grid, E.binary_evaluator(), two_parts(clean_pages(t), "url"))


def _hour_search(t: Tables, tuner, estimator, grid: dict) -> DataFrame:
    stages = V.indexed_stages(HOUR_FEATURES, unseen="keep")
    return _search(tuner, stages, estimator, grid, E.rmse_evaluator("cnt"), two_parts(hourly(t), "instant"))


@query("tun_train_validation")
def tun_train_validation(t: Tables) -> DataFrame:
    return _page_search(t, U.train_validation, M.tree_classifier(), U.TREE_GRID)


@query("tun_cross_validation_pages")
def tun_cross_validation_pages(t: Tables) -> DataFrame:
    return _page_search(t, U.cross_validation, M.tree_classifier(), U.TREE_GRID)


@query("tun_forest")
def tun_forest(t: Tables) -> DataFrame:
    return _page_search(t, U.train_validation, M.forest_classifier(), U.FOREST_GRID)


@query("tun_forest_cross_validation")
def tun_forest_cross_validation(t: Tables) -> DataFrame:
    return _page_search(t, U.cross_validation, M.forest_classifier(), U.FOREST_GRID)


@query("tun_multiclass")
def tun_multiclass(t: Tables) -> DataFrame:
    stages, parts = V.numeric_stages(VECTOR_FEATURES), two_parts(classes(t), "vec_id")
    return _search(U.train_validation, stages, M.tree_classifier(), U.MULTICLASS_GRID, E.accuracy_evaluator(), parts)


@query("tun_train_validation_hours")
def tun_train_validation_hours(t: Tables) -> DataFrame:
    return _hour_search(t, U.train_validation, M.tree_regressor(), U.REGRESSION_GRID)


@query("tun_cross_validation")
def tun_cross_validation(t: Tables) -> DataFrame:
    return _hour_search(t, U.cross_validation, M.tree_regressor(), U.REGRESSION_GRID)


@query("tun_boosted")
def tun_boosted(t: Tables) -> DataFrame:
    return _hour_search(t, U.cross_validation, M.boosted_regressor(), U.BOOSTED_GRID)


def _sweep(parts: tuple, settings: list[dict], train_one, measure=E.auc_of_classes, larger: bool = True) -> DataFrame:
    """All settings of a tree on the training part, measured on the validation part."""
    train, validation, test = parts
    done = U.sweep(train, validation, settings, train_one, measure, 4, "depth")
    return _with_test(done.trials, measure(done.best(larger).transform(test)).first()[0], larger)


def _page_sweep(t: Tables, settings: list[dict]) -> DataFrame:
    return _sweep(three_parts(clean_pages(t), "url"), settings, lambda rows, **s: M.fit(page_stages(), M.tree_classifier(**s), rows))


def _class_sweep(t: Tables, settings: list[dict]) -> DataFrame:
    def train_one(rows: DataFrame, **setting):
        return M.fit(V.numeric_stages(VECTOR_FEATURES), M.tree_classifier(**setting), rows)

    return _sweep(three_parts(classes(t), "vec_id"), settings, train_one, E.accuracy)


def _hour_sweep(t: Tables, settings: list[dict]) -> DataFrame:
    def train_one(rows: DataFrame, depth: int, bins: int):
        return M.fit(V.numeric_stages(HOUR_FEATURES), M.tree_regressor(maxDepth=depth, maxBins=bins), rows)

    return _sweep(three_parts(hourly(t), "instant"), settings, train_one, lambda df: E.rmse(df, label="cnt"), larger=False)


def _without_impurity(d: dict) -> dict:
    return {k: v for k, v in d.items() if k != "impurity"}


@query("tun_sweep")
def tun_sweep(t: Tables) -> DataFrame:
    return _page_sweep(t, U.full_grid(U.TREE_SWEEP))


@query("tun_sweep_multiclass")
def tun_sweep_multiclass(t: Tables) -> DataFrame:
    return _class_sweep(t, U.full_grid(U.TREE_SWEEP))


@query("tun_sweep_hours")
def tun_sweep_hours(t: Tables) -> DataFrame:
    return _hour_sweep(t, U.full_grid(_without_impurity(U.TREE_SWEEP)))


@query("tun_vary_tree")
def tun_vary_tree(t: Tables) -> DataFrame:
    """One parameter at a time, the others fixed."""
    return _page_sweep(t, U.vary_each(U.TREE_AROUND, U.TREE_SWEEP))


@query("tun_vary_multiclass")
def tun_vary_multiclass(t: Tables) -> DataFrame:
    return _class_sweep(t, U.vary_each(U.TREE_AROUND, U.TREE_SWEEP))


@query("tun_vary_hours")
def tun_vary_hours(t: Tables) -> DataFrame:
    return _hour_sweep(t, U.vary_each(_without_impurity(U.TREE_AROUND), _without_impurity(U.TREE_SWEEP)))


def _steps_sql(slope: str, settings: list[dict], longest: int) -> str:
    """The gradient steps of all ``settings`` on one-hot categories and numbers, scaled as the training part is.

    ``path`` has the weights of every run after each step, ``last`` those of each setting at its end.
    """
    known = ", ".join(
        f"({i}, '{', '.join(f'{k}={v}' for k, v in s['shown'].items())}', {s['iterations']}, {float(s['step'])!r}::DOUBLE, "
        f"{s['reg']!r}::DOUBLE, {s['fraction']!r}::DOUBLE)"
        for i, s in enumerate(settings)
    )
    draw = bucket_sql("url || '|' || (t + 1)", G.DRAWS)
    return f"""WITH RECURSIVE pages_ AS ({PAGES_SQL}), parted AS (SELECT *, {bucket_sql('url')} AS b FROM pages_),
    named AS (SELECT list(alchemy_category ORDER BY n DESC, alchemy_category) AS names
              FROM (SELECT alchemy_category, count(*) AS n FROM parted WHERE b < 80 GROUP BY alchemy_category)),
    coded AS (SELECT url, label, b, list_concat(list_transform(names, lambda c: (c = alchemy_category)::INT::DOUBLE),
                     [{', '.join(PAGE_NUMBERS)}]) AS f FROM parted, named),
    long_ AS (SELECT url, label, b, unnest(f) AS v, unnest(range(1, len(f) + 1)) AS j FROM coded),
    moments AS (SELECT j, avg(v) AS m, stddev_samp(v) AS s FROM long_ WHERE b < 80 GROUP BY j),
    scaled AS MATERIALIZED (SELECT url, label, b, list(CASE WHEN s > 0 THEN (v - m) / s ELSE 0 END ORDER BY j) AS x
                            FROM long_ JOIN moments USING (j) GROUP BY url, label, b),
    settings (trial, params, iterations, step, reg, fraction) AS (VALUES {known}),
    path AS (
        SELECT DISTINCT step, reg, fraction, 0 AS t, list_transform(range((SELECT count(*) FROM moments)), lambda i: 0.0::DOUBLE) AS w,
               false AS stopped FROM settings
        UNION ALL
        SELECT step, reg, fraction, t + 1, list(new ORDER BY j),
               t > 0 AND sqrt(sum((new - old) * (new - old))) < 0.001 * greatest(sqrt(sum(new * new)), 1)
        FROM (SELECT step, reg, fraction, t, j, any_value(w[j]) AS old,
                     any_value(w[j]) * (1 - step / sqrt(t + 1) * reg) - step / sqrt(t + 1) * (sum(slope * x[j]) / count(*)) AS new
              FROM (SELECT step, reg, fraction, t, w, x, {slope.format(m='list_inner_product(x, w)', y='label')} AS slope,
                           unnest(range(1, len(w) + 1)) AS j
                    FROM path JOIN scaled ON b < 80 AND (fraction >= 1 OR {draw} < fraction * {G.DRAWS})
                    WHERE NOT stopped AND t < {longest})
              GROUP BY step, reg, fraction, t, j)
        GROUP BY step, reg, fraction, t),
    last AS (SELECT trial, params, max(t)::INT AS steps, arg_max(w, t) AS w
             FROM settings s JOIN path p ON s.step = p.step AND s.reg = p.reg AND s.fraction = p.fraction AND t <= iterations
             GROUP BY trial, params) """


LOGISTIC_SLOPE = "(1 / (1 + exp(-{m})) - {y})"
HINGE_SLOPE = "(CASE WHEN (2 * {y} - 1) * {m} < 1 THEN -(2 * {y} - 1) ELSE 0 END)"


def _descents(settings: list[dict]) -> list[dict]:
    return [{"reg": 0.01, "fraction": 1.0, **s, "shown": s} for s in settings]


def _sweep_sql(slope: str, settings: list[dict]) -> str:
    rates = " + ".join(
        f"avg((CASE WHEN list_inner_product(x, w) > 0 THEN 1 ELSE 0 END = label)::INT) FILTER (label = {c})" for c in (0, 1)
    )
    return (
        _steps_sql(slope, _descents(settings), max(s["iterations"] for s in settings))
        + f""", measured AS (SELECT trial, params, steps, w, ({rates}) / 2 AS metric FROM last, scaled
                            WHERE b >= 80 AND b < 90 GROUP BY trial, params, steps, w),
    best AS (SELECT trial, w FROM measured ORDER BY metric DESC NULLS LAST, trial LIMIT 1),
    tested AS (SELECT trial, ({rates}) / 2 AS test_metric FROM best, scaled WHERE b >= 90 GROUP BY trial)
    SELECT trial, params, steps, round(ln(1 + sqrt(list_inner_product(w, w))), 6) AS length, round(metric, 9) AS metric,
           round(test_metric, 9) AS test_metric FROM measured LEFT JOIN tested USING (trial)"""
    )


def _scaled_parts(t: Tables) -> tuple[tuple[DataFrame, ...], list[str]]:
    """Training, validation and test pages with one-hot categories and numbers as scaled columns."""
    parts = three_parts(clean_pages(t), "url")
    fitted = Pipeline(stages=[*page_stages(), V.scaler()]).fit(parts[0])
    names = [f"x{i}" for i in range(V.category_size(fitted) + len(PAGE_NUMBERS))]
    return tuple(V.unpack(fitted.transform(p).select("url", "label", "scaled"), "scaled", names) for p in parts), names


def _linear_sweep(t: Tables, settings: list[dict], slope) -> DataFrame:
    """All settings, their runs in lockstep."""
    (train, validation, test), names = _scaled_parts(t)
    asked = _descents(settings)
    runs = [G.Descent(s["iterations"], float(s["step"]), s["reg"], s["fraction"]) for s in asked]
    models = G.descend_all(train, names, slope, runs, key=["url"])
    measured = {r["trial"]: r["metric"] for r in G.auc_of_models(models, validation).collect()}
    rows = [
        (i, ", ".join(f"{k}={v}" for k, v in s["shown"].items()), m.steps, round(math.log1p(math.hypot(*m.weights)), 6), measured.get(i))
        for i, (s, m) in enumerate(zip(asked, models))
    ]
    trials = t.spark.createDataFrame(rows, "trial int, params string, steps int, length double, metric double")
    best = models[U.best_trial(trials).first()["trial"]]
    scored = G.auc_of_models([best], test).first()
    tested = _with_test(trials, scored["metric"] if scored else None, True)
    return tested.withColumns({c: F.round(c, 9) for c in ("metric", "test_metric")})


LOGISTIC_ALL, SVM_ALL = U.full_grid(U.LOGISTIC_SWEEP), U.full_grid(U.SVM_SWEEP)
LOGISTIC_VARIED, SVM_VARIED = U.vary_each(U.LOGISTIC_AROUND, U.LOGISTIC_SWEEP), U.vary_each(U.SVM_AROUND, U.SVM_SWEEP)


@query("tun_sweep_logistic", _sweep_sql(LOGISTIC_SLOPE, LOGISTIC_ALL))
def tun_sweep_logistic(t: Tables) -> DataFrame:
    return _linear_sweep(t, LOGISTIC_ALL, G.logistic_slope)


@query("tun_sweep_svm", _sweep_sql(HINGE_SLOPE, SVM_ALL))
def tun_sweep_svm(t: Tables) -> DataFrame:
    return _linear_sweep(t, SVM_ALL, G.hinge_slope)


@query("tun_vary_logistic", _sweep_sql(LOGISTIC_SLOPE, LOGISTIC_VARIED))
def tun_vary_logistic(t: Tables) -> DataFrame:
    return _linear_sweep(t, LOGISTIC_VARIED, G.logistic_slope)


@query("tun_vary_svm", _sweep_sql(HINGE_SLOPE, SVM_VARIED))
def tun_vary_svm(t: Tables) -> DataFrame:
    return _linear_sweep(t, SVM_VARIED, G.hinge_slope)


@query(
    "cls_logistic_sgd",
    _steps_sql(LOGISTIC_SLOPE, _descents([{"iterations": 15, "step": 10.0, "fraction": 0.5}]), 15)
    + "SELECT unnest(range(len(w)))::INT AS place, round(unnest(w), 6) AS weight FROM last",
)
def cls_logistic_sgd(t: Tables) -> DataFrame:
    """The usual settings: half of the rows per step, chosen by key and step, and categories among the features."""
    (train, _, _), names = _scaled_parts(t)
    weights = G.logistic_sgd(train, names, key=["url"]).weights
    return t.spark.createDataFrame(list(enumerate(weights)), "place int, weight double").withColumn("weight", F.round("weight", 6))


def _bayes_search_sql(parted: str, train: str, held: str, smoothings: list[float], score: str, average: str) -> str:
    """Closed-form class parameters per smoothing and round; ``held`` rows are predicted, the others train."""
    total = " + ".join(f"s.{c}" for c in PAGE_NUMBERS)
    size = len(PAGE_NUMBERS)
    thetas = ", ".join(f"ln((s.{c} + lam) / ({total} + lam * {size})) AS {c}" for c in PAGE_NUMBERS)
    return f"""{PAGES}, parted AS ({parted}),
    spread AS (SELECT {', '.join(f'stddev_samp({c}) AS s_{c}' for c in PAGE_NUMBERS)} FROM parted WHERE {train}),
    scaled AS (SELECT url, label, fold, {', '.join(f'{c} / s_{c} AS {c}' for c in PAGE_NUMBERS)} FROM parted, spread),
    lams AS (SELECT unnest(range({len(smoothings)}))::INT AS trial, unnest({smoothings}::DOUBLE[]) AS lam),
    rounds AS (SELECT unnest({held}) AS r),
    sums AS (SELECT r, label, count(*) AS n, {', '.join(f'sum({c}) AS {c}' for c in PAGE_NUMBERS)}
             FROM scaled, rounds WHERE fold <> r AND fold >= 0 GROUP BY r, label),
    totals AS (SELECT r, sum(n) AS n, count(*) AS k FROM sums GROUP BY r),
    params AS (SELECT trial, lam, s.r, s.label, ln((s.n + lam) / (t.n + lam * t.k)) AS pi, {thetas}
               FROM sums s JOIN totals t ON s.r = t.r, lams),
    predicted AS (SELECT trial, lam, x.fold, url, x.label,
                  arg_max(p.label, p.pi + {' + '.join(f'x.{c} * p.{c}' for c in PAGE_NUMBERS)}) AS prediction
                  FROM scaled x JOIN params p ON x.fold = p.r GROUP BY trial, lam, x.fold, url, x.label),
    measured AS (SELECT trial, lam, fold, {score} AS metric FROM predicted GROUP BY trial, lam, fold)
    SELECT trial, 'smoothing=' || lam AS params, round({average}, 9) AS metric FROM measured GROUP BY trial, lam"""


def _bayes_pages(t: Tables) -> DataFrame:
    return clean_pages(t).withColumns({c: clamp_nonnegative(c) for c in PAGE_NUMBERS})


@query(
    "tun_sweep_bayes",
    _bayes_search_sql(
        f"SELECT *, CASE WHEN {bucket_sql('url')} < 80 THEN 0 WHEN {bucket_sql('url')} < 90 THEN 1 ELSE -1 END AS fold FROM pages_",
        "fold = 0",
        "[1]",
        U.BAYES_SWEEP["smoothing"],
        """(avg(CASE WHEN label = 1 THEN (prediction = 1)::INT END)
            + avg(CASE WHEN label = 0 THEN (prediction = 0)::INT END)) / 2""",
        "max(metric)",
    ),
)
def tun_sweep_bayes(t: Tables) -> DataFrame:
    train, validation, _ = three_parts(_bayes_pages(t), "url")
    prepared = Pipeline(stages=[*V.numeric_stages(PAGE_NUMBERS), V.scaler(with_mean=False)]).fit(train)
    done = U.sweep(
        prepared.transform(train),
        prepared.transform(validation),
        U.full_grid(U.BAYES_SWEEP),
        lambda rows, smoothing: M.bayes_classifier(smoothing).fit(rows),
        E.auc_of_classes,
    )
    return done.trials.select("trial", "params", F.round("metric", 9).alias("metric"))


@query(
    "tun_cross_validation_bayes",
    _bayes_search_sql(
        f"SELECT *, {bucket_sql('url', 3)} AS fold FROM pages_", "true", "[0, 1, 2]", [1.0, 20.0, 60.0],
        "avg((prediction = label)::INT)", "avg(metric)",
    ),
)
def tun_cross_validation_bayes(t: Tables) -> DataFrame:
    pages = _bayes_pages(t).withColumn("fold", key_bucket("url", buckets=3))
    stages = [*V.numeric_stages(PAGE_NUMBERS), V.scaler(with_mean=False)]
    trials = U.cross_validation(
        stages, M.bayes_classifier(), {"smoothing": [1.0, 20.0, 60.0]}, E.accuracy_evaluator(), pages, fold_column="fold"
    )[1]
    return trials.withColumn("metric", F.round("metric", 9))


@dataclass(frozen=True)
class Threshold:
    """Predicts 1 above a fixed score."""

    limit: float

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", (F.col("score") > self.limit).cast("int"))


@query(
    "tun_best_trial",
    SCORED
    + """, trials AS (SELECT CAST(l // 20 - 1 AS INT) AS trial, 'limit=' || l AS params,
                     avg(CASE WHEN (score > l) = (label = 1) THEN 1.0 ELSE 0.0 END) AS metric
              FROM scored, (SELECT unnest(range(20, 201, 20)) AS l) GROUP BY l)
         SELECT trial, params, round(metric, 9) AS metric FROM trials ORDER BY metrics_key LIMIT 1""".replace(
        "metrics_key", "trials.metric DESC, trial"
    ),
)
def tun_best_trial(t: Tables) -> DataFrame:
    scored = t.scored()
    settings = U.full_grid({"limit": list(range(20, 201, 20))})
    trials = U.sweep(scored, scored, settings, lambda _, limit: Threshold(limit), E.accuracy).trials
    return U.best_trial(trials).select("trial", "params", F.round("metric", 9).alias("metric"))
