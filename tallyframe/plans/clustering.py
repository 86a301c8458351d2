"""k-means queries over the numeric line columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.operators import cluster as K
from tallyframe.operators.features import scaled_columns
from tallyframe.plans.registry import query
from tallyframe.plans.tables import LINE_NUMBERS, Tables

PAIR = ("l_quantity", "l_discount")
CENTERS = [(0.0, 0.02), (20.0, 0.05), (45.0, 0.08)]

_DISTANCES = [f"((l_quantity - {x!r}) * (l_quantity - {x!r}) + (l_discount - {y!r}) * (l_discount - {y!r}))" for x, y in CENTERS]
_NEAREST = f"least({', '.join(_DISTANCES)})"
_CLUSTER = "CASE " + " ".join(f"WHEN {d} = {_NEAREST} THEN {i}" for i, d in enumerate(_DISTANCES)) + " END"


@query(
    "clu_assign_fixed_centers",
    f"""SELECT l_orderkey, l_linenumber, l_quantity, l_discount, {_CLUSTER} AS cluster,
        round({_NEAREST}, 6) AS distance2 FROM lineitem""",
)
def clu_assign_fixed_centers(t: Tables) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", *PAIR)
    return K.assign(lines, PAIR, CENTERS).withColumn("distance2", F.round("distance2", 6))


@query("clu_sse_fixed_centers", f"SELECT round(sum({_NEAREST}), 3) AS sse FROM lineitem")
def clu_sse_fixed_centers(t: Tables) -> DataFrame:
    return K.squared_error(t("lineitem"), PAIR, CENTERS).select(F.round("sse", 3).alias("sse"))


KEYS = {c: f"key_{c}" for c in LINE_NUMBERS}


def _lines(t: Tables) -> DataFrame:
    """Scaled columns, and beside them their values as they are stored."""
    lines = t("lineitem").select(*LINE_NUMBERS, *[F.col(c).alias(k) for c, k in KEYS.items()])
    return scaled_columns(lines, LINE_NUMBERS)


def _runs_sql(pairs: list[tuple[str, str]], ks: list[int], starts: int = 10) -> str:
    """All runs; ``best`` has the cheapest of each pair and number of clusters, its centers as lists."""
    points = " UNION ALL ".join(
        f"""SELECT {i} AS pair, {x} || '|' || {y} AS key, ({x} - m_{x}) / s_{x} AS x, ({y} - m_{y}) / s_{y} AS y, n::DOUBLE AS w
            FROM (SELECT {x}, {y}, count(*) AS n FROM lineitem GROUP BY {x}, {y}), moments"""
        for i, (x, y) in enumerate(pairs)
    )
    columns = sorted({c for pair in pairs for c in pair})
    moments = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in columns)
    near = "list_transform(range(1, len(cx) + 1), lambda i: (x - cx[i]) * (x - cx[i]) + (y - cy[i]) * (y - cy[i]))"
    nearest = f"list_position({near}, list_min({near}))"
    return f"""WITH RECURSIVE moments AS (SELECT {moments} FROM lineitem),
    points AS MATERIALIZED ({points}),
    spreads AS (SELECT pair, (sum(w * x * x) / sum(w) - (sum(w * x) / sum(w)) ** 2 + sum(w * y * y) / sum(w) - (sum(w * y) / sum(w)) ** 2) / 2 AS variance
                FROM points GROUP BY pair),
    seeds AS (SELECT pair, start, x, y, row_number() OVER (PARTITION BY pair, start ORDER BY md5(key || '|' || start), key) AS place
              FROM points, (SELECT unnest(range({starts})) AS start)),
    path AS (
        SELECT pair, k, start, 0 AS t, list(x ORDER BY place) AS cx, list(y ORDER BY place) AS cy, false AS stopped
        FROM seeds JOIN (SELECT unnest({ks}) AS k) ON place <= k GROUP BY pair, k, start
        UNION ALL
        SELECT pair, k, start, t + 1, nx, ny,
               list_sum(list_transform(range(1, len(nx) + 1), lambda i: (nx[i] - cx[i]) ** 2 + (ny[i] - cy[i]) ** 2)) <= 1e-4 * variance
        FROM (SELECT pair, k, start, t, cx, cy, list_transform(range(1, len(cx) + 1), lambda i: coalesce(mx[i], cx[i])) AS nx,
                     list_transform(range(1, len(cx) + 1), lambda i: coalesce(my[i], cy[i])) AS ny
              FROM (SELECT pair, k, start, t, any_value(cx) AS cx, any_value(cy) AS cy, map(list(near), list(mx)) AS mx, map(list(near), list(my)) AS my
                    FROM (SELECT pair, k, start, t, near, any_value(cx) AS cx, any_value(cy) AS cy, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my
                          FROM (SELECT path.pair, k, start, t, cx, cy, x, y, w, {nearest} AS near FROM path JOIN points USING (pair)
                                WHERE NOT stopped AND t < 100)
                          GROUP BY pair, k, start, t, near)
                    GROUP BY pair, k, start, t))
        JOIN spreads USING (pair)),
    ended AS (SELECT pair, k, start, max(t) AS t, arg_max(cx, t) AS cx, arg_max(cy, t) AS cy FROM path GROUP BY pair, k, start),
    costs AS (SELECT pair, k, start, cx, cy, sum(w * list_min({near})) AS sse FROM ended JOIN points USING (pair) GROUP BY pair, k, start, cx, cy),
    best AS (SELECT pair, k, arg_min(cx, sse) AS cx, arg_min(cy, sse) AS cy, min(sse) AS sse FROM costs GROUP BY pair, k) """


@query(
    "clu_kmeans",
    _runs_sql([PAIR], [3])
    + """SELECT (row_number() OVER (ORDER BY cx, cy) - 1)::INT AS cluster, round(cx, 6) AS center_x, round(cy, 6) AS center_y, round(sse, 4) AS sse
         FROM (SELECT unnest(cx) AS cx, unnest(cy) AS cy, sse FROM best)""",
)
def clu_kmeans(t: Tables) -> DataFrame:
    with K.weighted_points(_lines(t), [PAIR], KEYS) as points:
        found = K.best_kmeans(points, [3])[3]
    rows = [(i, round(x, 6), round(y, 6), round(found.cost, 4)) for i, (x, y) in enumerate(found.centers)]
    return t.spark.createDataFrame(rows, "cluster int, center_x double, center_y double, sse double")


_NAMES = ", ".join(f"({i}, '{x}', '{y}')" for i, (x, y) in enumerate(K.column_pairs(LINE_NUMBERS)))


@query(
    "clu_elbow",
    _runs_sql(K.column_pairs(LINE_NUMBERS), [2, 3, 4, 5])
    + f"SELECT x, y, k, round(sse, 3) AS sse FROM best JOIN (VALUES {_NAMES}) AS p(pair, x, y) USING (pair)",
)
def clu_elbow(t: Tables) -> DataFrame:
    return K.elbow(_lines(t), K.column_pairs(LINE_NUMBERS), keys=KEYS).withColumn("sse", F.round("sse", 3))


_HALF = "greatest(max(x) - min(x), max(y) - min(y)) / 2 + 0.5"


@query(
    "clu_report",
    _runs_sql(K.column_pairs(LINE_NUMBERS), [3])
    + f""", sized AS (
        SELECT pair, c, sum(w)::BIGINT AS counts FROM (
            SELECT pair, list_position(d, list_min(d)) AS c, w FROM (
                SELECT pair, w, list_transform([1, 2, 3], lambda i: (x - cx[i]) * (x - cx[i]) + (y - cy[i]) * (y - cy[i])) AS d
                FROM points JOIN best USING (pair))) GROUP BY pair, c),
    boxes AS (SELECT pair, sum(w * x) / sum(w) AS mx, sum(w * y) / sum(w) AS my, {_HALF} AS half FROM points GROUP BY pair)
    SELECT x, y, (row_number() OVER (PARTITION BY pair ORDER BY cx[c], cy[c]) - 1)::INT AS cluster, counts, round(cx[c], 5) AS center_x,
           round(cy[c], 5) AS center_y, round(sse, 3) AS sse, round(mx - half, 6) AS x_low, round(mx + half, 6) AS x_high,
           round(my - half, 6) AS y_low, round(my + half, 6) AS y_high
    FROM best JOIN sized USING (pair) JOIN boxes USING (pair) JOIN (VALUES {_NAMES}) AS p(pair, x, y) USING (pair)""",
)
def clu_report(t: Tables) -> DataFrame:
    found = K.report(_lines(t), K.column_pairs(LINE_NUMBERS), 3, keys=KEYS)
    digits = {"center_x": 5, "center_y": 5, "sse": 3, "x_low": 6, "x_high": 6, "y_low": 6, "y_high": 6}
    return found.withColumns({c: F.round(c, n) for c, n in digits.items()})
