"""Encoding, fitting, scoring. Fits on one feature have closed forms, which the SQL checks use."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tarmac.operators import encode
from tarmac.operators.caps import top_rows
from tarmac.plans import linear, models
from tarmac.plans.training import split_train_test
from tarmac.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from tarmac.session import cut_lineage, scratch_path
from workload.join_queries import SERVING_SQL, TRAINING_SQL, serving_set, training_set
from workload.registry import query
from workload.tables import load


# ---- split and encoding -------------------------------------------------------------------


@query("""SELECT o_orderkey, CASE WHEN ('0x' || substr(md5(o_orderkey || '|42'), 1, 8))::BIGINT % 10000 < 7500
  THEN 'train' ELSE 'test' END AS split FROM orders""")
def train_test_split(spark, sf):
    return split_train_test(load(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


def _encoded(spark, sf, **options):
    """One-hot codes of event types, learnt without the type 'view', as long rows."""
    events = load(spark, sf, "events").select("event_id", "event_type")
    codes = encode.dictionary(events.where("event_type <> 'view'"), ["event_type"], **options)
    slots = encode.one_hot(events, codes, ["event_type"]).select("event_id", F.explode("slots").alias("slot"))
    return slots.select("event_id", F.col("slot").cast("int").alias("slot"), F.lit(1.0).alias("value"))


@query("""
WITH c AS (SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) - 1 AS INTEGER) AS slot
           FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'view'))
SELECT event_id, slot, 1.0::DOUBLE AS value FROM events JOIN c ON events.event_type = c.event_type""")
def one_hot(spark, sf):
    return _encoded(spark, sf)


@query("""
WITH c AS (SELECT event_type, row_number() OVER (ORDER BY event_type DESC) - 1 AS slot, count(*) OVER () AS n
           FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'view'))
SELECT event_id, CAST(slot AS INTEGER) AS slot, 1.0::DOUBLE AS value FROM events JOIN c ON events.event_type = c.event_type
WHERE slot < n - 1""")
def one_hot_drop_first(spark, sf):
    return _encoded(spark, sf, drop_first=True, descending=True)


@query("""
WITH o AS (SELECT o_orderkey, o_custkey::VARCHAR AS customer, o_orderpriority AS priority, o_orderkey % 3 <> 0 AS known FROM orders),
c AS (SELECT customer, row_number() OVER (ORDER BY customer) - 1 AS slot FROM o WHERE known GROUP BY customer),
p AS (SELECT priority, row_number() OVER (ORDER BY priority) - 1 + (SELECT count(*) FROM c) AS slot FROM o WHERE known GROUP BY priority)
SELECT o_orderkey, list_sort(list_filter([c.slot, p.slot], lambda x: x IS NOT NULL))::VARCHAR AS slots
FROM o LEFT JOIN c USING (customer) LEFT JOIN p USING (priority)""")
def one_hot_many(spark, sf):
    """A column with a category per customer; customers of one third of the orders may be new."""
    rows = load(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("priority"))
    codes = encode.dictionary(rows.where("o_orderkey % 3 <> 0"), ["customer", "priority"])
    return encode.one_hot(rows, codes, ["customer", "priority"]).select("o_orderkey", F.col("slots").cast("string").alias("slots"))


# ---- linear models on one feature ---------------------------------------------------------


def _simple(spark, sf):
    rows = load(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows).select("features", "y")


def _line(spark, model):
    row = [(float(model.coefficients[0]), float(model.intercept))]
    line = spark.createDataFrame(row, "slope double, intercept double")
    return line.select(F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


def _line_sql(slope: str) -> str:
    return f"""
WITH d AS (SELECT l_quantity AS x, l_extendedprice / 1000 AS y FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS cxy, var_pop(x) AS vx, count(*) AS n FROM d),
s AS (SELECT {slope} AS slope, mx, my FROM m)
SELECT round(slope, 4) AS slope, round(my - slope * mx, 3) AS intercept FROM s"""


@query(_line_sql("cxy / vx"))
def linear_regression(spark, sf):
    return _line(spark, models.least_squares("y").fit(_simple(spark, sf)))


@query(_line_sql("cxy / (vx + 50000.0 / n)"))
def ridge(spark, sf):
    rows = _simple(spark, sf)
    return _line(spark, models.ridge(rows, "y", alpha=50000.0).fit(rows))


@query(_line_sql("sign(cxy) * greatest(abs(cxy) - 0.1 * 0.2, 0) / (vx + 0.1 * 0.8)"))
def elastic_net(spark, sf):
    rows = _simple(spark, sf)
    return _line(spark, models.elastic_net(rows, "y", **models.ELASTIC_NET).fit(rows))


@query(_line_sql("sign(cxy) * greatest(abs(cxy) - 40.0 * 0.5, 0) / (vx + 40.0 * 0.5)"))
def elastic_net_strong(spark, sf):
    rows = _simple(spark, sf)
    return _line(spark, models.elastic_net(rows, "y", alpha=40.0, l1_ratio=0.5).fit(rows))


_FIT_SQL = """
WITH d AS (SELECT l_orderkey, l_partkey, l_suppkey, l_quantity AS x, l_extendedprice / 1000 - 20 AS y FROM lineitem),
m AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) AS cxy, var_pop(x) AS vx FROM d),
p AS (SELECT d.*, my + cxy / vx * (x - mx) AS p FROM d, m)
"""


def _fitted(spark, sf):
    """Least squares on one numeric feature, saved and loaded again, with its rows."""
    rows = load(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000 - 20).alias("y")
    )
    stages = models.preprocessing(rows, [], ["x"]) + [models.least_squares("y")]
    path = scratch_path(spark, "model")
    models.save_model(Pipeline(stages=stages).fit(rows), path)
    return rows, models.load_model(path)


@query(_FIT_SQL + "SELECT l_orderkey, l_partkey, l_suppkey, round(CASE WHEN p > 0 THEN p ELSE 0.0 END, 4) AS prediction FROM p")
def score_rows(spark, sf):
    rows, model = _fitted(spark, sf)
    scored = models.score(model, rows)
    return scored.select("l_orderkey", "l_partkey", "l_suppkey", F.round("prediction", 4).alias("prediction"))


@query(_FIT_SQL + "SELECT round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)), 6) AS r2, count(*) AS rows FROM p")
def fit_quality(spark, sf):
    rows, model = _fitted(spark, sf)
    return models.r2(models.score(model, rows, clamp=False), "y", "prediction").select(F.round("r2", 6).alias("r2"), "rows")


# ---- the feature set ----------------------------------------------------------------------


def _training_split(spark, sf):
    # Several fits read the set; it is written once instead of being joined again for each.
    rows = split_train_test(training_set(spark, sf), ["pos"])
    return models.as_doubles(cut_lineage(rows))


def _cells_sql(source: str) -> str:
    """(pos, name, level, v): the filled features of every row, one row each; a number that is missing stays null."""
    texts = [f"{{'name': '{c}', 'level': coalesce({c}, (SELECT mode FROM modes WHERE name = '{c}')), 'v': 1.0::DOUBLE}}" for c in CATEGORICAL_FEATURES]
    numbers = [f"{{'name': '{c}', 'level': NULL::VARCHAR, 'v': {c}::DOUBLE}}" for c in NUMERIC_FEATURES]
    return f"SELECT pos, c.name AS name, c.level AS level, c.v AS v FROM {source}, unnest([{', '.join(texts + numbers)}]) u(c)"


def linear_sql(lasso: str, quadratic: str, drop_first: bool = False, sweeps: int = 80) -> str:
    """CTEs that minimise ``|y - Xw|^2 / 2 + lasso * |w|_1 + quadratic / 2 * |w|^2`` over the training rows by coordinate descent
    on X'X; they end in ``coef`` and ``inter``. The penalties may name ``n``, the number of rows."""
    modes = " UNION ALL ".join(
        f"""SELECT '{c}' AS name, (SELECT {c} FROM tr WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode"""
        for c in CATEGORICAL_FEATURES
    )
    levels = " UNION ALL ".join(
        f"""SELECT '{c}' AS name, {c} AS level FROM tr WHERE {c} {'>' if drop_first else '>='} (SELECT min({c}) FROM tr) GROUP BY 2"""
        for c in CATEGORICAL_FEATURES
    )
    means = " UNION ALL ".join(f"SELECT '{c}' AS name, avg({c})::DOUBLE AS mean FROM tr" for c in NUMERIC_FEATURES)
    return f"""
t AS ({TRAINING_SQL}),
s AS (SELECT *, CASE WHEN ('0x' || substr(md5(pos || '|42'), 1, 8))::BIGINT % 10000 < 7500 THEN 'train' ELSE 'test' END AS split FROM t),
tr AS (SELECT * FROM s WHERE split = 'train'),
modes AS ({modes}),
lv AS ({levels}),
means AS ({means}),
f AS (SELECT row_number() OVER (ORDER BY kind, name, level) AS j, * FROM (
  SELECT 'level' AS kind, name, level, NULL::DOUBLE AS mean FROM lv
  UNION ALL SELECT 'number', name, NULL, mean FROM means WHERE mean IS NOT NULL)),
c AS ({_cells_sql("tr")}),
x AS (SELECT c.pos, f.j, coalesce(c.v, f.mean) AS v FROM c JOIN f ON c.name = f.name AND c.level IS NOT DISTINCT FROM f.level),
n AS (SELECT count(*)::DOUBLE AS n, avg({TARGET}) AS my FROM tr),
m AS (SELECT j, sum(v) / any_value(n.n) AS m FROM x, n GROUP BY j),
p AS (SELECT a.j AS i, b.j AS j, sum(a.v * b.v) AS p FROM x a JOIN x b USING (pos) GROUP BY ALL),
g AS (SELECT a.j AS i, b.j AS j, coalesce(p.p, 0) - n.n * a.m * b.m AS g FROM m a JOIN m b ON true JOIN n ON true
      LEFT JOIN p ON p.i = a.j AND p.j = b.j),
xy AS (SELECT x.j, sum(x.v * tr.{TARGET}) - any_value(n.n * m.m * n.my) AS b FROM x JOIN tr USING (pos) JOIN m USING (j) JOIN n ON true GROUP BY x.j),
q AS (SELECT (SELECT list(r ORDER BY i) FROM (SELECT i, list(g ORDER BY j) AS r FROM g GROUP BY i)) AS g,
        (SELECT list(b ORDER BY j) FROM xy) AS b, {lasso} AS lasso, {quadratic} AS quadratic FROM n),
-- coordinate descent: each step renews one weight and what the others leave of X'y
cd AS (SELECT list_reduce(
  list_concat([{{'k': 0::BIGINT, 'w': list_transform(b, lambda v: 0.0::DOUBLE), 'r': b}}],
    list_transform(range(0, {sweeps} * len(b)), lambda k: {{'k': 1 + k % len(b), 'w': NULL::DOUBLE[], 'r': NULL::DOUBLE[]}})),
  lambda s, e: list_transform([{{'j': e.k, 'g': g[e.k], 'rho': s.r[e.k] + g[e.k][e.k] * s.w[e.k]}}], lambda o:
    list_transform([CASE WHEN o.g[o.j] > 1e-6 THEN sign(o.rho) * greatest(abs(o.rho) - lasso, 0.0) / (o.g[o.j] + quadratic) ELSE 0.0 END], lambda z:
      {{'k': o.j, 'w': list_transform(s.w, lambda v, i: CASE WHEN i = o.j THEN z ELSE v END),
       'r': list_transform(s.r, lambda v, i: v - o.g[i] * (z - s.w[o.j]))}})[1])[1]).w AS w FROM q),
coef AS (SELECT f.name, f.level, f.mean, cd.w[f.j] AS w FROM f, cd),
inter AS (SELECT n.my - (SELECT sum(m.m * cd.w[m.j]) FROM m, cd) AS b0 FROM n)"""


def _predicted_sql(source: str) -> str:
    return f"""SELECT k.pos, any_value(b0) + coalesce(sum(coef.w * coalesce(k.v, coef.mean)), 0) AS p FROM ({_cells_sql(source)}) k
  JOIN inter ON true LEFT JOIN coef ON coef.name = k.name AND coef.level IS NOT DISTINCT FROM k.level GROUP BY k.pos"""


def _r2_sql(model: str, name: str) -> str:
    return f"""WITH {model}, o AS ({_predicted_sql("s")}),
e AS (SELECT split, {TARGET} AS y, p FROM o JOIN s USING (pos))
SELECT {name}split, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2, count(*) AS rows FROM e GROUP BY split"""


def _elastic(alpha: float, l1_ratio: float) -> tuple[str, str]:
    return f"n.n * {alpha * l1_ratio!r}", f"n.n * {alpha * (1 - l1_ratio)!r}"


_PRODUCTION_SQL = linear_sql(*_elastic(**models.ELASTIC_NET))
_COMPARED_SQL = {
    "linear_regression": ("0.0", "0.0"),
    "ridge": ("0.0", repr(models.RIDGE_ALPHA)),
    "elastic_net": _elastic(**models.ELASTIC_NET_EXPLORATION),
}


def _production(spark, sf):
    """The production model and its scores, from one pass over the training set."""
    return models.fit_production(split_train_test(training_set(spark, sf), ["pos"]))


@query(_r2_sql(_PRODUCTION_SQL, ""))
def production_model(spark, sf):
    _, scores = _production(spark, sf)
    return scores.select("split", F.round("r2", 6).alias("r2"), "rows")


@query(f"""WITH {_PRODUCTION_SQL}
SELECT name, level, round(w, 4) + 0.0 AS coefficient FROM coef UNION ALL SELECT 'intercept', NULL, round(b0, 3) FROM inter""")
def production_coefficients(spark, sf):
    model, _ = _production(spark, sf)
    terms = model.table(spark)
    rounded = F.when(F.col("kind") == "intercept", F.round("coefficient", 3)).otherwise(F.round("coefficient", 4) + 0.0)
    return terms.select(F.coalesce("name", F.lit("intercept")).alias("name"), "level", rounded.alias("coefficient"))


@query(
    " UNION ALL ".join(
        f"""SELECT * FROM ({_r2_sql(linear_sql(*penalties, drop_first=True, sweeps=120 if any(p != "0.0" for p in penalties) else 400), f"'{name}' AS model, ")})"""
        for name, penalties in _COMPARED_SQL.items()
    )
)
def linear_comparison(spark, sf):
    """The three linear candidates from one pass over the rows."""
    rows = split_train_test(training_set(spark, sf), ["pos"])
    return models.compare_models(rows, names=list(_COMPARED_SQL)).withColumn("r2", F.round("r2", 6))


@query()
def model_comparison(spark, sf):
    return models.compare_models(_training_split(spark, sf))


@query()
def random_forest(spark, sf):
    return models.compare_models(_training_split(spark, sf), names=["random_forest"])


@query()
def gradient_boosting(spark, sf):
    return models.compare_models(_training_split(spark, sf), names=["gradient_boosting"])


SCORED_SQL = f"""WITH {_PRODUCTION_SQL}, live AS ({SERVING_SQL}), o AS ({_predicted_sql("live")})
SELECT pos, flight_iata, round(greatest(p, 0), 4) AS prediction FROM o JOIN live USING (pos)"""


def saved_production(spark, sf):
    """The production model, saved and loaded again."""
    path = scratch_path(spark, "model")
    _production(spark, sf)[0].save(spark, path)
    return linear.load(spark, path)


@query(SCORED_SQL)
def score_batch(spark, sf):
    scored = models.score(saved_production(spark, sf), serving_set(spark, sf))
    return scored.select("pos", "flight_iata", F.round("prediction", 4).alias("prediction"))


@query()
def top_delays(spark, sf):
    rows = _training_split(spark, sf)
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    model = models.build_model(train, models.gradient_boosting()).fit(train)
    best = top_rows(models.score(model, test, clamp=False), TARGET, 10, ["pos"])
    return best.select("pos", F.col(TARGET).alias("y_test"), F.round("prediction", 4).alias("y_pred"))
