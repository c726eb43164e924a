"""Costs, statistics, moments, gradients and selections."""

import numpy as np
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import features as ft
from ..operators import metrics as mt
from ..operators import splits
from ..operators.gram import moment_cells
from ..oracles import kit as k
from ..sources import views
from . import query, r6, r9
from .scalar import DESIGN, SIGMA, W, X, Z, design, scored
from .scan import nulled

E = f"(y - {Z})"
SOFT = f"(greatest({Z}, 0) + ln(1 + exp(-abs({Z}))))"


def _error(spark, sf):
    return scored(spark, sf).withColumn("e", F.col("y") - F.col("z"))


@query(k.sql(f"select {k.r6(f'avg({E} * {E}) / 2')} as cost from d", *DESIGN))
def cost_mse(spark, sf):
    return _error(spark, sf).agg(r6(mt.half_mse(F.col("e"))).alias("cost"))


@query(k.sql(f"select {k.r6(f'sqrt(avg({E} * {E}))')} as cost from d", *DESIGN))
def cost_rmse(spark, sf):
    return _error(spark, sf).agg(r6(mt.rmse(F.col("e"))).alias("cost"))


@query(k.sql(f"select {k.r6(f'avg(abs({E}))')} as cost from d", *DESIGN))
def cost_mae(spark, sf):
    return _error(spark, sf).agg(r6(mt.mae(F.col("e"))).alias("cost"))


@query(k.sql(f"select round(sum({SOFT} - y01 * {Z}), 4) as cost from d", *DESIGN))
def cost_loglik(spark, sf):
    return scored(spark, sf).agg(F.round(mt.log_loss(F.col("y01"), F.col("z")), 4).alias("cost"))


@query(k.sql(f"select round(sum({SOFT} - y01 * {Z}) + 0.5 * 100 * {float(np.dot(W, W))!r}, 4) as cost from d", *DESIGN))
def cost_loglik_penalised(spark, sf):
    loss = mt.log_loss(F.col("y01"), F.col("z")) + F.lit(mt.penalty(W, 100.0))
    return scored(spark, sf).agg(F.round(loss, 4).alias("cost"))


@query(k.sql(f"""select {k.r6(f"sqrt(avg(pow(r - {k.star('m')}, 2)))")} as rmse
  from te left join (select u, avg(r) as m from tr group by u) using (u)""", k.RATINGS, k.SPLIT))
def rmse_rounded(spark, sf):
    from ..operators.means import EntityMean
    train, test = splits.parts(splits.split_per_user(views.ratings(spark, sf)))
    scored_test = EntityMean("user").fit(train).transform(test)
    return scored_test.agg(r6(mt.rmse_stars(F.col("rating"), F.col("prediction"))).alias("rmse"))


@query(k.sql(f"""select k < floor(0.8::double * total) as is_train, count(*)::bigint as n,
  {k.r6(f'avg(case when y = (case when {Z} > 0 then 1 else -1 end) then 1.0 else 0.0 end)')} as accuracy
  from rk group by 1""", *DESIGN, k.ranked("rk", "d", 1)))
def accuracy_by_split(spark, sf):
    rows = splits.split_exact(scored(spark, sf), 0.8)
    hit = mt.accuracy(F.col("y"), fn.class_label(F.col("z")))
    return rows.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"), r6(hit).alias("accuracy"))


@query(k.sql(f"""select is_train, {k.r6("sum(n / (total * case when is_train then 0.8 else 0.2 end::double) * acc)")} as accuracy
  from (select seg, is_train, total, count(*) as n, avg(case when y = (case when {Z} > 0 then 1 else -1 end) then 1.0 else 0.0 end) as acc
        from (select rk.*, least(f2::int, 2) as seg, k < floor(0.8::double * total) as is_train from rk join f using (id)) group by 1, 2, 3)
  group by 1""", *DESIGN, k.ranked("rk", "d", 1)))
def weighted_accuracy(spark, sf):
    seg = views.features(spark, sf).select("id", ft.segment(views.SEGMENT).alias("segment"))
    rows = splits.split_exact(scored(spark, sf), 0.8).join(seg, "id")
    hit = F.when(F.col("y") == fn.class_label(F.col("z")), 1.0).otherwise(0.0)
    out = mt.weighted_accuracy(rows, "segment", "is_train", hit, {True: 0.8, False: 0.2})
    return out.select("is_train", r6(F.col("accuracy")).alias("accuracy"))


@query(k.sql("select id, " + ", ".join(f"{k.r9(f'coalesce({c}, m_{c})')} as {c}" for c in k.FS) + " from nf, "
             "(select " + ", ".join(f"median({c}) as m_{c}" for c in k.FS) + " from nf)", k.FEATURES, k.NULLED))
def impute_median(spark, sf):
    rows = ft.impute_median(nulled(spark, sf), views.FEATURES)
    return rows.select("id", *[r9(F.col(c)).alias(c) for c in views.FEATURES])


@query(k.sql("select id, " + ", ".join(f"{k.r6(f'coalesce(({c} - m_{c}) / s_{c}, 0)')} as {c}" for c in k.FS) + " from nf, "
             "(select " + ", ".join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in k.FS) + " from nf)",
             k.FEATURES, k.NULLED))
def standardize(spark, sf):
    rows = ft.standardise(nulled(spark, sf), views.FEATURES)
    return rows.select("id", *[r6(F.col(c)).alias(c) for c in views.FEATURES])


@query(k.sql(" union all ".join(f"select {i}::int as i, {j}::int as j, round(sum(x{i} * x{j}), 4) as v from d"
                                for i in range(5) for j in range(i, 5)), *DESIGN))
def gram_matrix(spark, sf):
    return moment_cells(design(spark, sf), X).select("i", "j", F.round("v", 4).alias("v"))


def _vector(values, spark, digits=6):
    return spark.createDataFrame([(i, c, round(float(v), digits)) for i, (c, v) in enumerate(zip(X, values))],
                                 "pos INT, feature STRING, value DOUBLE")


@query(k.sql(" union all ".join(f"select {i}::int as pos, '{c}' as feature, {k.r6(f'-sum(x{i} * {E}) / count(*)')} as value from d"
                                for i, c in enumerate(X)), *DESIGN))
def gradient_mse(spark, sf):
    return _vector(mt.squared_gradient(design(spark, sf), X, "y", W), spark)


@query(k.sql(" union all ".join(f"select {i}::int as pos, '{c}' as feature, round(sum(x{i} * ({SIGMA} - y01)), 4) as value from d"
                                for i, c in enumerate(X)), *DESIGN))
def gradient_loglik(spark, sf):
    return _vector(mt.logistic_gradient(design(spark, sf), X, "y01", W), spark, 4)


@query(k.sql(" union all ".join(
    f"select {i}::int as i, {j}::int as j, round(sum(x{i} * x{j} * {SIGMA} * (1 - {SIGMA})), 4) as v from d"
    for i in range(5) for j in range(i, 5)), *DESIGN))
def hessian_loglik(spark, sf):
    s = fn.sigmoid(F.col("z"))
    rows = scored(spark, sf).withColumn("k", s * (1 - s))
    return moment_cells(rows, X, weight="k").select("i", "j", F.round("v", 4).alias("v"))


def _activity(key):
    return k.sql(f"select {key[0]} as \"{key}\", count(*)::bigint as n, "
                 f"row_number() over (order by count(*) desc, {key[0]}) - 1 as place from r group by {key[0]}", k.RATINGS)


@query(_activity("user"))
def user_activity(spark, sf):
    return splits.activity(views.ratings(spark, sf), "user")


@query(_activity("item"))
def item_activity(spark, sf):
    return splits.activity(views.ratings(spark, sf), "item")


@query(k.sql("""select u as "user", count(*)::bigint as n, min(i) as first_item, max(i) as last_item,
  sum(i * i)::bigint as checksum from r group by u""", k.RATINGS))
def index_groups(spark, sf):
    parts = splits.index_groups(views.ratings(spark, sf), "user", "item")
    item = F.explode("members").alias("item")
    return parts.select("user", item).groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), F.min("item").alias("first_item"), F.max("item").alias("last_item"),
        F.sum((F.col("item") * F.col("item")).cast("bigint")).alias("checksum"))


LAMS = [0.001, 0.01, 0.1, 1.0]
_BEST = (*DESIGN, k.moment_cte("m", "d", 5), "lam as (select unnest([0.001, 0.01, 0.1, 1.0])::double as lam)",
         "ml as materialized (select * from m, lam)", *k.ridge_ctes("w", "ml", 5, "lam", ["lam"]))


@query(k.sql(f"""select lam, {k.r6('rmse')} as rmse from (
  select lam, sqrt(avg(pow(y - {k.score(5)}, 2))) as rmse from d, w group by lam) order by rmse, lam limit 1""", *_BEST))
def best_config(spark, sf):
    """Arg-min over ridge penalties, all scored in one pass over the rows."""
    from ..operators import linear as lm
    rows = design(spark, sf)
    models = lm.ridge_path(lm.moments_of(rows, X), X, LAMS)
    wide = rows.agg(*[mt.rmse(F.col("y") - m.score()).alias(f"e{i}") for i, m in enumerate(models)])
    each = F.explode(F.array(*[F.struct(F.lit(lam).alias("lam"), F.col(f"e{i}").alias("rmse")) for i, lam in enumerate(LAMS)]))
    return mt.best(wide.select(each.alias("s")).select("s.*"), "rmse", "lam").select("lam", r6(F.col("rmse")).alias("rmse"))
