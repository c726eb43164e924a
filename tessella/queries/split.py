"""Splits, samples, joins, set operations and ordering."""

from pyspark.sql import functions as F

from ..operators import blending, factors, splits
from ..operators import features as ft
from ..operators.means import EntityMean
from ..oracles import kit as k
from ..sources import views
from . import query, r6
from .scan import _MEANS, mean_predictions

_F = (k.FEATURES, k.ranked("rk", "f", 1))


@query(k.sql("select id, k < floor(0.8::double * total) as is_train from rk", *_F))
def split_exact(spark, sf):
    return splits.split_exact(views.features(spark, sf).select("id"), 0.8)


@query(k.sql("select id, least(k // (total // 4), 3)::int as fold from rk", *_F))
def kfold_assign(spark, sf):
    return splits.fold_exact(views.features(spark, sf).select("id"), 4)


@query(k.sql("select id, (k // 64)::int as batch from rk where k < 64 * 10", *_F))
def minibatch_assign(spark, sf):
    return splits.minibatches(views.features(spark, sf).select("id"), 64, 10)


@query(k.sql("select u as \"user\", i as item, r as rating, is_train from sp", k.RATINGS, k.SPLIT))
def split_per_user(spark, sf):
    return splits.split_per_user(views.ratings(spark, sf)).select("user", "item", "rating", "is_train")


_COIN = k.uniform("'988:' || u || ':' || i")


@query(k.sql(f"select u as \"user\", i as item, {_COIN} < 0.9::double as is_train from r", k.RATINGS))
def split_bernoulli(spark, sf):
    return splits.split_bernoulli(views.ratings(spark, sf), 0.9, 988, "user", "item").select("user", "item", "is_train")


_HOLD = (k.RATINGS, """rk as materialized (select u, i, r, row_number() over (partition by u order by md5('988:' || u || ':' || i), i) - 1 as k,
  count(*) over (partition by u) as n from r)""",
         f"dr as (select distinct u, floor({k.uniform("'988:' || u || ':' || (k + 1)")} * n) as k from rk where k < floor(n * 0.1::double))")


@query(k.sql("""select u as "user", i as item, r as rating, dr.k is not null as is_test
  from rk left join dr using (u, k)""", *_HOLD))
def split_holdout_replacement(spark, sf):
    return splits.holdout_with_replacement(views.ratings(spark, sf)).select("user", "item", "rating", "is_test")


_WANTED = "wanted as (select distinct u, (i + 1) % (select max(i) + 1 from r) as i from r)"


def wanted_pairs(spark, sf):
    """One wanted pair per rating: the next item id for the same user."""
    rows = views.ratings(spark, sf)
    items = (rows.agg(F.max("item")).first()[0] or 0) + 1
    return rows.select("user", F.pmod(F.col("item") + 1, F.lit(items)).alias("item")).distinct()


@query(k.sql("select u as \"user\", i as item, r as rating from r join wanted using (u, i)", k.RATINGS, _WANTED))
def wanted_pairs_join(spark, sf):
    return views.ratings(spark, sf).join(wanted_pairs(spark, sf), ["user", "item"])


@query(k.sql("select u as \"user\", i as item, r as rating from r anti join wanted using (u, i)", k.RATINGS, _WANTED))
def residual_antijoin(spark, sf):
    return views.ratings(spark, sf).join(wanted_pairs(spark, sf), ["user", "item"], "left_anti")


@query(k.sql("""select id, least(f2::int, 2) as segment,
  case when f0 > case when f2 = 0 then 2.0 when f2 = 1 then 2.5 else 3.0 end then 1 else -1 end as prediction from f""", k.FEATURES))
def segment_union(spark, sf):
    """One rule per segment: a segment column in one pass instead of a union of filtered passes."""
    rows = views.features(spark, sf).withColumn("segment", ft.segment(views.SEGMENT))
    cut = F.element_at(F.array(F.lit(2.0), F.lit(2.5), F.lit(3.0)), F.col("segment") + 1)
    return rows.select("id", "segment", F.when(F.col("f0") > cut, 1).otherwise(-1).alias("prediction"))


@query(k.sql(f"select model, u as \"user\", i as item, {k.r6('p')} as prediction from pr order by model, i, u", *_MEANS))
def ordered_predictions(spark, sf):
    return mean_predictions(spark, sf).select("model", "user", "item", r6(F.col("prediction")).alias("prediction")) \
        .orderBy("model", "item", "user")


@query(k.sql(f"""select u as "user", i as item, {k.r6("max(p) filter (where model = 'User-Mean')")} as user_mean,
  {k.r6("max(p) filter (where model = 'Item-Mean')")} as item_mean from pr group by u, i""", *_MEANS))
def prediction_pivot(spark, sf):
    wide = blending.align(mean_predictions(spark, sf), ["User-Mean", "Item-Mean"])
    return wide.select("user", "item", r6(F.col("User-Mean")).alias("user_mean"), r6(F.col("Item-Mean")).alias("item_mean"))


@query(k.sql(f"""select "user", item, {k.r6('p')} as prediction, place from (
  select u as "user", i as item, m as p, row_number() over (partition by u order by m desc, i)::int as place
  from r join (select i, avg(r) as m from r group by i) using (i)) where place <= 5""", k.RATINGS))
def topn_per_user(spark, sf):
    rows = views.ratings(spark, sf)
    scored = EntityMean("item").fit(rows).transform(rows.select("user", "item"))
    return factors.top_n(scored, 5).select("user", "item", r6(F.col("prediction")).alias("prediction"), "place")
