"""Mean baselines."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from ..operators import means as mn
from ..operators.splits import parts, split_per_user
from ..oracles import kit as k
from ..session import cut_lineage
from ..sources import views
from . import query, r6


def train_test(spark, sf):
    """The 90 % split of every user's ratings, computed once for the jobs of a fit; the events are read once for it."""
    ratings = views.ratings(spark, sf).persist(StorageLevel.MEMORY_AND_DISK)
    split = cut_lineage(split_per_user(ratings))
    ratings.unpersist()
    return parts(split)


def shown(scored):
    return scored.select("user", "item", r6(F.col("prediction")).alias("prediction"))


_TE = 'select te.u as "user", te.i as item, '


@query(k.sql(f"{_TE}{k.r6('m')} as prediction from te, (select avg(r) as m from tr)", k.RATINGS, k.SPLIT))
def rec_global_mean(spark, sf):
    train, test = train_test(spark, sf)
    return shown(mn.GlobalMean().fit(train).transform(test))


def _mean(key):
    return k.sql(f"{_TE}{k.r6('m')} as prediction from te left join (select {key}, avg(r) as m from tr group by {key}) using ({key})",
                 k.RATINGS, k.SPLIT)


def _error(key):
    return k.sql(f"select {k.r6('sqrt(sum(pow(r - m, 2)) / count(*))')} as rmse_all, {k.r6('sqrt(avg(pow(r - m, 2)))')} as rmse_seen "
                 f"from te left join (select {key}, avg(r) as m from tr group by {key}) using ({key})", k.RATINGS, k.SPLIT)


def _rmse(spark, sf, key):
    train, test = train_test(spark, sf)
    out = mn.holdout_rmse(mn.EntityMean(key).fit(train).transform(test))
    return out.select(*[r6(F.col(c)).alias(c) for c in out.columns])


@query(_mean("u"))
def rec_user_mean(spark, sf):
    train, test = train_test(spark, sf)
    return shown(mn.EntityMean("user").fit(train).transform(test))


@query(_error("u"))
def rec_user_mean_rmse(spark, sf):
    return _rmse(spark, sf, "user")


@query(_mean("i"))
def rec_item_mean(spark, sf):
    train, test = train_test(spark, sf)
    return shown(mn.EntityMean("item").fit(train).transform(test))


@query(_error("i"))
def rec_item_mean_rmse(spark, sf):
    return _rmse(spark, sf, "item")
