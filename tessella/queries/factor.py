"""Matrix factorisation and co-clustering."""

from pyspark.sql import functions as F

from ..operators import factors as fc
from ..operators.cocluster import CoClustering
from ..operators.strata import SequentialFactors
from ..operators.topn import top_unrated
from ..operators.tuning import tune
from ..oracles import kit as k
from ..oracles import recommenders as rec
from ..sources import views
from . import query, r6
from .means import shown, train_test


def _sql(built, recursive=False):
    ctes, select = built
    return k.sql(select, k.RATINGS, k.SPLIT, *ctes, recursive=recursive)


def _scored(spark, sf, model):
    train, test = train_test(spark, sf)
    return shown(model.fit(train).transform(test))


_INIT = " union all ".join(
    f"select '{kind}' as kind, {c} as id, {k.r6(first)} as f0, "
    + ", ".join(f"{k.r6(k.uniform(chr(39) + f'988:{kind}:' + chr(39) + f' || {c} || ' + chr(39) + f':{n}' + chr(39)))} as f{n}" for n in (1, 2))
    + f" from r group by {c}"
    for kind, c, first in (("user", "u", k.uniform("'988:user:' || u || ':0'")), ("item", "i", "avg(r)")))


@query(k.sql(_INIT, k.RATINGS))
def mf_init(spark, sf):
    users, items = fc.init_factors(views.ratings(spark, sf), 3)
    out = [t.select(F.lit(kind).alias("kind"), F.col(kind).alias("id"), *[r6(F.col(f"f{c}")).alias(f"f{c}") for c in range(3)])
           for kind, t in (("user", users), ("item", items))]
    return out[0].unionByName(out[1])


@query(k.sql(f"select {k.r6('sqrt(avg(pow(r - (p.f0 * q.f0 + p.f1 * q.f1 + p.f2 * q.f2), 2)))')} as rmse "
             "from r join v p on p.kind = 'user' and p.id = u join v q on q.kind = 'item' and q.id = i", k.RATINGS,
             f"v as materialized ({_INIT.replace('(round(', '((').replace(', 6) + 0.0)', '))')})"))
def mf_observed_rmse(spark, sf):
    """The error of the first factors over the observed cells."""
    rows = views.ratings(spark, sf)
    return fc.observed_rmse(rows, *fc.init_factors(rows, 3), 3).select(r6(F.col("rmse")).alias("rmse"))


@query(_sql(rec.gradient(2, 3, 0.01, 0.1, 0.7, decay=1.2, biased=False)))
def rec_mf_gradient(spark, sf):
    return _scored(spark, sf, fc.GradientFactors.plain(rank=2, epochs=3))


@query(_sql(rec.gradient(2, 3, 0.005, 0.02, 0.02)))
def rec_svd(spark, sf):
    return _scored(spark, sf, fc.GradientFactors(2, 3, 0.005, 0.02))


@query(_sql(rec.gradient(2, 2, 0.005, 0.02, 0.02, implicit=True)))
def rec_svdpp(spark, sf):
    return _scored(spark, sf, fc.GradientFactors(2, 2, 0.005, 0.02, implicit=True))


@query(_sql(rec.sequential(10, 1, 0.005, 0.02, 0.02), recursive=True))
def rec_svd_sequential(spark, sf):
    return _scored(spark, sf, SequentialFactors(10, 1, 0.005, 0.02))


@query(_sql(rec.sequential(20, 1, 0.01, 0.1, 0.7, decay=1.2, biased=False), recursive=True))
def rec_mf_sequential(spark, sf):
    return _scored(spark, sf, SequentialFactors.plain(rank=20, epochs=1))


@query(_sql(rec.weighted_als(2, 3, 0.1, 0.7)))
def rec_als_wr(spark, sf):
    return _scored(spark, sf, fc.WeightedAls(rank=2, stop=0.0, max_sweeps=3))


def _unrated(n):
    ctes, _ = rec.weighted_als(2, 3, 0.1, 0.7)
    best = f"""select "user", item, {k.r6('s')} as prediction, place from (
      select u as "user", i as item, s, row_number() over (partition by u order by s desc, i)::int as place from (
        select p.u, q.i, p.f0 * q.f0 + p.f1 * q.f1 as s from p3 p, q3 q) anti join tr using (u, i)) where place <= {n}"""
    return ctes, best


@query(_sql(_unrated(10)))
def recommend_top_n(spark, sf):
    train, _ = train_test(spark, sf)
    best = top_unrated(fc.WeightedAls(rank=2, stop=0.0, max_sweeps=3).fit(train), train, 10)
    return best.withColumn("prediction", r6(F.col("prediction")))


@query(_sql(rec.coclustering(2, 3, 2)))
def rec_coclustering(spark, sf):
    return _scored(spark, sf, CoClustering(2, 3, 2))


@query()
def rec_als_mllib(spark, sf):
    return _scored(spark, sf, fc.LibraryAls(epochs=10, lam=0.1))


@query()
def tune_als(spark, sf):
    _, table = tune(views.ratings(spark, sf), lambda **p: fc.LibraryAls(epochs=5, **p), {"lam": [0.1, 0.5], "rank": [2, 4]})
    return table.withColumn("rmse", r6(F.col("rmse")))
