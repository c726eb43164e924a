"""Neighbourhood models and Slope One."""

from pyspark.sql import functions as F

from ..operators.neighbours import Baselines, Neighbours, SlopeOne, tune_k
from ..operators.splits import fold_exact
from ..oracles import kit as k
from ..oracles import recommenders as rec
from ..sources import views
from . import query, r6
from .factor import _scored, _sql


@query(k.sql('select u as "user", i as item, ' + k.r6("p") + " as prediction from so", k.RATINGS, k.SPLIT, *rec.slope_one()))
def rec_slope_one(spark, sf):
    return _scored(spark, sf, SlopeOne())


@query(_sql(rec.neighbours(20, "user")))
def rec_knn_user(spark, sf):
    return _scored(spark, sf, Neighbours(20, "user"))


@query(_sql(rec.neighbours(900, "user")))
def rec_knn_user_wide(spark, sf):
    """The blended setting: more neighbours than most items have raters."""
    return _scored(spark, sf, Neighbours(900, "user"))


@query(_sql(rec.neighbours(15, "item")))
def rec_knn_item(spark, sf):
    return _scored(spark, sf, Neighbours(15, "item"))


@query(_sql(rec.neighbours(400, "user", "baseline")))
def rec_knn_user_baseline(spark, sf):
    return _scored(spark, sf, Neighbours(400, "user", "baseline", baselines=Baselines(3)))


@query(_sql(rec.neighbours(90, "item", "baseline")))
def rec_knn_item_baseline(spark, sf):
    return _scored(spark, sf, Neighbours(90, "item", "baseline", baselines=Baselines(3)))


@query(_sql(rec.neighbours(90, "item", "zscore")))
def rec_knn_zscore(spark, sf):
    return _scored(spark, sf, Neighbours(90, "item", "zscore"))


KS = (5, 20, 90)


def _tune_sql():
    place = ", ".join(f"sum(case when place <= {n} then w * x end) / sum(case when place <= {n} then w end) as s{n}" for n in KS)
    errors = " union all ".join(
        f"select {n}::int as k, avg(e) as rmse from (select held, sqrt(avg(pow(r - {k.clip(f'm + coalesce(s{n}, 0)')}, 2))) as e "
        f"from pr group by held)" for n in KS)
    return k.sql(f"select k, {k.r6('rmse')} as rmse from ({errors})", k.RATINGS,
        "fo as materialized (select u, i, r, least((row_number() over (order by md5('988:' || u || '_' || i)) - 1) "
        "// (count(*) over () // 3), 2)::int as fold from r)",
        "t as materialized (select held, u, i, r, avg(r) over (partition by held, i) as m from fo, "
        "(select unnest(range(3))::int as held) where fold <> held)",
        "sim as materialized (select held, i, j, case when n < 2 or vi < 1e-12 or vj < 1e-12 then 0 else "
        "cov / sqrt(vi * vj) end as w from (select a.held, a.i, b.i as j, count(*)::double as n, "
        "n * sum(a.r * a.r) - sum(a.r) * sum(a.r) as vi, n * sum(b.r * b.r) - sum(b.r) * sum(b.r) as vj, "
        "n * sum(a.r * b.r) - sum(a.r) * sum(b.r) as cov from t a join t b on a.held = b.held and a.u = b.u and a.i < b.i group by 1, 2, 3))",
        "link as materialized (select held, i, j, w from sim where w > 0 union all select held, j, i, w from sim where w > 0)",
        f"near as materialized (select held, u, i, {place} from (select fo.fold as held, fo.u, fo.i, w, t.r - t.m as x, "
        "row_number() over (partition by fo.fold, fo.u, fo.i order by w desc, j) as place from fo join t on t.held = fo.fold and t.u = fo.u "
        "join link on link.held = fo.fold and link.i = fo.i and link.j = t.i) group by 1, 2, 3)",
        "pr as materialized (select fo.fold as held, fo.r, mi.m, near.* exclude (held, u, i) from fo "
        "join (select distinct held, i, m from t) mi on mi.held = fo.fold and mi.i = fo.i "
        "left join near on near.held = fo.fold and near.u = fo.u and near.i = fo.i)")


@query(_tune_sql())
def tune_knn_k(spark, sf):
    """Three neighbour counts on three folds in one set of jobs."""
    keyed = views.ratings(spark, sf).withColumn("_key", F.concat_ws("_", "user", "item"))
    folds = fold_exact(keyed, 3, 988, "_key").drop("_key")
    return tune_k(folds, KS, "fold").select("k", r6(F.col("rmse")).alias("rmse"))
