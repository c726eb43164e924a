"""Blending and the recommendation workflow over the models that have an exact SQL form."""

from pyspark.sql import functions as F

from ..operators import blending
from ..operators.means import EntityMean, global_mean
from ..operators.neighbours import SlopeOne
from ..operators.splits import parts, split_per_user
from ..oracles import kit as k
from ..oracles import recommenders as rec
from ..plans.recommend import predict_all, recommend
from ..sources import views
from ..session import cut_lineage
from . import query, r6
from .means import train_test
from .split import _WANTED, wanted_pairs

MODELS = {"User-Mean": lambda: EntityMean("user", fallback=True), "Item-Mean": lambda: EntityMean("item", fallback=True),
          "Slope-One": lambda: SlopeOne()}
NAMES = list(MODELS)


def _models(train, pairs, name):
    return [*rec.slope_one(train, f"{name}_so", pairs),
            f"{name} as materialized (select q.*, um as x0, im as x1, p as x2 from {pairs} q "
            f"join (select u, avg(r) as um from {train} group by u) using (u) "
            f"join (select i, avg(r) as im from {train} group by i) using (i) join {name}_so using (u, i))"]


def _subsets(predicted, names):
    """CTEs up to ``ev`` (all subsets) and ``be`` (the best), given those of ``d`` with the models' x0.. on the test cells."""
    count = len(names)
    out = [k.RATINGS, k.SPLIT, _WANTED, *predicted, k.moment_cte("m", "d", count, y="r")]
    rows = []
    for mask in range(1, 1 << count):
        idx = [c for c in range(count) if mask >> c & 1]
        out += k.solve_ctes(f"s{mask}", "m", len(idx), diag="2 * n * 0.001::double",
                            left=lambda a, b, idx=idx: f"s{min(idx[a], idx[b])}_{max(idx[a], idx[b])}", right=lambda a, idx=idx: f"t{idx[a]}")
        ws = ", ".join(f"w{idx.index(c)} as w{c}" if c in idx else f"0.0::double as w{c}" for c in range(count))
        rows.append(f"select {mask}::bigint as mask, {len(idx)}::int as size, '{'+'.join(names[c] for c in idx)}' as members, {ws} from s{mask}")
    out.append("ws as materialized (" + " union all ".join(rows) + ")")
    out.append(f"ev as materialized (select mask, size, members, {', '.join(f'any_value(w{c}) as w{c}' for c in range(count))}, "
               f"sqrt(avg(pow(r - {k.star(k.score(count))}, 2))) as rmse from d, ws group by mask, size, members)")
    out.append("be as materialized (select * from ev order by rmse, mask limit 1)")
    return out


_EV = _subsets(_models("tr", "te", "d"), NAMES)
_SHOW = f"mask, size, members, {k.r6('rmse')} as rmse"


def evaluated(spark, sf):
    train, test = train_test(spark, sf)
    wide = blending.align(predict_all(train, test, MODELS), NAMES).join(test, ["user", "item"])
    return cut_lineage(blending.evaluate_subsets(cut_lineage(wide), NAMES))


def shown(ev):
    return ev.select("mask", "size", F.concat_ws("+", "members").alias("members"), r6(F.col("rmse")).alias("rmse"))


@query(k.sql(f"select {_SHOW} from ev", *_EV))
def blend_subsets(spark, sf):
    return shown(evaluated(spark, sf))


@query(k.sql(f"select {_SHOW} from be", *_EV))
def blend_best(spark, sf):
    return shown(blending.best_subset(evaluated(spark, sf)))


@query(k.sql(f"select {_SHOW} from (select *, row_number() over (partition by size order by rmse, mask) as place from ev) where place = 1",
             *_EV))
def best_by_size(spark, sf):
    return shown(blending.best_by_size(evaluated(spark, sf)))


_APPLY = [*_EV, *_models("r", "wanted", "a")]


@query(k.sql(f'select u as "user", i as item, {k.star(k.score(3))}::int as prediction from a, be', *_APPLY))
def blend_apply(spark, sf):
    """The best subset's weights on predictions for the wanted pairs by models trained on all ratings."""
    top = blending.best_subset(evaluated(spark, sf)).first()
    rows = predict_all(views.ratings(spark, sf), wanted_pairs(spark, sf), {n: MODELS[n] for n in top["members"]})
    return blending.weigh(blending.align(rows, top["members"]), top["members"], top["weights"])


@query(k.sql(f"select 'r' || (u + 1) || '_c' || (i + 1) as \"Id\", {k.star(k.score(3))}::int as \"Prediction\" from a, be", *_APPLY))
def recommend_workflow(spark, sf):
    """Split, train twice, blend, write the upstream form."""
    return recommend(views.ratings(spark, sf), wanted_pairs(spark, sf), MODELS)[1]


COLD = {"User-Mean": lambda: EntityMean("user"), "Item-Mean": lambda: EntityMean("item")}


def _means(train, pairs, name, how):
    return (f"{name} as materialized (select q.*, um as x0, im as x1 from {pairs} q {how} join (select u, avg(r) as um from {train} "
            f"group by u) using (u) {how} join (select i, avg(r) as im from {train} group by i) using (i))")


_COLD = [*_subsets([_means("tr", "te", "d", "")], list(COLD)),
         "cold as (select distinct u + case when u % 4 in (1, 3) then 1000000 else 0 end as u, "
         "i + case when u % 4 in (2, 3) then 1000000 else 0 end as i from wanted)",
         _means("r", "cold", "a", "left"),
         "hb as (select have, mask, w0, w1 from (select unnest([1, 2, 3])::bigint as have) join ev on mask & have = mask "
         "qualify row_number() over (partition by have order by rmse, mask) = 1)",
         "al as (select *, ((x0 is not null)::int + 2 * (x1 is not null)::int)::bigint as have from a)"]


@query(k.sql(f"""select u as "user", i as item, coalesce(mask, 0)::bigint as mask,
  {k.star("coalesce(case when w0 = 0 then 0 else x0 * w0 end + case when w1 = 0 then 0 else x1 * w1 end, mu)")}::int as prediction
  from al left join hb using (have), (select avg(r) as mu from r)""", *_COLD))
def blend_apply_cold(spark, sf):
    """Wanted pairs with unseen users, unseen items or both: each gets the best subset of the models that know it."""
    ratings = cut_lineage(views.ratings(spark, sf))
    train, test = parts(cut_lineage(split_per_user(ratings)))
    wide = blending.align(predict_all(train, test, COLD), list(COLD)).join(test, ["user", "item"])
    evaluated = cut_lineage(blending.evaluate_subsets(cut_lineage(wide), list(COLD)))
    far = F.lit(1_000_000)
    kind = F.pmod("user", F.lit(4))
    cold = wanted_pairs(spark, sf).select((F.col("user") + F.when(kind.isin(1, 3), far).otherwise(0)).alias("user"),
                                          (F.col("item") + F.when(kind.isin(2, 3), far).otherwise(0)).alias("item"))
    cold = cut_lineage(cold.distinct())
    known = cold.join(blending.align(predict_all(ratings, cold, COLD), list(COLD)), ["user", "item"], "left")
    return blending.weigh_all(cut_lineage(known), list(COLD), evaluated, global_mean(ratings))
