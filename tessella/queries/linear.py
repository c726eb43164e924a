"""Linear models and the tabular workflow."""

import numpy as np
from pyspark.sql import functions as F

from ..operators import features as ft
from ..operators import linear as lm
from ..operators.splits import split_exact
from ..oracles import kit as k
from ..plans.tabular import Experiment, SegmentedRidge, SegmentPlan
from ..sources import views
from . import query, r6
from .scalar import DESIGN, X, design
from .scan import nulled

M = k.moment_cte("m", "d", 5)


def weights(spark, model):
    return model.table(spark).select("pos", "feature", r6(F.col("weight")).alias("weight"))


@query(k.sql(k.weights_out(X, "w"), *DESIGN, M, *k.solve_ctes("w", "m", 5)))
def fit_least_squares(spark, sf):
    return weights(spark, lm.least_squares(lm.moments_of(design(spark, sf), X), X))


@query(k.sql(k.weights_out(X, "w"), *DESIGN, M, *k.ridge_ctes("w", "m", 5, "0.02")))
def fit_ridge(spark, sf):
    return weights(spark, lm.ridge(lm.moments_of(design(spark, sf), X), X, 0.02))


@query(k.sql(k.weights_out(X, "w"), *DESIGN, M, *k.ridge_ctes("w", "m", 5, "0.1")))
def warm_start_ridge(spark, sf):
    """The starting weights of the iterative models."""
    return weights(spark, lm.ridge(lm.moments_of(design(spark, sf), X), X, 0.1))


def _gd_sql(d, steps, gamma):
    def s(i, j):
        return f"s{min(i, j)}_{max(i, j)}"

    moves = ", ".join(f"w{i} - {gamma!r}::double * ({' + '.join(f'{s(i, j)} * w{j}' for j in range(d))} - t{i}) / n" for i in range(d))
    first = ", ".join(f"0.0::double as w{i}" for i in range(d))
    return [M, f"g as (select 0 as step, {first} union all select step + 1, {moves} from g, m where step < {steps})",
            f"w as (select * from g where step = {steps})"]


@query(k.sql(k.weights_out(X, "w"), *DESIGN, *_gd_sql(5, 50, 0.0001), recursive=True))
def fit_gd(spark, sf):
    return weights(spark, lm.descend(lm.moments_of(design(spark, sf), X), X, np.zeros(5), 50, 0.0001))


_SGD = (k.ranked("rk", "d", 1),
        f"draw as materialized (select t, floor({k.uniform("'1:' || t")} * n)::bigint as k from "
        "(select unnest(range(1, 31)) as t), (select count(*) as n from d))",
        "seq as materialized (select t, x0, x1, x2, x3, x4, y from draw join rk using (k))",
        "g as (select 0::bigint as step, " + ", ".join(f"0.0::double as w{i}" for i in range(5)) +
        " union all select step + 1, " + ", ".join(f"w{i} + 0.001::double * (y - {k.score(5)}) * x{i}" for i in range(5)) +
        " from g join seq on t = step + 1)",
        "w as (select * from g where step = 30)")


@query(k.sql(k.weights_out(X, "w"), *DESIGN, *_SGD, recursive=True))
def fit_sgd(spark, sf):
    return weights(spark, lm.descend_stochastic(design(spark, sf), X, "y", np.zeros(5), 30, [0.001])[0])


_BATCHES = (k.ranked("rk", "d", 1),
            f"draw as materialized (select t, floor({k.uniform("'1:' || t || case when b = 0 then '' else ':' || b end")} * n)::bigint as k "
            "from (select unnest(range(1, 21)) as t), (select unnest(range(8)) as b), (select count(*) as n from d))",
            "seq as materialized (select t, x0, x1, x2, x3, x4, y from draw join rk using (k))",
            k.moment_cte("mm", "seq", 5, keys=["t"]).replace("yy", "sq"),
            "g as (select 0::bigint as step, " + ", ".join(f"0.0::double as w{i}" for i in range(5)) + " union all select step + 1, "
            + ", ".join(f"w{i} - 0.001::double * (" + " + ".join(f"s{min(i, j)}_{max(i, j)} * w{j}" for j in range(5)) + f" - t{i}) / n"
                        for i in range(5)) + " from g join mm on t = step + 1)",
            "w as (select * from g where step = 20)")


@query(k.sql(k.weights_out(X, "w"), *DESIGN, *_BATCHES, recursive=True))
def fit_sgd_batch(spark, sf):
    """Eight drawn rows for each step."""
    return weights(spark, lm.descend_stochastic(design(spark, sf), X, "y", np.zeros(5), 20, [0.001], batch=8)[0])


def _logistic_sql(d, steps, gamma, lam=0.0, newton=False):
    p = f"(1 / (1 + exp(-{k.score(d)})))"
    out = [f"v0 as materialized (select {', '.join(f'0.0::double as w{i}' for i in range(d))})"]
    for t in range(steps):
        grads = ", ".join(f"sum(x{i} * ({p} - y01)) + {lam!r} * any_value(w{i}) as t{i}" for i in range(d))
        hess = "".join(f", sum(x{i} * x{j} * {p} * (1 - {p}))" + (f" + {lam!r}" if i == j else "") + f" as s{i}_{j}"
                       for i in range(d) for j in range(i, d)) if newton else ""
        out.append(f"q{t} as materialized (select {grads}{hess} from d, v{t})")
        if newton:
            out += k.solve_ctes(f"st{t}", f"q{t}", d)
            moves = ", ".join(f"v{t}.w{i} - {gamma!r}::double * st{t}.w{i} as w{i}" for i in range(d))
            out.append(f"v{t + 1} as materialized (select {moves} from v{t}, st{t})")
        else:
            moves = ", ".join(f"w{i} - {gamma!r}::double * t{i} as w{i}" for i in range(d))
            out.append(f"v{t + 1} as materialized (select {moves} from v{t}, q{t})")
    return out


# the gradient is a sum over the rows: the step is set for the size of the checked table
_GAMMA = 1e-6


@query(k.sql(k.weights_out(X, "v5"), *DESIGN, *_logistic_sql(5, 5, _GAMMA)))
def fit_logistic_gd(spark, sf):
    return weights(spark, lm.logistic(design(spark, sf), X, "y01", np.zeros(5), 5, _GAMMA))


@query(k.sql(k.weights_out(X, "v3"), *DESIGN, *_logistic_sql(5, 3, 1.0, newton=True)))
def fit_logistic_newton(spark, sf):
    return weights(spark, lm.logistic(design(spark, sf), X, "y01", np.zeros(5), 3, 1.0, newton=True))


@query(k.sql(k.weights_out(X, "v5"), *DESIGN, *_logistic_sql(5, 5, _GAMMA, 1000.0)))
def fit_logistic_l2(spark, sf):
    return weights(spark, lm.logistic(design(spark, sf), X, "y01", np.zeros(5), 5, _GAMMA, lam=1000.0, stop=lm.STOP_BELOW))


COLS = ["f0", "f1", "f3"]
PREP, NAMES = k.prepared(COLS, 2, "median", True)
D = len(NAMES)
_RIDGE = (*PREP, k.ranked("rk", "d", 1), "dt as materialized (select *, k < floor(0.8::double * total) as is_train from rk)",
          k.moment_cte("m", "dt", D, where="where is_train"), *k.ridge_ctes("w", "m", D, "0.02"))
_LABEL = f"(case when {k.score(D)} > 0 then 1 else -1 end)"
_HIT = f"avg(case when y = {_LABEL} then 1.0 else 0.0 end)"


def experiment(**kw):
    return Experiment("ridge", COLS, degree=2, missing="median", **{"params": {"lam": 0.02}, **kw})


@query(k.sql(k.weights_out(NAMES, "w"), *_RIDGE))
def ridge_workflow(spark, sf):
    """Repair by median, powers to degree 2, scaling, exact 80 % split, ridge."""
    return weights(spark, experiment(ratio=0.8).run(nulled(spark, sf)).model)


@query(k.sql(f"""select {k.r6('sqrt(avg(pow(y - ' + k.score(D) + ', 2)) filter (where not is_train))')} as error,
  {k.r6(_HIT + ' filter (where is_train)')} as train_accuracy, {k.r6(_HIT + ' filter (where not is_train)')} as accuracy
  from dt, w""", *_RIDGE))
def train_validate_ridge(spark, sf):
    out = experiment(ratio=0.8).run(nulled(spark, sf))
    return spark.createDataFrame([tuple(round(v, 6) for v in (out.error, out.train_accuracy, out.accuracy))],
                                 "error DOUBLE, train_accuracy DOUBLE, accuracy DOUBLE")


_GAPPED, _GAP_NAMES = k.prepared(["f0", "f1", "f3", "f5"], 1, "keep", False)
_COMPLETE = (*_GAPPED, "dc as materialized (select * from d where " + " and ".join(f"x{i} is not null" for i in range(5)) + ")",
             k.ranked("rk", "dc", 1), "dt as materialized (select *, k < floor(0.8::double * total) as is_train from rk)",
             k.moment_cte("m", "dt", 5, where="where is_train"), *k.ridge_ctes("w", "m", 5, "0.02"))


@query(k.sql("select pos, feature, weight, (select count(*) from d)::bigint - (select count(*) from dc)::bigint as left_out from ("
             + k.weights_out(_GAP_NAMES, "w") + ")", *_COMPLETE))
def ridge_incomplete_rows(spark, sf):
    """Unscaled features that keep their gaps: incomplete rows are left out and counted."""
    exp = Experiment("ridge", ["f0", "f1", "f3", "f5"], missing="keep", scale=False, ratio=0.8, params={"lam": 0.02})
    out = exp.run(nulled(spark, sf))
    return weights(spark, out.model).withColumn("left_out", F.lit(out.left_out).cast("bigint"))


_FOLDS = (*PREP, k.ranked("rk", "d", 1), "dt as materialized (select *, least(k // (total // 4), 3)::int as fold from rk)",
          "fd as materialized (select dt.*, g.held from dt, (select unnest(range(4))::int as held) g)",
          k.moment_cte("m", "fd", D, keys=["held"], where="where fold <> held"), *k.ridge_ctes("w", "m", D, "0.02", ["held"]))


@query(k.sql(f"""select {k.r6('avg(err)')} as error, {k.r6('avg(acc_train)')} as train_accuracy, {k.r6('avg(acc)')} as accuracy from (
  select held, sqrt(avg(pow(y - {k.score(D)}, 2)) filter (where fold = held)) as err,
         {_HIT} filter (where fold <> held) as acc_train, {_HIT} filter (where fold = held) as acc
  from fd join w using (held) group by held)""", *_FOLDS))
def cross_validate_ridge(spark, sf):
    """Four exact folds from one pass of moments."""
    out = experiment(folds=4).run(nulled(spark, sf))
    return spark.createDataFrame([tuple(round(v, 6) for v in (out.error, out.train_accuracy, out.accuracy))],
                                 "error DOUBLE, train_accuracy DOUBLE, accuracy DOUBLE")


_GRID = (*PREP, k.ranked("rk", "d", 1), "dt as materialized (select *, k < floor(0.8::double * total) as is_train from rk)",
         k.moment_cte("m", "dt", D, where="where is_train"),
         "lam as (select t, pow(10.0::double, -12 + 11 * t / 19.0::double) as lam from (select unnest(range(20))::int as t))",
         "ml as materialized (select * from m, lam)", *k.ridge_ctes("w", "ml", D, "lam", ["t", "lam"]))


@query(k.sql(f"""select t as config, {k.r6('sqrt(avg(pow(y - ' + k.score(D) + ', 2)))')} as error, {k.r6(_HIT)} as accuracy
  from dt, w where not is_train group by t""", *_GRID))
def grid_search_ridge(spark, sf):
    """The default 20 penalties: one moment matrix, one scoring pass."""
    out = experiment(ratio=0.8, tune=True).run(nulled(spark, sf))
    return spark.createDataFrame([(i, round(t["error"], 6), round(t["accuracy"], 6)) for i, t in enumerate(out.trials)],
                                 "config INT, error DOUBLE, accuracy DOUBLE")


_WARM = [*PREP, k.ranked("rk", "d", 1), "dt as materialized (select *, k < floor(0.8::double * total) as is_train from rk)"]
_SETTINGS = [(g, lam) for lam in (100.0, 1000.0) for g in (1e-6, 1e-5)]


def _logistic_grid_sql(steps):
    z, p = k.score(D), f"(1 / (1 + exp(-{k.score(D)})))"
    out = [*_WARM, k.moment_cte("ma", "dt", D, y="y01"), *k.ridge_ctes("wa", "ma", D, "0.1")]
    out.append("v0 as materialized (select config, gamma, lam, wa.* from wa, (values "
               + ", ".join(f"({c}::int, {g!r}::double, {lam!r}::double)" for c, (g, lam) in enumerate(_SETTINGS)) + ") s(config, gamma, lam))")
    for t in range(steps):
        moves = ", ".join(f"any_value(w{i}) - gamma * (sum(x{i} * ({p} - y01)) + lam * any_value(w{i})) as w{i}" for i in range(D))
        out.append(f"v{t + 1} as materialized (select config, gamma, lam, {moves} from dt, v{t} where is_train group by config, gamma, lam)")
    size = " + ".join(f"any_value(w{i}) * any_value(w{i})" for i in range(D))
    return k.sql(f"select config, round(sum(greatest({z}, 0) + ln(1 + exp(-abs({z}))) - y01 * {z}) + 0.5 * any_value(lam) * ({size}), 4) as error, "
                 f"{k.r6(f'avg(case when y01 = (case when {z} > 0 then 1 else 0 end) then 1.0 else 0.0 end)')} as accuracy "
                 f"from dt, v{steps} where not is_train group by config", *out)


@query(_logistic_grid_sql(3))
def grid_search_logistic(spark, sf):
    """Penalties and steps of the regularised model, all moved together: one pass over the rows for each step."""
    exp = Experiment("logistic_l2", COLS, degree=2, missing="median", ratio=0.8, steps=3,
                     ranges={"lam": [100.0, 1000.0], "gamma": [1e-6, 1e-5]})
    out = exp.run(nulled(spark, sf))
    return spark.createDataFrame([(i, round(t["error"], 4), round(t["accuracy"], 6)) for i, t in enumerate(out.trials)],
                                 "config INT, error DOUBLE, accuracy DOUBLE")


_GAMMAS = [0.05, 0.1, 0.2, 0.3]


def _gd_grid_sql(steps):
    moves = ", ".join(f"w{i} - gamma * ({' + '.join(f's{min(i, j)}_{max(i, j)} * w{j}' for j in range(D))} - t{i}) / n" for i in range(D))
    out = [*_WARM, k.moment_cte("ma", "dt", D), *k.ridge_ctes("wa", "ma", D, "0.1"), k.moment_cte("m", "dt", D, where="where is_train"),
           "g as (select 0 as step, config, gamma, wa.* from wa, (values "
           + ", ".join(f"({c}::int, {g!r}::double)" for c, g in enumerate(_GAMMAS))
           + f") s(config, gamma) union all select step + 1, config, gamma, {moves} from g, m where step < {steps})",
           f"w as (select * from g where step = {steps})"]
    return k.sql(f"select config, {k.r6(f'avg(pow(y - {k.score(D)}, 2)) / 2')} as error, {k.r6(_HIT)} as accuracy "
                 "from dt, w where not is_train group by config", *out, recursive=True)


@query(_gd_grid_sql(20))
def grid_search_gd(spark, sf):
    """Step lengths of gradient descent, all from one pass of moments."""
    out = Experiment("gd", COLS, degree=2, missing="median", ratio=0.8, steps=20, ranges={"gamma": _GAMMAS}).run(nulled(spark, sf))
    return spark.createDataFrame([(i, round(t["error"], 6), round(t["accuracy"], 6)) for i, t in enumerate(out.trials)],
                                 "config INT, error DOUBLE, accuracy DOUBLE")


@query(k.sql(f"select id::bigint as \"Id\", {_LABEL} as \"Prediction\" from d, w", *_RIDGE))
def predict_workflow(spark, sf):
    """Fit on the labelled table, then the same preparation and the chosen weights on the whole table."""
    table = nulled(spark, sf)
    exp = experiment(ratio=0.8)
    return exp.predict(exp.run(table), table)


PLANS = {0: SegmentPlan(["f0", "f1"], 3, 0.2), 1: SegmentPlan(["f0", "f1", "f3", "f4"], 2, 0.1),
         2: SegmentPlan(["f0", "f1", "f3", "f4", "f5"], 1, 0.2)}


def _segment_sql():
    out = [k.FEATURES, k.NULLED, "sm as materialized (select id, y, least(f2::int, 2) as seg, f0, coalesce(f1, 0) as f1, "
           "coalesce(f3, 0) as f3, coalesce(f4, 0) as f4, coalesce(f5, 0) as f5 from nf)",
           "ss as materialized (select *, row_number() over (partition by seg order by md5('155:' || id), id) "
           "<= floor(0.8::double * count(*) over (partition by seg)) as is_train from sm)"]
    parts = []
    for s, p in PLANS.items():
        cells = [f"pow({c}, {e})" for c in p.cols for e in range(1, p.degree + 1)]
        d = len(cells) + 1
        cols = ", ".join(f"{c} as x{i}" for i, c in enumerate(cells, 1))
        out += [f"d{s} as materialized (select id, y, is_train, 1.0::double as x0, {cols} from ss where seg = {s})",
                k.moment_cte(f"m{s}", f"d{s}", d, where="where is_train"), *k.ridge_ctes(f"w{s}", f"m{s}", d, repr(p.lam))]
        parts.append(f"select id, {s} as seg, y, is_train, case when {k.score(d)} > 0 then 1 else -1 end as p from d{s}, w{s}")
    return [*out, "pr as materialized (" + " union all ".join(parts) + ")"]


def _segmented(spark, sf):
    return SegmentedRidge(ft.segment(views.SEGMENT), PLANS).fit(nulled(spark, sf))


@query(k.sql(f"""select seg as segment, is_train, count(*)::bigint as n,
  {k.r6('avg(case when y = p then 1.0 else 0.0 end)')} as accuracy from pr group by 1, 2""", *_segment_sql()))
def segmented_ridge(spark, sf):
    return _segmented(spark, sf).accuracies().withColumn("accuracy", r6(F.col("accuracy")))


@query(k.sql("select id::bigint as \"Id\", p::int as \"Prediction\" from pr", *_segment_sql()))
def segmented_predictions(spark, sf):
    return _segmented(spark, sf).predict(nulled(spark, sf))


@query(k.sql(f"select {k.r6(f'avg(case when is_train then pow(y - {k.score(D)}, 2) end)')} as train_mse, "
             f"{k.r6(f'avg(case when not is_train then pow(y - {k.score(D)}, 2) end)')} as test_mse from dt, w", *_RIDGE))
def ridge_split_errors(spark, sf):
    """Both errors of a fit from the moments of the two parts, without scoring a row."""
    from ..operators.gram import moments
    exp = experiment(ratio=0.8)
    prep = exp.prep.fit(nulled(spark, sf))
    from ..sources.features import encode_label
    rows = split_exact(prep.transform(nulled(spark, sf)).withColumn("y", encode_label()), 0.8)
    by = moments(rows, prep.out, "y", by="is_train")
    w = lm.ridge(by[True], prep.out, 0.02).w
    return spark.createDataFrame([tuple(round(by[s].sse(w) / by[s].n, 6) for s in (True, False))],
                                 "train_mse DOUBLE, test_mse DOUBLE")
