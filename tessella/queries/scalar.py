"""Projections, filters and scalar functions."""

from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import features as ft
from ..operators.splits import active_only
from ..oracles import kit as k
from ..sources import features as fs
from ..sources import views
from . import query, r6, r9
from .scan import nulled

X = ["bias", "f0", "f1", "f3", "f4"]
W = [-2.0, 0.3, 0.4, 0.02, -1.5]

DESIGN = (k.FEATURES, k.NULLED, "d as materialized (select id, y, y01, 1.0::double as x0, f0 as x1, "
          "coalesce(f1, 0) as x2, coalesce(f3, 0) as x3, coalesce(f4, 0) as x4 from nf)")
Z = k.dot(k.xs(5), W)
SIGMA = f"(1 / (1 + exp(-{Z})))"


def design(spark, sf):
    rows = nulled(spark, sf).fillna(0.0, views.FEATURES)
    return rows.select("id", fs.encode_label().alias("y"), fs.encode_label(logistic=True).alias("y01"),
                       F.lit(1.0).alias("bias"), *X[1:])


def scored(spark, sf):
    return design(spark, sf).withColumn("z", fn.dot(X, W))


@query(k.sql(f"select id, {k.r6(SIGMA)} as p from d", *DESIGN))
def sigmoid_score(spark, sf):
    return scored(spark, sf).select("id", r6(fn.sigmoid(F.col("z"))).alias("p"))


@query(k.sql(f"select id, {k.r9(Z)} as score from d", *DESIGN))
def linear_score(spark, sf):
    return scored(spark, sf).select("id", r9(F.col("z")).alias("score"))


@query(k.sql(f"select id, {k.r9('y - ' + Z)} as residual from d", *DESIGN))
def residuals(spark, sf):
    return scored(spark, sf).select("id", r9(F.col("y") - F.col("z")).alias("residual"))


@query(k.sql(f"select id, case when {Z} > 0 then 1.0 else -1.0 end::double as label from d", *DESIGN))
def predict_labels_linear(spark, sf):
    return scored(spark, sf).select("id", fn.class_label(F.col("z")).alias("label"))


@query(k.sql(f"select id, case when {SIGMA} > 0.5 then 1.0 else 0.0 end::double as label from d", *DESIGN))
def predict_labels_logistic(spark, sf):
    return scored(spark, sf).select("id", fn.class_label(fn.sigmoid(F.col("z")), logistic=True).alias("label"))


# a feature has seven decimals and its square fourteen: neither is cut at a half by these digits
def _powers(cols, degree, step=1):
    return [f"{(k.r9 if p == 1 else k.r6)(f'pow({c}, {p})')} as {c}_p{p}" for c in cols for p in range(1, degree + 1, step)]


def _show(df, cols):
    return df.select("id", *[(r6 if c[-2:] in ("p2", "p3", "p4") else r9)(F.col(c)).alias(c) for c in cols])


@query(k.sql(f"select id, 1.0::double as bias, {', '.join(_powers(['f0', 'f1', 'f4'], 3))} from nf", k.FEATURES, k.NULLED))
def poly_expand(spark, sf):
    return _show(*ft.expand_powers(nulled(spark, sf), ["f0", "f1", "f4"], 3))


@query(k.sql(f"select id, 1.0::double as bias, {', '.join(_powers(['f0', 'f1', 'f4'], 3, 2))} from nf", k.FEATURES, k.NULLED))
def poly_expand_odd(spark, sf):
    return _show(*ft.expand_powers(nulled(spark, sf), ["f0", "f1", "f4"], 3, odd_only=True))


@query(k.sql(f"select id, {', '.join(_powers(['f0'], 4))} from nf", k.FEATURES, k.NULLED))
def poly_one_feature(spark, sf):
    return _show(*ft.expand_powers(nulled(spark, sf), ["f0"], 4, bias=False))


@query(k.sql(f"select id, {k.r9('f0')} as f0, {', '.join(_powers(['f1'], 3))}, {k.r9('f3')} as f3 from nf", k.FEATURES, k.NULLED))
def augment_feature(spark, sf):
    return _show(*ft.expand_one(nulled(spark, sf), ["f0", "f1", "f3"], "f1", 3))


@query(k.sql(f"select id, 1.0::double as bias, {', '.join(_powers(['f0'], 2) + _powers(['f1'], 3) + _powers(['f2'], 1))} from nf",
             k.FEATURES, k.NULLED))
def poly_with_degrees(spark, sf):
    return _show(*ft.expand_powers(nulled(spark, sf), ["f0", "f1", "f2"], [2, 3, 1]))


@query(k.sql("select id, (f1 is not null)::int as has_f1, (f3 is not null)::int as has_f3, (f5 is not null)::int as has_f5 "
             "from nf", k.FEATURES, k.NULLED))
def missing_indicators(spark, sf):
    rows, names = ft.missing_indicators(nulled(spark, sf), views.FEATURES)
    return rows.select("id", *names)


@query(k.sql(f"select id, {k.r9('f0')} as f0, {k.r9('f2')} as f2 from nf", k.FEATURES, k.NULLED))
def drop_missing_features(spark, sf):
    rows, kept = ft.drop_incomplete(nulled(spark, sf), views.FEATURES)
    return _show(rows, kept)


@query(k.sql("select least(f2::int, 2) as segment, label, count(*)::bigint as n from f group by 1, 2", k.FEATURES))
def segment_counts(spark, sf):
    rows = views.features(spark, sf).withColumn("segment", ft.segment(views.SEGMENT))
    return rows.groupBy("segment", "label").agg(F.count(F.lit(1)).alias("n"))


@query(k.sql(f"""select id, least(f2::int, 2) as segment, {k.r9('f0')} as f0, {k.r9('f1')} as f1,
  case when f2 >= 1 then {k.r9('f3')} end as f3, case when f2 >= 1 then {k.r9('f4')} end as f4,
  case when f2 >= 2 then {k.r9('f5')} end as f5 from nf""", k.FEATURES, k.NULLED))
def segment_project(spark, sf):
    """Each segment keeps its own features; the others are absent for it."""
    kept = {"f0": 0, "f1": 0, "f3": 1, "f4": 1, "f5": 2}
    rows = nulled(spark, sf).withColumn("segment", ft.segment(views.SEGMENT))
    return rows.select("id", "segment", *[F.when(F.col("segment") >= least, r9(F.col(c))).alias(c) for c, least in kept.items()])


@query(k.sql(f"select u as \"user\", i as item, {k.r6(k.clip('r * 1.5 - 1'))} as rating from r", k.RATINGS))
def clip_ratings(spark, sf):
    return views.ratings(spark, sf).select("user", "item", r6(fn.clip(F.col("rating") * 1.5 - 1)).alias("rating"))


@query(k.sql(f"select u as \"user\", i as item, {k.star('r * 1.5 - 1')} as rating from r", k.RATINGS))
def round_clip_ratings(spark, sf):
    return views.ratings(spark, sf).select("user", "item", fn.star(F.col("rating") * 1.5 - 1).alias("rating"))


@query(k.sql("""select u as "user", i as item, r as rating from r
  where u in (select u from r group by u having count(*) >= (select avg(n) - 5 from (select count(*) n from r group by u)))
    and i in (select i from r group by i having count(*) >= (select avg(n) - 5 from (select count(*) n from r group by u)))""",
             k.RATINGS))
def activity_filter(spark, sf):
    rows = views.ratings(spark, sf)
    typical = rows.groupBy("user").count().agg(F.avg("count")).first()[0]
    return active_only(rows, typical - 5)
