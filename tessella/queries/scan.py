"""Sources, sinks and format conversion."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..oracles import kit as k
from ..operators.means import EntityMean
from ..operators.splits import parts, split_per_user
from ..session import scratch_path
from ..sources import checked
from ..sources import features as fs
from ..sources import ratings as rs
from ..sources import views
from . import query, r6, r9


def nulled(spark: SparkSession, sf: str) -> DataFrame:
    return fs.missing_to_null(views.features(spark, sf), views.FEATURES)


@query(k.sql("select id, label, " + ", ".join(f"{k.r9(c)} as {c}" for c in k.FS) + " from nf", k.FEATURES, k.NULLED))
def load_features(spark, sf):
    return nulled(spark, sf).select("id", "label", *[r9(F.col(c)).alias(c) for c in views.FEATURES])


@query(k.sql("select id, y as signed, y01 as binary_label from nf", k.FEATURES, k.NULLED))
def label_encode(spark, sf):
    return views.features(spark, sf).select("id", fs.encode_label().alias("signed"),
                                            fs.encode_label(logistic=True).alias("binary_label"))


@query(k.sql(f"select id, label, {k.r9('f0')} as f0 from f order by id limit 100", k.FEATURES))
def subsample_head(spark, sf):
    return fs.head_sample(views.features(spark, sf).select("id", "label", r9(F.col("f0")).alias("f0")))


@query(k.sql("select id::bigint as \"Id\", case when f0 > 2.5 then 1 else -1 end as \"Prediction\" from f", k.FEATURES))
def submission_classes(spark, sf):
    binary = views.features(spark, sf).select("id", F.when(F.col("f0") > 2.5, 1.0).otherwise(0.0).alias("prediction"))
    return fs.submission(binary)


@query(k.sql("select id::bigint as \"Id\", case when f0 > 2.5 then 1 else -1 end as \"Prediction\" from f", k.FEATURES))
def submission_file(spark, sf):
    """The classes written as a CSV file and read again."""
    path = scratch_path(spark, "submission")
    fs.write_submission(submission_classes(spark, sf), path)
    return spark.read.csv(path, header=True, schema="Id BIGINT, Prediction INT")


def _damaged(df: DataFrame, key: str, cols: list[str], path: str) -> None:
    """The rows as CSV text without a header; by ``key`` some have a word for a number, some lack fields, some have too many."""
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    kind = F.pmod(F.col(key), F.lit(50))
    df.select(F.when(kind == 3, F.concat(text, F.lit("x"))).when(kind == 7, F.substring_index(text, ",", len(cols) - 1))
              .when(kind == 11, F.concat(text, F.lit(",1"))).otherwise(text).alias("value")).write.text(path)


_DAMAGED = "% 50 in (3, 7, 11)"


@query(k.sql("select id, label, " + ", ".join(f"{k.r9(c)} as {c}" for c in k.FS)
             + f", (select count(*) from nf where id {_DAMAGED})::bigint as n_bad from nf where not id {_DAMAGED}", k.FEATURES, k.NULLED))
def load_features_damaged(spark, sf):
    """A labelled file with damaged rows: the good rows, and how many are bad."""
    path = scratch_path(spark, "damaged-features")
    _damaged(nulled(spark, sf), "id", ["id", "label", *views.FEATURES], path)
    found = checked.read_labelled_checked(spark, path, len(views.FEATURES), header=False)
    return found.good.select("id", "label", *[r9(F.col(c)).alias(c) for c in views.FEATURES], F.lit(found.n_bad).cast("long").alias("n_bad"))


@query(k.sql("select u as \"user\", i as item, r as rating, "
             f"(select count(*) from r where (u * 100 + i) {_DAMAGED} or (u + i) % 31 = 0)::bigint as n_bad from r "
             f"where not ((u * 100 + i) {_DAMAGED} or (u + i) % 31 = 0)", k.RATINGS))
def normalize_ratings_damaged(spark, sf):
    """An upstream file with damaged rows, ids of another form and ratings out of range."""
    path = scratch_path(spark, "damaged-ratings")
    rows = views.ratings(spark, sf)
    spoilt = F.pmod(F.col("user") + F.col("item"), F.lit(31)) == 0
    named = F.concat(F.lit("r"), F.col("user") + 1, F.when(spoilt & (F.col("user") % 2 == 0), "-c").otherwise("_c"), F.col("item") + 1)
    rated = F.when(spoilt & (F.col("user") % 2 == 1), 9).otherwise(F.col("rating").cast("int"))
    _damaged(rows.select((F.col("user") * 100 + F.col("item")).alias("key"), named.alias("Id"), rated.alias("Prediction")), "key",
             ["Id", "Prediction"], path)
    found = checked.read_ratings_checked(spark, path, header=False)
    return found.good.withColumn("n_bad", F.lit(found.n_bad).cast("long"))


@query(k.sql("select u as \"user\", i as item, r as rating from r", k.RATINGS))
def load_item_major(spark, sf):
    """A file whose ids name the item first: the same triplets from the other form."""
    path = scratch_path(spark, "item-major")
    turned = views.ratings(spark, sf).select(F.col("item").alias("user"), F.col("user").alias("item"), "rating")
    rs.denormalise(turned).write.csv(path, header=True)
    return rs.normalise(rs.read_upstream(spark, path), row="item", col="user")


@query(k.sql("select u as \"user\", i as item, r as rating from r", k.RATINGS))
def normalize_ratings(spark, sf):
    """Upstream text file out and in again, then normalised."""
    path = scratch_path(spark, "upstream")
    views.upstream(spark, sf).write.csv(path, header=True)
    return rs.normalise(rs.read_upstream(spark, path))


@query(k.sql("select u as \"user\", i as item, r as rating from r", k.RATINGS))
def ratings_scan(spark, sf):
    """Normalised triplet file out and in again under its fixed schema."""
    path = scratch_path(spark, "triplets")
    rs.write_triplets(views.ratings(spark, sf), path)
    return rs.read_triplets(spark, path)


@query(k.sql("select 'r' || (u + 1) || '_c' || (i + 1) as \"Id\", trunc(r * 0.9)::int as \"Prediction\" from r", k.RATINGS))
def denormalize_predictions(spark, sf):
    return rs.denormalise(views.ratings(spark, sf).withColumn("rating", F.col("rating") * 0.9))


@query("""with log as (select user_id::bigint as u, json_extract_string(props, '$.k')::bigint as i, event_id,
                  case when event_type = 'view' then 0 else value end as rating from events)
select u as "user", i as item, round(max_by(rating, event_id), 6) as rating from log
group by 1, 2 having max_by(rating, event_id) <> 0""")
def ratings_dedup(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    log = ev.select(F.col("user_id").cast("bigint").alias("user"), F.get_json_object("props", "$.k").cast("bigint").alias("item"),
                    "event_id", F.when(F.col("event_type") == "view", 0.0).otherwise(F.col("value")).alias("rating"))
    return rs.last_write(log, "event_id").withColumn("rating", r6(F.col("rating")))


_MEANS = (k.RATINGS, k.SPLIT, """pr as (
  select 'User-Mean' as model, u, i, m as p from te left join (select u, avg(r) as m from tr group by u) using (u)
  union all select 'Item-Mean', u, i, m from te left join (select i, avg(r) as m from tr group by i) using (i))""")


def mean_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each model and test cell; unseen users and items have no prediction."""
    train, test = parts(split_per_user(views.ratings(spark, sf)))
    out = [EntityMean(key).fit(train).transform(test).select(F.lit(name).alias("model"), "user", "item", "prediction")
           for name, key in (("User-Mean", "user"), ("Item-Mean", "item"))]
    return out[0].unionByName(out[1])


@query(k.sql(f"select model, u as \"user\", i as item, {k.r6('p')} as prediction from pr", *_MEANS))
def prediction_scan_long(spark, sf):
    """One CSV folder per model, named after it, read back as one long table."""
    root = scratch_path(spark, "prediction-files")
    long = mean_predictions(spark, sf).persist()
    for name in ("User-Mean", "Item-Mean"):
        long.where(F.col("model") == name).select("user", "item", "prediction").write.csv(f"{root}/{name}.csv", header=True)
    long.unpersist()
    return rs.read_prediction_files(spark, root).withColumn("prediction", r6(F.col("prediction")))


@query(k.sql("select distinct u as \"user\", i as item from pr", *_MEANS))
def submission_pairs(spark, sf):
    return rs.id_pairs(mean_predictions(spark, sf))


@query(k.sql("select min(u) as min_user, max(u) as max_user, min(i) as min_item, max(i) as max_item from r", k.RATINGS))
def rating_shape(spark, sf):
    return rs.id_ranges(views.ratings(spark, sf))
