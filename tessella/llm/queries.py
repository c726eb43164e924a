"""The registered queries of the corpus operators and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
with w as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words from documents),
s as (
  select doc_id, words, unnest(range(1, greatest(len(words) - 18, 1)::bigint)) as p0 from w),
k as (
  select doc_id, p0, array_to_string(list_slice(words, p0, p0 + 19), ' ') as win from s),
later as (
  select doc_id, p0 from k
  qualify row_number() over (partition by win order by doc_id, p0) > 1),
gone as (
  select distinct doc_id, unnest(range(p0, p0 + 20)) as pos from later),
each as (
  select doc_id, unnest(words) as word, unnest(range(1, len(words)::bigint + 1)) as pos from w),
kept as (
  select e.doc_id, string_agg(e.word, ' ' order by e.pos) filter (where g.pos is null) as txt,
         count(g.pos) as n_removed
  from each e left join gone g on g.doc_id = e.doc_id and g.pos = e.pos group by 1)
select w.doc_id, len(w.words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(txt, '')) as kept_sha256
from w left join kept using (doc_id)
""")
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.substrings import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.licences import scan_licences

    return scan_licences(table(spark, sf_dir, "documents"))[1]


@query()
def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.curves import search

    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(rows, rows.where("vec_id % 100 = 0"))


@query()
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.templates import RECURS, drop_recurring_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_recurring_lines(docs, least_docs=RECURS).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query()
def op2_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.pages import extract_text

    return extract_text(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.toxicity import fit, held_out, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels").where(~held_out()))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query()
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@query("""
with low as (
  select doc_id as id, 'd' as kind, text from documents union all select item_id, 'i', text from benchmark),
w as (
  select id, kind, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from low),
i as (
  select id, words, least(10, len(words))::bigint as width from w where kind = 'i' and len(words) > 0),
iw as (
  select id, width, words, unnest(range(1, len(words)::bigint - width + 2)) as p0 from i),
win as (
  select distinct id as item_id, width, array_to_string(list_slice(words, p0, p0 + width - 1), ' ') as win from iw),
d as (
  select id, words, width from w, (select distinct width from i) where kind = 'd' and len(words) >= width),
dw as (
  select id, width, words, unnest(range(1, len(words)::bigint - width + 2)) as p0 from d),
hits as (
  select dw.id as doc_id, p0, dw.width, item_id
  from dw join win on dw.width = win.width and array_to_string(list_slice(words, p0, p0 + dw.width - 1), ' ') = win),
cover as (
  select doc_id, count(distinct pos)::bigint as n_hit from (
    select doc_id, unnest(range(p0, p0 + width)) as pos from hits) group by 1),
items as (
  select doc_id, count(*)::bigint as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as names
  from (select distinct doc_id, item_id from hits) group by 1)
select id as doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join cover on cover.doc_id = w.id left join items on items.doc_id = w.id where kind = 'd'
""")
def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.suffixes import match_documents

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return match_documents(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query()
def op6_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessella.llm.bpe import encode_decode

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query()
def op9_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tessella.llm.rans import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


CRC_SQL = """
xor(4294967295, list_reduce(
  list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
  lambda sum, byte: list_reduce(list_prepend(xor(sum, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                                lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))
"""


@query("""
with o as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as words, len(words)::bigint as n,
         """ + CRC_SQL + """ as h from documents),
t as (
  select doc_id, words, n, case when h % 10 = 0 and n > 0 then (h // 10) % n else n end as a, 3 + (h // 10) % 8 as parts
  from o),
w as (
  select doc_id, unnest(range(n)) as i, unnest(list_transform(range(n), lambda i: words[
    1 + case when i < a then i else a + (i - a) % (1 + (n - a) // parts) end])) as word, n from t),
g as (
  select doc_id, i, n, word || ' ' || lead(word, 1) over d || ' ' || lead(word, 2) over d || ' ' || lead(word, 3) over d
                       || ' ' || lead(word, 4) over d as gram
  from w window d as (partition by doc_id order by i)),
s as (
  select x.doc_id, x.i, y.i - x.i as q from g x join g y
    on x.doc_id = y.doc_id and x.gram = y.gram and y.i > x.i and 4 * (y.i - x.i) <= x.n),
isle as (
  select doc_id, q, i, i - row_number() over (partition by doc_id, q order by i) as k from s),
stretch as (
  select doc_id, q, min(i) as start, max(i) - min(i) + 5 + q as length from isle group by doc_id, q, k
  having max(i) - min(i) + 5 + q >= greatest(6, 4 * q)),
run as (
  select * from stretch x where not exists (
    select 1 from stretch y where y.doc_id = x.doc_id and y.q < x.q and y.start <= x.start
                              and y.start + y.length >= x.start + x.length)),
r as (
  select doc_id, count(*)::bigint as n_runs, min({l: -length, s: start, q: q}) as top,
         string_agg(start || ',' || length || ',' || q || chr(10), '' order by start, q) as lines from run group by 1),
gone as (
  select distinct doc_id, unnest(range(start + q, start + length)) as i from run),
c as (
  select w.doc_id, string_agg(word, ' ' order by w.i) as txt from w anti join gone using (doc_id, i) group by 1)
select doc_id, coalesce(n_runs, 0) as n_runs, top.s::bigint as start, (-top.l)::bigint as length, top.q::bigint as period,
       (-1000 * top.l // top.q)::bigint as exponent_milli, sha256(coalesce(lines, '')) as runs_sha256,
       sha256(coalesce(txt, '')) as collapsed_sha256
from o left join r using (doc_id) left join c using (doc_id)
""")
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.runs import periodic_runs, repeated_tail

    found = periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), edit=repeated_tail)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), "top.length",
        (-F.col("top.period")).alias("period"),
        F.expr("(1000 * top.length) div (-top.period)").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


@query("""
with low as (
  select doc_id as id, 'd' as kind, text from documents union all select item_id, 'i', text from benchmark),
w as (
  select id, kind, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms from low),
d as (
  select id as doc_id, terms, len(terms)::bigint as n from w where kind = 'd' and len(terms) > 0),
total as (
  select count(*)::bigint as docs, sum(n)::bigint as all_terms from d),
i as (
  select item_id, term, count(*)::bigint as times
  from (select id as item_id, unnest(terms) as term from w where kind = 'i') group by 1, 2),
tf as (
  select doc_id, n, term, count(*)::bigint as tf from (select doc_id, n, unnest(terms) as term from d)
  semi join i using (term) group by 1, 2, 3),
df as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as weight
  from tf, total group by 1),
s as (
  select item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (
    25 + (75 * n * docs) // all_terms))))::bigint as score
  from i join tf using (term) join df using (term), total group by 1, 2)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
from s where score > 0 qualify rank <= 10
""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.lexical import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessella.llm.maxent import score_texts

    apart = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2
    scored = score_texts(table(spark, sf_dir, "documents"), ~apart)
    return scored.select("doc_id", apart.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
