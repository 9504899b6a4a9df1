"""Text features, bridges and profiles over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text
from ..operators import profile
from ..operators.ordered import stratified_split
from ..plans import star
from ..plans.rules import TWEETS
from ..plans.structured import clean_structured
from ..sources.tables import spread
from .registry import DATE, clean, fp, query, table


def tweets_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as tweets: tags and emojis as bracketed text, plus a mention, links and keywords the prose lacks."""
    suffix = F.concat(F.lit(" @user_"), F.col("doc_id").cast("string"), F.lit(" https://x.example www.example.com YouTube "))
    words = F.when(F.col("source") == "src1", "EMERGENCY rescue help!").when(F.col("source") == "src2", "damage, dead?").otherwise("safe?")
    return spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "source")).select(
        F.col("doc_id").alias("Tweet ID"),
        F.concat("text", suffix, words).alias("Tweet Text"),
        F.col("lang").alias("Disaster Type"),
        F.concat(F.lit("['#"), "source", F.lit("', ' ', '#"), F.upper("lang"), F.lit("']")).alias("Hashtags"),
        F.when(F.col("lang") == "en", "[]").otherwise(F.concat(F.lit("['🔥', '"), F.substring("lang", 1, 1), F.lit("🌊']"))).alias("Emojis"),
    )


def tweets(spark: SparkSession, folder: str) -> DataFrame:
    return clean_structured(tweets_raw(spark, folder), TWEETS, DATE, "documents").valid


def features(spark: SparkSession, folder: str) -> DataFrame:
    return star.text_features(tweets(spark, folder), "id", "tweet_text", "disaster_type", "hashtags", "emojis")


TWEETS_SQL = f"""
tweets as (
  select cast(doc_id as varchar) as id,
    {clean("text || ' @user_' || doc_id || ' https://x.example www.example.com YouTube ' || case source when 'src1' then 'EMERGENCY rescue help!' when 'src2' then 'damage, dead?' else 'safe?' end")} as body,
    lower(lang) as kind, ['#' || lower(source), '#' || lower(lang)] as tags, case when lang = 'en' then [] else ['🔥', lower(substr(lang, 1, 1)) || '🌊'] end as emojis
  from documents),
features as (
  select id as tweet_id, {fp('kind')} as disaster_type_key, kind as disaster_type, cast(len(emojis) as int) as emoji_count, coalesce(body, '') as tweet_text, cast(length(coalesce(body, '')) as int) as text_length,
    cast(len(string_split(trim(coalesce(body, '')), ' ')) as int) as word_count, cast(len(tags) as int) as hashtag_count,
    cast(len(regexp_extract_all(coalesce(body, ''), '@[A-Za-z0-9_]+')) as int) as mention_count,
    cast(len(regexp_extract_all(coalesce(body, ''), 'https?://|www\\.')) as int) as url_count,
    cast(len(regexp_extract_all(coalesce(body, ''), '!')) as int) as exclamation_count, cast(len(regexp_extract_all(coalesce(body, ''), '\\?')) as int) as question_count,
    cast(contains(body, 'youtube') as int) as contains_youtube,
    cast(contains(body, 'emergency') or contains(body, 'warning') or contains(body, 'evacuation') as int) as contains_alert_keyword,
    cast(contains(body, 'safe') as int) + cast(contains(body, 'rescue') as int) + cast(contains(body, 'help') as int)
      - cast(contains(body, 'damage') as int) - cast(contains(body, 'dead') as int) - cast(contains(body, 'destroyed') as int) as simple_sentiment_score
  from tweets),
labelled as (select *, case when simple_sentiment_score > 0 then 'positive' when simple_sentiment_score < 0 then 'negative' else 'neutral' end as simple_sentiment_label from features)
"""


@query("text_features", f"with {TWEETS_SQL} select * from labelled")
def text_features(spark, folder):
    return features(spark, folder)


@query("text_mart", f"with {TWEETS_SQL} select * exclude (disaster_type_key, tweet_text) from labelled")
def text_mart(spark, folder):
    return star.mart_disaster_tweet_features(features(spark, folder))


@query(
    "text_type_profile",
    f"""with {TWEETS_SQL} select disaster_type, count(*) as tweet_count, round(avg(text_length), 6) as avg_text_length, round(avg(word_count), 6) as avg_word_count,
    round(avg(hashtag_count), 6) as avg_hashtag_count, round(avg(mention_count), 6) as avg_mention_count, round(avg(url_count), 6) as avg_url_count,
    round(avg(emoji_count), 6) as avg_emoji_count, round(avg(contains_alert_keyword), 6) as alert_keyword_share, round(avg(simple_sentiment_score), 6) as avg_simple_sentiment_score,
    count(*) filter (simple_sentiment_label = 'positive') as positive_tweets, count(*) filter (simple_sentiment_label = 'negative') as negative_tweets,
    count(*) filter (simple_sentiment_label = 'neutral') as neutral_tweets from labelled group by 1""",
)
def text_type_profile(spark, folder):
    mart = star.mart_disaster_type_profile(features(spark, folder))
    return mart.withColumns({c: F.round(c, 6) for c in mart.columns if c.startswith("avg_") or c.endswith("_share")})


@query("dim_disaster_type", f"with {TWEETS_SQL} select distinct {fp('kind')} as disaster_type_key, kind as disaster_type from tweets")
def dim_disaster_type(spark, folder):
    return star.dim_disaster_type(tweets(spark, folder))


@query("hashtag_bridge", f"with {TWEETS_SQL} select tweet_id, substr(tag, 2) as hashtag from (select id as tweet_id, unnest(tags) as tag from tweets)")
def hashtag_bridge(spark, folder):
    return star.bridge_hashtag(tweets(spark, folder))


@query("emoji_bridge", f"with {TWEETS_SQL} select id as tweet_id, unnest(emojis) as emoji from tweets")
def emoji_bridge(spark, folder):
    return star.bridge_emoji(tweets(spark, folder))


@query(
    "token_bridge",
    """select doc_id, token from (select doc_id, unnest(string_split(text, ' ')) as token from documents) where token <> ''""",
)
def token_bridge(spark, folder):
    words = table(spark, folder, "documents").select("doc_id", F.split("text", " ", -1).alias("words"))
    return star.explode_bridge(words, "doc_id", "words", "token")


@query(
    "array_cleaning",
    """select doc_id, '#' || lower(source) as first_tag, cast(2 as int) as tags from documents""",
)
def array_cleaning(spark, folder):
    tags = text.clean_array(text.bracketed_to_array(F.col("Hashtags")))
    return tweets_raw(spark, folder).select(F.col("Tweet ID").alias("doc_id"), F.get(tags, 0).alias("first_tag"), F.size(tags).alias("tags"))


PERIODS = "case o_orderpriority when '1-URGENT' then 'Meteorological Year' when '2-HIGH' then 'Dec - Feb' when '3-MEDIUM' then null else 'Month ' || month(o_orderdate) end"


@query(
    "period_type",
    f"""with p as (select o_orderkey, {PERIODS} as name from orders)
    select o_orderkey, case when contains(coalesce(name, ''), '-') then 'season' when contains(lower(coalesce(name, '')), 'year') then 'annual' else 'month' end as period_type,
    regexp_replace(name, '\\s*-\\s*', '-', 'g') as month_range,
    trim(regexp_replace(regexp_replace(lower(replace(name, ' - ', '/')), '[^\\w\\s\\-]', '-', 'g'), '-+', '-', 'g')) as period_label from p""",
)
def period_type(spark, folder):
    priority = F.col("o_orderpriority")
    name = (
        F.when(priority == "1-URGENT", "Meteorological Year")
        .when(priority == "2-HIGH", "Dec - Feb")
        .when(priority != "3-MEDIUM", F.concat(F.lit("Month "), F.month("o_orderdate").cast("string")))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", name.alias("name"))
    return orders.select(
        "o_orderkey",
        text.period_type(F.col("name")).alias("period_type"),
        text.month_range(F.col("name")).alias("month_range"),
        text.period_label(F.replace("name", F.lit(" - "), F.lit("/"))).alias("period_label"),
    )


@query(
    "text_profile",
    """with d as (select case when n_chars < 40 then ' ' else text end as text, lang, source from documents)
    select count(*) as row_count, count(*) - (select count(*) from (select distinct * from d)) as duplicate_rows,
    count(*) filter (trim(coalesce(text, '')) = '') as blank_texts, count(*) filter (length(coalesce(text, '')) < 5) as short_texts from d""",
)
def text_profile(spark, folder):
    body = F.when(F.col("n_chars") < 40, " ").otherwise(F.col("text"))
    return profile.overview(table(spark, folder, "documents").select(body.alias("text"), "lang", "source"), "text")


@query(
    "missing_profile",
    """with j as (select d.doc_id, quality, toxic from documents d left join labels l using (doc_id))
    select 'doc_id' as "column", round(avg((doc_id is null)::int * 100.0::double), 6) as missing_pct from j
    union all select 'quality', round(avg((quality is null)::int * 100.0::double), 6) from j union all select 'toxic', round(avg((toxic is null)::int * 100.0::double), 6) from j""",
)
def missing_profile(spark, folder):
    joined = table(spark, folder, "documents").select("doc_id").join(table(spark, folder, "labels"), "doc_id", "left")
    return profile.missing_share(joined).withColumn("missing_pct", F.round("missing_pct", 6))


@query("label_share", "select lang, count(*) as n, round(count(*) * 100.0::double / (select count(*) from documents), 6) as pct from documents group by lang")
def label_share(spark, folder):
    return profile.label_share(table(spark, folder, "documents"), "lang").withColumn("pct", F.round("pct", 6))


@query(
    "numeric_profile",
    """select 'l_quantity' as "column", count(l_quantity) as n, round(avg(l_quantity), 6) as mean, round(stddev_samp(l_quantity), 6) as std, min(l_quantity) as min, max(l_quantity) as max from lineitem
    union all select 'l_discount', count(l_discount), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6), min(l_discount), max(l_discount) from lineitem
    union all select 'l_linenumber', count(l_linenumber), round(avg(l_linenumber), 6), round(stddev_samp(l_linenumber), 6), min(l_linenumber)::double, max(l_linenumber)::double from lineitem""",
)
def numeric_profile(spark, folder):
    stats = profile.describe(table(spark, folder, "lineitem"), ["l_quantity", "l_discount", "l_linenumber"])
    return stats.drop("quartiles").withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "numeric_quartiles",
    """with q as (select 'l_quantity' as "column", quantile_cont(l_quantity::double, [0.25, 0.5, 0.75]) as q from lineitem union all select 'l_extendedprice', quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) from lineitem)
    select "column", round(q[1], 6) as q25, round(q[2], 6) as q50, round(q[3], 6) as q75 from q""",
)
def numeric_quartiles(spark, folder):
    out = profile.describe(table(spark, folder, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select("column", *[F.round(F.get("quartiles", F.lit(i)), 6).alias(n) for i, n in enumerate(("q25", "q50", "q75"))])


@query(
    "value_counts",
    """select 'quality' as "column", quality::varchar as value, count(*) as n from labels group by all union all select 'toxic', toxic::varchar, count(*) from labels group by all""",
)
def value_counts(spark, folder):
    return profile.value_counts(table(spark, folder, "labels"), ["quality", "toxic"])


@query(
    "classification_metrics",
    """with p as (select quality as t, case when n_chars > 800 and lang = 'en' then 1 when toxic = 1 then 0 else quality end as p from labels join documents using (doc_id)),
    c as (select t, p, count(*) as n from p group by all),
    k as (select t, sum(n) as support, coalesce(sum(n) filter (t = p), 0) as hit, (select coalesce(sum(n), 0) from c d where d.p = c.t) as predicted from c group by t),
    m as (select support, hit, hit / support as r, case when predicted = 0 then 0 else hit / predicted end as p from k)
    select cast(sum(support) as bigint) as row_count, round(sum(hit) / sum(support), 6) as accuracy, round(sum(p * support) / sum(support), 6) as "precision",
    round(sum(r * support) / sum(support), 6) as recall, round(sum(case when p + r = 0 then 0 else 2 * p * r / (p + r) end * support) / sum(support), 6) as f1 from m""",
)
def classification_metrics(spark, folder):
    joined = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    guess = F.when((F.col("n_chars") > 800) & (F.col("lang") == "en"), 1).when(F.col("toxic") == 1, 0).otherwise(F.col("quality"))
    measured = profile.classification_metrics(joined.select("quality", guess.alias("guess")), "quality", "guess")
    return measured.withColumns({c: F.round(c, 6) for c in ("accuracy", "precision", "recall", "f1")})


@query(
    "stratified_split",
    """with r as (select doc_id, lang, row_number() over (partition by lang order by md5('2026:' || doc_id)) as n, count(*) over (partition by lang) as total from documents)
    select doc_id, lang, case when n <= ceil(0.2 * total) then 'test' else 'train' end as part from r""",
)
def split(spark, folder):
    train, test = stratified_split(table(spark, folder, "documents").select("doc_id", "lang"), "lang", "doc_id")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
