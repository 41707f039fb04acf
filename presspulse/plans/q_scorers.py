"""Queries over the text scorers, embeddings and the incremental ingest."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import scoring as S
from presspulse.operators import enrich as E
from presspulse.plans import inputs as I
from presspulse.plans import sql as Q
from presspulse.plans.registry import query, round_all, rounded
from presspulse.plans.sql import r, with_views
from presspulse.sources.storage import new_path, read_table, spread_if_narrow
from presspulse.streaming.ingest import ingest_articles


@query(
    "sentiment_scored",
    f"""select doc_id, {r('p / (p + n + 1.0::double)')} as "Sentiment_Positive",
    {r('1.0::double / (p + n + 1)')} as "Sentiment_Neutral", {r('n / (p + n + 1.0::double)')} as "Sentiment_Negative",
    {r('p / (p + n + 1.0::double) - n / (p + n + 1.0::double)')} as "Sentiment_Score"
    from (select doc_id, {Q.listed(E.POSITIVE_WORDS, 'text')} as p, {Q.listed(E.NEGATIVE_WORDS, 'text')} as n from documents)""",
)
def sentiment_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents through a plugged-in batch scorer."""
    docs = spread_if_narrow(read_table(spark, folder, "documents").select("doc_id", "text"))
    scored = E.score_sentiment(docs, "text", E.word_list_scorer)
    return scored.select(
        "doc_id", *round_all("Sentiment_Positive", "Sentiment_Neutral", "Sentiment_Negative", "Sentiment_Score")
    )


@query(
    "topics_scored",
    f"""with s as (select doc_id, {Q.topic_similarities('t')} as v from (select doc_id, {Q.tokens('text')} as t from documents)),
    e as (select doc_id, list_transform(v, lambda a: exp(a - list_max(v))) as e from s),
    p as (select doc_id, list_transform(e, lambda a: a / list_sum(e)) as p from e)
    select doc_id, {', '.join(r(f'p[{i}]') + f' as "{c}"' for i, c in enumerate(C.TOPIC_COLUMNS, 1))} from p""",
)
def topics_scored(spark: SparkSession, folder: str) -> DataFrame:
    """Topic distribution of whole documents by the built-in scorer."""
    docs = spread_if_narrow(read_table(spark, folder, "documents").select("doc_id", "text"))
    probs = docs.select("doc_id", S.topic_overlap_scores(F.col("text")).alias("p"))
    return probs.select("doc_id", *[rounded(F.get("p", F.lit(i))).alias(c) for i, c in enumerate(C.TOPIC_COLUMNS)])


@query(
    "text_embeddings",
    f"""with words as (select doc_id, {Q.tokens('text')} as t from documents where text <> ''),
    counted as (select doc_id, dim, count(*)::double as c
      from (select doc_id, unnest({Q.word_dimensions('t')}) as dim from words) group by all),
    norms as (select doc_id, sqrt(sum(c * c)) as norm from counted group by doc_id)
    select w.doc_id, d.dim::int as dim, {r('coalesce(c.c / n.norm, 0.0::double)')} as value
    from words w cross join range(64) d(dim) left join counted c on c.doc_id = w.doc_id and c.dim = d.dim
    left join norms n on n.doc_id = w.doc_id""",
)
def text_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Document vectors through the keyed cache: English texts first, then all, computing only the rest."""
    docs = spread_if_narrow(read_table(spark, folder, "documents").select("doc_id", "lang", "text"))
    path = new_path(spark, "embedding-cache")
    encode = lambda texts: E.hashed_embedding(texts, "text")
    E.enrich(docs.where("lang = 'en'"), "text", path, E.EMBEDDINGS, encode, E.HASHED_ENCODER)
    out = E.enrich(docs, "text", path, E.EMBEDDINGS, encode, E.HASHED_ENCODER)
    return out.select("doc_id", F.posexplode("embedding").alias("dim", "value")).withColumn("value", rounded("value"))


@query(
    "stream_ingest",
    with_views(
        "dated",
        """select ord, ticker as "Ticker", company as "Company", news_date as "News_Date", published_ist as "Published_At",
        title as "Headline", url as "URL", publisher as "Publisher", sha256(description) as "Description_Hash",
        url_key as "URL_Key", headline_key as "Headline_Key" from kept""",
        [
            ("keyed", f"select *, {Q.url_key('url')} as url_key, {Q.norm('title')} as headline_key from dated"),
            *Q.dedup_walk("keyed"),
        ],
        recursive=True,
    ),
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The event table, as a stream of two batches of files, into a table of distinct whole articles."""
    events = read_table(spark, folder, "events")
    source = new_path(spark, "events")
    halves = [events.where(F.col("event_id") % 2 == part) for part in (0, 1)]  # late rows: each half has rows of all days
    for half in halves:
        half.write.mode("append").parquet(source)
    files = math.ceil(len(spark.read.parquet(source).inputFiles()) / 2)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(source)
    table = ingest_articles(stream, lambda batch: I.articles(spark, folder, events=batch), new_path(spark, "ingest"), I.HOLIDAYS)
    return table.select(
        "ord", "Ticker", "Company", "News_Date", "Published_At", "Headline", "URL", "Publisher",
        F.sha2("Description", 256).alias("Description_Hash"), "URL_Key", "Headline_Key",
    )
