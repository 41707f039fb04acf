"""Queries over company days: aggregation, thresholds, labels, validation, storage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.functions import scoring as S
from presspulse.operators import daily as D
from presspulse.operators import market as MK
from presspulse.plans import inputs as I
from presspulse.plans import jobs as J
from presspulse.plans import sql as Q
from presspulse.plans.q_articles import scored_articles
from presspulse.plans.registry import query, round_all, rounded
from presspulse.plans.sql import r, with_views
from presspulse.schemas import ARTICLES, DAILY, PERFORMANCE, PREDICTIONS, conform, finite
from presspulse.sources.storage import append_rows, cut_lineage, new_path, read_or_empty, read_range_table, replace_days, replace_range

_T = [f"t{i}" for i in range(1, 7)]
_TOPICS_SQL = ", ".join(r(f"t{i}") + f' as "{c}"' for i, c in enumerate(C.TOPIC_COLUMNS, 1))

# Articles of each company day with a simple raw weight; every tenth score is missing.
_WEIGHTED = [
    (
        "wts",
        """
  select *, raw / sum(raw) over (partition by ticker, news_date) as weight
  from (select d.ord, d.ticker, d.news_date, (d.ord % 9) + 1.0::double as raw,
          case when d.ord % 10 = 0 then null else p.score end as score, p.pos, p.neu, p.neg,
          p.t1, p.t2, p.t3, p.t4, p.t5, p.t6
        from dated_times d join probs p using (ord))""",
    )
]


def _weighted_days(spark: SparkSession, folder: str) -> DataFrame:
    """Weighted rows of uncapped company days, reduced without ever forming the shares row by row."""
    df = I.with_scores(I.feed_times(spark, folder))
    df = df.withColumn("News_Date", M.news_date(F.col("Published_At"), I.HOLIDAYS)).where("News_Date IS NOT NULL")
    score = F.when(F.col("ord") % 10 != 0, F.col("Sentiment_Score"))
    df = df.withColumns({"Raw": F.col("ord") % 9 + F.lit(1.0), "Sentiment_Score": score})
    return D.aggregate_unnormalized(df, "Raw")


@query(
    "daily_weighted_sentiment",
    with_views(
        "dated_times probs",
        f"""select ticker as "Ticker", news_date as "News_Date", {r('coalesce(sum(score * weight), 0.0::double)')} as "Sentiment_Score",
        {r('sum(pos * weight)')} as "Sentiment_Positive", {r('sum(neu * weight)')} as "Sentiment_Neutral",
        {r('sum(neg * weight)')} as "Sentiment_Negative", count(*) as "Article_Count" from wts group by ticker, news_date""",
        _WEIGHTED,
    ),
)
def daily_weighted_sentiment(spark: SparkSession, folder: str) -> DataFrame:
    return _weighted_days(spark, folder).select(
        "Ticker", "News_Date", *round_all(*D.WEIGHTED[:4]), "Article_Count"
    )


@query(
    "daily_topic_argmax",
    with_views(
        "dated_times probs",
        f"""select ticker as "Ticker", news_date as "News_Date", {_TOPICS_SQL}, {Q.arg_max_topic(_T)} as "Predicted_Topic"
        from (select ticker, news_date, {', '.join(f'sum({t} * weight) as {t}' for t in _T)} from wts
              group by ticker, news_date)""",
        _WEIGHTED,
    ),
)
def daily_topic_argmax(spark: SparkSession, folder: str) -> DataFrame:
    topics = [F.col(c) for c in C.TOPIC_COLUMNS]
    return _weighted_days(spark, folder).select(
        "Ticker", "News_Date", *round_all(*C.TOPIC_COLUMNS), S.arg_max_name(C.TOPIC_COLUMNS, topics).alias("Predicted_Topic")
    )


@query(
    "daily_headlines",
    with_views(
        "articles_raw news_windows",
        """select ticker as "Ticker", news_date as "News_Date", string_agg(h, ' || ' order by ord) as "Headlines",
        count(*) as "Article_Count"
        from (select a.ord, a.ticker, w.news_date, case when a.ord % 8 = 0 then '' else a.title end as h
              from articles_raw a join news_windows w on a.published_ist between w.wstart and w.wend)
        group by ticker, news_date""",
    ),
)
def daily_headlines(spark: SparkSession, folder: str) -> DataFrame:
    """Headlines of the company days in feed order; a missing headline keeps its place."""
    arts = I.articles(spark, folder, text=False, url=False)
    arts = arts.withColumn("News_Date", M.news_date(F.col("Published_At"), I.HOLIDAYS)).where("News_Date IS NOT NULL")
    arts = arts.withColumn("Headline", F.when(F.col("ord") % 8 != 0, F.col("Headline")))
    return arts.groupBy(*D.DAY).agg(
        D.joined_headlines("ord").alias("Headlines"), F.count(F.lit(1)).alias("Article_Count")
    )


@query(
    "daily_empty_fallback",
    with_views(
        "companies dated_times probs",
        f"""select c.ticker as "Ticker", c.name as "Company", date '2024-01-15' as "News_Date",
        {r('coalesce(g.score, 0.0::double)')} as "Sentiment_Score", {r('coalesce(g.neu, 1.0::double)')} as "Sentiment_Neutral",
        {r('coalesce(g.t1, 1.0::double / 6)')} as "{C.TOPIC_COLUMNS[0]}",
        coalesce(g.topic, '{C.TOPIC_COLUMNS[0]}') as "Predicted_Topic", '' as "Headlines", coalesce(g.n, 0) as "Article_Count"
        from companies c left join (
          select *, {Q.arg_max_topic(_T)} as topic from (
            select ticker, sum(score * weight) as score, sum(neu * weight) as neu,
              {', '.join(f'sum({t} * weight) as {t}' for t in _T)}, count(*) as n
            from wts where news_date = date '2024-01-15' and ticker not in ('Brand#2', 'Brand#7', 'Brand#11') group by ticker)
        ) g on g.ticker = c.ticker""",
        _WEIGHTED,
    ),
)
def daily_empty_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """One run date: companies whose feed gave nothing still get a neutral row."""
    day = F.to_date(F.lit("2024-01-15"))
    agg = _weighted_days(spark, folder).where((F.col("News_Date") == day) & ~F.col("Ticker").isin("Brand#2", "Brand#7", "Brand#11"))
    companies = I.companies(spark, folder).select(F.col("ticker").alias("Ticker"), F.col("name").alias("Company"))
    merged = companies.join(agg.drop("News_Date"), "Ticker", "left").withColumns(
        {"News_Date": day, "Headlines": F.lit(None).cast("string")}
    )
    return D.fill_empty_days(merged).select(
        "Ticker", "Company", "News_Date",
        *round_all("Sentiment_Score", "Sentiment_Neutral", C.TOPIC_COLUMNS[0]),
        "Predicted_Topic", "Headlines", "Article_Count",
    )


# --- thresholds and labels ------------------------------------------------------------------

_VOLS_SQL = """
select ticker, bar_date, vol, case when median(vol) over (partition by bar_date) > 0
    then median(vol) over (partition by bar_date) else 0.02::double end as vref
from (select *, case when count(lr) over w >= 30 then stddev_samp(lr) over w end as vol
      from (select *, ln(close / lag(close) over (partition by ticker order by bar_date)) as lr from bars)
      window w as (partition by ticker order by bar_date rows between 89 preceding and current row))"""


@query(
    "adaptive_threshold",
    with_views(
        "bars",
        f"""select ticker as "Ticker", bar_date as "Date", {r('vol')} as "Volatility", {r('vref')} as "Reference_Volatility",
        {r(Q.threshold('vol', 'vref'))} as "Threshold" from ({_VOLS_SQL})""",
    ),
)
def adaptive_threshold(spark: SparkSession, folder: str) -> DataFrame:
    vol = MK.add_rolling_volatility(MK.normalize_bars(I.bars(spark, folder)))
    both = MK.add_reference_volatility(vol, "Date")
    limit = S.adaptive_threshold(F.col("Volatility"), F.col("Reference_Volatility"))
    return both.withColumn("Threshold", limit).select(
        "Ticker", "Date", *round_all("Volatility", "Reference_Volatility", "Threshold")
    )


@query(
    "sentiment_labels",
    with_views(
        "probs feed_times",
        f"""select ord, {Q.label('score', 't')} as "Sentiment_Label", {r('t')} as "Threshold" from (
          select ord, score, {Q.threshold('v', '0.02::double')} as t from (
            select ord, score, case when ord % 5 = 0 then null else (ord % 13) * 0.005::double end as v from probs))""",
    ),
)
def sentiment_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Article labels at thresholds scaled by volatilities from zero to three times the reference."""
    vol = F.when(F.col("ord") % 5 != 0, (F.col("ord") % 13) * F.lit(0.005))
    df = I.scores(spark, folder).withColumn("Threshold", S.adaptive_threshold(vol))
    label = S.sentiment_label(F.col("Sentiment_Score"), F.col("Threshold"))
    return df.select("ord", label.alias("Sentiment_Label"), rounded("Threshold").alias("Threshold"))


# --- validation --------------------------------------------------------------------------------

_FAULTY_SQL = """
  select p.ord, case p.ord % 7 when 0 then '  ' when 1 then null else f.ticker end as ticker,
    case when p.ord % 11 = 3 then t1 + 0.3::double else t1 end as t1, t2, t3, t4, t5, t6,
    case when p.ord % 13 = 5 then null when p.ord % 13 = 6 then pos + 0.2::double else pos end as pos, neu, neg,
    case p.ord % 17 when 2 then 5.0::double when 3 then null when 4 then 'nan'::double else score end as score,
    case when p.ord % 19 = 1 then null else 100.0::double end as o, 105.0::double as h,
    case when p.ord % 19 = 2 then 'nan'::double else 99.0::double end as l,
    case when p.ord % 23 = 0 then null else 102.0::double end as c
  from probs p join feed_times f using (ord)"""
_TSUM = "0.0::double + t1 + t2 + t3 + t4 + t5 + t6"
_PSUM = "0.0::double + pos + neu + neg"
_PROBLEMS_SQL = f"""
  select *, concat_ws('; ',
    case when coalesce(trim(ticker), '') = '' then 'Ticker is missing or blank' end,
    case when abs({_TSUM} - 1) > 0.05 then 'Topic probabilities sum to ' || printf('%.4f', {_TSUM}) || ', expected ~1.0' end,
    case when pos is null or neu is null or neg is null then 'Sentiment probability columns are missing'
         when abs({_PSUM} - 1) > 0.05 then 'Sentiment probabilities sum to ' || printf('%.4f', {_PSUM}) || ', expected ~1.0' end,
    case when score is null then 'Sentiment_Score is missing'
         when isnan(score) then 'Sentiment_Score NaN is out of range [-1, 1]'
         when score < -1 or score > 1 then 'Sentiment_Score ' || cast(score as varchar) || ' is out of range [-1, 1]' end,
    case when o is null then 'Open is missing' end, case when isnan(l) then 'Low is missing' end,
    case when c is null then 'Close is missing' end) as problems
  from ({_FAULTY_SQL})"""


def _faulty_days(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the shape of the daily table with faults of every kind, often several at once."""
    df = I.with_scores(I.feed_times(spark, folder))
    nan = F.lit(float("nan"))

    def fault(n: int, *cases: tuple[int, Column]) -> Column | None:
        out = F
        for k, v in cases:
            out = out.when(F.col("ord") % n == k, v)
        return out

    null = F.lit(None)
    t1, pos, score = C.TOPIC_COLUMNS[0], F.col("Sentiment_Positive"), F.col("Sentiment_Score")
    return df.withColumns(
        {
            "Ticker": fault(7, (0, F.lit("  ")), (1, null)).otherwise(F.col("Ticker")),
            t1: fault(11, (3, F.col(t1) + 0.3)).otherwise(F.col(t1)),
            "Sentiment_Positive": fault(13, (5, null), (6, pos + 0.2)).otherwise(pos),
            "Sentiment_Score": fault(17, (2, F.lit(5.0)), (3, null), (4, nan)).otherwise(score),
            "Open": fault(19, (1, null)).otherwise(100.0),
            "High": F.lit(105.0),
            "Low": fault(19, (2, nan)).otherwise(99.0),
            "Close": fault(23, (0, null)).otherwise(102.0),
        }
    )


@query("daily_validation", with_views("probs feed_times", f"""select ord, problems as "Problems" from ({_PROBLEMS_SQL})"""))
def daily_validation(spark: SparkSession, folder: str) -> DataFrame:
    return _faulty_days(spark, folder).select("ord", F.array_join(D.problems(), "; ").alias("Problems"))


@query(
    "daily_quarantine",
    with_views(
        "probs feed_times",
        f"""select problems = '' as "Valid", problems as "Problems", count(*) as "Rows" from ({_PROBLEMS_SQL}) group by problems""",
    ),
)
def daily_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Sizes of the valid and the quarantined set by reason; together they are all rows."""
    valid, held = D.split_valid(_faulty_days(spark, folder))
    both = valid.select(F.lit(True).alias("Valid"), F.lit("").alias("Problems")).unionByName(
        held.select(F.lit(False).alias("Valid"), F.array_join("problems", "; ").alias("Problems"))
    )
    return both.groupBy("Valid", "Problems").agg(F.count(F.lit(1)).alias("Rows"))


# --- the daily job ------------------------------------------------------------------------------


def daily_rows(spark: SparkSession, folder: str) -> DataFrame:
    companies = I.companies(spark, folder)
    days = J.run_days(I.feed_times(spark, folder), I.HOLIDAYS)
    if days is None:
        return conform(companies.limit(0), DAILY)
    grid = J.company_days(companies, *days, I.HOLIDAYS)
    return J.build_daily(scored_articles(spark, folder), grid, MK.normalize_bars(I.bars_2024(spark, folder)))


_DAILY_SQL = f"""select ticker as "Ticker", company as "Company", news_date as "News_Date", open as "Open", high as "High",
  low as "Low", close as "Close", close as "Adj_Close", volume as "Volume", {r('score')} as "Sentiment_Score",
  {r('pos')} as "Sentiment_Positive", {r('neu')} as "Sentiment_Neutral", {r('neg')} as "Sentiment_Negative",
  label as "Sentiment_Label", {_TOPICS_SQL}, topic as "Predicted_Topic", headlines as "Headlines", n as "Article_Count",
  {r('vol')} as "Volatility" from daily"""


@query(
    "dataset_daily",
    with_views("dated bars_2024 dated_times", _DAILY_SQL, Q.article_views() + Q.daily_views(), recursive=True),
)
def dataset_daily(spark: SparkSession, folder: str) -> DataFrame:
    computed = {*D.WEIGHTED, "Volatility"}
    df = daily_rows(spark, folder)
    return df.select(*[rounded(c).alias(c) if c in computed else F.col(c) for c in df.columns])


@query(
    "run_stats",
    with_views(
        "dated bars_2024 dated_times",
        """select news_date as "News_Date", count(*) as "Companies", sum(n)::bigint as "Articles",
        count(*) filter (where open is not null) as "Daily_Rows", count(*) filter (where open is null) as "Quarantined",
        4 * count(*) filter (where open is not null) as "Predictions" from daily group by news_date""",
        Q.article_views() + Q.daily_views(),
        recursive=True,
    ),
)
def run_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of one run per reference date, in a single pass over its daily rows."""
    models = I.FORMULA_SPECS
    checked = daily_rows(spark, folder).withColumn("ok", F.size(D.problems()) == 0)
    made = F.lit(0)
    for _, fn in models:
        made = made + F.when(F.col("ok") & finite(fn(checked)).isNotNull(), 1).otherwise(0)
    return checked.withColumn("made", made).groupBy("News_Date").agg(
        F.count(F.lit(1)).alias("Companies"),
        F.sum("Article_Count").alias("Articles"),
        F.count_if("ok").alias("Daily_Rows"),
        F.count_if(~F.col("ok")).alias("Quarantined"),
        F.sum("made").alias("Predictions"),
    )


@query(
    "append_conform",
    with_views(
        "bars",
        """select ticker as "Ticker", bar_date as "News_Date", open as "Open", close as "Close",
        case when bar_date < date '1998-01-01' then volume end as "Volume", cast(null as varchar) as "Headlines",
        1 as "Copies" from bars""",
    ),
)
def append_conform(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends with different columns into one stored table, and a repeated day that replaces itself.

    The second append lacks the volume and brings a column that the table does not have.
    """
    bars = I.bars(spark, folder).withColumnRenamed("Date", "News_Date")
    year = F.date_trunc("year", "News_Date").cast("date")
    old = bars.where("News_Date < DATE'1998-01-01'")
    new = bars.where("News_Date >= DATE'1998-01-01'").select("Ticker", "News_Date", "Open", "Close", F.lit(1).alias("Unknown"))
    schema = T.StructType([*DAILY.fields, T.StructField("Year", T.DateType())])
    path = new_path(spark, "daily")
    append_rows(old.withColumn("Year", year), path, schema, "Year")
    append_rows(new.withColumn("Year", year), path, schema, "Year")
    replace_days(old.withColumn("Year", year), path, schema, "Year")
    stored = read_or_empty(spark, path, schema)
    return stored.groupBy("Ticker", "News_Date", "Open", "Close", "Volume", "Headlines").agg(
        F.count(F.lit(1)).cast("int").alias("Copies")
    )


@query(
    "typed_sinks",
    with_views(
        "dated_times clamped actuals",
        """select 'articles' as "Table", count(*) as "Written", count(*) as "Stored", count(distinct ticker) as "Tickers" from dated_times
        union all select 'daily', count(*), count(*), count(distinct ticker) from bars
        union all select 'predictions', count(*), count(*), count(distinct ticker) from clamped where value is not null
        union all select 'performance', count(*), 2 * count(*), count(distinct ticker) from (
          select distinct ticker, model_name, target from clamped join actuals using (ticker, news_date, target))""",
    ),
)
def typed_sinks(spark: SparkSession, folder: str) -> DataFrame:
    """The four stored tables written twice, as by a repeated run: rows counted while writing, and rows read back.

    Repeated days replace themselves; accuracy is appended.
    """
    root = new_path(spark, "tables")
    feed = I.feed_times(spark, folder).withColumn("News_Date", M.news_date(F.col("Published_At"), I.HOLIDAYS))
    history, made = I.history(spark, folder), I.formula_predictions(spark, folder)
    by_year = lambda df: df.withColumn("Year", F.date_trunc("year", "News_Date").cast("date"))
    yearly = lambda schema: T.StructType([*schema.fields]).add("Year", "date")
    every = (dt.date(1900, 1, 1), dt.date(2100, 1, 1))
    parts = []
    for name, rows, schema, day in (
        ("articles", feed, ARTICLES, "News_Date"),
        ("daily", by_year(history), yearly(DAILY), "Year"),
        ("predictions", by_year(made), yearly(PREDICTIONS), "Year"),
    ):
        written = [replace_range(rows, f"{root}/{name}", schema, *every, partition=day) for _ in range(2)]
        parts.append((name, written[-1], read_range_table(spark, f"{root}/{name}", schema, partition=day)))
    measured = cut_lineage(J.monitor(made, history).withColumn("Evaluated_At", F.current_timestamp()))
    for _ in range(2):
        written = append_rows(measured, f"{root}/performance", PERFORMANCE, partition=None)
    parts.append(("performance", written, read_or_empty(spark, f"{root}/performance", PERFORMANCE)))
    out = None
    for name, written, stored in parts:
        counted = stored.agg(F.count(F.lit(1)).alias("Stored"), F.count_distinct("Ticker").alias("Tickers"))
        row = counted.select(F.lit(name).alias("Table"), F.lit(written).cast("long").alias("Written"), "Stored", "Tickers")
        out = row if out is None else out.unionByName(row)
    return out
