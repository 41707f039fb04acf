"""Queries over articles: text, URLs, windows, matching, duplicates, weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.functions import scoring as S
from presspulse.functions import text as X
from presspulse.operators import daily as D
from presspulse.operators import enrich as E
from presspulse.operators import news as N
from presspulse.operators.matching import match_companies
from presspulse.plans import inputs as I
from presspulse.plans import jobs as J
from presspulse.plans import sql as Q
from presspulse.plans.registry import query, round_all, rounded
from presspulse.plans.sql import r, with_views
from presspulse.sources.storage import broadcast_if_small, cut_lineage, new_path, read_table, spread_if_narrow

_T = [f"t{i}" for i in range(1, 7)]

# --- feed and windows ------------------------------------------------------------------


@query(
    "article_feed_scan",
    with_views(
        "articles_raw",
        f"""select ord, title as "Headline", description as "Summary", url as "URL",
        coalesce(nullif(publisher, ''), {Q.publisher('url')}) as "Source",
        date_trunc('second', published_ist) as "Published_At" from articles_raw""",
    ),
)
def article_feed_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Rows in the shape of a news feed (nested publisher, text date) to article columns."""
    utc = F.col("Published_At") - F.make_dt_interval(mins=F.lit(C.IST_OFFSET_MINUTES))
    raw = I.articles(spark, folder).select(
        "ord",
        F.col("Headline").alias("title"),
        F.col("Description").alias("description"),
        F.col("URL").alias("url"),
        F.concat(F.date_format(utc, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("published date"),
        F.struct(F.col("Publisher").alias("title")).alias("publisher"),
    )
    return N.scan_feed(raw)


_DATES_SQL = """
  select event_id as ord, case event_id % 5
     when 0 then strftime(ts, '%a, %d %b %Y %H:%M:%S') || ' GMT'
     when 1 then strftime(ts + interval 330 minute, '%a, %d %b %Y %H:%M:%S') || ' +0530'
     when 2 then strftime(ts - interval 300 minute, '%d %b %Y %H:%M:%S') || ' EST'
     when 3 then strftime(ts, '%Y-%m-%d %H:%M:%S')
     else strftime(ts, '%a, %d %b %Y %H:%M:%S') end as raw from events"""


@query(
    "parse_published_at",
    rf"""with d as ({_DATES_SQL})
    select ord, try_strptime(regexp_replace(regexp_replace(raw, '^\w+, ', ''), ' (GMT|EST|[+-]\d+)$', ''), '%d %b %Y %H:%M:%S')
      + case when raw like '%+0530' then interval 0 minute when raw like '%EST' then interval 630 minute
             else interval 330 minute end as "Published_At" from d""",
)
def parse_published_at(spark: SparkSession, folder: str) -> DataFrame:
    """Mail-format dates in several zones, without a zone, and one in four not a mail date."""
    kind = F.col("event_id") % 5
    at = lambda minutes, fmt: F.date_format(F.col("ts") + F.make_dt_interval(mins=F.lit(minutes)), fmt)
    long = "EEE, dd MMM yyyy HH:mm:ss"
    raw = (
        F.when(kind == 0, F.concat(at(0, long), F.lit(" GMT")))
        .when(kind == 1, F.concat(at(330, long), F.lit(" +0530")))
        .when(kind == 2, F.concat(at(-300, "dd MMM yyyy HH:mm:ss"), F.lit(" EST")))
        .when(kind == 3, at(0, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(at(0, long))
    )
    events = read_table(spark, folder, "events").select(F.col("event_id").alias("ord"), raw.alias("raw"))
    return events.select("ord", X.parse_published_at(F.col("raw")).alias("Published_At"))


@query(
    "news_window_join",
    with_views(
        "dated_times",
        """select ord, ticker as "Ticker", news_date as "News_Date", wstart as "Window_Start", wend as "Window_End"
        from dated_times""",
    ),
)
def news_window_join(spark: SparkSession, folder: str) -> DataFrame:
    """Each article with the news window that contains it."""
    d = F.col("News_Date")
    dated = I.feed_times(spark, folder).withColumn("News_Date", M.news_date(F.col("Published_At"), I.HOLIDAYS))
    return dated.where(d.isNotNull()).select(
        "ord", "Ticker", "News_Date", M.window_start(d, I.HOLIDAYS).alias("Window_Start"), M.window_end(d).alias("Window_End")
    )


@query(
    "news_window_filter",
    with_views(
        "feed_times",
        """select ord, ticker as "Ticker", published_ist as "Published_At" from feed_times
        where published_ist between timestamp '2024-01-12 08:30:00' and timestamp '2024-01-15 08:29:59'""",
    ),
)
def news_window_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Articles of the run of one reference date, a Monday."""
    ref = F.to_date(F.lit("2024-01-15"))
    times = I.feed_times(spark, folder)
    return times.where(M.within_window(F.col("Published_At"), ref, I.HOLIDAYS)).select("ord", "Ticker", "Published_At")


@query(
    "top_articles_per_company",
    with_views(
        "dated_times",
        """select ord, ticker as "Ticker", news_date as "News_Date", published_ist as "Published_At" from dated_times
        qualify row_number() over (partition by ticker, news_date order by ord) <= 40""",
    ),
)
def top_articles_per_company(spark: SparkSession, folder: str) -> DataFrame:
    dated = I.feed_times(spark, folder).withColumn("News_Date", M.news_date(F.col("Published_At"), I.HOLIDAYS))
    return N.first_per_group(dated.where("News_Date IS NOT NULL"), D.DAY, "ord")


# --- matching ---------------------------------------------------------------------------


@query(
    "company_mentions",
    with_views(
        "articles_raw",
        r"""select distinct a.ord, c.ticker as "Ticker" from (
          select ord, unnest(regexp_extract_all(title || ' ' || description,
            '(?i)(?:^|[^\p{L}\p{N}_])(brand [0-9]+ energy|brk[0-9]+)(?:[^\p{L}\p{N}_]|$)', 1)) as hit from articles_raw) a
        join companies c on lower(a.hit) in (lower(c.name), lower(c.alias1))""",
    ),
)
def company_mentions(spark: SparkSession, folder: str) -> DataFrame:
    arts = I.articles(spark, folder, url=False)
    body = arts.select("ord", F.concat_ws(" ", "Headline", "Description").alias("body"))
    return match_companies(body, I.companies(spark, folder), "ord", "body").withColumnRenamed("ticker", "Ticker")


@query(
    "company_profiles",
    with_views(
        "companies",
        """select ticker as "Ticker", name || '. ' || alias1 || '. ' || keyword1 || '. Energy' as "Profile",
        '"' || name || '" OR "' || alias1 || '"' as "Search_Phrase" from companies""",
    ),
)
def company_profiles(spark: SparkSession, folder: str) -> DataFrame:
    name, aliases = F.col("name"), F.col("aliases")
    return I.companies(spark, folder).select(
        F.col("ticker").alias("Ticker"),
        S.company_profile(name, aliases, F.col("keywords"), F.col("sector")).alias("Profile"),
        S.search_phrase(name, aliases).alias("Search_Phrase"),
    )


@query(
    "source_reliability",
    with_views(
        "articles_raw",
        f"""select ord, {Q.reliability('s')} as "Source_Reliability" from (
          select ord, case when ord % 7 = 0 then ' zee business / MINT ' when ord % 7 = 1 then 'The Company'
            else coalesce(nullif(publisher, ''), case when ord % 2 = 0 then null else '  ' end) end as s
          from articles_raw)""",
    ),
)
def source_reliability(spark: SparkSession, folder: str) -> DataFrame:
    arts = I.articles(spark, folder, text=False, url=False)
    blank = F.when(F.col("ord") % 2 == 0, F.lit(None)).otherwise("  ")
    name = (
        F.when(F.col("ord") % 7 == 0, " zee business / MINT ")
        .when(F.col("ord") % 7 == 1, "The Company")
        .otherwise(F.coalesce(F.nullif("Publisher", F.lit("")), blank))
    )
    return arts.withColumn("s", name).select("ord", S.source_reliability(F.col("s")).alias("Source_Reliability"))


# the url of every page, and further rows with known domains, other schemes and ports
_URL_SQL = """
  select page_id, 0 as variant, url as u from pages union all
  select page_id, 1 + (page_id % 6)::int, case page_id % 6 when 0 then 'https://www.NDTV.com/' || page_id when 1 then
    'http://energy.economictimes.indiatimes.com/x?id=' || page_id when 2 then 'ftp://livemint.com/a' else
    replace(url, '//', '//notreuters.com:8080/') end from pages where page_id % 6 < 4"""


def _page_urls(spark: SparkSession, folder: str) -> DataFrame:
    pick = F.col("page_id") % 6
    page = F.col("page_id").cast("string")
    odd = (
        F.when(pick == 0, F.concat(F.lit("https://www.NDTV.com/"), page))
        .when(pick == 1, F.concat(F.lit("http://energy.economictimes.indiatimes.com/x?id="), page))
        .when(pick == 2, "ftp://livemint.com/a")
        .otherwise(F.replace("url", F.lit("//"), F.lit("//notreuters.com:8080/")))
    )
    pages = read_table(spark, folder, "pages")
    return pages.select("page_id", F.lit(0).alias("Variant"), F.col("url").alias("u")).unionAll(
        pages.where(pick < 4).select("page_id", (pick + 1).cast("int").alias("Variant"), odd.alias("u"))
    )


@query("publisher_from_url", f"""select page_id, variant as "Variant", {Q.publisher('u')} as "Publisher" from ({_URL_SQL})""")
def publisher_from_url(spark: SparkSession, folder: str) -> DataFrame:
    return _page_urls(spark, folder).select("page_id", "Variant", X.publisher_from_url(F.col("u")).alias("Publisher"))


@query(
    "url_validity",
    f"""select page_id, variant as "Variant", regexp_matches(u, '^[hH][tT][tT][pP][sS]?://[^/?#]+') as "Valid"
    from ({_URL_SQL} union all select page_id, 9, substr(url, 7) from pages where page_id % 11 = 0)""",
)
def url_validity(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's url, the odd ones, and urls cut at the start."""
    cut = read_table(spark, folder, "pages").where(F.col("page_id") % 11 == 0)
    cut = cut.select("page_id", F.lit(9).alias("Variant"), F.expr("substr(url, 7)").alias("u"))
    return _page_urls(spark, folder).unionAll(cut).select("page_id", "Variant", X.is_valid_url(F.col("u")).alias("Valid"))


@query("canonical_url", with_views("articles_raw", f"""select ord, {Q.url_key('url')} as "URL_Key" from articles_raw"""))
def canonical_url(spark: SparkSession, folder: str) -> DataFrame:
    return I.articles(spark, folder, text=False).select("ord", X.canonical_url(F.col("URL")).alias("URL_Key"))


# --- text ---------------------------------------------------------------------------------


@query("normalize_headline", f"""select doc_id, {Q.norm('text')} as "Normalized" from documents""")
def normalize_headline(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread_if_narrow(read_table(spark, folder, "documents"))
    return docs.select("doc_id", X.normalize_headline(F.col("text")).alias("Normalized"))


_STEXT = (
    r"regexp_replace(regexp_replace(coalesce(h, '') || '. ' || coalesce(s, ''), '^[. ]+|[. ]+$', '', 'g'), "
    r"'^[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]+|[\t-\r\x{1c}-\x{1f}\x{85}\p{Z}]+$', '', 'g')"
)


@query(
    "scoring_text",
    f"""select doc_id, variant as "Variant", {_STEXT} as "Scoring_Text" from (
      select doc_id, 0 as variant, lang || ' item.. ' as h, text as s from documents
      union all select doc_id, 1, null, text from documents where doc_id % 3 = 0
      union all select doc_id, 2, lang || ' item.. ', null from documents where doc_id % 5 = 0)""",
)
def scoring_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every whole text with a headline, and further rows without one of the two."""
    docs = spread_if_narrow(read_table(spark, folder, "documents"))
    head, none = F.concat("lang", F.lit(" item.. ")), F.lit(None).cast("string")
    variants = F.array(
        F.struct(F.lit(0).alias("v"), head.alias("h"), F.col("text").alias("s")),
        F.when(F.col("doc_id") % 3 == 0, F.struct(F.lit(1).alias("v"), none.alias("h"), F.col("text").alias("s"))),
        F.when(F.col("doc_id") % 5 == 0, F.struct(F.lit(2).alias("v"), head.alias("h"), none.alias("s"))),
    )
    rows = docs.select("doc_id", F.inline(F.filter(variants, lambda x: x.isNotNull())))
    return rows.select("doc_id", F.col("v").alias("Variant"), X.scoring_text(F.col("h"), F.col("s")).alias("Scoring_Text"))


@query(
    "headline_strength",
    with_views("articles_raw", f"""select ord, {Q.strength('title')} as "Headline_Strength" from articles_raw"""),
)
def headline_strength(spark: SparkSession, folder: str) -> DataFrame:
    arts = I.articles(spark, folder, text=False, url=False)
    return arts.select("ord", S.headline_strength(F.col("Headline")).alias("Headline_Strength"))


@query(
    "headline_strength_blend",
    with_views(
        "articles_raw",
        f"""select ord, {r('case when m is null then a else greatest(0.3::double, least(1.0::double, 0.7::double * a + 0.3::double * m)) end')}
        as "Headline_Strength" from (select ord, {Q.strength('title')} as a,
          case when ord % 4 = 0 then null else (ord % 100) / 100.0::double end as m from articles_raw)""",
    ),
)
def headline_strength_blend(spark: SparkSession, folder: str) -> DataFrame:
    arts = I.articles(spark, folder, text=False, url=False)
    model = F.when(F.col("ord") % 4 != 0, (F.col("ord") % 100) / F.lit(100.0))
    blend = S.blended_strength(S.headline_strength(F.col("Headline")), model)
    return arts.select("ord", rounded(blend).alias("Headline_Strength"))


_HIDDEN_SQL = "(?is)<!--.*?-->|" + "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in ("script", "style", "head", "nav"))
_BODY_SQL = f"regexp_replace(regexp_replace(html, '{_HIDDEN_SQL}', ' ', 'g'), '<[^>]*>', ' ', 'g')"
for _e, _c in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
    _BODY_SQL = f"replace({_BODY_SQL}, '{_e}', '{_c}')"


@query(
    "page_text_extract",
    f"""select page_id, variant as "Variant", case when length(body) < 40 then title else body end as "Text",
      case when title = '' then body else title end as "Summary", length(body) < 40 as "Used_Fallback"
    from (select page_id, variant, {Q.clean(_BODY_SQL)} as body,
      {Q.clean("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} as title
      from (select page_id, 0 as variant, html from pages union all
            select page_id, 1, '<title>Only a title</title><p>short</p>' from pages where page_id % 9 = 0))""",
)
def page_text_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Readable page text, or the title where the body is too short to be useful."""
    html = F.col("html")
    pages = spread_if_narrow(read_table(spark, folder, "pages").select("page_id", F.lit(0).alias("Variant"), "html"))
    short_page = F.lit("<title>Only a title</title><p>short</p>").alias("html")
    ids = read_table(spark, folder, "pages").where(F.col("page_id") % 9 == 0)
    pages = pages.unionAll(ids.select("page_id", F.lit(1).alias("Variant"), short_page))
    body = pages.select("page_id", "Variant", X.page_text(html).alias("body"), X.page_title(html).alias("title"))
    short = F.length("body") < C.MIN_USEFUL_BODY_LENGTH
    return body.select(
        "page_id",
        "Variant",
        F.when(short, F.col("title")).otherwise(F.col("body")).alias("Text"),
        F.when(F.col("title") == "", F.col("body")).otherwise(F.col("title")).alias("Summary"),
        short.alias("Used_Fallback"),
    )


@query(
    "cache_misses",
    """with keyed as (select sha256(text) as key, count(*) as n from documents where text <> '' group by 1)
    select key as "Key", n as "Copies" from keyed
    where key not in (select sha256(text) from documents where lang = 'en')""",
)
def cache_misses(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct texts that are not in a cache holding every English text."""
    docs = read_table(spark, folder, "documents")
    keys = docs.select(X.stable_hash(F.col("text")).alias("key"), "text", "lang")
    counted = keys.where("text <> ''").groupBy("key").agg(F.count(F.lit(1)).alias("Copies"))
    cache = keys.where("lang = 'en'").select("key").distinct()
    return E.misses(counted, cache).select(F.col("key").alias("Key"), "Copies")


# --- duplicates ---------------------------------------------------------------------------


@query(
    "dedup_articles",
    with_views(
        "dated",
        """select ord, ticker as "Ticker", news_date as "News_Date", url as "URL", title as "Headline" from kept""",
        [
            ("keyed", f"select *, {Q.url_key('url')} as url_key, {Q.norm('title')} as headline_key from dated"),
            *Q.dedup_walk("keyed"),
        ],
        recursive=True,
    ),
)
def dedup_articles(spark: SparkSession, folder: str) -> DataFrame:
    """First-wins duplicates within each company day, with no limit on the size of a day."""
    arts = I.articles(spark, folder, text=False).withColumn("News_Date", M.news_date(F.col("Published_At"), I.HOLIDAYS))
    keyed = N.duplicate_keys(arts.where("News_Date IS NOT NULL"))
    return N.dedupe(keyed, D.DAY, "ord").select("ord", "Ticker", "News_Date", "URL", "Headline")


# --- relevance and weights ------------------------------------------------------------------


@query(
    "relevance_jaccard",
    with_views(
        "articles_raw",
        f"""select ord, {r(Q.jaccard('a', 'b'))} as "Article_Relevance" from (
          select ord, {Q.tokens("title || ' ' || description")} as a,
            {Q.tokens("company || '. ' || alias1 || '. ' || keyword1 || '. Energy'")} as b from articles_raw)""",
    ),
)
def relevance_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    arts = I.articles(spark, folder, url=False)
    profiles = company_profiles(spark, folder).select("Ticker", "Profile")
    text = F.concat("Headline", F.lit(" "), "Description")
    joined = arts.join(broadcast_if_small(profiles), "Ticker")
    return joined.select("ord", rounded(S.text_jaccard(text, F.col("Profile"))).alias("Article_Relevance"))


_COS = (
    "case when sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)) = 0 then 0.0::double else "
    "list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))) end"
)


@query(
    "relevance_cosine",
    f"""with profile as (select label, cast(arg_min(embedding, vec_id) as double[]) as b from embeddings group by label)
    select vec_id, {r(f'(({_COS}) + 1) / 2')} as "Article_Relevance"
    from (select vec_id, label, cast(embedding as double[]) as a from embeddings) e join profile using (label)""",
)
def relevance_cosine(spark: SparkSession, folder: str) -> DataFrame:
    """Vector relevance against the first vector of the same label, rescaled to [0, 1]."""
    vecs = read_table(spark, folder, "embeddings")
    profile = vecs.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("profile"))
    relevance = (S.cosine(F.col("embedding"), F.col("profile")) + 1) / 2
    return vecs.join(profile, "label").select("vec_id", rounded(relevance).alias("Article_Relevance"))


_HOURS = "(epoch_us(wend) - epoch_us(published_ist)) / 3.6e9::double"
_RECENCY = f"exp(-greatest(0.0::double, {_HOURS}) / 24.0::double)"


@query(
    "recency_weight",
    with_views("dated_times", f"""select ord, {_HOURS} as "Hours", {r(_RECENCY)} as "Recency_Weight" from dated_times"""),
)
def recency_weight(spark: SparkSession, folder: str) -> DataFrame:
    return _with_recency(I.feed_times(spark, folder)).select("ord", "Hours", *round_all("Recency_Weight"))


def _with_recency(df: DataFrame) -> DataFrame:
    dated = df.withColumn("News_Date", M.news_date(F.col("Published_At"), I.HOLIDAYS)).where("News_Date IS NOT NULL")
    hours = M.hours_between(F.col("Published_At"), M.window_end(F.col("News_Date")))
    return dated.withColumn("Hours", hours).withColumn("Recency_Weight", S.recency_weight(F.col("Hours")))


_IMPACT_SQL = f"{Q.reliability('publisher')} * {_RECENCY} * {Q.strength('title')}"


def _weighted(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with an impact weight of their source, age and headline."""
    df = _with_recency(I.articles(spark, folder, text=False, url=False))
    raw = S.raw_impact(
        S.source_reliability(F.col("Publisher")), F.col("Recency_Weight"), S.headline_strength(F.col("Headline"))
    )
    return df.withColumn("Raw_Weight", raw)


@query("impact_weight", with_views("dated", f"""select ord, {r(_IMPACT_SQL)} as "Raw_Weight" from dated"""))
def impact_weight(spark: SparkSession, folder: str) -> DataFrame:
    return _weighted(spark, folder).select("ord", *round_all("Raw_Weight"))


@query(
    "normalize_weights",
    with_views(
        "dated",
        f"""select ord, ticker as "Ticker", news_date as "News_Date",
        {r('case when sum(raw) over g > 0 then raw / sum(raw) over g else 1.0::double / count(*) over g end')}
        as "News_Impact_Weight" from (
          select ord, ticker, news_date, case when ticker in ('Brand#3', 'Brand#4') then 0.0::double else {_IMPACT_SQL} end as raw
          from dated) window g as (partition by ticker, news_date)""",
    ),
)
def normalize_weights(spark: SparkSession, folder: str) -> DataFrame:
    """Weight shares per company day; two companies have zero weights and get uniform shares."""
    raw = F.when(F.col("Ticker").isin("Brand#3", "Brand#4"), 0.0).otherwise(F.col("Raw_Weight"))
    shares = D.normalize_weights(_weighted(spark, folder).withColumn("Raw_Weight", raw), "Raw_Weight", "News_Impact_Weight")
    return shares.select("ord", "Ticker", "News_Date", *round_all("News_Impact_Weight"))


_MULT = " + ".join(f"t{i} * {m}::double" for i, m in enumerate(I.TOPIC_MULTIPLIERS, 1))


@query(
    "optional_weights",
    with_views(
        "probs feed_times",
        f"""select ord, case when ticker = 'Brand#1' then 1.5::double else 1.0::double end as "Company_Weight",
        {r(_MULT)} as "Topic_Weight" from probs join feed_times using (ord)""",
    ),
)
def optional_weights(spark: SparkSession, folder: str) -> DataFrame:
    df = I.with_scores(I.feed_times(spark, folder))
    topics = [F.col(c) for c in C.TOPIC_COLUMNS]
    return df.select(
        "ord",
        J.company_weight(F.col("Ticker"), {"Brand#1": 1.5}).alias("Company_Weight"),
        rounded(S.topic_importance(topics, I.TOPIC_MULTIPLIERS)).alias("Topic_Weight"),
    )


# --- distributions ------------------------------------------------------------------------------


@query("sentiment_score", with_views("probs", f"""select ord, {r('pos - neg')} as "Sentiment_Score" from probs"""))
def sentiment_score(spark: SparkSession, folder: str) -> DataFrame:
    return I.scores(spark, folder).select("ord", *round_all("Sentiment_Score"))


@query(
    "article_topic_argmax",
    with_views("probs", f"""select ord, {Q.arg_max_topic(_T)} as "Predicted_Topic" from probs"""),
)
def article_topic_argmax(spark: SparkSession, folder: str) -> DataFrame:
    topics = [F.col(c) for c in C.TOPIC_COLUMNS]
    return I.scores(spark, folder).select("ord", S.arg_max_name(C.TOPIC_COLUMNS, topics).alias("Predicted_Topic"))


_LABEL_SQL = " ".join(f"when '{k}' then '{v}'" for k, v in C.TOPIC_LABELS.items())


@query(
    "topic_labels",
    with_views(
        "probs",
        f"""select case topic {_LABEL_SQL} end as "Topic_Label", count(*) as "Articles"
        from (select {Q.arg_max_topic(_T)} as topic from probs) group by 1""",
    ),
)
def topic_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Display names of the predicted topics with their article counts."""
    labels = F.create_map(*[F.lit(x) for kv in C.TOPIC_LABELS.items() for x in kv])
    return (
        article_topic_argmax(spark, folder)
        .groupBy(F.try_element_at(labels, F.col("Predicted_Topic")).alias("Topic_Label"))
        .agg(F.count(F.lit(1)).alias("Articles"))
    )


@query(
    "topic_fallback",
    with_views(
        "probs",
        f"""select ord, {', '.join(r(f't{i}') + f' as "{c}"' for i, c in enumerate(C.TOPIC_COLUMNS, 1))}, topic as "Predicted_Topic"
        from (select *, {Q.arg_max_topic(_T)} as topic from (
          select ord, {', '.join(f'case when ord % 3 = 0 then 1.0::double / 6 else {t} end as {t}' for t in _T)} from probs))""",
    ),
)
def topic_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A scorer that gave nothing for every third article: those get the uniform distribution."""
    df = I.scores(spark, folder)
    failed = F.col("ord") % 3 == 0
    df = df.withColumns({c: F.when(~failed, F.col(c)) for c in C.TOPIC_COLUMNS})
    df = df.withColumns({c: F.coalesce(F.col(c), u) for c, u in zip(C.TOPIC_COLUMNS, S.uniform_topics())})
    topics = [F.col(c) for c in C.TOPIC_COLUMNS]
    return df.select("ord", *round_all(*C.TOPIC_COLUMNS), S.arg_max_name(C.TOPIC_COLUMNS, topics).alias("Predicted_Topic"))


@query(
    "scores_to_columns",
    with_views(
        "probs",
        f"""select ord, {r('pos')} as positive, {r('case when ord % 4 = 0 then 0.0::double else neu end')} as neutral,
        {r('neg')} as negative from probs""",
    ),
)
def scores_to_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Classifier output as a list of labelled scores, with a label missing on every fourth row."""
    item = lambda label, c: F.struct(F.lit(label).alias("label"), F.col(c).alias("score"))
    three = F.array(
        item("Positive", "Sentiment_Positive"), item("NEGATIVE", "Sentiment_Negative"), item("neutral", "Sentiment_Neutral")
    )
    out = F.when(F.col("ord") % 4 == 0, F.slice(three, 1, 2)).otherwise(three)
    spread = I.scores(spark, folder).withColumn("s", out).select(
        "ord", *S.scores_to_columns(F.col("s"), E.SENTIMENT_LABELS, lower=True)
    )
    return spread.select("ord", *round_all(*E.SENTIMENT_LABELS))


@query(
    "softmax_probs",
    f"""with e as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
    x as (select vec_id, list_transform(v, lambda a: exp(a - list_max(v))) as w from e)
    select vec_id, i as "Pos", {r('w[i] / list_sum(w)')} as "Prob" from x, range(1, 65) t(i)""",
)
def softmax_probs(spark: SparkSession, folder: str) -> DataFrame:
    vecs = read_table(spark, folder, "embeddings")
    probs = vecs.select("vec_id", S.softmax(F.col("embedding").cast("array<double>")).alias("p"))
    long = probs.select("vec_id", F.posexplode("p").alias("i", "prob"))
    return long.select("vec_id", (F.col("i") + 1).cast("bigint").alias("Pos"), rounded("prob").alias("Prob"))


@query(
    "safe_float",
    f"""select event_id, variant as "Variant", {r('coalesce(case when isfinite(x) then x end, 0.0::double)')} as "Value" from (
      select event_id, 0 as variant, value as x from events union all
      select event_id, 1 + (event_id % 5)::int, try_cast(case event_id % 5 when 0 then 'nan' when 1 then 'x' || value when 2 then null
        else 'inf' end as double) from events where event_id % 5 < 4)""",
)
def safe_float(spark: SparkSession, folder: str) -> DataFrame:
    """Every event value as text, and further rows that are broken in different ways."""
    pick = F.col("event_id") % 5
    text = F.col("value").cast("string")
    broken = F.when(pick == 0, "NaN").when(pick == 1, F.concat(F.lit("x"), text)).when(pick == 3, "Infinity")
    events = read_table(spark, folder, "events")
    rows = events.select("event_id", F.lit(0).alias("Variant"), text.alias("raw")).unionAll(
        events.where(pick < 4).select("event_id", (pick + 1).cast("int").alias("Variant"), broken.alias("raw"))
    )
    return rows.select("event_id", "Variant", rounded(S.safe_float(F.col("raw"))).alias("Value"))


# --- the article job ---------------------------------------------------------------------------

_TOPICS_SQL = ", ".join(r(f"t{i}") + f' as "{c}"' for i, c in enumerate(C.TOPIC_COLUMNS, 1))


@query(
    "dataset_articles",
    with_views(
        "dated",
        f"""select ticker as "Ticker", company as "Company", news_date as "News_Date", published_ist as "Published_At",
        title as "Headline", summ as "Summary", url as "URL", source as "Source",
        {r('pos')} as "Sentiment_Positive", {r('neu')} as "Sentiment_Neutral", {r('neg')} as "Sentiment_Negative",
        {r('score')} as "Sentiment_Score", {_TOPICS_SQL}, {Q.arg_max_topic(_T)} as "Predicted_Topic",
        {r('relevance')} as "Article_Relevance", {r('strength')} as "Headline_Strength",
        {r('reliability')} as "Source_Reliability", {r('recency')} as "Recency_Weight",
        1.0::double as "Company_Weight", 1.0::double as "Topic_Weight", {r('weight')} as "News_Impact_Weight" from scored""",
        Q.article_views(),
        recursive=True,
    ),
)
def dataset_articles(spark: SparkSession, folder: str) -> DataFrame:
    """The article table. Labels need the day's threshold and are in the ``sentiment_labels`` query."""
    table = J.article_table(scored_articles(spark, folder))
    kinds = dict(table.dtypes)
    return table.drop("Sentiment_Label").select(
        *[rounded(c).alias(c) if kinds[c] == "double" else F.col(c) for c in table.columns if c != "Sentiment_Label"]
    )


def scored_articles(spark: SparkSession, folder: str) -> DataFrame:
    selected = J.select_articles(I.articles(spark, folder), I.companies(spark, folder), I.HOLIDAYS)
    chosen = cut_lineage(J.with_texts(selected))
    encode = lambda texts: E.hashed_embedding(texts, "text")
    vectors = J.article_vectors(chosen, new_path(spark, "embeddings"), encode, E.HASHED_ENCODER)
    return J.score_articles(E.description_topics(E.word_list_sentiment(chosen)), vectors=vectors)
