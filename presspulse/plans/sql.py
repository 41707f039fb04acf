"""SQL fragments for the independent statements of the queries (DuckDB dialect)."""

from __future__ import annotations

from presspulse import config as C
from presspulse.operators.enrich import NEGATIVE_WORDS, POSITIVE_WORDS

VIEWS = {
    "bars": """
  select ticker, d as bar_date, max(case when rn = 1 then px end) as open, max(px) as high, min(px) as low,
         max(case when rd = 1 then px end) as close, sum(q) as volume
  from (select p_brand as ticker, cast(l_shipdate as date) as d, l_extendedprice / l_quantity as px, l_quantity as q,
          row_number() over (partition by p_brand, cast(l_shipdate as date)
            order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) as rn,
          row_number() over (partition by p_brand, cast(l_shipdate as date)
            order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc, l_extendedprice desc,
                     l_quantity desc) as rd
        from lineitem join part on l_partkey = p_partkey) t
  group by ticker, d""",
    "bars_2024": "select ticker, bar_date + 8122 as bar_date, open, high, low, close, volume from bars",
    "companies": """
  select distinct p_brand as ticker, concat('Brand ', substr(p_brand, 7), ' Energy') as name,
         concat('BRK', substr(p_brand, 7)) as alias1, concat('Keyword ', substr(p_brand, 7)) as keyword1
  from part""",
    "templates": """
  select * from (values (0,'{c} CEO resigns amid controversy'),(1,'Chairman resigned after {c} board meeting'),
   (2,'{c} Wins Major Order Worth Rs 5000 Crore'),(3,'{c} bags mega deal with government'),
   (4,'{c} Reports Q2 Results, Net Profit Jumps 20%'),(5,'{c} announces final dividend of Rs 5 per share'),
   (6,'Analysts discuss {c} outlook for next year'),(7,'{c} board approves buyback!'),
   (8,'Regulator fined {c}'),(9,'{c} rated AA+ by agency'),(10,'Market closes flat'),(11,'{a} SHARES STEADY'))
   as t(tid, tmpl)""",
    "articles_raw": """
  select e.event_id as ord, e.ts as published_utc, e.ts + interval '330' minute as published_ist,
         co.ticker as ticker, co.name as company, co.alias1, co.keyword1,
         replace(replace(t.tmpl, '{c}', co.name), '{a}', co.alias1) as title, dc.text as description,
         case when e.event_type = 'click' then concat('https://www.', substr(p.url, instr(p.url, '//') + 2))
              else p.url end as url,
         case e.event_id % 6 when 0 then 'Reuters' when 1 then 'The Economic Times Online' when 2 then 'Some Blog'
              when 3 then '' when 4 then null else 'Hindustan Times' end as publisher
  from events e
  join companies co on co.ticker = concat('Brand#', cast(e.user_id % 25 + 1 as varchar))
  join templates t on t.tid = (e.event_id * 7) % 12
  join documents dc on dc.doc_id = e.event_id % (select count(*) from documents)
  join pages p on p.page_id = e.event_id % (select count(*) from pages)""",
    "probs": """
  select ord, cast(a as double) / (a + b + c) as pos, cast(b as double) / (a + b + c) as neu,
         cast(c as double) / (a + b + c) as neg,
         cast(a as double) / (a + b + c) - cast(c as double) / (a + b + c) as score,
         cast(t1 as double) / ts as t1, cast(t2 as double) / ts as t2, cast(t3 as double) / ts as t3,
         cast(t4 as double) / ts as t4, cast(t5 as double) / ts as t5, cast(t6 as double) / ts as t6
  from (select *, t1 + t2 + t3 + t4 + t5 + t6 as ts from (
    select event_id as ord, (event_id * 37) % 101 + 1 as a, (event_id * 53) % 97 + 1 as b, (event_id * 71) % 89 + 1 as c,
     (event_id * 3) % 7 + 1 as t1, (event_id * 5) % 11 + 1 as t2, (event_id * 7) % 13 + 1 as t3,
     (event_id * 11) % 17 + 1 as t4, (event_id * 13) % 19 + 1 as t5, (event_id * 17) % 23 + 1 as t6 from events) x) y""",
    "trading": """
  select d from (select cast(unnest(generate_series(
      (select min(cast(ts as date)) from events) - interval 30 day,
      (select max(cast(ts as date)) from events) + interval 30 day, interval 1 day)) as date) as d)
  where isodow(d) <= 5 and d <> date '2024-01-26'""",
    "news_windows": """
  select d as news_date, prev + interval '8 hours 30 minutes' as wstart, d + interval '8 hours 29 minutes 59 seconds' as wend
  from (select d, lag(d) over (order by d) as prev from trading) where prev is not null""",
    "feed_times": """
  select event_id as ord, concat('Brand#', cast(user_id % 25 + 1 as varchar)) as ticker,
         ts + interval '330' minute as published_ist from events""",
    "dated_times": """
  select f.*, w.news_date, w.wstart, w.wend from feed_times f
  join news_windows w on f.published_ist between w.wstart and w.wend""",
    "dated": """
  select a.*, w.news_date, w.wend from articles_raw a
  join news_windows w on a.published_ist between w.wstart and w.wend""",
    "history": """
  select ticker, bar_date as news_date, open, high, low, close, volume,
         ((dn * 7 + b * 3) % 21 - 10) / 10.0::double as score,
         cast(t1 as double) / ts as t1, cast(t2 as double) / ts as t2, cast(t3 as double) / ts as t3,
         cast(t4 as double) / ts as t4, cast(t5 as double) / ts as t5, cast(t6 as double) / ts as t6
  from (select *, t1 + t2 + t3 + t4 + t5 + t6 as ts from (
    select *, (dn * 3 + b) % 7 + 1 as t1, (dn * 5 + b) % 11 + 1 as t2, (dn * 7 + b) % 13 + 1 as t3,
     (dn * 11 + b) % 17 + 1 as t4, (dn * 13 + b) % 19 + 1 as t5, (dn * 17 + b) % 23 + 1 as t6
    from (select *, bar_date - date '1970-01-01' as dn, cast(substr(ticker, 7) as int) as b from bars)))""",
    "predictions": """
  select ticker, bar_date as news_date, model_name, target, close as last_close,
         case when model_name = 'naive' then close * cast(1.01 as double)
              else close + (close - open) * cast(1.5 as double) end as raw_value
  from bars cross join (values ('naive','Open'),('naive','Close'),('swing','Open'),('swing','Close')) as m(model_name, target)""",
    "clamped": """
  select *, case when last_close > 0
      then greatest(last_close * (1 - 0.2::double), least(last_close * (1 + 0.2::double), raw_value)) else raw_value end as value
  from predictions""",
    "actuals": """
  select ticker, bar_date as news_date, 'Open' as target, open as actual from bars
  union all select ticker, bar_date, 'Close', close from bars""",
}

_NEEDS = {
    "bars_2024": ["bars"],
    "articles_raw": ["companies", "templates"],
    "news_windows": ["trading"],
    "dated_times": ["feed_times", "news_windows"],
    "dated": ["articles_raw", "news_windows"],
    "history": ["bars"],
    "predictions": ["bars"],
    "clamped": ["predictions"],
    "actuals": ["bars"],
}

ROUND = 6
ROLLING_WORD = r"[^\p{L}\p{N}_]+"


def with_views(names: str, body: str, extra: list[tuple[str, str]] | None = None, recursive: bool = False) -> str:
    """``body`` preceded by the named views and everything they need; ``extra`` views come after."""
    ordered: list[str] = []

    def add(n: str) -> None:
        for m in _NEEDS.get(n, []):
            add(m)
        if n not in ordered:
            ordered.append(n)

    for n in names.split():
        add(n)
    parts = [f"{n} as materialized ({VIEWS[n]})" for n in ordered]
    parts += [f"{n} as {'' if n == 'walk' else 'materialized '}({q})" for n, q in extra or []]
    head = "with recursive " if recursive else "with "
    return (head + ",\n".join(parts) + "\n" + body) if parts else body


def r(x: str, digits: int = ROUND) -> str:
    return f"round({x}, {digits}) + 0.0::double"


def norm(x: str) -> str:
    return rf"coalesce(trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}_]+', ' ', 'g')), '')"


def clean(x: str) -> str:
    return rf"coalesce(trim(regexp_replace({x}, '[\t-\r\x{{1c}}-\x{{1f}}\x{{85}}\p{{Z}}]+', ' ', 'g')), '')"


def tokens(x: str) -> str:
    return f"list_filter(list_distinct(string_split({norm(x)}, ' ')), lambda t: t <> '')"


_PARTS = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def url_key(x: str) -> str:
    u = f"trim({x})"
    host = rf"regexp_replace(lower(regexp_extract({u}, '{_PARTS}', 1)), '^www\.', '')"
    path = f"regexp_replace(regexp_extract({u}, '{_PARTS}', 2), '/+$', '')"
    pairs = (
        f"list_filter(string_split(regexp_extract({u}, '{_PARTS}', 3), '&'), "
        "lambda p: p <> '' and not regexp_matches(lower(p), '^(utm_|fbclid|gclid|ref|ocid)'))"
    )
    query = f"case when len({pairs}) > 0 then '?' || array_to_string({pairs}, '&') else '' end"
    return f"coalesce(regexp_replace({host} || {path} || {query}, '^/+', ''), '')"


def host(x: str) -> str:
    return rf"regexp_replace(lower(regexp_extract({x}, '^(?:[hH][tT][tT][pP][sS]?)://([^/?#]+)', 1)), '^www\.', '')"


def publisher(x: str) -> str:
    h = host(x)
    whens = " ".join(f"when {h} = '{d}' or ends_with({h}, '.{d}') then '{p}'" for d, p in C.PUBLISHER_DOMAINS)
    return f"coalesce(case {whens} else {h} end, '')"


def strength(x: str) -> str:
    hits = ", ".join(
        f"case when regexp_matches({x}, '{p}', 'i') then {s}::double else 0.3::double end" for p, s in C.HEADLINE_ANCHORS
    )
    return f"greatest(0.3::double, {hits})"


def reliability(x: str) -> str:
    name = f"lower(trim({x}))"
    ranked = sorted(enumerate(C.SOURCE_RELIABILITY), key=lambda e: (-len(e[1][0]), e[0]))
    whens = " ".join(f"when contains({name}, '{k.lower()}') then {w}::double" for _, (k, w) in ranked)
    return f"case when {x} is null or {name} = '' then 0.65::double {whens} else 0.8::double end"


def mention(text: str, name: str) -> str:
    """Whether the text holds the name on word boundaries. All names have one of two forms, so one
    constant pattern lists every company named in the text."""
    edge = r"[^\p{L}\p{N}_]"
    found = rf"regexp_extract_all({text}, '(?i)(?:^|{edge})(brand [0-9]+ energy|brk[0-9]+)(?:{edge}|$)', 1)"
    return f"list_contains(list_transform({found}, lambda z: lower(z)), lower({name}))"


def jaccard(a: str, b: str) -> str:
    return (
        f"case when len({a}) > 0 and len({b}) > 0 then "
        f"cast(len(list_intersect({a}, {b})) as double) / len(list_distinct(list_concat({a}, {b}))) else 0.0::double end"
    )


TOPIC_LIST = "[" + ", ".join(f"'{c}'" for c in C.TOPIC_COLUMNS) + "]"


def arg_max_topic(cols: list[str]) -> str:
    arr = "[" + ", ".join(cols) + "]"
    return f"{TOPIC_LIST}[list_position({arr}, list_max({arr}))]"


def threshold(v: str, ref: str) -> str:
    return (
        f"greatest(0.08::double, least(0.45::double, 0.15::double * (1 + 0.8::double * "
        f"((case when {v} > 0 then {v} / {ref} else 1.0::double end) - 1))))"
    )


def label(score: str, t: str) -> str:
    return f"case when {score} > {t} then 'Positive' when {score} < -({t}) then 'Negative' else 'Neutral' end"


def dedup_walk(source: str) -> list[tuple[str, str]]:
    """Step-by-step duplicate removal per company day: ``kept`` lists the surviving rows."""
    return [
        (
            "numbered",
            f"select *, row_number() over (partition by ticker, news_date order by ord) as rn from {source}",
        ),
        (
            "walk",
            """
  select ticker, news_date, rn, ord, true as keep,
         case when url_key <> '' then [url_key] else cast([] as varchar[]) end as us,
         case when headline_key <> '' then [headline_key] else cast([] as varchar[]) end as hs
  from numbered where rn = 1
  union all
  select n.ticker, n.news_date, n.rn, n.ord,
         not (list_contains(w.us, n.url_key) or list_contains(w.hs, n.headline_key)),
         case when n.url_key <> '' and not (list_contains(w.us, n.url_key) or list_contains(w.hs, n.headline_key))
              then list_append(w.us, n.url_key) else w.us end,
         case when n.headline_key <> '' and not (list_contains(w.us, n.url_key) or list_contains(w.hs, n.headline_key))
              then list_append(w.hs, n.headline_key) else w.hs end
  from walk w join numbered n on n.ticker = w.ticker and n.news_date = w.news_date and n.rn = w.rn + 1""",
        ),
        ("kept", "select n.* from numbered n join walk w using (ticker, news_date, rn) where w.keep"),
    ]


def listed(words: frozenset[str], text: str) -> str:
    """How many words of the text are in the list."""
    found = ", ".join(f"'{w}'" for w in sorted(words))
    return f"len(list_filter(regexp_extract_all(lower({text}), '[a-z]+'), lambda w: w in ({found})))"


def topic_similarities(tokens_of: str) -> str:
    """Scaled cosines of a token list and the tokens of each topic's description."""
    described = ["list_distinct(regexp_extract_all(lower('{}'), '[a-z0-9_]+'))".format(C.TOPIC_DESCRIPTIONS[c].replace("'", "''")) for c in C.TOPIC_COLUMNS]
    each = (f"10.0::double * len(list_intersect({tokens_of}, {d})) / (sqrt(len({tokens_of})) * sqrt(len({d})))" for d in described)
    return "[" + ", ".join(f"case when len({tokens_of}) = 0 then 0.0::double else {e} end" for e in each) + "]"


def word_dimensions(tokens_of: str, dims: int = 64) -> str:
    return f"list_transform({tokens_of}, lambda t: ('0x' || substr(md5(t), 1, 8))::bigint % {dims})"


def article_views(importance: bool = False) -> list[tuple[str, str]]:
    """From dated feed rows to weighted article rows."""
    text = "title || ' ' || coalesce(description, '')"
    stext = r"regexp_replace(regexp_replace(title || '. ' || summary, '^[. ]+|[. ]+$', '', 'g'), '^\s+|\s+$', '', 'g')"
    profile = "name || '. ' || alias1 || '. ' || keyword1 || '. Energy'"
    return [
        ("mentioned", f"select * from dated where {mention(text, 'company')} or {mention(text, 'alias1')}"),
        ("keyed", f"select *, {url_key('url')} as url_key, {norm('title')} as headline_key from mentioned"),
        *dedup_walk("keyed"),
        (
            "texts",
            f"""
  select *, {tokens('stext')} as text_tokens from (
    select *, {stext} as stext from (select *, {clean('description')} as summary from kept))""",
        ),
        (
            "scores",
            f"""
  select ord, p / (p + n + 1.0::double) as pos, 1.0::double / (p + n + 1) as neu, n / (p + n + 1.0::double) as neg,
         p / (p + n + 1.0::double) - n / (p + n + 1.0::double) as score,
         {', '.join(f'e[{i}] / list_sum(e) as t{i}' for i in range(1, 7))}
  from (select *, list_transform(v, lambda a: exp(a - list_max(v))) as e from (
    select ord, {listed(POSITIVE_WORDS, 'stext')} as p, {listed(NEGATIVE_WORDS, 'stext')} as n,
           {topic_similarities('text_tokens')} as v from texts))""",
        ),
        (
            "text_dims",
            f"""
  select ord, ticker, dim, count(*)::double as c
  from (select ord, ticker, unnest({word_dimensions('text_tokens')}) as dim from texts) group by all""",
        ),
        (
            "profile_dims",
            f"""
  select ticker, dim, count(*)::double as c
  from (select ticker, unnest({word_dimensions(tokens(profile))}) as dim from companies) group by all""",
        ),
        (
            "cosines",
            """
  select ord, dot / (tn * pn) as cosine
  from (select t.ord, t.ticker, sum(t.c * p.c) as dot from text_dims t join profile_dims p using (ticker, dim) group by all)
  join (select ord, sqrt(sum(c * c)) as tn from text_dims group by ord) using (ord)
  join (select ticker, sqrt(sum(c * c)) as pn from profile_dims group by ticker) using (ticker)""",
        ),
        (
            "factors",
            f"""
  select k.*, p.* exclude (ord), k.summary as summ,
         coalesce(nullif(k.publisher, ''), {publisher('k.url')}) as source,
         {strength('k.title')} as strength,
         exp(-greatest(0.0::double, (epoch_us(k.wend) - epoch_us(k.published_ist)) / 3.6e9::double) / 24.0::double) as recency,
         case when k.stext = '' then 0.0::double else (coalesce(c.cosine, 0.0::double) + 1) / 2 end as relevance
  from texts k join scores p using (ord) left join cosines c using (ord)""",
        ),
        (
            "weighted",
            f"""
  select *, {reliability('source')} as reliability from factors""",
        ),
        (
            "scored",
            """
  select *, case when sum(raw) over g > 0 then raw / sum(raw) over g else 1.0::double / count(*) over g end as weight
  from (select *, reliability * recency * relevance * strength as raw from weighted)
  window g as (partition by ticker, news_date)""",
        ),
    ]


def daily_views() -> list[tuple[str, str]]:
    """From weighted article rows to labelled daily rows for every company and trading day."""
    topics = ", ".join(f"sum(t{i} * weight) as t{i}" for i in range(1, 7))
    filled = ", ".join(f"coalesce(g.t{i}, 1.0::double / 6) as t{i}" for i in range(1, 7))
    return [
        (
            "agg",
            f"""
  select ticker, news_date, sum(score * weight) as score, sum(pos * weight) as pos, sum(neu * weight) as neu,
         sum(neg * weight) as neg, {topics}, string_agg(title, ' || ' order by ord) as headlines, count(*) as n
  from scored group by ticker, news_date""",
        ),
        (
            "vols",
            """
  select *, case when count(lr) over w >= 30 then stddev_samp(lr) over w end as vol
  from (select *, ln(close / lag(close) over (partition by ticker order by bar_date)) as lr from bars_2024)
  window w as (partition by ticker order by bar_date rows between 89 preceding and current row)""",
        ),
        (
            "grid",
            """
  select c.ticker, c.name as company, t.d as news_date from companies c cross join trading t
  where t.d between (select min(news_date) from dated_times) and (select max(news_date) from dated_times)""",
        ),
        (
            "grid_bars",
            """
  select g.*, b.open, b.high, b.low, b.close, b.volume, v.vol from grid g
  asof left join bars_2024 b on g.ticker = b.ticker and g.news_date >= b.bar_date
  asof left join (select * from vols where vol is not null) v on g.ticker = v.ticker and g.news_date >= v.bar_date""",
        ),
        (
            "refs",
            "select news_date, case when median(vol) > 0 then median(vol) else 0.02::double end as vref from grid_bars group by news_date",
        ),
        (
            "daily0",
            f"""
  select b.*, r.vref, coalesce(g.score, 0.0::double) as score, coalesce(g.pos, 0.0::double) as pos,
         coalesce(g.neu, 1.0::double) as neu, coalesce(g.neg, 0.0::double) as neg, {filled},
         coalesce(g.headlines, '') as headlines, coalesce(g.n, 0) as n
  from grid_bars b join refs r using (news_date) left join agg g using (ticker, news_date)""",
        ),
        (
            "daily",
            f"select *, {arg_max_topic([f't{i}' for i in range(1, 7)])} as topic, {label('score', threshold('vol', 'vref'))} as label from daily0",
        ),
    ]
