from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from presspulse import config as C
from presspulse.functions import market_time as M
from presspulse.operators import daily as D
from presspulse.operators import matching
from presspulse.operators import news as N
from presspulse.operators.matching import match_companies
from presspulse.plans import inputs as I
from presspulse.plans import jobs as J
from presspulse.plans.q_articles import relevance_jaccard
from presspulse.schemas import COMPANIES, RAW_ARTICLE

MONDAY = dt.date.fromisocalendar(2025, 33, 1)
TUESDAY, WEDNESDAY, FRIDAY = (MONDAY + dt.timedelta(days=n) for n in (1, 2, -3))


def _previous(value, day, holidays):
    return value(M.previous_trading_day(F.col("d"), holidays), d=day)


def test_windows_start_on_the_previous_trading_day(value):
    assert _previous(value, WEDNESDAY, ()) == TUESDAY
    assert _previous(value, MONDAY, ()) == FRIDAY
    assert _previous(value, TUESDAY, (MONDAY.isoformat(),)) == FRIDAY
    start, end = (value(f(F.col("d")), d=WEDNESDAY) for f in (M.window_start, M.window_end))
    assert start == dt.datetime.combine(TUESDAY, dt.time(8, 30)) and end == dt.datetime.combine(WEDNESDAY, dt.time(8, 29, 59))
    assert value(M.window_end(F.col("d"), 9, 0), d=WEDNESDAY) == dt.datetime.combine(WEDNESDAY, dt.time(8, 59, 59))


@pytest.mark.parametrize("seed", [1, 2])
def test_calendar_equals_stepping_day_by_day(spark, seed):
    rng = random.Random(seed)
    days = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(500)]
    holidays = tuple(C.HOLIDAYS) if seed == 1 else tuple(d.isoformat() for d in rng.sample(days, 180))
    closed = {dt.date.fromisoformat(h) for h in holidays}
    shut = lambda d: d.weekday() >= 5 or d in closed

    def step(d, by):
        while shut(d):
            d += dt.timedelta(days=by)
        return d

    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    rows = df.select(
        d, M.is_trading_day(d, holidays), M.on_or_after(d, holidays), M.previous_trading_day(d, holidays)
    ).collect()
    for day, trading, after, before in rows:
        assert trading == (not shut(day))
        assert after == step(day, 1)
        assert before == step(day - dt.timedelta(days=1), -1)


def test_news_date_equals_the_window_that_contains_the_time(spark):
    rng = random.Random(7)
    holidays = ("2024-01-26", "2024-01-15")
    times = [dt.datetime(2024, 1, 8) + dt.timedelta(seconds=rng.uniform(0, 30 * 86400)) for _ in range(1000)]
    times += [dt.datetime(2024, 1, 17, 8, m, s, us) for m, s, us in ((29, 59, 0), (29, 59, 1), (29, 59, 999999), (30, 0, 0))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t timestamp_ntz")
    got = dict(df.select("i", M.news_date(F.col("t"), holidays)).collect())
    closed = {dt.date.fromisoformat(h) for h in holidays}
    trading = [d for d in (dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(60)) if d.weekday() < 5 and d not in closed]
    windows = [
        (dt.datetime.combine(a, dt.time(8, 30)), dt.datetime.combine(b, dt.time(8, 29, 59)), b)
        for a, b in zip(trading, trading[1:])
    ]
    for i, t in enumerate(times):
        assert got[i] == next((b for lo, hi, b in windows if lo <= t <= hi), None), t


def test_hours_do_not_depend_on_the_session_zone(spark, value):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        hours = value(
            M.hours_between(F.lit("2025-03-09 00:00:00").cast("timestamp_ntz"), F.lit("2025-03-09 12:00:00").cast("timestamp_ntz"))
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert hours == 12.0


def test_feed_scan(spark):
    raw = spark.createDataFrame(
        [
            ("T", None, "https://www.ndtv.com/a", "Mon, 01 Jan 2024 07:30:00 GMT", ("", None)),
            (None, "d", None, "bad", ("Mint", None)),
            ("T", "d", "x", None, None),
        ],
        RAW_ARTICLE,
    )
    rows = N.scan_feed(raw).collect()
    assert [r["Source"] for r in rows] == ["NDTV", "Mint", ""]
    assert [r["Headline"] for r in rows] == ["T", "", "T"]
    assert [r["Published_At"] for r in rows] == [dt.datetime(2024, 1, 1, 13, 0), None, None]


def sequential(rows):
    """rows: (ord, url_key, headline_key) -> kept ords."""
    urls, heads, kept = set(), set(), []
    for o, u, h in sorted(rows):
        if (u and u in urls) or (h and h in heads):
            continue
        urls.add(u)
        heads.add(h)
        kept.append(o)
    return kept


@pytest.mark.parametrize("spread", [4, 15, 60])
def test_duplicates_equal_the_sequential_rule(spark, spread):
    rng = random.Random(spread)
    data = []
    for g in range(25):
        n = rng.randint(1, 40)
        for o in rng.sample(range(1000), n):
            u, h = (rng.choice(["", *map(str, range(spread))]) for _ in range(2))
            data.append((f"T{g}", dt.date(2024, 1, 1), o, u and f"u{u}", h and f"h{h}", f"x{o}"))
    df = spark.createDataFrame(data, "Ticker string, News_Date date, ord int, url_key string, headline_key string, extra string")
    want = sorted((t, o) for t in {r[0] for r in data} for o in sequential([r[2:5] for r in data if r[0] == t]))
    result = N.dedupe(df, D.DAY, "ord")
    assert result.columns == df.columns
    assert sorted((r["Ticker"], r["ord"]) for r in result.collect()) == want
    assert all(r["extra"] == f"x{r['ord']}" for r in result.collect())


def test_a_long_chain_of_shared_keys_is_followed_to_its_end(spark):
    # each row shares its headline with the row before and its URL with the row after
    chain = [(o, f"u{(o + 1) // 2}", f"h{o // 2}") for o in range(13)]
    df = spark.createDataFrame([("T", dt.date(2024, 1, 1), *r) for r in chain], "Ticker string, News_Date date, ord int, url_key string, headline_key string")
    got = sorted(r["ord"] for r in N.dedupe(df, D.DAY, "ord").collect())
    assert got == sequential(chain) == list(range(0, 13, 2))


def test_copies_of_one_article_leave_one_row(spark):
    df = spark.range(20000).select(
        F.lit("T").alias("Ticker"), F.lit("2024-01-01").cast("date").alias("News_Date"), F.col("id").alias("ord"),
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("url_key"),
        F.lit("").alias("headline_key"),
    )
    assert N.dedupe(df, D.DAY, "ord").count() == 20000 - 6667 + 1


def test_duplicate_keys_follow_links_and_spelling(spark):
    df = spark.createDataFrame(
        [
            (1, "https://www.e.com/a?utm_source=x", "Big News!"),
            (2, "http://e.com/a/", "Other"),
            (3, "http://e.com/b", "BIG  news"),
            (4, "http://e.com/c", "Third"),
        ],
        "ord int, URL string, Headline string",
    ).withColumns({"Ticker": F.lit("T"), "News_Date": F.lit("2024-01-01").cast("date")})
    kept = N.dedupe(N.duplicate_keys(df), D.DAY, "ord")
    assert sorted(r["ord"] for r in kept.collect()) == [1, 4]


def test_mentions_match_whole_words_in_one_and_in_several_parts(spark, monkeypatch):
    companies = spark.createDataFrame(C.COMPANIES, COMPANIES)
    odd = spark.createDataFrame([("A&B (India)", "AB", None, ["C++", "&"], None)], COMPANIES)
    texts = {
        1: "ONGC Videsh wins; crude OIL rises",
        2: "Foil and oily things, RILX",
        3: "ril: strong quarter. Indian Oil Corporation and Coal India",
        4: "The A&B (India) story; C++x",
        5: "indianoil IndianOil",
        6: "éRIL RILé _RIL",
        7: "",
        8: "x & y, p&q",
        9: "A&B (India)x",
        10: "\u0130ndian O\u0131l and r\u0130l, Co\u00e4l \u212aG coa\u2113",
        11: "NHP\u0421 ntpc Ntpc\u00b2 NTPC\u0301",
    }
    df = spark.createDataFrame(list(texts.items()), "id int, t string")
    every = companies.unionByName(odd)
    pairs = sorted(map(tuple, match_companies(df, every, "id", "t").collect()))
    monkeypatch.setattr(matching, "NAMES_AT_ONCE", 7)
    assert pairs == sorted(map(tuple, match_companies(df, every, "id", "t").collect()))
    dims = [(t, [n, *a]) for n, t, _, a, _ in C.COMPANIES] + [("AB", ["A&B (India)", "C++", "&"])]
    hit = lambda names, text: any(re.search(rf"\b{re.escape(n)}\b", text, re.IGNORECASE) for n in names)
    assert pairs == sorted((i, t) for i, text in texts.items() for t, names in dims if hit(names, text))
    assert {t for i, t in pairs if i == 3} == {"RELIANCE.NS", "IOC.NS", "COALINDIA.NS", "OIL.NS"}
    own = spark.createDataFrame([(1, "Coal India rises", "COALINDIA.NS"), (2, "COALS", "COALINDIA.NS"), (3, "Coal India", "RELIANCE.NS"), (4, None, "x"), (5, "RIL", None)], "id int, t string, k string")
    assert [tuple(r) for r in match_companies(own, every, ["id", "k"], "t", own="k").collect()] == [(1, "COALINDIA.NS")]
    assert match_companies(own, every.limit(0), "id", "t").count() == 0


def test_case_folding_is_that_of_a_regex():
    letters = matching.folded_letters()
    fold = lambda c: letters.get(ord(c), c)
    sample = [chr(c) for c in range(0x20, 0x600)] + list("\u1f80\u1f88\u1e9e\u2126\u212a\u212b\u017f\ufb01\U00010400\U00010428")
    same = {}
    for c in sample:
        same.setdefault(fold(c), []).append(c)
    for group in same.values():
        assert all(re.fullmatch(re.escape(a), b, re.IGNORECASE) or {a, b} <= set("iI\u0130\u0131") for a in group for b in group)
    assert fold("\u0130") == fold("\u0131") == "i" and fold("\u1f80") == fold("\u1f88")


def test_many_names_need_one_pass(spark):
    names = spark.range(100_000).select(
        F.concat(F.lit("T"), "id").alias("ticker"), F.concat(F.lit("Acme "), F.hex("id"), F.lit(" & Sons")).alias("name"),
        F.lit(None).cast("string").alias("sector"), F.array(F.concat(F.lit("ACM"), "id")).alias("aliases"), F.lit(None).cast("array<string>").alias("keywords"),
    )
    texts = spark.range(2000).select("id", F.concat(F.lit("news of acme "), F.lower(F.hex(F.col("id") * 40)), F.lit(" & SONS, not ACM7x; acm"), F.col("id") + 3).alias("t"))
    got = {(r["id"], r["ticker"]) for r in match_companies(texts, names, "id", "t").collect()}
    assert got == {(i, f"T{n}") for i in range(2000) for n in (40 * i, i + 3)}


def test_cap_keeps_the_first_rows(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), (100 - F.col("id")).alias("ord"))
    got = N.first_per_group(df, ["k"], "ord", 3)
    assert sorted(r["ord"] for r in got.collect()) == [1, 2, 3, 4, 5, 6]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan  # rows beyond the cap are dropped before the shuffle


def nodes(plan, kinds):
    """Outputs of the nodes of these kinds in a physical plan that is not adaptive."""
    own = [plan.output().mkString(",")] if plan.nodeName().split(" ")[0] in kinds else []
    children = plan.children()
    return own + [o for i in range(children.size()) for o in nodes(children.apply(i), kinds)]


@pytest.fixture
def shuffled_joins(spark):
    held = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_no_shuffle_carries_the_bodies_with_the_events(spark, shuffled_joins):
    arts = I.articles(spark, "/root/testdata/sf0.001")
    moved = nodes(arts._jdf.queryExecution().executedPlan(), ("Exchange", "Sort"))
    assert len([o for o in moved if "Description" in o]) == 2  # the documents alone, dealt and sorted


def test_surviving_keys_select_articles_without_shuffling_texts(spark, shuffled_joins, tmp_path):
    rows = [(i, "T", "Alpha", f"Alpha {i % 3}", f"http://e.com/{i % 4}", dt.datetime.combine(WEDNESDAY, dt.time(3)), "x" * 50) for i in range(12)]
    kinds = "ord long, Ticker string, Company string, Headline string, URL string, Published_At timestamp_ntz, Description string"
    spark.createDataFrame(rows, kinds).write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    companies = spark.createDataFrame([("T", "Alpha", "s", ["k"], ["A"])], "ticker string, name string, sector string, keywords array<string>, aliases array<string>")
    chosen = J.select_articles(feed, companies, ())
    moved = nodes(chosen._jdf.queryExecution().executedPlan(), ("Exchange", "Sort"))
    assert not [o for o in moved if "Description" in o]
    assert sorted(r["ord"] for r in chosen.collect()) == [0, 1, 2]


def test_few_profiles_are_broadcast_to_the_texts(spark, shuffled_joins):
    plan = relevance_jaccard(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    assert len([o for o in nodes(plan, ("Exchange", "Sort")) if "Description" in o]) == 2  # the documents alone
