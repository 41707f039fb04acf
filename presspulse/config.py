"""Fixed values of the engine: reference dimensions, thresholds and column sets.

Everything here is data. Dimensions that a deployment normally keeps in tables
(companies, holidays, source tiers) can be replaced by DataFrames or arguments at
every call site; the values below are the defaults.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: news window (Asia/Kolkata wall clock) ---------------------
IST_OFFSET_MINUTES = 330
WINDOW_START_HOUR = 8
WINDOW_START_MINUTE = 30
MAX_ARTICLES_PER_COMPANY = 40

# --- fixed values: market history ---------------------------------------------
LOOKBACK_DAYS = 200
VOLATILITY_WINDOW = 90
ATR_WINDOW = 14
SEQUENCE_LENGTH = 15

# --- fixed values: text handling ----------------------------------------------
MIN_USEFUL_BODY_LENGTH = 40
HEADLINE_SEPARATOR = " || "
TRACKING_PARAM_PREFIXES = ("utm_", "fbclid", "gclid", "ref", "ocid")

# --- fixed values: prediction and monitoring ----------------------------------
PROB_SUM_TOLERANCE = 0.05
CLAMP_PCT = 0.20
MAPE_ALERT = 5.0
DIRECTION_ALERT = 0.50


@dataclass(frozen=True)
class ThresholdParams:
    """Parameters of the volatility-scaled label threshold."""

    base: float = 0.15
    k: float = 0.8
    min_threshold: float = 0.08
    max_threshold: float = 0.45
    v_ref: float = 0.02


DEFAULT_V_REF = 0.02

# --- fixed values: topics -----------------------------------------------------
TOPIC_COLUMNS = [
    "Prob_Topic_1_Policy_Regulatory",
    "Prob_Topic_2_Financial_Performance",
    "Prob_Topic_3_Investment_FII_DII",
    "Prob_Topic_4_Infrastructure_Expansion",
    "Prob_Topic_5_Stock_Price_Action",
    "Prob_Topic_6_Commodity_Macro",
]

TOPIC_LABELS = {
    "Prob_Topic_1_Policy_Regulatory": "Policy / Regulatory",
    "Prob_Topic_2_Financial_Performance": "Financial Performance",
    "Prob_Topic_3_Investment_FII_DII": "Investment / FII-DII",
    "Prob_Topic_4_Infrastructure_Expansion": "Infrastructure / Expansion",
    "Prob_Topic_5_Stock_Price_Action": "Stock Price Action",
    "Prob_Topic_6_Commodity_Macro": "Commodity / Macro",
}

TOPIC_DESCRIPTIONS = {
    "Prob_Topic_1_Policy_Regulatory": (
        "Government policy, regulation, licensing, taxation, subsidies, court rulings, "
        "or ministry/regulator actions affecting the company or sector."
    ),
    "Prob_Topic_2_Financial_Performance": (
        "Quarterly or annual results, revenue, profit, margins, guidance, credit "
        "rating actions, or other financial-performance disclosures."
    ),
    "Prob_Topic_3_Investment_FII_DII": (
        "Investment activity, stake changes, FII/DII flows, block deals, fund-raising, "
        "mergers and acquisitions, or capital allocation decisions."
    ),
    "Prob_Topic_4_Infrastructure_Expansion": (
        "New plants, capacity expansion, project commissioning, infrastructure builds, "
        "partnerships, or major contract/order wins related to physical operations."
    ),
    "Prob_Topic_5_Stock_Price_Action": (
        "Direct commentary on the stock's price movement, analyst target price changes, "
        "technical levels, trading volume, or brokerage upgrades/downgrades."
    ),
    "Prob_Topic_6_Commodity_Macro": (
        "Commodity price movements (crude oil, coal, natural gas), currency, interest "
        "rates, or broader macroeconomic factors affecting the energy sector."
    ),
}

TOPIC_MULTIPLIERS = dict.fromkeys(TOPIC_COLUMNS, 1.0)

# --- fixed values: source reliability (name, weight), in listing order ---------
SOURCE_RELIABILITY = [
    ("Reuters", 1.00),
    ("Bloomberg", 1.00),
    ("The Economic Times", 0.95),
    ("Business Standard", 0.95),
    ("Mint", 0.92),
    ("Financial Express", 0.90),
    ("Moneycontrol", 0.90),
    ("Livemint", 0.90),
    ("Business Today", 0.88),
    ("CNBC-TV18", 0.88),
    ("CNBC TV18", 0.88),
    ("The Hindu BusinessLine", 0.88),
    ("Hindustan Times", 0.85),
    ("Times of India", 0.85),
    ("India Today", 0.83),
    ("NDTV", 0.83),
    ("The Indian Express", 0.83),
    ("Zee Business", 0.80),
    ("Press Trust of India", 0.95),
    ("PTI", 0.95),
    ("ANI", 0.90),
]
SOURCE_DEFAULT_NAMED = 0.80
SOURCE_DEFAULT_BLANK = 0.65

# --- fixed values: publisher domains (domain, publisher), in listing order -----
PUBLISHER_DOMAINS = [
    ("moneycontrol.com", "Moneycontrol"),
    ("economictimes.indiatimes.com", "The Economic Times"),
    ("business-standard.com", "Business Standard"),
    ("livemint.com", "Mint"),
    ("financialexpress.com", "Financial Express"),
    ("businesstoday.in", "Business Today"),
    ("cnbctv18.com", "CNBC-TV18"),
    ("thehindubusinessline.com", "The Hindu BusinessLine"),
    ("hindustantimes.com", "Hindustan Times"),
    ("timesofindia.indiatimes.com", "Times of India"),
    ("indiatoday.in", "India Today"),
    ("ndtv.com", "NDTV"),
    ("indianexpress.com", "The Indian Express"),
    ("zeebiz.com", "Zee Business"),
    ("reuters.com", "Reuters"),
    ("bloomberg.com", "Bloomberg"),
    ("ptinews.com", "Press Trust of India"),
    ("aninews.in", "ANI"),
]

# --- fixed values: headline anchors (pattern, score) ---------------------------
HEADLINE_FLOOR = 0.30
HEADLINE_ANCHORS = [
    (
        r"\b(ceo|cfo|coo|cmd|chairman|md|managing director)\b[^.]{0,40}"
        r"\b(resign\w*|quit\w*|steps?\s+down|exits?|ousted|removed|sack\w*)\b",
        0.98,
    ),
    (r"\b(resign\w*|quit\w*|steps?\s+down)\b[^.]{0,40}\b(ceo|cfo|coo|chairman|md)\b", 0.98),
    (r"\b(wins?|bags?|secures?|clinches?|awarded)\b[^.]{0,40}\b(order|contract|deal|project)\b", 0.96),
    (r"\bmega\s*deal\b", 0.96),
    (r"\b(q[1-4]\s*(fy)?\d{0,4}|quarterly)\b[^.]{0,40}\b(results?|earnings?|profit|revenue)\b", 0.93),
    (r"\bnet\s+profit\b", 0.93),
    (r"\bannual\s+results?\b", 0.93),
    (r"\bdividend\w*\b", 0.75),
    (r"\bbuyback\b", 0.72),
    (r"\b(probe|investigat\w*|penalt\w*|fined?|raid\w*)\b", 0.85),
    (r"\b(rating\s+(upgrad\w*|downgrad\w*)|rated?\s+(aa|a|bbb)\+?)\b", 0.80),
]

# --- fixed values: exchange holidays -------------------------------------------
HOLIDAYS = [
    "2026-01-26", "2026-03-04", "2026-03-26", "2026-03-31", "2026-04-01",
    "2026-04-14", "2026-05-01", "2026-08-15", "2026-08-26", "2026-10-02",
    "2026-10-20", "2026-11-08", "2026-11-09", "2026-11-24", "2026-12-25",
    "2027-01-26", "2027-02-21", "2027-03-15", "2027-03-20", "2027-04-01",
    "2027-04-14", "2027-05-01", "2027-08-15", "2027-08-16", "2027-10-02",
    "2027-10-09", "2027-10-28", "2027-10-29", "2027-11-14", "2027-12-25",
]

# --- fixed values: tracked companies (name, ticker, sector, aliases, keywords) --
COMPANIES = [
    ("Reliance Industries", "RELIANCE.NS", "Diversified Energy",
     ["Reliance Industries", "Reliance Industries Limited", "RIL"],
     ["Reliance", "Jio", "Reliance Retail", "O2C", "Mukesh Ambani"]),
    ("ONGC", "ONGC.NS", "Oil & Gas Exploration",
     ["Oil and Natural Gas Corporation", "ONGC Videsh"],
     ["ONGC", "crude oil production", "KG basin"]),
    ("Indian Oil", "IOC.NS", "Oil Marketing & Refining",
     ["Indian Oil Corporation", "IOCL", "IndianOil"],
     ["Indian Oil", "IOCL", "Paradip refinery"]),
    ("Bharat Petroleum", "BPCL.NS", "Oil Marketing & Refining",
     ["Bharat Petroleum Corporation", "BPCL"],
     ["BPCL", "Bharat Petroleum", "Kochi refinery"]),
    ("Hindustan Petroleum", "HINDPETRO.NS", "Oil Marketing & Refining",
     ["Hindustan Petroleum Corporation", "HPCL"],
     ["HPCL", "Hindustan Petroleum", "Visakh refinery"]),
    ("GAIL", "GAIL.NS", "Gas Transmission & Distribution",
     ["GAIL India", "Gas Authority of India"],
     ["GAIL", "gas pipeline", "LNG terminal"]),
    ("NTPC", "NTPC.NS", "Power Generation",
     ["National Thermal Power Corporation", "NTPC Limited"],
     ["NTPC", "thermal power plant", "NTPC Green"]),
    ("Power Grid", "POWERGRID.NS", "Power Transmission",
     ["Power Grid Corporation of India", "PGCIL"],
     ["Power Grid", "PGCIL", "transmission line"]),
    ("Tata Power", "TATAPOWER.NS", "Power Generation & Distribution",
     ["Tata Power Company"],
     ["Tata Power", "Tata Power Renewable"]),
    ("Adani Power", "ADANIPOWER.NS", "Power Generation",
     ["Adani Power Limited"],
     ["Adani Power", "thermal power"]),
    ("Adani Green", "ADANIGREEN.NS", "Renewable Energy",
     ["Adani Green Energy", "Adani Green Energy Limited"],
     ["Adani Green", "solar park", "wind power Adani"]),
    ("Adani Energy Solutions", "ADANIENSOL.NS", "Power Transmission & Distribution",
     ["Adani Energy Solutions Limited", "Adani Transmission"],
     ["Adani Energy Solutions", "Adani Transmission"]),
    ("JSW Energy", "JSWENERGY.NS", "Power Generation",
     ["JSW Energy Limited"],
     ["JSW Energy", "JSW Power"]),
    ("NHPC", "NHPC.NS", "Hydro Power",
     ["National Hydroelectric Power Corporation"],
     ["NHPC", "hydroelectric project"]),
    ("SJVN", "SJVN.NS", "Hydro Power",
     ["Satluj Jal Vidyut Nigam"],
     ["SJVN", "hydro power project"]),
    ("Torrent Power", "TORNTPOWER.NS", "Power Generation & Distribution",
     ["Torrent Power Limited"],
     ["Torrent Power"]),
    ("CESC", "CESC.NS", "Power Distribution",
     ["CESC Limited", "Calcutta Electric Supply Corporation"],
     ["CESC", "Kolkata power distribution"]),
    ("Coal India", "COALINDIA.NS", "Coal Mining",
     ["Coal India Limited", "CIL"],
     ["Coal India", "CIL", "coal production"]),
    ("Oil India", "OIL.NS", "Oil & Gas Exploration",
     ["Oil India Limited", "OIL"],
     ["Oil India", "Assam oil field"]),
    ("Petronet LNG", "PETRONET.NS", "LNG Terminal & Regasification",
     ["Petronet LNG Limited"],
     ["Petronet LNG", "Dahej terminal", "Kochi LNG terminal"]),
]

# --- fixed values: feature sets -------------------------------------------------
ENGINEERED_COLUMNS = [
    "Sentiment_Score",
    *TOPIC_COLUMNS,
    "NewsDay_Intraday_Pct",
    "NewsDay_Range_Pct",
    "Log_Volume",
    "Month_sin",
    "Month_cos",
    "DOW_sin",
    "DOW_cos",
    "Sentiment_RollMean_3",
    "Sentiment_RollMean_7",
    "Momentum_RollMean_3",
    "Momentum_RollMean_7",
    "Volatility_Roll7",
    "Ticker_Code",
]

SAME_DAY_COLUMNS = [
    "News_Day_Open",
    "News_Day_High",
    "News_Day_Low",
    "News_Day_Close",
    "News_Day_Volume",
    "Day_High_Low_Spread_Pct",
    "Day_Close_Open_Spread_Pct",
    "Sentiment_Score",
    *TOPIC_COLUMNS,
]

_NO_TICKER = [c for c in ENGINEERED_COLUMNS if c != "Ticker_Code"]
FEATURE_SETS = {
    "engineered_v1": ENGINEERED_COLUMNS,
    "engineered_v1_no_ticker": _NO_TICKER,
    "engineered_v1_keras_open": _NO_TICKER[:16],
    "engineered_v1_keras_close": _NO_TICKER[:17],
    "stock_news_v1": SAME_DAY_COLUMNS,
}

# --- fixed values: inputs of the scale-then-reduce regression -------------------
REGRESSION_COLUMNS = [
    "Open", "High", "Low", "Close", "Adj_Close", "Volume",
    "Sentiment_Score", "Sentiment_Positive", "Sentiment_Neutral", "Sentiment_Negative",
    *TOPIC_COLUMNS,
    "Article_Count", "Volatility",
]
PCA_COMPONENTS = 8


@dataclass(frozen=True)
class ModelSpec:
    """One price model for one target; rows of the model dimension."""

    name: str
    target: str
    backend: str
    feature_set: str
    builder: str = "engineered"
    output_index: int | None = None
    sequence_length: int | None = None
    unverified: bool = False


# --- fixed values: configured models --------------------------------------------
MODEL_SPECS = [
    ModelSpec("stock_news_rf", "Open", "sklearn", "stock_news_v1", "stock_news_row", 0, None, True),
    ModelSpec("stock_news_rf", "Close", "sklearn", "stock_news_v1", "stock_news_row", 1, None, True),
    ModelSpec("lstm_keras", "Open", "keras", "engineered_v1_keras_open", "engineered", None, SEQUENCE_LENGTH, True),
    ModelSpec("lstm_keras", "Close", "keras", "engineered_v1_keras_close", "engineered", None, SEQUENCE_LENGTH, True),
]
