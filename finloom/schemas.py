"""Declared schemas of every table the jobs read or write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The themes, in load order, with their listing pages.
THEME_LISTINGS = (
    ("Stock_Market", "https://finance.yahoo.com/topic/stock-market-news/"),
    ("Original", "https://finance.yahoo.com/topic/yahoo-finance-originals/"),
    ("Economies", "https://finance.yahoo.com/topic/economic-news/"),
    ("Earning", "https://finance.yahoo.com/topic/earnings/"),
    ("Tech", "https://finance.yahoo.com/topic/tech/"),
    ("Housing", "https://finance.yahoo.com/topic/housing-market/"),
    ("Crypto", "https://finance.yahoo.com/topic/crypto/"),
    ("Latest", "https://finance.yahoo.com/topic/latest-news/"),
)
THEMES = tuple(name for name, _ in THEME_LISTINGS)

# Zones of the market clock and of the readers' clock.
MARKET_ZONE = "America/New_York"
READER_ZONE = "Asia/Seoul"


TEXT, NUMBER, SMALL, REAL = T.StringType(), T.DoubleType(), T.ShortType(), T.FloatType()
WALL = T.TimestampNTZType()
AMOUNT, RATIO = T.DecimalType(20, 2), T.DecimalType(10, 4)


def row(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DAY_PARTITIONS = row(year=TEXT, month=TEXT, day=TEXT)
RAW_PAGE = row(url=TEXT, timestamp=TEXT, content=TEXT)

# The columns of the tables.
ARTICLES = row(
    article_publisher=TEXT,
    authors=TEXT,
    date=WALL,
    text=TEXT,
    theme=TEXT,
    timezone=TEXT,
    title=TEXT,
    url=TEXT,
)
# Stored articles have the day of their date as folder column.
STORED_ARTICLES = row(**{f.name: f.dataType for f in ARTICLES.fields}, day=TEXT)
FINANCIAL_EVENTS = row(
    release_time=WALL,
    timezone=TEXT,
    country=TEXT,
    volatility=SMALL,
    title=TEXT,
    actual=REAL,
    forecast=REAL,
    previous=REAL,
    unit=TEXT,
)
# Where a parsed row stood: rows of one page are loaded in page order.
PAGE_PLACE = row(page=TEXT, position=T.IntegerType())
MEASURE = row(value=NUMBER, unit=TEXT)
EARNING_RECORD = row(
    company=row(name=TEXT, symbol=TEXT),
    country=TEXT,
    eps=row(actual=MEASURE, forecast=MEASURE),
    revenue=row(actual=MEASURE, forecast=MEASURE),
    market_cap=MEASURE,
    year=T.IntegerType(),
    quarter=T.IntegerType(),
    call_date=T.LongType(),
    timezone=TEXT,
)
EARNING_CALLS = row(
    company_name=TEXT,
    symbol=TEXT,
    country=TEXT,
    year=SMALL,
    quarter=SMALL,
    eps_actual_value=REAL,
    eps_actual_unit=TEXT,
    eps_forecast_value=REAL,
    eps_forecast_unit=TEXT,
    revenue_actual_value=REAL,
    revenue_actual_unit=TEXT,
    revenue_forecast_value=REAL,
    revenue_forecast_unit=TEXT,
    market_cap_value=REAL,
    market_cap_unit=TEXT,
    call_date=WALL,
    timezone=TEXT,
)
COMPANIES = row(company_id=TEXT, name=TEXT, symbol=TEXT, country=TEXT, market_cap=AMOUNT, market_cap_unit=TEXT)
EARNING_PERIODS = row(period_id=TEXT, year=T.IntegerType(), quarter=T.IntegerType())
EARNINGS = row(
    earning_id=TEXT,
    company_id=TEXT,
    period_id=TEXT,
    eps_forecast=RATIO,
    eps_actual=RATIO,
    revenue_forecast=AMOUNT,
    revenue_forecast_unit=TEXT,
    revenue_actual=AMOUNT,
    revenue_actual_unit=TEXT,
    call_date=WALL,
    timezone=TEXT,
)
MEMBERS = row(response_id=TEXT, timestamp=T.TimestampType(), email_address=TEXT)
MEMBER_BODY = row(responseId=TEXT, timestamp=TEXT, email=TEXT)
LATEST_TEXT = row(path=TEXT, text=TEXT)


def theme_table(spark: SparkSession) -> DataFrame:
    """The fixed theme dimension; its position gives the precedence between themes."""
    rows = [(i, name, url) for i, (name, url) in enumerate(THEME_LISTINGS)]
    return spark.createDataFrame(rows, "precedence int, theme string, listing_url string")


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
