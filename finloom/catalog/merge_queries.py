"""Keyed merges on the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.catalog.registry import Tables, query
from finloom.functions.keys import surrogate_key
from finloom.operators import merge
from finloom.operators.lookup import lookup_join
from finloom.operators.project import nest_earnings
from finloom.plans.star import load_star
from finloom.schemas import COMPANIES, EARNING_PERIODS, EARNINGS, empty_table
from finloom.session import materialize


def key_sql(*parts: str) -> str:
    coded = [f"coalesce(length({p}::VARCHAR)::VARCHAR || ':' || {p}::VARCHAR, '-')" for p in parts]
    return "md5(" + " || '|' || ".join(coded) + ")"


@query(
    "insert_if_absent",
    """SELECT DISTINCT text, lang, source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM documents e WHERE e.lang = 'en' AND e.text = d.text)""",
)
def insert_if_absent(t: Tables):
    # The text is the key; its SHA-256 stands for it in the join, which then moves 64 bytes a row.
    staged = t.documents.select("text", "lang", "source", F.sha2("text", 256).alias("key"))
    return merge.insert_if_absent(staged.where("lang = 'en'"), staged, ["key"]).drop("key")


@query(
    "not_in_nulls",
    """WITH keys AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k FROM orders),
known AS (SELECT k FROM keys WHERE k IS NOT NULL),
staged AS (SELECT c_custkey AS k FROM customer UNION ALL SELECT NULL FROM nation)
SELECT 'not exists' AS rule, s.k FROM (SELECT DISTINCT k FROM staged) s WHERE NOT EXISTS (SELECT 1 FROM keys WHERE keys.k = s.k)
UNION ALL SELECT 'not in, target with null', k FROM (SELECT DISTINCT k FROM staged) WHERE k NOT IN (SELECT k FROM keys)
UNION ALL SELECT 'not in, target without null', k FROM (SELECT DISTINCT k FROM staged) WHERE k NOT IN (SELECT k FROM known)
UNION ALL SELECT 'not in, empty target', k FROM (SELECT DISTINCT k FROM staged) WHERE k NOT IN (SELECT k FROM known WHERE false)""",
)
def not_in_nulls(t: Tables):
    keys = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"))
    known = keys.where("k IS NOT NULL")
    staged = t.customer.select(F.col("c_custkey").alias("k")).union(t.nation.select(F.lit(None).cast("bigint")))
    cases = [
        ("not exists", keys, False),
        ("not in, target with null", keys, True),
        ("not in, target without null", known, True),
        ("not in, empty target", known.where("false"), True),
    ]
    parts = [
        merge.insert_if_absent(target, staged, ["k"], rule).select(F.lit(name).alias("rule"), "k")
        for name, target, rule in cases
    ]
    return reduce(DataFrame.unionAll, parts)


@query(
    "replace_by_keys",
    """WITH staged AS (SELECT * REPLACE (l_tax + 0.01 AS l_tax) FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01')
SELECT l.* FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.l_orderkey = l.l_orderkey AND s.l_linenumber = l.l_linenumber)
UNION ALL SELECT * FROM staged""",
)
def replace_by_keys(t: Tables):
    staged = t.lineitem.where("l_shipdate >= TIMESTAMP_NTZ '2000-01-01'").withColumn("l_tax", F.col("l_tax") + 0.01)
    return merge.replace_by_keys(t.lineitem, staged, ["l_orderkey", "l_linenumber"])


@query(
    "replace_by_null_keys",
    """WITH target AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS k, o_orderpriority AS p FROM orders),
staged AS (SELECT * FROM target WHERE p = '1-URGENT')
SELECT 'equal' AS rule, * FROM target t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.k = t.k AND s.p = t.p)
UNION ALL SELECT 'equal', * FROM staged
UNION ALL SELECT 'null safe', * FROM target t WHERE NOT EXISTS (SELECT 1 FROM staged s WHERE s.k IS NOT DISTINCT FROM t.k AND s.p = t.p)
UNION ALL SELECT 'null safe', * FROM staged""",
)
def replace_by_null_keys(t: Tables):
    target = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("k"),
        F.col("o_orderpriority").alias("p"),
    )
    staged = target.where("p = '1-URGENT'")
    parts = [
        merge.replace_by_keys(target, staged, ["k", "p"], safe).withColumn("rule", F.lit(name))
        for name, safe in (("equal", False), ("null safe", True))
    ]
    return parts[0].unionByName(parts[1])


def _event_batches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Events before and from 2024-01-16; the later batch has no value for errors."""
    columns = ["user_id", "event_type", "ts", "event_id", "value"]
    early = t.events.where("ts < TIMESTAMP_NTZ '2024-01-16'").select(*columns)
    late = t.events.where("ts >= TIMESTAMP_NTZ '2024-01-16'").select(*columns)
    return early, late.withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))


_BATCHES_SQL = """early AS (SELECT user_id, event_type, ts, event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-16'),
late AS (SELECT user_id, event_type, ts, event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events WHERE ts >= TIMESTAMP '2024-01-16'),
latest AS (SELECT * FROM late QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)"""


@query(
    "update_join",
    f"""WITH {_BATCHES_SQL}
SELECT e.user_id, e.event_type, CASE WHEN l.user_id IS NULL THEN e.ts ELSE l.ts END AS ts,
  CASE WHEN l.user_id IS NULL THEN e.event_id ELSE l.event_id END AS event_id,
  CASE WHEN l.user_id IS NULL THEN e.value ELSE l.value END AS value
FROM early e LEFT JOIN latest l ON e.user_id = l.user_id AND e.event_type = l.event_type""",
)
def update_join(t: Tables):
    early, late = _event_batches(t)
    keys = ["user_id", "event_type"]
    return merge.update_matched(early, merge.last_per_key(late, keys, ["ts", "event_id"]), keys)


@query(
    "upsert_latest",
    f"""WITH {_BATCHES_SQL}, small AS (SELECT * FROM early WHERE event_type IN ('view', 'error')),
more AS (SELECT * FROM (SELECT * FROM late UNION ALL SELECT * FROM early WHERE event_type NOT IN ('view', 'error'))
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1)
SELECT e.user_id, e.event_type, CASE WHEN l.user_id IS NULL THEN e.ts ELSE l.ts END AS ts,
  CASE WHEN l.user_id IS NULL THEN e.event_id ELSE l.event_id END AS event_id,
  CASE WHEN l.user_id IS NULL THEN e.value ELSE l.value END AS value
FROM small e LEFT JOIN more l ON e.user_id = l.user_id AND e.event_type = l.event_type
UNION ALL SELECT * FROM more l WHERE NOT EXISTS (SELECT 1 FROM small e WHERE e.user_id = l.user_id AND e.event_type = l.event_type)""",
)
def upsert_latest(t: Tables):
    early, late = _event_batches(t)
    stored = "event_type IN ('view', 'error')"
    staged = late.unionByName(early.where(f"NOT ({stored})"))
    return merge.upsert_latest(early.where(stored), staged, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "dim_upsert_first_wins",
    f"""WITH loaded AS (SELECT p_brand, p_type, p_partkey, p_name FROM part WHERE p_size <= 10
  QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey DESC) = 1),
dim AS (SELECT {key_sql("p_brand", "p_type")} AS part_id, * FROM loaded),
first AS (SELECT p_brand, p_type, p_partkey, p_name FROM part
  QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey) = 1)
SELECT * FROM dim UNION ALL SELECT {key_sql("p_brand", "p_type")}, * FROM first f
WHERE NOT EXISTS (SELECT 1 FROM dim d WHERE d.p_brand = f.p_brand AND d.p_type = f.p_type)""",
)
def dim_upsert_first_wins(t: Tables):
    keys = ["p_brand", "p_type"]
    parts = t.part.select(*keys, "p_partkey", "p_name")
    small = t.part.where("p_size <= 10").select(*keys, "p_partkey", "p_name")
    loaded = merge.last_per_key(small, keys, ["p_partkey"])
    dimension = loaded.select(surrogate_key(F.col("p_brand"), F.col("p_type")).alias("part_id"), "*")
    return merge.extend_dimension(dimension, parts, "part_id", keys, ["p_partkey"])


_KINDS = ["brand", "size"]


@query(
    "fact_key_resolve",
    f"""WITH p AS (SELECT p_partkey, CASE WHEN p_type <> 'SMALL' THEN p_brand END AS brand, p_size AS size FROM part),
dim AS (SELECT DISTINCT {key_sql("brand", "size")} AS kind_id, brand, size FROM p)
SELECT l.l_orderkey, l.l_linenumber, l.l_extendedprice, p.brand, p.size, dim.kind_id
FROM lineitem l JOIN p ON l_partkey = p_partkey
JOIN dim ON dim.brand IS NOT DISTINCT FROM p.brand AND dim.size = p.size""",
)
def fact_key_resolve(t: Tables):
    parts = t.part.select(
        F.col("p_partkey").alias("l_partkey"),
        F.when(F.col("p_type") != "SMALL", F.col("p_brand")).alias("brand"),
        F.col("p_size").alias("size"),
    )
    dimension = parts.select(surrogate_key(F.col("brand"), F.col("size")).alias("kind_id"), *_KINDS).distinct()
    # The parts get their key first, so that the lines are joined once.
    keyed = merge.resolve_key(parts, dimension, "kind_id", _KINDS)
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return lookup_join(lines, keyed, ["l_partkey"]).drop("l_partkey")


_ORDER_BATCHES_SQL = """old AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
new AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
flags AS (SELECT n.*, CASE WHEN o.o_orderkey IS NULL THEN 'insert'
    WHEN o.o_orderstatus IS NOT DISTINCT FROM n.o_orderstatus AND o.o_totalprice IS NOT DISTINCT FROM n.o_totalprice THEN 'same' ELSE 'update' END AS change
  FROM new n LEFT JOIN old o ON o.o_orderkey = n.o_orderkey)"""


def _order_batches(t: Tables) -> tuple[DataFrame, DataFrame]:
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    old = t.orders.where("o_orderdate < TIMESTAMP_NTZ '2000-01-01'").select(*columns)
    new = t.orders.where("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").select(*columns)
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return old, new.withColumns(
        {
            "o_orderstatus": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderstatus")),
            "o_totalprice": F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        }
    )


@query("fact_change_flags", f"WITH {_ORDER_BATCHES_SQL} SELECT * FROM flags")
def fact_change_flags(t: Tables):
    old, new = _order_batches(t)
    return merge.change_flags(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])


@query(
    "fact_change_merge",
    f"""WITH {_ORDER_BATCHES_SQL}, changed AS (SELECT * EXCLUDE (change) FROM flags WHERE change <> 'same')
SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM changed) UNION ALL SELECT * FROM changed""",
)
def fact_change_merge(t: Tables):
    old, new = _order_batches(t)
    flagged = merge.change_flags(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
    return merge.apply_changes(old, flagged, ["o_orderkey"])


@query("dedupe_batch", "SELECT DISTINCT text, lang FROM documents")
def dedupe_batch(t: Tables):
    return t.documents.select("text", "lang").dropDuplicates()


@query(
    "latest_per_partition",
    """SELECT user_id, event_id, ts, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_per_partition(t: Tables):
    rows = t.events.select("user_id", "event_id", "ts", "value")
    return merge.last_per_key(rows, ["user_id"], ["ts", "event_id"])


_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@query("load_count", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in _TABLES))
def load_count(t: Tables):
    counts = [getattr(t, n).agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in _TABLES]
    return reduce(DataFrame.unionAll, counts)


def order_records(t: Tables) -> DataFrame:
    """Nested earning records out of orders: the customer is the company, the order day the call."""
    price, whole = F.col("o_totalprice"), F.floor("o_totalprice")
    flat = t.orders.select(
        F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("company_name"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("S"), F.col("o_custkey").cast("string"))).alias("symbol"),
        F.col("o_orderstatus").alias("country"),
        (whole / 1000).alias("eps_actual_value"),
        F.lit(None).cast("string").alias("eps_actual_unit"),
        F.when(F.col("o_orderstatus") != "P", F.lit(1.5)).alias("eps_forecast_value"),
        F.lit(None).cast("string").alias("eps_forecast_unit"),
        price.alias("revenue_actual_value"),
        F.lit("M").alias("revenue_actual_unit"),
        F.when(F.col("o_orderpriority") != "2-HIGH", whole.cast("double")).alias("revenue_forecast_value"),
        F.lit("M").alias("revenue_forecast_unit"),
        F.col("o_orderkey").cast("double").alias("market_cap_value"),
        F.lit("B").alias("market_cap_unit"),
        F.year("o_orderdate").alias("year"),
        F.quarter("o_orderdate").alias("quarter"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("call_date"),
        F.lit("America/New_York").alias("timezone"),
        "o_orderkey",
    )
    return nest_earnings(flat, keep=["o_orderkey"])


_STAR_SQL = f"""rec AS (SELECT 'Company ' || o_custkey AS name, CASE WHEN o_orderpriority <> '5-LOW' THEN 'S' || o_custkey END AS symbol,
  o_orderstatus AS country, CAST(o_orderkey AS DECIMAL(20,2)) AS market_cap, 'B' AS market_cap_unit,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(1.5 AS DECIMAL(10,4)) END AS eps_forecast,
  CAST(floor(o_totalprice) / 1000 AS DECIMAL(10,4)) AS eps_actual,
  CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(floor(o_totalprice) AS DECIMAL(20,2)) END AS revenue_forecast, 'M' AS revenue_forecast_unit,
  CAST(o_totalprice AS DECIMAL(20,2)) AS revenue_actual, 'M' AS revenue_actual_unit, o_orderdate AS call_date,
  'America/New_York' AS timezone, o_orderkey FROM orders),
ids AS (SELECT *, {key_sql("name", "symbol")} AS company_id, {key_sql("year", "quarter")} AS period_id FROM rec),
one AS (SELECT * FROM ids WHERE call_date >= TIMESTAMP '1998-01-01'),
two AS (SELECT * FROM ids WHERE call_date < TIMESTAMP '2000-01-01' AND (country <> 'F' OR call_date < TIMESTAMP '1998-01-01')),
last_one AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY company_id, period_id ORDER BY call_date DESC, o_orderkey DESC) = 1),
last_two AS (SELECT * FROM two QUALIFY row_number() OVER (PARTITION BY company_id, period_id ORDER BY call_date DESC, o_orderkey DESC) = 1)"""
_EARNING_FIELDS = (
    "eps_forecast, eps_actual, revenue_forecast, revenue_forecast_unit, revenue_actual, revenue_actual_unit, call_date, timezone"
)
_EARNING_SQL = f"{key_sql('company_id', 'period_id')} AS earning_id, company_id, period_id, {_EARNING_FIELDS}"


def _star(t: Tables, dimensions_only: bool = False) -> dict[str, DataFrame]:
    """The star after the orders from 1998 on, and after a late batch of those before 2000.

    The late batch has all orders before 1998, and again those until 2000 that are not F."""
    records, order = order_records(t), ("call_date", "o_orderkey")
    empty = [empty_table(t.spark, schema) for schema in (COMPANIES, EARNING_PERIODS, EARNINGS)]
    names = ("companies", "periods") if dimensions_only else ("companies", "periods", "earnings")
    one = load_star(records.where("call_date >= 883612800000"), *empty, order, dimensions_only=dimensions_only)
    tables = [materialize(one[name], name) for name in names] + empty[len(names) :]
    late = records.where("call_date < 946684800000 AND (country <> 'F' OR call_date < 883612800000)")
    return load_star(late, *tables, order, dimensions_only=dimensions_only)


@query(
    "star_companies",
    f"""WITH {_STAR_SQL}, f1 AS (SELECT * FROM one QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY call_date, o_orderkey) = 1),
f2 AS (SELECT * FROM two QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY call_date, o_orderkey) = 1),
f AS (SELECT * FROM f1 UNION ALL SELECT * FROM f2 WHERE company_id NOT IN (SELECT company_id FROM f1))
SELECT company_id, name, symbol, country, market_cap, market_cap_unit FROM f""",
)
def star_companies(t: Tables):
    return _star(t, dimensions_only=True)["companies"]


@query(
    "star_periods",
    f"""WITH {_STAR_SQL} SELECT period_id, year, quarter FROM one UNION SELECT period_id, year, quarter FROM two""",
)
def star_periods(t: Tables):
    return _star(t, dimensions_only=True)["periods"]


@query(
    "star_earnings",
    f"""WITH {_STAR_SQL}, f AS (SELECT * FROM last_two UNION ALL
  SELECT * FROM last_one o WHERE NOT EXISTS (SELECT 1 FROM last_two n WHERE n.company_id = o.company_id AND n.period_id = o.period_id))
SELECT {_EARNING_SQL} FROM f""",
)
def star_earnings(t: Tables):
    return _star(t)["earnings"]


@query(
    "star_changes",
    f"""WITH {_STAR_SQL} SELECT CASE WHEN o.company_id IS NULL THEN 'insert'
  WHEN n.eps_forecast IS NOT DISTINCT FROM o.eps_forecast AND n.eps_actual = o.eps_actual
    AND n.revenue_forecast IS NOT DISTINCT FROM o.revenue_forecast AND n.revenue_actual = o.revenue_actual
    AND n.call_date = o.call_date THEN 'same' ELSE 'update' END AS change, count(*) AS n
FROM last_two n LEFT JOIN last_one o ON o.company_id = n.company_id AND o.period_id = n.period_id GROUP BY 1""",
)
def star_changes(t: Tables):
    return _star(t)["changes"].groupBy("change").agg(F.count("*").alias("n"))
