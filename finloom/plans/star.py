"""Earning records -> companies, periods and earnings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finloom.functions.dates import from_epoch_ms
from finloom.functions.keys import surrogate_key
from finloom.operators.merge import change_flags, extend_dimension, last_per_key, merge_changes, resolve_key
from finloom.schemas import EARNINGS
from finloom.session import materialize

COMPANY_KEYS = ("name", "symbol")
PERIOD_KEYS = ("year", "quarter")
EARNING_KEYS = ("company_id", "period_id")
EARNING_FIELDS = tuple(f for f in EARNINGS.fieldNames() if not f.endswith("_id"))


def _measured(records: DataFrame, missing_as_zero: bool) -> DataFrame:
    """Records (plus order columns) as flat star inputs."""

    def amount(path: str, kind: str):
        value = F.col(path).try_cast(kind)
        return F.coalesce(value, F.lit(0).cast(kind)) if missing_as_zero else value

    inputs = {
        "name": F.col("company.name"),
        "symbol": F.col("company.symbol"),
        "market_cap": amount("market_cap.value", "decimal(20,2)"),
        "market_cap_unit": F.col("market_cap.unit"),
        "call_date": from_epoch_ms(F.col("call_date")),
    }
    for name, kind in (("eps", "decimal(10,4)"), ("revenue", "decimal(20,2)")):
        for side in ("forecast", "actual"):
            inputs[f"{name}_{side}"] = amount(f"{name}.{side}.value", kind)
            if name == "revenue":
                inputs[f"{name}_{side}_unit"] = F.col(f"{name}.{side}.unit")
    kept = [c for c in records.columns if c not in ("company", "eps", "revenue", *inputs)]
    return records.select(*kept, *[c.alias(n) for n, c in inputs.items()])


def load_star(
    records: DataFrame,
    companies: DataFrame,
    periods: DataFrame,
    earnings: DataFrame,
    order: tuple[str, ...],
    missing_as_zero: bool = False,
    foreign_ids: bool = False,
    dimensions_only: bool = False,
) -> dict[str, DataFrame]:
    """The three tables after the batch, and the batch's earnings with their change flag.

    `order` names record columns giving the load order: the first record makes a company or
    period, the last one of a company and period makes the earning. Existing companies and
    periods are never changed.

    Ids made here are a function of the name and symbol, or year and quarter, so a record
    knows its ids without a join. With `foreign_ids` the dimensions may hold ids from
    elsewhere, and records look them up. With `dimensions_only` the earnings are left out,
    and nothing is stored.
    """
    flat = _measured(records, missing_as_zero)
    companies = extend_dimension(companies, flat, "company_id", COMPANY_KEYS, order)
    periods = extend_dimension(periods, flat, "period_id", PERIOD_KEYS, order)
    if dimensions_only:
        return {"companies": companies, "periods": periods}
    if foreign_ids:
        keyed = resolve_key(flat, companies, "company_id", COMPANY_KEYS)
        keyed = resolve_key(keyed, periods, "period_id", PERIOD_KEYS, sketch=flat)
    else:
        ids = {"company_id": COMPANY_KEYS, "period_id": PERIOD_KEYS}
        keyed = flat.withColumns({name: surrogate_key(*map(F.col, keys)) for name, keys in ids.items()})
    latest = last_per_key(
        keyed.select(*EARNING_KEYS, *EARNING_FIELDS, *[c for c in order if c not in EARNING_FIELDS]),
        EARNING_KEYS,
        order,
    ).withColumn("earning_id", surrogate_key(*[F.col(k) for k in EARNING_KEYS]))
    # The batch is read several times from here on; stored, its keys are resolved once.
    batch = materialize(latest.select(*EARNINGS.fieldNames()), "earnings")
    return {
        "companies": companies,
        "periods": periods,
        "earnings": merge_changes(earnings, batch, EARNING_KEYS, EARNING_FIELDS),
        "changes": change_flags(earnings, batch, EARNING_KEYS, EARNING_FIELDS),
    }
