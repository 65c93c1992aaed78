"""Roll-up plans of the five history tables: what is computed, as data."""

from __future__ import annotations

from collections.abc import Collection
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import EPSILON, as_column, between_zero_one, floor_at, ratio
from riskloom.operators.rollup import (
    Latest, Recency, Rollup, Split, Stat, categories, categories_by_recency, child_means, roll_up, share_stats, stats,
)
from riskloom.plans import fixed_values as fv
from riskloom.session import DENSE, settle

ALL_SETS = frozenset(fv.FEATURE_SETS)


def _have(df: DataFrame, *columns: str) -> tuple[str, ...]:
    return tuple(c for c in columns if c in df.columns)


def debt_columns(bureau: DataFrame, sets: Collection[str] = ALL_SETS, epsilon: float = EPSILON) -> DataFrame:
    """Debt per credit, where both are known columns."""
    if "bureau_extended" not in sets or len(_have(bureau, "AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM")) < 2:
        return bureau
    return bureau.withColumn("DEBT_CREDIT_RATIO", ratio("AMT_CREDIT_SUM_DEBT", "AMT_CREDIT_SUM", epsilon))


def bureau_rollup(bureau: DataFrame, balance: DataFrame, sets: Collection[str] = ALL_SETS, epsilon: float = EPSILON) -> DataFrame:
    """Two levels: monthly status per loan, then loans per customer."""
    # written, so that the join below reads a plain table and adaptive execution can split a loan id held by many rows
    per_loan = settle(loan_status_rollup(balance), "loans", DENSE)
    raw, derive = bureau, partial(debt_columns, sets=sets, epsilon=epsilon)
    bureau = derive(raw)
    debt_share = _have(bureau, "DEBT_CREDIT_RATIO")
    money = ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT")
    split_stats = (
        Stat("mean", "DAYS_CREDIT"), *stats("sum", money), *stats("mean", debt_share),
    )
    splits = tuple(
        # the count name carries the label twice, as the published feature list does
        Split("CREDIT_ACTIVE", value, label, (Stat("rows", name=f"{label}_LOANS_COUNT"), *split_stats))
        for label, value in (("ACTIVE", "Active"), ("CLOSED", "Closed"))
    )
    plan = Rollup(
        key=fv.CUSTOMER,
        overall=(
            Stat("min", "DAYS_CREDIT"), Stat("max", "DAYS_CREDIT"), Stat("mean", "DAYS_CREDIT"), *stats("sum", money),
            Stat("matches", "CREDIT_ACTIVE", value="Active", name="ACTIVE_LOANS_COUNT"),
            Stat("share", "CREDIT_ACTIVE", value="Active", name="CREDIT_ACTIVE_prop_active"),
            *stats("mean", _have(
                bureau, "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT",
                "DEBT_CREDIT_RATIO",
            )),
            *stats("sum", _have(bureau, "AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE")),
        ),
        recency=Recency(
            "DAYS_CREDIT", fv.BUREAU_DAY_WINDOWS, "D",
            (Stat("rows", name="BUREAU_COUNT"), *stats("sum", money), *stats("mean", debt_share)),
        ) if "recency_windows" in sets else None,
        splits=splits if "bureau_extended" in sets else (),
        prefix=fv.ROLLUP_PREFIXES["bureau"],
    )
    own = roll_up(raw, plan, derive)
    children = child_means(raw, per_loan, fv.CUSTOMER, fv.LOAN)
    named = children.select(
        as_column(fv.CUSTOMER), *[as_column(c).alias(plan.prefix + c) for c in children.columns if c != fv.CUSTOMER]
    )
    return own.join(named, fv.CUSTOMER, "left")


def loan_status_rollup(balance: DataFrame) -> DataFrame:
    """Months and status shares per loan, overall and inside each window.

    Share columns exist for the statuses that occur in that window anywhere.
    """
    seen = categories_by_recency(balance, "STATUS", "MONTHS_BALANCE", fv.MONTH_WINDOWS)
    return roll_up(balance, Rollup(
        key=fv.LOAN,
        overall=(
            Stat("count", "MONTHS_BALANCE"), Stat("min", "MONTHS_BALANCE"), Stat("max", "MONTHS_BALANCE"),
            *share_stats("STATUS", seen[None]),
        ),
        recency=Recency(
            "MONTHS_BALANCE", fv.MONTH_WINDOWS, "M",
            shares={m: share_stats("STATUS", seen[m], f"STATUS_{m}M") for m in fv.MONTH_WINDOWS},
        ),
    ))


def interest_columns(previous: DataFrame, sets: Collection[str] = ALL_SETS, epsilon: float = EPSILON) -> DataFrame:
    """Gap between wish and credit, total to pay back, interest and credit per annuity."""
    credit, annuity = as_column("AMT_CREDIT"), as_column("AMT_ANNUITY")
    added = {"APP_CREDIT_GAP": as_column("AMT_APPLICATION") - credit}
    if "previous_interest" in sets:
        if len(_have(previous, "AMT_ANNUITY", "CNT_PAYMENT")) == 2:
            total = annuity * as_column("CNT_PAYMENT")
            added |= {"PREV_TOTAL_PAYMENT": total, "PREV_SIMPLE_INTEREST": total - credit}
        if "AMT_ANNUITY" in previous.columns:
            added["PREV_CREDIT_TO_ANNUITY"] = ratio("AMT_CREDIT", "AMT_ANNUITY", epsilon)
    return previous.withColumns(added)


def previous_rollup(previous: DataFrame, sets: Collection[str] = ALL_SETS, epsilon: float = EPSILON) -> DataFrame:
    raw, derive = previous, partial(interest_columns, sets=sets, epsilon=epsilon)
    previous = derive(raw)
    interest = _have(previous, "PREV_TOTAL_PAYMENT", "PREV_SIMPLE_INTEREST", "PREV_CREDIT_TO_ANNUITY")
    counted = Stat("count", fv.PREVIOUS)
    detail = (counted, Stat("mean", "AMT_CREDIT"), Stat("mean", "APP_CREDIT_GAP"), *stats("mean", interest))
    plan = Rollup(
        key=fv.CUSTOMER,
        overall=(
            counted, Stat("mean", "AMT_ANNUITY"), Stat("sum", "AMT_CREDIT"), Stat("sum", "APP_CREDIT_GAP"),
            Stat("mean", "APP_CREDIT_GAP"), Stat("min", "DAYS_DECISION"), Stat("mean", "DAYS_DECISION"),
            *share_stats("NAME_CONTRACT_STATUS", categories(previous, "NAME_CONTRACT_STATUS")),
            *stats("mean", interest),
        ),
        recency=Recency(
            "DAYS_DECISION", fv.DAY_WINDOWS, "D", (counted, Stat("mean", "APP_CREDIT_GAP"), *stats("mean", interest)),
        ) if "recency_windows" in sets else None,
        splits=tuple(
            Split("NAME_CONTRACT_STATUS", value, value.upper(), detail) for value in ("Approved", "Refused", "Canceled")
        ) if "previous_interest" in sets else (),
        latest=Latest(
            "DAYS_DECISION", fv.LAST_RECORDS, detail, ties=(fv.PREVIOUS, "AMT_CREDIT", "AMT_APPLICATION", *_have(previous, "AMT_ANNUITY", "CNT_PAYMENT")),
        ) if "last_n_aggregations" in sets else None,
        prefix=fv.ROLLUP_PREFIXES["prev"],
    )
    return roll_up(raw, plan, derive)


POS_FLOORS = {"SK_DPD": 0, "CNT_INSTALMENT": 0, "CNT_INSTALMENT_FUTURE": 0}


def floor_audit(df: DataFrame, floors: dict[str, float]) -> DataFrame:
    """How many values each floor would change."""
    return df.agg(*[F.count_if(as_column(c) < low).alias(c) for c, low in floors.items() if c in df.columns])


def apply_floors(df: DataFrame, floors: dict[str, float]) -> DataFrame:
    return df.withColumns({c: floor_at(c, low) for c, low in floors.items() if c in df.columns})


def pos_rollup(pos: DataFrame, sets: Collection[str] = ALL_SETS) -> DataFrame:
    if "pos_cash_cleanup" in sets:
        pos = apply_floors(pos, POS_FLOORS)
    extra = _have(pos, "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE")
    detail = (Stat("max", "SK_DPD"), Stat("mean", "SK_DPD"), *stats("mean", extra))
    return roll_up(pos, Rollup(
        key=fv.CUSTOMER,
        overall=(*detail, *stats("max", extra)),
        distinct=(fv.PREVIOUS,),
        recency=Recency("MONTHS_BALANCE", fv.MONTH_WINDOWS, "M", detail, trends=("SK_DPD",))
        if "recency_windows" in sets else None,
        latest=Latest("MONTHS_BALANCE", fv.LAST_RECORDS, detail, ties=(fv.PREVIOUS, "SK_DPD", *extra))
        if "last_n_aggregations" in sets else None,
        prefix=fv.ROLLUP_PREFIXES["pos"],
    ))


def installment_columns(payments: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """Paid share, amount still open, days late and days early of each instalment."""
    paid, due = as_column("AMT_PAYMENT").cast("double"), as_column("AMT_INSTALMENT").cast("double")
    late = as_column("DAYS_ENTRY_PAYMENT").cast("double") - as_column("DAYS_INSTALMENT").cast("double")
    return payments.withColumns({
        "PAYMENT_PERC": ratio("AMT_PAYMENT", "AMT_INSTALMENT", epsilon),
        "PAYMENT_DIFF": due - paid,
        "DPD": floor_at(late, 0.0),
        "DBD": floor_at(-late, 0.0),
    })


def installment_rollup(payments: DataFrame, sets: Collection[str] = ALL_SETS, epsilon: float = EPSILON) -> DataFrame:
    raw, derive = payments, partial(installment_columns, epsilon=epsilon)
    payments = derive(raw)
    detail = stats("mean", ("DPD", "DBD", "PAYMENT_PERC", "PAYMENT_DIFF"))
    return roll_up(raw, Rollup(
        key=fv.CUSTOMER,
        overall=(
            Stat("max", "DPD"), Stat("max", "DBD"), *detail, Stat("sum", "PAYMENT_DIFF"),
            Stat("sum", "AMT_INSTALMENT"), Stat("sum", "AMT_PAYMENT"),
        ),
        distinct=("NUM_INSTALMENT_VERSION",),
        recency=Recency("DAYS_INSTALMENT", fv.DAY_WINDOWS, "D", detail, trends=("DPD", "PAYMENT_PERC"))
        if "recency_windows" in sets else None,
        latest=Latest(
            "DAYS_INSTALMENT", fv.LAST_RECORDS, detail,
            ties=_have(payments, fv.PREVIOUS, "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT"),
        ) if "last_n_aggregations" in sets else None,
        prefix=fv.ROLLUP_PREFIXES["inst"],
    ), derive)


def card_columns(card: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    return card.withColumn("UTILIZATION", between_zero_one(ratio("AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", epsilon)))


def card_rollup(card: DataFrame, sets: Collection[str] = ALL_SETS, epsilon: float = EPSILON) -> DataFrame:
    raw, derive = card, partial(card_columns, epsilon=epsilon)
    card = derive(raw)
    extra = _have(card, "AMT_TOTAL_RECEIVABLE", "AMT_RECEIVABLE_PRINCIPAL", "CNT_DRAWINGS_CURRENT")
    detail = (
        Stat("sum", "AMT_DRAWINGS_CURRENT"), Stat("mean", "UTILIZATION"), Stat("max", "SK_DPD"), *stats("mean", extra),
    )
    return roll_up(raw, Rollup(
        key=fv.CUSTOMER,
        overall=(Stat("mean", "AMT_BALANCE"), *detail[:2], Stat("max", "UTILIZATION"), *detail[2:], *stats("sum", extra)),
        recency=Recency("MONTHS_BALANCE", fv.MONTH_WINDOWS, "M", detail, trends=("UTILIZATION",))
        if "recency_windows" in sets else None,
        latest=Latest(
            "MONTHS_BALANCE", fv.LAST_RECORDS, detail,
            ties=_have(card, fv.PREVIOUS, "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT", "SK_DPD", *extra),
        ) if "last_n_aggregations" in sets else None,
        prefix=fv.ROLLUP_PREFIXES["cc"],
    ), derive)


def all_rollups(tables: dict[str, DataFrame], sets: Collection[str] = ALL_SETS, epsilon: float = EPSILON) -> dict[str, DataFrame]:
    return {
        "bureau": bureau_rollup(tables["bureau"], tables["bureau_balance"], sets, epsilon),
        "prev": previous_rollup(tables["previous_application"], sets, epsilon),
        "pos": pos_rollup(tables["pos_cash_balance"], sets),
        "inst": installment_rollup(tables["installments_payments"], sets, epsilon),
        "cc": card_rollup(tables["credit_card_balance"], sets, epsilon),
    }
