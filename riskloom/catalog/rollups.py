"""Roll-up queries: A09-A18, W01, J01-J03, P17-P21. The SQL side joins one aggregate per window."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog import mapping as m
from riskloom.catalog.registry import CATALOG, query, r, rounded_table, table
from riskloom.operators.rollup import (
    Latest, Recency, Rollup, Split, Stat, categories, categories_by_recency, child_means, roll_up, share_stats, stats,
)
from riskloom.plans import fixed_values as fv
from riskloom.plans import histories as h
from riskloom.plans.build import merge_rollups


def agg_sql(stat: Stat) -> str:
    c = f'"{stat.column}"'
    return {
        "rows": "count(*)", "count": f"count({c})", "sum": f"coalesce(sum({c}), 0)", "mean": f"avg({c})",
        "max": f"max({c})", "min": f"min({c})",
        "matches": f"count(*) FILTER (WHERE {c} = '{stat.value}')",
        "share": f"avg(CASE WHEN {c} = '{stat.value}' THEN 1.0 WHEN {c} IS NOT NULL THEN 0.0 END)",
    }[stat.kind]


def _typed(stat: Stat, name: str) -> str:
    if stat.kind in ("rows", "count", "matches"):
        return f'CAST("{name}" AS BIGINT)'
    return r(f'"{name}"')


def rollup_sql(source: str, key: str, overall, spans=None, splits=(), latest=None, distinct=(), prefix="",
               shares=None, trends=(), order=None, unit="", span_stats=(), raw=False) -> str:
    """One grouped query per window, split and last-N block, left-joined to the overall one."""
    parts, joins, out = [], [], []

    def block(name, where, found, label, src=source):
        cols = ", ".join([f'{agg_sql(s)} AS "{label(s)}"' for s in found])
        parts.append(f'{name} AS (SELECT "{key}", {cols} FROM {src} WHERE {where} GROUP BY "{key}")')
        for s in found:
            out.append((label(s), _typed(s, label(s))))
        if name != "b0":
            joins.append(f'LEFT JOIN {name} ON {name}."{key}" = b0."{key}"')

    block("b0", "TRUE", list(overall), lambda s: s.label)
    for i, c in enumerate(distinct):
        name = f"d{i}"
        parts.append(
            f'{name} AS (SELECT "{key}", count(DISTINCT "{c}") + max(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END) AS "{c}_nunique" FROM {source} GROUP BY "{key}")'
        )
        joins.append(f'LEFT JOIN {name} ON {name}."{key}" = b0."{key}"')
        out.append((f"{c}_nunique", f'CAST("{c}_nunique" AS BIGINT)'))
    for span in spans or ():
        tail = f"{span}{unit}"
        if span_stats:
            block(f"w{span}", f'"{order}" >= -{span}', list(span_stats), lambda s, t=tail: f"{s.label}_{t}")
        if shares and shares.get(span):
            block(f"s{span}", f'"{order}" >= -{span}', list(shares[span]), lambda s: s.label)
        for t in trends:
            out.append((f"{t}_mean_trend_{tail}", r(f'"{t}_mean_{tail}" - "{t}_mean"')))
    for i, sp in enumerate(splits):
        block(f"x{i}", f"\"{sp.column}\" = '{sp.value}'", list(sp.stats), lambda s, sp=sp: f"{sp.label}_{s.label}")
    if latest:
        ties = "".join(f', "{t}" ASC NULLS FIRST' for t in latest.ties)
        parts.append(
            f'ranked AS (SELECT *, count("{latest.order}") OVER (PARTITION BY "{key}" ORDER BY "{latest.order}" DESC NULLS FIRST{ties} '
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __rank FROM {source})"
        )
        for n in latest.sizes:
            block(f"l{n}", f"__rank <= {n}", list(latest.stats), lambda s, n=n: f"LAST_{n}_{s.label}", src="ranked")
    cols = ", ".join(f'{expr if not raw else chr(34) + name + chr(34)} AS "{prefix}{name}"' for name, expr in out)
    return f'{", ".join(parts)} SELECT b0."{key}", {cols} FROM b0 {" ".join(joins)}'


def plan_sql(ctes: str, source: str, plan: Rollup) -> str:
    rec = plan.recency
    return f"WITH {ctes}, " + rollup_sql(
        source, plan.key, plan.overall, rec.spans if rec else None, plan.splits, plan.latest, plan.distinct, plan.prefix,
        rec.shares if rec else None, rec.trends if rec else (), rec.order if rec else None, rec.unit if rec else "", rec.stats if rec else (),
    )


# --- A10, A11, A12, W01, P17, P18, P19, P21: one mechanism each ----------------------------------------------------

WINDOWS = Rollup(
    "SK_ID_CURR", (Stat("count", "SK_ID_PREV"), Stat("sum", "AMT_CREDIT"), Stat("mean", "AMT_CREDIT")),
    recency=Recency("DAYS_DECISION", fv.DAY_WINDOWS, "D", (
        Stat("rows", name="ROWS"), Stat("count", "AMT_CREDIT"), Stat("sum", "AMT_CREDIT"), Stat("mean", "AMT_CREDIT"),
        Stat("max", "AMT_CREDIT"), Stat("min", "AMT_CREDIT"),
    )),
)
SPLITS = Rollup("SK_ID_CURR", (Stat("rows", name="ROWS"),), splits=tuple(
    Split("NAME_CONTRACT_STATUS", v, v.upper(), (Stat("count", "SK_ID_PREV"), Stat("mean", "AMT_CREDIT"), Stat("sum", "AMT_ANNUITY")))
    for v in ("Approved", "Refused", "Canceled")
))
LATEST = Rollup("SK_ID_CURR", (Stat("rows", name="ROWS"),), latest=Latest(
    "DAYS_DECISION", fv.LAST_RECORDS, (Stat("count", "SK_ID_PREV"), Stat("mean", "AMT_CREDIT"), Stat("max", "AMT_APPLICATION")), ("SK_ID_PREV",),
))
TREND = Rollup("SK_ID_CURR", (Stat("mean", "SK_DPD"),), recency=Recency("MONTHS_BALANCE", fv.MONTH_WINDOWS, "M", (Stat("mean", "SK_DPD"),), ("SK_DPD",)))


@query("a10_windowed_rollup", plan_sql(m.PREVIOUS_SQL, "previous_application", WINDOWS))
def windowed(spark, folder):
    return rounded_table(roll_up(m.previous_application(spark, folder), WINDOWS))


@query("a11_split_rollup", plan_sql(m.PREVIOUS_SQL, "previous_application", SPLITS))
def split(spark, folder):
    return rounded_table(roll_up(m.previous_application(spark, folder), SPLITS))


@query("a12_last_n_rollup", plan_sql(m.PREVIOUS_SQL, "previous_application", LATEST))
def last_n(spark, folder):
    return rounded_table(roll_up(m.previous_application(spark, folder), LATEST))


@query("p19_trend", plan_sql(m.POS_SQL, "pos_cash", TREND))
def trend(spark, folder):
    return rounded_table(roll_up(m.pos_cash(spark, folder), TREND))


@query("w01_last_n_filter", f"""WITH {m.PREVIOUS_SQL}, ranked AS (
 SELECT SK_ID_CURR, SK_ID_PREV, DAYS_DECISION, count(DAYS_DECISION) OVER (PARTITION BY SK_ID_CURR ORDER BY DAYS_DECISION DESC NULLS FIRST, SK_ID_PREV
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS c FROM previous_application)
 SELECT SK_ID_CURR, SK_ID_PREV, DAYS_DECISION FROM ranked WHERE c <= 3""")
def last_n_rows(spark, folder):
    """The rows themselves: undated ones always, of the dated ones the newest three."""
    from riskloom.operators.rollup import latest_rows

    df = m.previous_application(spark, folder).select("SK_ID_CURR", "SK_ID_PREV", "DAYS_DECISION")
    return latest_rows(df, "SK_ID_CURR", "DAYS_DECISION", 3, ("SK_ID_PREV",))


# --- A09, A13, A14 ------------------------------------------------------------------------------------------------

PREV_CATEGORIES = ("Approved", "Canceled", "Refused", "Unused offer")
STATUSES = ("A", "N", "R")


@query("a09_category_shares", plan_sql(m.PREVIOUS_SQL, "previous_application", Rollup(
    "SK_ID_CURR", (Stat("rows", name="ROWS"), *share_stats("NAME_CONTRACT_STATUS", PREV_CATEGORIES)))))
def shares(spark, folder):
    df = m.previous_application(spark, folder)
    found = categories(df, "NAME_CONTRACT_STATUS")
    return rounded_table(roll_up(df, Rollup("SK_ID_CURR", (Stat("rows", name="ROWS"), *share_stats("NAME_CONTRACT_STATUS", found)))))


LOAN_PLAN = Rollup(
    "SK_ID_BUREAU",
    (Stat("count", "MONTHS_BALANCE"), Stat("min", "MONTHS_BALANCE"), Stat("max", "MONTHS_BALANCE"), *share_stats("STATUS", STATUSES)),
    recency=Recency("MONTHS_BALANCE", fv.MONTH_WINDOWS, "M", shares={w: share_stats("STATUS", STATUSES, f"STATUS_{w}M") for w in fv.MONTH_WINDOWS}),
)


@query("a13_child_rollup", plan_sql(m.BUREAU_BALANCE_SQL, "bureau_balance", LOAN_PLAN))
def child(spark, folder):
    return rounded_table(h.loan_status_rollup(m.bureau_balance(spark, folder)))


def _bureau_plan() -> Rollup:
    money = ("AMT_CREDIT_SUM", "AMT_CREDIT_SUM_DEBT")
    split_stats = (Stat("mean", "DAYS_CREDIT"), *stats("sum", money), Stat("mean", "DEBT_CREDIT_RATIO"))
    return Rollup(
        "SK_ID_CURR",
        (
            Stat("min", "DAYS_CREDIT"), Stat("max", "DAYS_CREDIT"), Stat("mean", "DAYS_CREDIT"), *stats("sum", money),
            Stat("matches", "CREDIT_ACTIVE", "Active", "ACTIVE_LOANS_COUNT"), Stat("share", "CREDIT_ACTIVE", "Active", "CREDIT_ACTIVE_prop_active"),
            *stats("mean", ("AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE", "DAYS_CREDIT_ENDDATE", "DAYS_ENDDATE_FACT", "DEBT_CREDIT_RATIO")),
            *stats("sum", ("AMT_CREDIT_SUM_LIMIT", "AMT_CREDIT_SUM_OVERDUE")),
            *[Stat("mean", c) for c in LOAN_COLUMNS],
        ),
        Recency("DAYS_CREDIT", fv.BUREAU_DAY_WINDOWS, "D", (Stat("rows", name="BUREAU_COUNT"), *stats("sum", money), Stat("mean", "DEBT_CREDIT_RATIO"))),
        tuple(Split("CREDIT_ACTIVE", v, l, (Stat("rows", name=f"{l}_LOANS_COUNT"), *split_stats)) for l, v in (("ACTIVE", "Active"), ("CLOSED", "Closed"))),
        prefix="bureau_",
    )


LOAN_COLUMNS = ["MONTHS_BALANCE_count", "MONTHS_BALANCE_min", "MONTHS_BALANCE_max"] + [f"STATUS_{c}_prop" for c in STATUSES] + [
    f"STATUS_{w}M_{c}_prop" for w in fv.MONTH_WINDOWS for c in STATUSES
]
_LOANS = rollup_sql("bureau_balance", "SK_ID_BUREAU", LOAN_PLAN.overall, fv.MONTH_WINDOWS, shares=LOAN_PLAN.recency.shares, order="MONTHS_BALANCE", raw=True)
BUREAU_CTES = f"""{m.BUREAU_SQL}, {m.BUREAU_BALANCE_SQL}, loans AS (WITH {_LOANS}), full_bureau AS (
 SELECT bureau.*, loans.* EXCLUDE (SK_ID_BUREAU), AMT_CREDIT_SUM_DEBT / (AMT_CREDIT_SUM + 1e-9) AS DEBT_CREDIT_RATIO
 FROM bureau LEFT JOIN loans USING (SK_ID_BUREAU))"""


@query("a14_two_level_bureau", plan_sql(BUREAU_CTES, "full_bureau", _bureau_plan()))
def bureau_two_level(spark, folder):
    return rounded_table(h.bureau_rollup(m.bureau(spark, folder), m.bureau_balance(spark, folder)))


@query("j02_child_to_parent", f"""WITH {m.BUREAU_SQL}, {m.BUREAU_BALANCE_SQL},
 c AS (SELECT SK_ID_BUREAU, max(MONTHS_BALANCE) AS newest, count(MONTHS_BALANCE) AS months FROM bureau_balance GROUP BY 1)
 SELECT SK_ID_CURR, {r('avg(newest)')} AS newest_mean, {r('avg(months)')} AS months_mean
 FROM bureau LEFT JOIN (SELECT * FROM c WHERE SK_ID_BUREAU % 4 <> 0 AND SK_ID_BUREAU % 9 < 5) c USING (SK_ID_BUREAU) GROUP BY 1""")
def child_to_parent(spark, folder):
    """Many loans have no history here, and some customers no loan with one: they stay, with nulls."""
    per_loan = m.bureau_balance(spark, folder).groupBy("SK_ID_BUREAU").agg(
        F.max("MONTHS_BALANCE").alias("newest"), F.count("MONTHS_BALANCE").alias("months")
    ).where("SK_ID_BUREAU % 4 <> 0 AND SK_ID_BUREAU % 9 < 5")
    return rounded_table(child_means(m.bureau(spark, folder), per_loan, "SK_ID_CURR", "SK_ID_BUREAU"))


# --- A15 - A18 ----------------------------------------------------------------------------------------------------

INTEREST = ("PREV_TOTAL_PAYMENT", "PREV_SIMPLE_INTEREST", "PREV_CREDIT_TO_ANNUITY")
_PREV_DETAIL = (Stat("count", "SK_ID_PREV"), Stat("mean", "AMT_CREDIT"), Stat("mean", "APP_CREDIT_GAP"), *stats("mean", INTEREST))
PREV_PLAN = Rollup(
    "SK_ID_CURR",
    (
        Stat("count", "SK_ID_PREV"), Stat("mean", "AMT_ANNUITY"), Stat("sum", "AMT_CREDIT"), Stat("sum", "APP_CREDIT_GAP"), Stat("mean", "APP_CREDIT_GAP"),
        Stat("min", "DAYS_DECISION"), Stat("mean", "DAYS_DECISION"), *share_stats("NAME_CONTRACT_STATUS", PREV_CATEGORIES), *stats("mean", INTEREST),
    ),
    Recency("DAYS_DECISION", fv.DAY_WINDOWS, "D", (Stat("count", "SK_ID_PREV"), Stat("mean", "APP_CREDIT_GAP"), *stats("mean", INTEREST))),
    tuple(Split("NAME_CONTRACT_STATUS", v, v.upper(), _PREV_DETAIL) for v in ("Approved", "Refused", "Canceled")),
    Latest("DAYS_DECISION", fv.LAST_RECORDS, _PREV_DETAIL, ("SK_ID_PREV",)), prefix="prev_",
)
PREV_CTES = f"""{m.PREVIOUS_SQL}, prev AS (SELECT *, AMT_APPLICATION - AMT_CREDIT AS APP_CREDIT_GAP, AMT_ANNUITY * CNT_PAYMENT AS PREV_TOTAL_PAYMENT,
 AMT_ANNUITY * CNT_PAYMENT - AMT_CREDIT AS PREV_SIMPLE_INTEREST, AMT_CREDIT / (AMT_ANNUITY + 1e-9) AS PREV_CREDIT_TO_ANNUITY FROM previous_application)"""


@query("a15_previous_applications", plan_sql(PREV_CTES, "prev", PREV_PLAN))
def previous(spark, folder):
    return rounded_table(h.previous_rollup(m.previous_application(spark, folder)))


_POS_DETAIL = (Stat("max", "SK_DPD"), Stat("mean", "SK_DPD"), Stat("mean", "CNT_INSTALMENT"), Stat("mean", "CNT_INSTALMENT_FUTURE"))
POS_PLAN = Rollup(
    "SK_ID_CURR", (*_POS_DETAIL, Stat("max", "CNT_INSTALMENT"), Stat("max", "CNT_INSTALMENT_FUTURE")),
    Recency("MONTHS_BALANCE", fv.MONTH_WINDOWS, "M", _POS_DETAIL, ("SK_DPD",)),
    latest=Latest("MONTHS_BALANCE", fv.LAST_RECORDS, _POS_DETAIL, ("SK_ID_PREV", "SK_DPD", "CNT_INSTALMENT", "CNT_INSTALMENT_FUTURE")),
    distinct=("SK_ID_PREV",), prefix="pos_",
)
POS_CTES = f"""{m.POS_SQL}, pos AS (SELECT * REPLACE (CASE WHEN SK_DPD < 0 THEN 0 ELSE SK_DPD END AS SK_DPD,
 CASE WHEN CNT_INSTALMENT < 0 THEN 0 ELSE CNT_INSTALMENT END AS CNT_INSTALMENT) FROM pos_cash)"""


@query("a16_pos_cash", plan_sql(POS_CTES, "pos", POS_PLAN))
def pos(spark, folder):
    return rounded_table(h.pos_rollup(m.pos_cash(spark, folder)))


_INST_DETAIL = stats("mean", ("DPD", "DBD", "PAYMENT_PERC", "PAYMENT_DIFF"))
INST_PLAN = Rollup(
    "SK_ID_CURR",
    (Stat("max", "DPD"), Stat("max", "DBD"), *_INST_DETAIL, Stat("sum", "PAYMENT_DIFF"), Stat("sum", "AMT_INSTALMENT"), Stat("sum", "AMT_PAYMENT")),
    Recency("DAYS_INSTALMENT", fv.DAY_WINDOWS, "D", _INST_DETAIL, ("DPD", "PAYMENT_PERC")),
    latest=Latest("DAYS_INSTALMENT", fv.LAST_RECORDS, _INST_DETAIL, ("SK_ID_PREV", "DAYS_ENTRY_PAYMENT", "AMT_INSTALMENT", "AMT_PAYMENT")),
    distinct=("NUM_INSTALMENT_VERSION",), prefix="inst_",
)
INST_CTES = f"""{m.INSTALLMENTS_SQL}, inst AS (SELECT *, AMT_PAYMENT / (AMT_INSTALMENT + 1e-9) AS PAYMENT_PERC, AMT_INSTALMENT - AMT_PAYMENT AS PAYMENT_DIFF,
 CASE WHEN DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT < 0 THEN 0 ELSE DAYS_ENTRY_PAYMENT - DAYS_INSTALMENT END AS DPD,
 CASE WHEN DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT < 0 THEN 0 ELSE DAYS_INSTALMENT - DAYS_ENTRY_PAYMENT END AS DBD FROM installments)"""


@query("a17_installments", plan_sql(INST_CTES, "inst", INST_PLAN))
def inst(spark, folder):
    return rounded_table(h.installment_rollup(m.installments(spark, folder)))


_CARD_EXTRA = ("AMT_TOTAL_RECEIVABLE", "AMT_RECEIVABLE_PRINCIPAL", "CNT_DRAWINGS_CURRENT")
_CARD_DETAIL = (Stat("sum", "AMT_DRAWINGS_CURRENT"), Stat("mean", "UTILIZATION"), Stat("max", "SK_DPD"), *stats("mean", _CARD_EXTRA))
CARD_PLAN = Rollup(
    "SK_ID_CURR", (Stat("mean", "AMT_BALANCE"), *_CARD_DETAIL, Stat("max", "UTILIZATION"), *stats("sum", _CARD_EXTRA)),
    Recency("MONTHS_BALANCE", fv.MONTH_WINDOWS, "M", _CARD_DETAIL, ("UTILIZATION",)),
    latest=Latest("MONTHS_BALANCE", fv.LAST_RECORDS, _CARD_DETAIL, ("SK_ID_PREV", "AMT_BALANCE", "AMT_CREDIT_LIMIT_ACTUAL", "AMT_DRAWINGS_CURRENT", "SK_DPD", *_CARD_EXTRA)),
    prefix="cc_",
)
_USE = "AMT_BALANCE / (AMT_CREDIT_LIMIT_ACTUAL + 1e-9)"
CARD_CTES = f"{m.CARD_SQL}, card AS (SELECT *, CASE WHEN {_USE} > 1 THEN 1 WHEN {_USE} < 0 THEN 0 ELSE {_USE} END AS UTILIZATION FROM card_balance)"


@query("a18_credit_card", plan_sql(CARD_CTES, "card", CARD_PLAN))
def card(spark, folder):
    return rounded_table(h.card_rollup(m.card_balance(spark, folder)))


# --- J01 and the flagship -------------------------------------------------------------------------------------------


@query("j01_left_join_rollups", f"""WITH {m.APPLICATION_SQL}, {m.PREVIOUS_SQL}, {m.POS_SQL},
 a AS (SELECT SK_ID_CURR, count(SK_ID_PREV) AS c, avg(AMT_CREDIT) AS a FROM previous_application GROUP BY 1),
 b AS (SELECT SK_ID_CURR, max(SK_DPD) AS d, avg(CNT_INSTALMENT) AS i FROM pos_cash GROUP BY 1)
 SELECT application.SK_ID_CURR, TARGET::BIGINT AS "TARGET", a.c AS "prev_SK_ID_PREV_count", {r('a.a')} AS "prev_AMT_CREDIT_mean", {r('b.d')} AS "pos_SK_DPD_max",
 {r('b.i')} AS "pos_CNT_INSTALMENT_mean" FROM application LEFT JOIN a USING (SK_ID_CURR) LEFT JOIN b USING (SK_ID_CURR)""")
def merged(spark, folder):
    base = m.application(spark, folder).select("SK_ID_CURR", "TARGET")
    prev = roll_up(m.previous_application(spark, folder), Rollup("SK_ID_CURR", (Stat("count", "SK_ID_PREV"), Stat("mean", "AMT_CREDIT")), prefix="prev_"))
    pos = roll_up(m.pos_cash(spark, folder), Rollup("SK_ID_CURR", (Stat("max", "SK_DPD"), Stat("mean", "CNT_INSTALMENT")), prefix="pos_"))
    return rounded_table(merge_rollups(base, {"prev": prev, "pos": pos}))


_FIVE = {"a14_two_level_bureau": "bureau", "a15_previous_applications": "prev", "a16_pos_cash": "pos", "a17_installments": "inst", "a18_credit_card": "cc"}


@query("j01_all_rollups", "SELECT c_custkey AS SK_ID_CURR, " + ", ".join(f"{t}.* EXCLUDE (SK_ID_CURR)" for t in _FIVE.values()) + " FROM customer " + " ".join(
    f"LEFT JOIN ({CATALOG[name].sql}) {t} ON c_custkey = {t}.SK_ID_CURR" for name, t in _FIVE.items()))
def all_five(spark, folder):
    """The widest table of the feature job: every customer with the roll-ups of all five histories."""
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("SK_ID_CURR"))
    return rounded_table(merge_rollups(base, h.all_rollups(m.credit_tables(spark, folder))))


_SKETCHED = Rollup(
    "o_custkey", (Stat("approx_distinct", "o_orderdate"), Stat("approx_distinct", "priority")),
    Recency("age", (200, 800), "D", (Stat("approx_distinct", "priority"), Stat("rows", name="n"))),
    (Split("o_orderstatus", "F", "FILLED", (Stat("approx_distinct", "priority"),)),),
    Latest("age", (3, 5), (Stat("approx_distinct", "priority"),), ("o_orderkey",)),
)
_SKETCH_SQL = """WITH o AS (SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS priority,
  CASE WHEN o_orderkey % 11 <> 0 THEN -(o_orderkey * 17 % 1000) END AS age FROM orders),
 p AS (SELECT *, CASE WHEN age IS NOT NULL THEN row_number() OVER (PARTITION BY o_custkey, age IS NULL ORDER BY age DESC, o_orderkey) ELSE 0 END AS place FROM o),
 x AS (SELECT *, coalesce(priority, 'none at all') AS v FROM p)
 SELECT o_custkey, count(DISTINCT o_orderdate) AS o_orderdate_approx_distinct, count(DISTINCT v) AS priority_approx_distinct, """ + ", ".join(
    f'CASE WHEN count(*) FILTER (WHERE age >= -{d}) > 0 THEN count(DISTINCT v) FILTER (WHERE age >= -{d}) END AS "priority_approx_distinct_{d}D", nullif(count(*) FILTER (WHERE age >= -{d}), 0) AS "n_{d}D"' for d in (200, 800)) + """,
  CASE WHEN count(*) FILTER (WHERE o_orderstatus = 'F') > 0 THEN count(DISTINCT v) FILTER (WHERE o_orderstatus = 'F') END AS "FILLED_priority_approx_distinct",
  count(DISTINCT v) FILTER (WHERE place <= 3) AS "LAST_3_priority_approx_distinct", count(DISTINCT v) FILTER (WHERE place <= 5) AS "LAST_5_priority_approx_distinct" FROM x GROUP BY 1"""


@query("a06_sketched_distinct", _SKETCH_SQL)
def sketched(spark, folder):
    """Distinct counts by sketches that merge over windows, a split and the newest rows; few values are counted exactly."""
    df = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderkey") % 11 != 0, -(F.col("o_orderkey") * 17 % 1000)).alias("age"))
    return rounded_table(roll_up(df, _SKETCHED))


FLAG_PLAN = Rollup(
    "SK_ID_CURR", (Stat("count", "SK_ID_PREV"), Stat("sum", "AMT_APPLICATION"), Stat("mean", "AMT_APPLICATION")),
    Recency("DAYS_DECISION", fv.DAY_WINDOWS, "D", (Stat("count", "SK_ID_PREV"), Stat("sum", "AMT_APPLICATION"), Stat("mean", "AMT_APPLICATION")), ("AMT_APPLICATION",)),
    latest=Latest("DAYS_DECISION", fv.LAST_RECORDS, (Stat("mean", "AMT_APPLICATION"), Stat("max", "AMT_APPLICATION")), ("SK_ID_PREV",)), prefix="prev_",
)


def flagship_columns() -> list[tuple[str, bool]]:
    names = [(s.label, s.kind == "count") for s in FLAG_PLAN.overall]
    for w in fv.DAY_WINDOWS:
        names += [(f"{s.label}_{w}D", s.kind == "count") for s in FLAG_PLAN.recency.stats] + [(f"AMT_APPLICATION_mean_trend_{w}D", False)]
    for n in fv.LAST_RECORDS:
        names += [(f"LAST_{n}_{s.label}", False) for s in FLAG_PLAN.latest.stats]
    return [(f"prev_{n}", whole) for n, whole in names]


_FLAG_INNER = plan_sql(m.PREVIOUS_SQL, "previous_application", FLAG_PLAN)
_FLAG_COLS = ", ".join(f'coalesce("{n}", 0) AS "{n}"' for n, _ in flagship_columns())


@query("j01_customer_order_features", f'WITH inside AS ({_FLAG_INNER}) SELECT c_custkey AS SK_ID_CURR, c_mktsegment, {_FLAG_COLS} FROM customer LEFT JOIN inside ON c_custkey = SK_ID_CURR')
def flagship(spark, folder):
    """Customers with their order history over six windows and the last 1, 3, 5 and 10 orders; no history gives 0."""
    base = table(spark, folder, "customer").select(F.col("c_custkey").alias("SK_ID_CURR"), "c_mktsegment")
    rolled = rounded_table(roll_up(m.previous_application(spark, folder), FLAG_PLAN))
    return merge_rollups(base, {"prev": rolled}).fillna(0, subset=[n for n, _ in flagship_columns()])


@query("a13_categories_per_window", f"""WITH {m.BUREAU_BALANCE_SQL} """ + " UNION ALL ".join(
    f"SELECT CAST({w} AS BIGINT) AS span, STATUS AS category FROM bureau_balance WHERE STATUS IS NOT NULL AND MONTHS_BALANCE >= -{w} GROUP BY STATUS" for w in fv.MONTH_WINDOWS))
def window_categories(spark, folder):
    """Which category columns each window gets."""
    found = categories_by_recency(m.bureau_balance(spark, folder), "STATUS", "MONTHS_BALANCE", fv.MONTH_WINDOWS)
    return spark.createDataFrame([(int(w), c) for w in fv.MONTH_WINDOWS for c in found[w]], "span long, category string")


FILTERED = Rollup("SK_ID_CURR", (Stat("rows", name="ROWS"),), recency=Recency("DAYS_DECISION", (365,), "D", (Stat("rows", name="ROWS"), Stat("mean", "AMT_CREDIT"))))


@query("p17_recency_filter", plan_sql(m.PREVIOUS_SQL, "previous_application", FILTERED))
def recency_filter(spark, folder):
    return rounded_table(roll_up(m.previous_application(spark, folder), FILTERED))


EQUAL = Rollup("SK_ID_CURR", (Stat("rows", name="ROWS"),), splits=(Split("NAME_CONTRACT_STATUS", "Refused", "REFUSED", (Stat("rows", name="ROWS"), Stat("sum", "AMT_CREDIT"))),))


@query("p18_equality_split", plan_sql(m.PREVIOUS_SQL, "previous_application", EQUAL))
def equality_split(spark, folder):
    return rounded_table(roll_up(m.previous_application(spark, folder), EQUAL))


NAMED = Rollup("SK_ID_CURR", (Stat("mean", "SK_DPD"),), recency=Recency("MONTHS_BALANCE", (3,), "M", (Stat("max", "SK_DPD"),)),
               latest=Latest("MONTHS_BALANCE", (1,), (Stat("max", "SK_DPD"),), ("SK_ID_PREV", "SK_DPD")), prefix="pos_")


@query("p21_window_names", plan_sql(m.POS_SQL, "pos_cash", NAMED))
def window_names(spark, folder):
    return rounded_table(roll_up(m.pos_cash(spark, folder), NAMED))


@query("j03_fused_windows", plan_sql(m.INSTALLMENTS_SQL, "installments", Rollup(
    "SK_ID_CURR", (Stat("sum", "AMT_PAYMENT"),), Recency("DAYS_INSTALMENT", fv.DAY_WINDOWS, "D", (Stat("sum", "AMT_PAYMENT"), Stat("count", "AMT_PAYMENT"))))))
def fused_windows(spark, folder):
    """Six windows without a join; the SQL check joins six aggregates."""
    plan = Rollup("SK_ID_CURR", (Stat("sum", "AMT_PAYMENT"),), Recency("DAYS_INSTALMENT", fv.DAY_WINDOWS, "D", (Stat("sum", "AMT_PAYMENT"), Stat("count", "AMT_PAYMENT"))))
    return rounded_table(roll_up(m.installments(spark, folder), plan))
