"""Fixed values of the credit data set: source columns, windows and feature definitions."""

# Source column types that are not left to inference.
SOURCE_TYPES = {
    "SK_ID_CURR": "Int64",
    "SK_ID_BUREAU": "Int64",
    "SK_ID_PREV": "Int64",
    "AMT_INCOME_TOTAL": "Float64",
    "AMT_CREDIT": "Float64",
    "AMT_ANNUITY": "Float64",
    "AMT_GOODS_PRICE": "Float64",
    "AMT_PAYMENT": "Float64",
    "AMT_INSTALMENT": "Float64",
    "DAYS_ENTRY_PAYMENT": "Float64",
    "DAYS_INSTALMENT": "Float64",
    "AMT_BALANCE": "Float64",
    "AMT_CREDIT_LIMIT_ACTUAL": "Float64",
    "AMT_DRAWINGS_CURRENT": "Float64",
    "AMT_APPLICATION": "Float64",
    "DAYS_DECISION": "Float64",
    "DAYS_EMPLOYED": "Float64",
    "DAYS_BIRTH": "Float64",
    "DAYS_REGISTRATION": "Float64",
    "DAYS_ID_PUBLISH": "Float64",
    "DAYS_LAST_PHONE_CHANGE": "Float64",
    "MONTHS_BALANCE": "Float64",
    "DAYS_CREDIT": "Float64",
    "DAYS_CREDIT_ENDDATE": "Float64",
    "DAYS_ENDDATE_FACT": "Float64",
    "AMT_CREDIT_SUM": "Float64",
    "AMT_CREDIT_SUM_DEBT": "Float64",
    "AMT_CREDIT_SUM_LIMIT": "Float64",
    "AMT_CREDIT_SUM_OVERDUE": "Float64",
    "CNT_INSTALMENT": "Float64",
    "CNT_INSTALMENT_FUTURE": "Float64",
    "CNT_PAYMENT": "Float64",
    "AMT_DOWN_PAYMENT": "Float64",
    "RATE_DOWN_PAYMENT": "Float64",
    "AMT_TOTAL_RECEIVABLE": "Float64",
    "AMT_RECEIVABLE_PRINCIPAL": "Float64",
    "AMT_RECIVABLE": "Float64",
    "CNT_DRAWINGS_CURRENT": "Float64",
    "SK_DPD": "Float64",
    "SK_DPD_DEF": "Float64",
}

# Text that means null in a source file.
NULL_MARKERS = ("", "NA", "NaN", "nan", "NULL")

# Keys and target.
CUSTOMER = "SK_ID_CURR"
LOAN = "SK_ID_BUREAU"
PREVIOUS = "SK_ID_PREV"
TARGET = "TARGET"

# Required key columns per history table.
REQUIRED_COLUMNS = {
    "bureau": ("SK_ID_CURR", "SK_ID_BUREAU"),
    "bureau_balance": ("SK_ID_BUREAU",),
    "previous_application": ("SK_ID_CURR", "SK_ID_PREV"),
    "pos_cash_balance": ("SK_ID_CURR", "SK_ID_PREV"),
    "installments_payments": ("SK_ID_CURR", "SK_ID_PREV"),
    "credit_card_balance": ("SK_ID_CURR", "SK_ID_PREV"),
}

# Feature sets that can be switched off.
FEATURE_SETS = (
    "application_extended",
    "bureau_extended",
    "previous_interest",
    "last_n_aggregations",
    "recency_windows",
    "pos_cash_cleanup",
    "missing_indicators",
)

# Window lengths and record counts.
LAST_RECORDS = (1, 3, 5, 10)
MONTH_WINDOWS = (3, 6, 12, 24)
DAY_WINDOWS = (60, 90, 180, 365, 730, 1000)
BUREAU_DAY_WINDOWS = (365, 730, 1095)

# Placeholder for an unknown employment start.
UNKNOWN_EMPLOYMENT = 365243

# Column groups of the application table.
FREQUENCY_COLUMNS = ("ORGANIZATION_TYPE", "OCCUPATION_TYPE")
EXTERNAL_SCORES = ("EXT_SOURCE_1", "EXT_SOURCE_2", "EXT_SOURCE_3")
FLAGGED_WHEN_MISSING = (
    "EXT_SOURCE_1",
    "EXT_SOURCE_2",
    "EXT_SOURCE_3",
    "AMT_ANNUITY",
    "AMT_GOODS_PRICE",
    "DAYS_LAST_PHONE_CHANGE",
)
ENQUIRY_COUNTS = (
    "AMT_REQ_CREDIT_BUREAU_HOUR",
    "AMT_REQ_CREDIT_BUREAU_DAY",
    "AMT_REQ_CREDIT_BUREAU_WEEK",
    "AMT_REQ_CREDIT_BUREAU_MON",
    "AMT_REQ_CREDIT_BUREAU_QRT",
    "AMT_REQ_CREDIT_BUREAU_YEAR",
)
DOCUMENT_PREFIX = "FLAG_DOCUMENT_"

# Ratio features as (name, numerator, denominator).
BASE_RATIOS = (
    ("DAYS_EMPLOYED_PERC", "DAYS_EMPLOYED", "DAYS_BIRTH"),
    ("INCOME_PER_PERSON", "AMT_INCOME_TOTAL", "CNT_FAM_MEMBERS"),
)
GLOBAL_RATIOS = (
    ("CREDIT_INCOME_RATIO", "AMT_CREDIT", "AMT_INCOME_TOTAL"),
    ("ANNUITY_INCOME_RATIO", "AMT_ANNUITY", "AMT_INCOME_TOTAL"),
    ("CREDIT_TERM", "AMT_ANNUITY", "AMT_CREDIT"),
    ("GOODS_CREDIT_RATIO", "AMT_GOODS_PRICE", "AMT_CREDIT"),
)
EXTENDED_RATIOS = (
    ("CREDIT_TO_ANNUITY_RATIO", "AMT_CREDIT", "AMT_ANNUITY"),
    ("CREDIT_TO_GOODS_RATIO", "AMT_CREDIT", "AMT_GOODS_PRICE"),
    ("REGISTRATION_BIRTH_RATIO", "DAYS_REGISTRATION", "DAYS_BIRTH"),
    ("ID_PUBLISH_BIRTH_RATIO", "DAYS_ID_PUBLISH", "DAYS_BIRTH"),
    ("PHONE_CHANGE_BIRTH_RATIO", "DAYS_LAST_PHONE_CHANGE", "DAYS_BIRTH"),
)
CROSS_RATIO_BASES = ("CREDIT_INCOME_RATIO", "ANNUITY_INCOME_RATIO")

# Prefixes of the rolled-up tables, in merge order.
ROLLUP_PREFIXES = {"bureau": "bureau_", "prev": "prev_", "pos": "pos_", "inst": "inst_", "cc": "cc_"}
