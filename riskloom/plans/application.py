"""Base-table features: cleaning, ratios, encoders, row statistics and pruning."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from riskloom.functions import columns as fx
from riskloom.functions.text import finite_text, name
from riskloom.operators.encode import CategoryCodes, FrequencyTable, fit_codes, fit_frequency
from riskloom.operators.prune import correlated_columns, near_constant_columns
from riskloom.plans import fixed_values as fv
from riskloom.plans.histories import ALL_SETS


@dataclass(frozen=True)
class BaseOptions:
    sets: Collection[str] = ALL_SETS
    epsilon: float = fx.EPSILON
    unknown_employment: float = fv.UNKNOWN_EMPLOYMENT
    use_binary: bool = True
    drop_first: bool = False
    normalize_frequency: bool = False
    cross_ratios: bool = False
    most_categories: int | None = None


def ratio_columns(df: DataFrame, family: Sequence[tuple[str, str, str]], epsilon: float = fx.EPSILON) -> dict:
    """Ratios whose two inputs both exist."""
    present = set(df.columns)
    return {n: fx.ratio(a, b, epsilon) for n, a, b in family if a in present and b in present}


def derive_base(df: DataFrame, options: BaseOptions = BaseOptions()) -> DataFrame:
    """Row-wise base features. Each one appears only if its inputs do."""
    present = set(df.columns)
    if "DAYS_EMPLOYED" in present:
        df = df.withColumn("DAYS_EMPLOYED", fx.blank_value("DAYS_EMPLOYED", options.unknown_employment))
    added = {}
    if "application_extended" in options.sets:
        if "DAYS_BIRTH" in present:
            added["AGE_YEARS"] = fx.age_years("DAYS_BIRTH")
        if {"AMT_GOODS_PRICE", "AMT_CREDIT"} <= present:
            added["DOWN_PAYMENT"], added["DOWN_PAYMENT_RATIO"] = fx.gap_pair("AMT_GOODS_PRICE", "AMT_CREDIT", options.epsilon)
        added |= ratio_columns(df, fv.EXTENDED_RATIOS, options.epsilon)
    if "missing_indicators" in options.sets:
        for c in fv.FLAGGED_WHEN_MISSING:
            if c in present and f"{c}_is_missing" not in present:
                added[f"{c}_is_missing"] = fx.null_flag(c)
    added |= ratio_columns(df, fv.BASE_RATIOS, options.epsilon)
    documents = [c for c in df.columns if c.startswith(fv.DOCUMENT_PREFIX)]
    if documents:
        added["DOCUMENT_COUNT"] = fx.row_sum(documents)
    return df.withColumns(added) if added else df


@dataclass(frozen=True)
class BaseTransform:
    """Encoders fitted on the training rows, applied after the row-wise features."""

    options: BaseOptions
    frequencies: list[FrequencyTable]
    codes: CategoryCodes

    def apply(self, df: DataFrame) -> DataFrame:
        df = derive_base(df, self.options)
        for table in self.frequencies:
            if table.column in df.columns:
                df = table.apply(df)
        return self.codes.apply(df)


def fit_base(train: DataFrame, key: str = fv.CUSTOMER, target: str = fv.TARGET, options: BaseOptions = BaseOptions(),
             frequency_columns: Sequence[str] = fv.FREQUENCY_COLUMNS) -> BaseTransform:
    frequent = [c for c in frequency_columns if c in train.columns]
    tables = [fit_frequency(train, c, options.normalize_frequency) for c in frequent]
    codes = fit_codes(
        train, fx.string_columns(train, skip=[key, target, *frequent]),
        use_binary=options.use_binary, drop_first=options.drop_first, limit=options.most_categories,
    )
    return BaseTransform(options, tables, codes)


def add_row_statistics(df: DataFrame, options: BaseOptions = BaseOptions(), fill: float = 0) -> DataFrame:
    """Ratios and statistics across columns, then every unusable number becomes ``fill``.

    The fill covers all numeric columns, key and target included.
    """
    present = set(df.columns)
    added = ratio_columns(df, fv.GLOBAL_RATIOS, options.epsilon)
    scores, enquiries = list(fv.EXTERNAL_SCORES), list(fv.ENQUIRY_COUNTS)
    lenient = []
    if set(scores) <= present:
        lenient += scores
        added |= {
            "EXT_SOURCES_MEAN": fx.row_mean(scores), "EXT_SOURCES_MIN": fx.row_min(scores),
            "EXT_SOURCES_MAX": fx.row_max(scores), "EXT_SOURCES_RANGE": fx.row_range(scores),
            "EXT_SOURCES_PROD": fx.row_product(scores), "EXT_SOURCES_STD": fx.row_std(scores),
        }
    if set(enquiries) <= present:
        lenient += enquiries
        added["AMT_REQ_CREDIT_BUREAU_TOTAL"] = fx.row_sum(enquiries)
    df = df.selectExpr(*[f"try_cast({name(c)} AS DOUBLE) AS {name(c)}" if c in lenient else name(c) for c in df.columns if c not in added]
                       + [name(c) for c in added if c in present]).withColumns(added)
    if options.cross_ratios and set(scores) <= present:
        # off by default: the published feature list does not hold these; their bases are ratios made above
        df = df.withColumns(ratio_columns(df, [(f"{b}_TO_{s}", b, s) for b in fv.CROSS_RATIO_BASES for s in scores], options.epsilon))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = set(fx.numeric_columns(df))
    return df.selectExpr(*[f"{finite_text(c, kinds[c], fill)} AS {name(c)}" if c in numbers else name(c) for c in df.columns])


@dataclass(frozen=True)
class Pruning:
    """Columns kept and dropped, decided on training rows only."""

    kept: list[str]
    correlated: list[str] = field(default_factory=list)
    near_constant: list[str] = field(default_factory=list)

    def apply(self, df: DataFrame, fill: float = 0, without: Sequence[str] = ()) -> DataFrame:
        """Kept columns in training order; absent ones are filled."""
        names, present = [c for c in self.kept if c not in without], set(df.columns)
        return df.selectExpr(*[name(c) if c in present else f"{fill} AS {name(c)}" for c in names])

    def padded(self, df: DataFrame, without: Sequence[str] = ()) -> list[str]:
        return sorted(c for c in self.kept if c not in without and c not in df.columns)


def fit_pruning(train: DataFrame, key: str = fv.CUSTOMER, target: str = fv.TARGET,
                correlation: float = 0.99, dominance: float = 0.995) -> Pruning:
    """Correlated columns first, then near-constant ones among those left."""
    correlated = correlated_columns(train, fx.numeric_columns(train, skip=[key, target]), correlation)
    gone = set(correlated)
    left = [c for c in train.columns if c not in gone and c not in (key, target)]
    constant = near_constant_columns(train, left, dominance)
    gone |= set(constant)
    return Pruning([c for c in train.columns if c not in gone], correlated, constant)
