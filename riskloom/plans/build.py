"""Source tables to final feature tables."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import as_column
from riskloom.operators.impute import fit_imputation
from riskloom.operators.quality import (
    Check, bit_columns, facts_of_bits, final_table_checks, null_bits, raise_on_failure, raw_table_checks, settle_with_facts, sparse_columns, table_facts,
)
from riskloom.plans import fixed_values as fv
from riskloom.plans.application import BaseOptions, add_row_statistics, fit_base, fit_pruning
from riskloom.plans.histories import ALL_SETS, all_rollups
from riskloom.session import DENSE, discard, partitions_for, settle, spread

SPLIT = "__is_train"
#: Base rows of one task, with all that their histories add.
ENTITIES = 20_000


@dataclass(frozen=True)
class FeatureTables:
    train: DataFrame
    test: DataFrame
    checks: list[Check]
    manifest: dict
    sparse: dict[str, float]


def merge_rollups(base: DataFrame, rollups: dict[str, DataFrame], key: str = fv.CUSTOMER) -> DataFrame:
    """Every base row keeps its place; entities without history get nulls.

    All inputs are unique per key and partitioned by it, so no input is
    shuffled twice.
    """
    return reduce(lambda df, agg: df.join(agg, key, "left"), rollups.values(), base)


def build_features(tables: dict[str, DataFrame], sets: Collection[str] = ALL_SETS, key: str = fv.CUSTOMER,
                   target: str = fv.TARGET, options: BaseOptions | None = None,
                   correlation: float = 0.99, dominance: float = 0.995, sparse_limit: float = 0.6) -> FeatureTables:
    """The whole feature job. Everything fitted is fitted on training rows only.

    Train and test rows are merged with the histories together, so each history
    is rolled up once. Medians are those of base columns and fitted before the
    merge, so the table that correlations and dominant values are read from is
    written filled, and only once if train and test have the same columns.
    """
    options = options or BaseOptions(sets=sets)
    train, test = (spread(tables[name], name) for name in ("application_train", "application_test"))  # the checks and encoders read them often
    checks = raw_table_checks(train, test, tables, fv.REQUIRED_COLUMNS, key, target)
    raise_on_failure(checks, "source table")

    with partitions_for(train.sparkSession, train.count() + test.count(), ENTITIES):
        base = fit_base(train, key, target, options)
        train_base, test_base = base.apply(train), base.apply(test)
        rollups = all_rollups(tables, sets, options.epsilon)
        both = train_base.withColumn(SPLIT, F.lit(True)).unionByName(
            test_base.withColumn(SPLIT, F.lit(False)), allowMissingColumns=True
        )
        merged = merge_rollups(both, rollups, key)
        added = [c for c in merged.columns if c not in both.columns]
        absent_in_test = [c for c in train_base.columns if c not in test_base.columns]
        absent_in_train = [c for c in test_base.columns if c not in train_base.columns]
        imputation = fit_imputation(merged.drop(SPLIT, *absent_in_train), [key, target], tuple(fv.ROLLUP_PREFIXES.values()), base_rows=train_base)

        def filled(df: DataFrame) -> DataFrame:
            return add_row_statistics(imputation.apply(df), options)

        if absent_in_test == [target] and not absent_in_train:
            # all rows are filled alike and written once, with bits that tell which values of the histories were null
            whole = settle(filled(merged.selectExpr("*", *null_bits(added))), "filled", DENSE)
            seen = facts_of_bits(whole, added, SPLIT)
            train_full, test_full = (whole.where(rows).drop(SPLIT, *bit_columns(added)) for rows in (as_column(SPLIT), ~as_column(SPLIT)))
            test_full = test_full.drop(target)
        else:
            merged, seen = settle_with_facts(merged, "merged", only=SPLIT)
            train_full = settle(filled(merged.where(as_column(SPLIT)).drop(SPLIT, *absent_in_train)), "train", DENSE)
            test_full = settle(filled(merged.where(~as_column(SPLIT)).drop(SPLIT, *absent_in_test)), "test", DENSE)
            discard(merged)
        sparse = sparse_columns(train_full, added, sparse_limit, seen)

        pruning = fit_pruning(train_full, key, target, correlation, dominance)
        # some columns of written tables, which need not be written again; one pass over each counts all that the checks and the manifest ask for
        final_train, final_test = pruning.apply(train_full), pruning.apply(test_full, without=[target])
        of_train, of_test = table_facts(final_train, target), table_facts(final_test)
        padded = pruning.padded(test_full, without=[target])
        discard(*(df for df, name in ((train, "application_train"), (test, "application_test")) if df is not tables[name]))
        final = final_table_checks(final_train, final_test, key, target, (of_train, of_test))
        raise_on_failure(final, "final table")
        manifest = feature_manifest(
            final_train, final_test, key, target, sorted(sets), sorted(tables),
            {
                "dropped_correlated": sorted(pruning.correlated),
                "dropped_low_variance": sorted(pruning.near_constant),
                "missing_columns_added_to_test": padded,
            },
            (of_train.rows, of_test.rows),
        )
        return FeatureTables(final_train, final_test, checks + final, manifest, sparse)


def feature_manifest(train: DataFrame, test: DataFrame, key: str, target: str, sets, sources, dropped: dict, rows: tuple[int, int] | None = None) -> dict:
    features = [c for c in train.columns if c not in (key, target)]
    return {
        "enabled_feature_sets": list(sets),
        "source_tables_used": list(sources),
        "final_train_shape": [rows[0] if rows else train.count(), len(train.columns)],
        "final_test_shape": [rows[1] if rows else test.count(), len(test.columns)],
        "final_feature_count": len(features),
        "train_columns": list(train.columns),
        "test_columns": list(test.columns),
        "dropped_columns": dropped,
    }
