"""Pooled regression on the featured panel: preparation, training, comparison."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from stockspark.checks import require_columns
from stockspark.functions.coerce import literal_to_map
from stockspark.operators.accuracy import METRICS, error_measures, forecast_record, period_label, python_literal, with_saved_model
from stockspark.operators.cleaning import align_features, drop_incomplete, encode_label, fill_values, label_codes
from stockspark.operators.series import DATE, TARGET
from stockspark.operators.splits import split_by_date
from stockspark.operators.trees import fit_trees, predict
from stockspark.session import by_series, materialise
from stockspark.sources.tables import load_model, save_model

TYPE, TYPE_CODE = "Type", "Type_Encoded"
GLOBAL_ID = 0
UNSEEN = -1


@dataclass
class RegressionPrep:
    """Medians, modes, label codes and feature order, taken from the train rows only."""

    target: str = TARGET
    features: list[str] = field(default_factory=list)
    fills: dict[str, object] = field(default_factory=dict)
    codes: DataFrame | None = None

    @classmethod
    def fit(cls, train: DataFrame, target: str = TARGET, features: Sequence[str] | None = None) -> RegressionPrep:
        require_columns(train, [target, DATE])
        rows = drop_incomplete(train, [target])
        if features is None:
            names = [TYPE_CODE if c == TYPE else c for c in rows.columns if c not in (target, DATE, "is_test")]
            features = sorted(names)
        raw = [TYPE if c == TYPE_CODE and TYPE in rows.columns else c for c in features]
        raw = [c for c in raw if c in rows.columns]
        fills = fill_values(rows, raw)
        codes = None
        if TYPE in rows.columns and TYPE_CODE in features:
            codes = label_codes(rows.fillna({TYPE: fills[TYPE]}), TYPE, TYPE_CODE)
        return cls(target, list(features), fills, codes)

    def transform(self, df: DataFrame) -> DataFrame:
        """The kept columns (keys, date, target, split flag) and the aligned features."""
        rows = drop_incomplete(df, [self.target]) if self.target in df.columns else df
        present = {name: F.coalesce(F.col(name), F.lit(fill)) for name, fill in self.fills.items() if name in rows.columns}
        rows = rows.withColumns(present)
        if self.codes is not None and TYPE in rows.columns:
            rows = encode_label(rows, TYPE, TYPE_CODE, self.codes)
            # A label that training never saw gets a code of its own.
            rows = rows.withColumn(TYPE_CODE, F.coalesce(TYPE_CODE, F.lit(UNSEEN)))
        kept = [c for c in (DATE, self.target, "is_test") if c in rows.columns]
        return rows.select(*kept, *align_features(rows, self.features))


def compare_trees(
    featured: DataFrame,
    configs: dict[str, dict[str, object]],
    stamp: str,
    weeks: int = 52,
    target: str = TARGET,
    save_to: str | None = None,
) -> DataFrame:
    """Train each configured model on the weeks before the split, score it on the rest, log it.

    The prepared rows are written once, since every model passes over them many times.
    """
    split = split_by_date(featured, weeks)
    prep = RegressionPrep.fit(split.where(~F.col("is_test")), target)
    # Rows are placed by a hash of their values, so that the draws of the trees repeat.
    prepared = prep.transform(split)
    prepared = materialise(by_series(prepared, prepared.columns), "prepared")
    spans = prepared.agg(
        period_label(DATE, ~F.col("is_test")).alias("Train_Period"),
        period_label(DATE, F.col("is_test")).alias("Test_Period"),
    )
    train, test = prepared.where(~F.col("is_test")), prepared.where(F.col("is_test"))
    spans = spans.first()

    def one(kind: str) -> DataFrame:
        settings = configs[kind]
        model = fit_trees(train, prep.features, target, kind, **settings)
        params = dict(settings)
        if save_to:
            params["model_path"] = f"{save_to.rstrip('/')}/{kind}_{stamp.translate(str.maketrans('', '', '- :'))}"
            save_model(model, params["model_path"], featured.sparkSession)
        measures = error_measures(F.col(target), F.col("yhat"))
        scored = predict(model, test).agg(*[c.alias(n) for n, c in measures.items()])
        scored = scored.withColumns(
            {
                "Store": F.lit(GLOBAL_ID),
                "Dept": F.lit(GLOBAL_ID),
                "Train_Period": F.lit(spans["Train_Period"]),
                "Test_Period": F.lit(spans["Test_Period"]),
            }
        )
        return forecast_record(scored, F.lit(kind), python_literal(params), stamp, prep.features)

    # The fits are many small jobs each, so they run beside each other.
    with ThreadPoolExecutor(len(configs)) as pool:
        records = list(pool.map(inheritable_thread_target(featured.sparkSession)(one), configs))
    return reduce(DataFrame.unionByName, records)


def rescore_stored(featured: DataFrame, log: DataFrame, weeks: int = 52, target: str = TARGET) -> DataFrame:
    """The stored models of an experiment log, loaded by their ``model_path`` and scored on the same split again.

    One row for each record with a path: the logged errors beside those of the loaded model. The preparation is
    fitted again on the train rows, so the loaded model sees the features it was trained on. Records without a path
    have no row. A log holds one record for each pooled model, so its paths are few.
    """
    split = split_by_date(featured, weeks)
    prep = RegressionPrep.fit(split.where(~F.col("is_test")), target)
    test = materialise(prep.transform(split.where(F.col("is_test"))), "held-out")
    records = log.withColumn("model_path", literal_to_map(F.col("Parameters")).getItem("model_path"))
    names = list(METRICS)
    records = with_saved_model(records).select("Timestamp", "Model", "model_path", *names)
    measures = error_measures(F.col(target), F.col("yhat"))
    empty = records.limit(0).select("*", *[F.col(n).alias(f"{n}_again") for n in names])

    def one(record: Row) -> DataFrame:
        scored = predict(load_model(record["model_path"], featured.sparkSession), test).agg(*[measures[n].alias(f"{n}_again") for n in names])
        kept = [F.lit(record[c]).cast(records.schema[c].dataType).alias(c) for c in records.columns]
        return scored.select(*kept, *[f"{n}_again" for n in names])

    return reduce(DataFrame.unionByName, [one(record) for record in records.collect()], empty)
