"""Freshness of datasets, registry updates and layer roll-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import allowed_lag, as_time
from ..functions.text import roll_text
from .calendars import minus
from .numbering import number_rows

# Days allowed for datasets whose source is known to lag, by a
# part of the dataset's name, and days after which a known issue is looked at again.
LAG_OVERRIDES = {
    "bio.002": 30, "bio.037": 53, "cit.035": 45, "cit.038": 5, "cit.041a": 32,
    "cli.005a": 70, "cli.005b": 70, "cli.021": 90, "cli.035": 120, "cli.039": 60,
    "cli.040": 150, "cli.041": 120, "cli.042": 120, "cli.043": 450, "cli.045": 120,
    "cli.047": 400, "dis.003": 60, "dis.006": 15, "dis.009": 20, "dis.015": 50,
    "ene.008": 50, "foo.024": 12, "foo.051": 12, "for.003": 10, "for.012": 30,
    "soc.016": 20, "soc.062": 10, "wat.040": 30,
}
RECHECK_DAYS = 31


def lag_days(frequency: Column, name: Column, overrides: dict[str, int] = LAG_OVERRIDES) -> Column:
    """Allowed days: the override of the dataset, else those of its frequency."""
    out = None
    for mark, days in overrides.items():
        out = (F if out is None else out).when(name.contains(mark), days)
    return allowed_lag(frequency) if out is None else out.otherwise(allowed_lag(frequency))


def freshness(
    registry: DataFrame, known: DataFrame, now, overrides: dict[str, int] = LAG_OVERRIDES
) -> DataFrame:
    """Status of each dataset.

    ``registry`` has ``dataset_id``, ``name``, ``frequency`` and
    ``last_updated``; ``known`` has ``dataset_id``, ``last_check`` and
    ``reason``.  Overdue datasets are ``outdated``, or ``explained`` where a
    known issue has a reason; a known issue whose data came back is
    ``recovered``.  ``recheck`` marks known issues not looked at for a month.
    """
    age = F.timestamp_diff("SECOND", F.col("last_updated"), as_time(now))
    allowed = lag_days(F.col("frequency"), F.col("name"), overrides)
    listed = F.col("_listed").isNotNull()
    overdue = age > allowed * 86400
    status = (
        F.when(overdue & listed & F.col("reason").isNotNull(), "explained")
        .when(overdue, "outdated")
        .when(listed, "recovered")
        .otherwise("ok")
    )
    check = F.try_to_timestamp("last_check", F.lit("MM/dd/yyyy")).cast("timestamp_ntz")
    recheck = F.floor(F.timestamp_diff("SECOND", check, as_time(now)) / 86400) > RECHECK_DAYS
    return registry.join(known.withColumn("_listed", F.lit(True)), "dataset_id", "left").select(
        "dataset_id",
        "name",
        F.floor(age / 86400).cast("bigint").alias("age_days"),
        allowed.cast("int").alias("allowed_days"),
        status.alias("status"),
        F.coalesce(listed & recheck, F.lit(False)).alias("recheck"),
    )


def registry_updates(latest: DataFrame, registry: DataFrame, key: str, latest_col: str, recorded_col: str) -> DataFrame:
    """Datasets whose newest data time differs from the recorded one."""
    joined = latest.select(key, latest_col).join(registry.select(key, recorded_col), key, "left")
    return joined.filter(~F.col(latest_col).eqNullSafe(F.col(recorded_col)))


def missing_periods(data: DataFrame, catalog: DataFrame, dataset: str, period: str) -> DataFrame:
    """Periods of a dataset that its layer catalogue lacks."""
    return minus(data, catalog, [dataset, period])


def rollout_years(catalog: DataFrame, data: DataFrame, dataset: str, year: str, texts: list[str]) -> DataFrame:
    """The catalogue with a layer for each new year; the newest year is the default.

    A new layer copies the dataset's newest layer, with the old year replaced in
    ``texts``.
    """
    fresh = missing_periods(data, catalog, dataset, year)
    rest = [c for c in catalog.columns if c != dataset]
    templates = catalog.groupBy(dataset).agg(F.max_by(F.struct(*rest), F.col(year)).alias("_t"))
    added = templates.join(fresh, dataset).select(
        dataset,
        *[
            (
                F.col(year) if c == year
                else roll_text(F.col(f"_t.{c}"), F.col(f"_t.{year}").cast("string"), F.col(year).cast("string"))
                if c in texts
                else F.col(f"_t.{c}")
            ).alias(c)
            for c in rest
        ],
    )
    layers = catalog.select(dataset, *rest).unionByName(added)
    newest = layers.groupBy(dataset).agg(F.max(year).alias("_newest"))
    return layers.join(newest, dataset).withColumn("default", F.col(year) == F.col("_newest")).drop("_newest")


def assign_by_order(
    layers: DataFrame, dates: DataFrame, order: str = "order", date: str = "date", current: str = "shown", first: int = 0
) -> DataFrame:
    """The layer of order ``first`` shows the first date, and so on; layers without one keep theirs."""
    days = dates.select(F.col(date).alias("_date")).filter("_date IS NOT NULL").distinct()
    placed = number_rows(days, ["_date"], name="_pos")
    return (
        layers.join(placed, F.col(order) == F.col("_pos") - 1 + first, "left")
        .withColumn(current, F.coalesce("_date", current))
        .drop("_pos", "_date")
    )
