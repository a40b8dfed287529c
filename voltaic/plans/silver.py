"""Bronze to silver: conform types, drop incomplete rows, keep the last
published row per key, classify and add time features (P1-P18, P25)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import (classify_by, pct, row_sum, time_feature_columns, to_number,
                         with_time_features)
from ..operators.dedupe import keep_last
from ..operators.pivot import pivot_measure

KEYS = list(config.KEYS)
ORDER_COLUMNS = ("_published_at", "_row_id")


def conform(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the named columns in one projection; a value that does not fit
    becomes NULL (``try_cast``), other columns pass through.  Rejects of a
    reader (rows with a ``_reason``) go."""
    if "_reason" in df.columns:
        df = df.filter(F.col("_reason").isNull()).drop("_reason")
    source = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def cast(c: str) -> F.Column:
        target = types[c]
        if source[c] == target:
            return F.col(c)
        if source[c] == "string" and target not in ("string", "date"):
            return to_number(F.col(c), target).alias(c)
        return F.col(c).try_cast(target).alias(c)

    return df.select(*[cast(c) if c in types else F.col(c) for c in df.columns])


def publication_order(df: DataFrame) -> list[str]:
    """The columns that order publications in a bronze frame: the packed
    order, or else path or time and position."""
    return ["_order"] if "_order" in df.columns else [c for c in ORDER_COLUMNS if c in df.columns]


def _required_order(df: DataFrame) -> list[str]:
    order = publication_order(df)
    if not order:
        raise ValueError(f"no publication order: need one of _order, {', '.join(ORDER_COLUMNS)}")
    return order


def _dedupe(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    keys = list(keys) if keys is not None else config.series_of(df) + KEYS
    return keep_last(df, keys, _required_order(df), drop_order=True)


def demand(bronze: DataFrame) -> DataFrame:
    """date, hour, market_demand, region_demand, time features,
    demand_category, export_demand."""
    df = conform(bronze, {"date": "date", "hour": "int", "market_demand": "int",
                          "region_demand": "int"})
    df = _dedupe(df.dropna(subset=["date", "hour", "region_demand"]))
    return df.select(
        *config.series_of(df), "date", "hour", "market_demand", "region_demand",
        *time_feature_columns(),
        classify_by("region_demand", config.DEMAND_CLASSES).alias("demand_category"),
        (F.col("market_demand") - F.col("region_demand")).alias("export_demand"))


MW_COLUMNS = [config.fuel_column(f) for f in config.FUELS]
PCT_COLUMNS = [config.fuel_column(f, "pct") for f in config.FUELS]


def generation_wide(bronze: DataFrame) -> DataFrame:
    """Long generation to one row per hour with one MW column per fuel.

    Per (date, hour, fuel) the last published row wins; it is then dropped
    if its output is NULL or negative, and a missing fuel is 0.  An hour
    keeps its row only if some fuel survived.  Fuels outside the list add up
    in ``other_mw``, so totals count every fuel.

    Two hash aggregates: keep-last per fuel, whose map-side combine leaves
    one row per hour, fuel and task, then the pivot over those few rows.
    """
    last = generation_last(bronze)
    keys = config.series_of(last) + KEYS
    wide = pivot_measure(last, keys, "fuel_type", "output_mw", config.FUELS,
                         rest=config.OTHER_FUEL, rename=config.fuel_column)
    return wide.select(*keys, *[F.coalesce(c, F.lit(0.0)).alias(c) for c in MW_COLUMNS])


def generation_last(bronze: DataFrame) -> DataFrame:
    """The last published output per hour and fuel, NULL and negative ones
    dropped (long form)."""
    df = conform(bronze, {"date": "date", "hour": "int", "fuel_type": "string",
                          "output_mw": "double"})
    df = df.dropna(subset=["date", "hour", "fuel_type"])
    keys = config.series_of(df) + KEYS + ["fuel_type"]
    order = _required_order(df)
    df = df.select(*keys, "output_mw", *order)
    return keep_last(df, keys, order, drop_order=True).filter(F.col("output_mw") >= 0)


def with_generation_shares(wide: DataFrame) -> DataFrame:
    """total_generation_mw, a percent share per fuel, clean_energy_pct
    (nuclear, hydro, wind, solar, biofuel), renewable_frac (hydro, wind,
    solar, biofuel; a fraction, unrounded)."""
    total = F.col("total_generation_mw")
    clean = row_sum(config.fuel_column(f) for f in config.CLEAN_FUELS)
    renewable = row_sum(config.fuel_column(f) for f in config.RENEWABLE_FUELS)
    return (wide.withColumn("total_generation_mw", row_sum(MW_COLUMNS))
            .select("*", *[pct(c, total).alias(p) for c, p in zip(MW_COLUMNS, PCT_COLUMNS)],
                    pct(clean, total).alias("clean_energy_pct"),
                    F.try_divide(renewable, total).alias("renewable_frac")))


def generation(bronze: DataFrame, features: bool = True) -> DataFrame:
    out = with_generation_shares(generation_wide(bronze))
    return with_time_features(out) if features else out


def prices(bronze: DataFrame) -> DataFrame:
    df = conform(bronze, {"date": "date", "hour": "int", "energy_price": "double"})
    df = _dedupe(df.dropna(subset=["date", "hour", "energy_price"]))
    return df.select(
        *df.columns,
        classify_by("energy_price", config.PRICE_CLASSES).alias("price_category"),
        *time_feature_columns())


def weather(bronze: DataFrame) -> DataFrame:
    df = conform(bronze, {"date": "date", "hour": "int", "temperature_c": "double",
                          "humidity_pct": "double", "wind_speed_kmh": "double"})
    df = _dedupe(df.dropna(subset=["date", "hour", "temperature_c"]))
    return df.select(
        *df.columns,
        classify_by("temperature_c", config.TEMPERATURE_CLASSES).alias("temp_category"),
        classify_by("temperature_c", config.HVAC_MODES).alias("hvac_mode"),
        *time_feature_columns())


REALTIME_MEASURES = ("total_energy", "total_loss", "total_load", "total_disp_load_sched_off",
                     "total_10s", "total_10n", "total_30r")


def realtime(bronze: DataFrame) -> DataFrame:
    """Net load = energy - loss; loss_pct = round(loss / energy * 100, 2).

    A frame with a publication order keeps the last row per interval, as the
    stream does; one without must be unique on the interval."""
    types = {"date": "date", "hour": "int", "interval": "int"}
    types.update({m: "double" for m in REALTIME_MEASURES if m in bronze.columns})
    df = conform(bronze, types)
    order = ["_order"] if "_order" in df.columns else [c for c in ("_published_at", "_line_no") if c in df.columns]
    if order:
        df = keep_last(df, config.series_of(df) + KEYS + ["interval"], order, drop_order=True)
    return df.select(
        *df.columns,
        (F.col("total_energy") - F.col("total_loss")).alias("net_load"),
        pct("total_loss", "total_energy").alias("loss_pct"))


def intertie(bronze: DataFrame) -> DataFrame:
    """Net scheduled flow = import - export and its direction."""
    types = {"date": "date", "hour": "int", "intertie_zone": "string",
             "schedule_import_mw": "double", "schedule_export_mw": "double"}
    if "actual_flow_mw" in bronze.columns:
        types["actual_flow_mw"] = "double"
    df = conform(bronze, types)
    net = F.col("schedule_import_mw") - F.col("schedule_export_mw")
    return df.select(
        *df.columns, net.alias("net_scheduled_flow_mw"),
        classify_by(net, config.FLOW_DIRECTIONS).alias("flow_direction"),
        *time_feature_columns())


def dayahead(bronze: DataFrame) -> DataFrame:
    """Day-ahead prices; a frame with a publication order keeps the last one."""
    df = conform(bronze, {"date": "date", "hour": "int", "da_price": "double"}).dropna(subset=["date", "hour"])
    return _dedupe(df) if publication_order(df) else df


TRANSFORMS = {
    "demand": demand,
    "generation": generation,
    "prices": prices,
    "weather": weather,
    "realtime": realtime,
    "intertie": intertie,
    "dayahead": dayahead,
}


def silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Apply each transform whose source is present (absent ones are skipped)."""
    return {name: TRANSFORMS[name](df) for name, df in bronze.items()
            if name in TRANSFORMS and df is not None}
