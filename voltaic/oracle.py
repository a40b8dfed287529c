"""Independent SQL for every registered query, as run by DuckDB on the
driver's tables.  Written from the query definitions, not generated from
the Spark plans, so that a wrong Spark plan shows up as a mismatch.

Rules shared with the Spark side (see FIXTURES.md part 4): decimal
rounding (``R2``), ``x / nullif(y, 0)`` for ``try_divide``, Sunday = 1,
integer types cast to match Spark's.
"""

from __future__ import annotations


def R(expr: str, digits: int = 2) -> str:
    """Round half up through decimal(30,8), back to double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(30,8)), {digits}) AS DOUBLE)"


def DIV(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def PCT(a: str, b: str) -> str:
    return R(f"{DIV(a, b)} * 100")


FUELS = ("nuclear", "hydro", "wind", "solar", "gas", "biofuel", "other")
FACTORS = {"nuclear": 12, "hydro": 24, "wind": 11, "solar": 45, "gas": 490, "biofuel": 230,
           "other": 0}
CLEAN = ("nuclear", "hydro", "wind", "solar", "biofuel")
RENEWABLE = ("hydro", "wind", "solar", "biofuel")


def _case(value: str, rules, default: str) -> str:
    whens = " ".join(f"WHEN {value} {op} {bound} THEN '{label}'" for op, bound, label in rules)
    return f"CASE {whens} ELSE '{default}' END"


DEMAND_CLASS = _case("region_demand", [("<", 15000, "Low"), ("<", 20000, "Medium"),
                                       ("<", 25000, "High")], "Extreme")
PRICE_CLASS = _case("energy_price", [("<", 0, "Negative"), ("<", 20, "Low"),
                                     ("<", 50, "Medium"), ("<", 100, "High")], "Spike")
TEMP_CLASS = _case("temperature_c", [("<", -10, "Extreme Cold"), ("<", 0, "Cold"),
                                     ("<", 15, "Mild"), ("<", 25, "Warm"), ("<", 35, "Hot")],
                   "Extreme Heat")
HVAC = _case("temperature_c", [("<", 18, "Heating"), (">", 22, "Cooling")], "Neutral")
CARBON_CLASS = _case("carbon_intensity_gco2_kwh", [("<", 50, "Very Clean"), ("<", 100, "Clean"),
                                                   ("<", 200, "Moderate")], "Dirty")


def SEASON(d: str = "date") -> str:
    return (f"CASE WHEN month({d}) IN (12, 1, 2) THEN 'Winter' "
            f"WHEN month({d}) IN (3, 4, 5) THEN 'Spring' "
            f"WHEN month({d}) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END")


TIME_FEATURES = f"""
    CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
    dayname(date) AS day_name,
    coalesce(dayofweek(date) + 1 BETWEEN 2 AND 6, false) AS is_weekday,
    CAST(month(date) AS INTEGER) AS month_num,
    {SEASON()} AS season,
    coalesce(hour BETWEEN 7 AND 19, false) AS is_peak_hour,
    CAST(year(date) AS INTEGER) AS year,
    CAST(month(date) AS INTEGER) AS month"""

FEATURE_NAMES = ("day_of_week", "day_name", "is_weekday", "month_num", "season",
                 "is_peak_hour", "year", "month")


def _total(prefix: str = "") -> str:
    return " + ".join(f"{prefix}{f}_mw" for f in FUELS)


def _carbon(prefix: str = "") -> str:
    weighted = " + ".join(f"coalesce({prefix}{f}_mw, 0.0) * {FACTORS[f]}" for f in FUELS)
    return R(DIV(weighted, f"{prefix}total_generation_mw"))


CTES: list[tuple[str, str]] = [
    ("b_demand", """
    SELECT DATE '2024-01-01' + CAST(o_orderkey % 40 AS INTEGER) AS date,
           CAST((o_orderkey // 40) % 24 + 1 AS INTEGER) AS hour,
           CAST(floor(o_totalprice / 15) AS INTEGER) AS market_demand,
           CAST(floor(o_totalprice / 16) AS INTEGER) AS region_demand,
           o_orderkey AS _row_id
    FROM orders"""),
    ("b_generation", """
    SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) + 1 AS INTEGER) AS hour,
           CASE event_type WHEN 'click' THEN 'Nuclear' WHEN 'view' THEN 'Hydro'
                WHEN 'signup' THEN 'Wind' WHEN 'purchase' THEN 'Solar'
                WHEN 'error' THEN 'Gas' END AS fuel_type,
           value AS output_mw, ts AS _published_at, event_id AS _row_id
    FROM events"""),
    ("b_prices", """
    SELECT DATE '2024-01-01' + CAST(c_custkey % 30 AS INTEGER) AS date,
           CAST((c_custkey // 30) % 24 + 1 AS INTEGER) AS hour,
           c_acctbal / 60 AS energy_price, c_custkey AS _row_id
    FROM customer"""),
    ("b_weather", """
    SELECT DATE '2024-01-01' + CAST(p_partkey % 30 AS INTEGER) AS date,
           CAST((p_partkey // 30) % 24 + 1 AS INTEGER) AS hour,
           CAST(p_size * 1.2 - 22 AS DOUBLE) AS temperature_c,
           CAST(p_partkey % 101 AS DOUBLE) AS humidity_pct,
           p_retailprice % 60 AS wind_speed_kmh, p_partkey AS _row_id
    FROM part"""),
    ("b_realtime", """
    SELECT date, hour, interval,
           CAST(e AS DOUBLE) AS total_energy, CAST(l AS DOUBLE) AS total_loss,
           CAST(e - l AS DOUBLE) AS total_load, CAST(r1 AS DOUBLE) AS total_10s,
           CAST(r2 AS DOUBLE) AS total_10n, CAST(r3 AS DOUBLE) AS total_30r
    FROM (
      SELECT CAST(ts AS DATE) AS date, CAST(hour(ts) + 1 AS INTEGER) AS hour,
             CAST(minute(ts) // 5 + 1 AS INTEGER) AS interval,
             sum(CASE WHEN event_type = 'purchase' THEN CAST(0 AS DECIMAL(20,4))
                      ELSE CAST(value AS DECIMAL(20,4)) END) AS e,
             CAST(0.02 AS DECIMAL(3,2)) * sum(CASE WHEN event_type = 'error'
                      THEN CAST(value AS DECIMAL(20,4)) ELSE CAST(0 AS DECIMAL(20,4)) END) AS l,
             coalesce(sum(CAST(value AS DECIMAL(20,4))) FILTER (WHERE event_type = 'click'), 0) AS r1,
             coalesce(sum(CAST(value AS DECIMAL(20,4))) FILTER (WHERE event_type = 'view'), 0) AS r2,
             coalesce(sum(CAST(value AS DECIMAL(20,4))) FILTER (WHERE event_type = 'signup'), 0) AS r3
      FROM events GROUP BY 1, 2, 3)"""),
    ("b_intertie", """
    SELECT DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS date,
           CAST(l_partkey % 24 + 1 AS INTEGER) AS hour,
           l_returnflag AS intertie_zone,
           sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0.0 END) AS schedule_import_mw,
           sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0.0 END) AS schedule_export_mw
    FROM lineitem GROUP BY 1, 2, 3"""),
    ("b_dayahead", """
    SELECT DATE '2024-01-01' + CAST(l_orderkey % 30 AS INTEGER) AS date,
           CAST(l_partkey % 24 + 1 AS INTEGER) AS hour,
           avg(l_extendedprice / 1000) AS da_price
    FROM lineitem GROUP BY 1, 2"""),
    ("s_demand", f"""
    SELECT date, hour, market_demand, region_demand, {TIME_FEATURES},
           {DEMAND_CLASS} AS demand_category,
           market_demand - region_demand AS export_demand
    FROM (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY _row_id DESC) AS rn
          FROM b_demand
          WHERE date IS NOT NULL AND hour IS NOT NULL AND region_demand IS NOT NULL)
    WHERE rn = 1"""),
    ("g_last", """
    SELECT date, hour, fuel_type, output_mw
    FROM (SELECT *, row_number() OVER (PARTITION BY date, hour, fuel_type
                                       ORDER BY _published_at DESC, _row_id DESC) AS rn
          FROM b_generation
          WHERE date IS NOT NULL AND hour IS NOT NULL AND fuel_type IS NOT NULL)
    WHERE rn = 1 AND output_mw IS NOT NULL AND output_mw >= 0"""),
    ("s_gen_wide", "SELECT date, hour, " + ", ".join(
        f"coalesce(max(CASE WHEN fuel_type = '{f.capitalize()}' THEN output_mw END), 0.0) "
        f"AS {f}_mw" for f in FUELS) + " FROM g_last GROUP BY date, hour"),
    ("s_gen_total", f"SELECT *, {_total()} AS total_generation_mw FROM s_gen_wide"),
    ("s_generation", "SELECT *, " + ", ".join(
        f"{PCT(f + '_mw', 'total_generation_mw')} AS {f}_pct" for f in FUELS)
        + f", {PCT(' + '.join(c + '_mw' for c in CLEAN), 'total_generation_mw')}"
          f" AS clean_energy_pct"
        + f", {DIV(' + '.join(c + '_mw' for c in RENEWABLE), 'total_generation_mw')}"
          f" AS renewable_frac"
        + " FROM s_gen_total"),
    ("s_prices", f"""
    SELECT date, hour, energy_price, {PRICE_CLASS} AS price_category, {TIME_FEATURES}
    FROM (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY _row_id DESC) AS rn
          FROM b_prices
          WHERE date IS NOT NULL AND hour IS NOT NULL AND energy_price IS NOT NULL)
    WHERE rn = 1"""),
    ("s_weather", f"""
    SELECT date, hour, temperature_c, humidity_pct, wind_speed_kmh,
           {TEMP_CLASS} AS temp_category, {HVAC} AS hvac_mode, {TIME_FEATURES}
    FROM (SELECT *, row_number() OVER (PARTITION BY date, hour ORDER BY _row_id DESC) AS rn
          FROM b_weather
          WHERE date IS NOT NULL AND hour IS NOT NULL AND temperature_c IS NOT NULL)
    WHERE rn = 1"""),
    ("snapshot", f"""
    SELECT d.*, {', '.join('g.' + f + '_mw' for f in FUELS)}, g.total_generation_mw,
           {', '.join('g.' + f + '_pct' for f in FUELS)}, g.clean_energy_pct, g.renewable_frac,
           p.energy_price, p.price_category,
           w.temperature_c, w.humidity_pct, w.wind_speed_kmh, w.temp_category, w.hvac_mode,
           {_carbon('g.')} AS carbon_intensity_gco2_kwh
    FROM s_demand d
    LEFT JOIN s_generation g ON d.date = g.date AND d.hour = g.hour
    LEFT JOIN s_prices p ON d.date = p.date AND d.hour = p.hour
    LEFT JOIN s_weather w ON d.date = w.date AND d.hour = w.hour"""),
    ("carbon_mart", f"""
    SELECT date, hour, carbon_intensity_gco2_kwh, total_generation_mw, gas_mw, nuclear_mw,
           hydro_mw, wind_mw, solar_mw, clean_energy_pct, season, is_peak_hour, temperature_c,
           {CARBON_CLASS} AS carbon_category
    FROM snapshot"""),
    ("daily_mart", f"""
    SELECT date, season, is_weekday, day_name, year, month,
           {R('avg(region_demand)')} AS avg_demand_mw,
           max(region_demand) AS peak_demand_mw, min(region_demand) AS min_demand_mw,
           {R('avg(energy_price)')} AS avg_price, {R('max(energy_price)')} AS max_price,
           {R('min(energy_price)')} AS min_price,
           {R('avg(nuclear_mw)')} AS avg_nuclear_mw, {R('avg(gas_mw)')} AS avg_gas_mw,
           {R('avg(hydro_mw)')} AS avg_hydro_mw, {R('avg(wind_mw)')} AS avg_wind_mw,
           {R('avg(solar_mw)')} AS avg_solar_mw,
           {R('avg(total_generation_mw)')} AS avg_total_gen_mw,
           {R('avg(clean_energy_pct)')} AS avg_clean_energy_pct,
           {R('avg(carbon_intensity_gco2_kwh)')} AS avg_carbon_intensity,
           {R('avg(temperature_c)')} AS avg_temp_c, {R('max(temperature_c)')} AS max_temp_c,
           {R('min(temperature_c)')} AS min_temp_c
    FROM snapshot GROUP BY date, season, is_weekday, day_name, year, month"""),
]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it (transitively) names."""
    names = [n for n, _ in CTES]
    text = {n: t for n, t in CTES}
    need: set[str] = set()

    def visit(sql: str) -> None:
        import re
        for n in names:
            if n not in need and re.search(rf"\b{n}\b", sql):
                need.add(n)
                visit(text[n])

    visit(body)
    used = [n for n in names if n in need]
    if not used:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({text[n]})" for n in used) + "\n" + body
