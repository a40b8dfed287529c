"""Configuration as data.

FIXED VALUES: the constants below must equal the source system's so that
results match.  They are listed plainly and in natural order.
"""

from __future__ import annotations

# --- FIXED VALUES -----------------------------------------------------------

# Fuel seed: fuel_type, fuel_category, is_renewable, carbon_factor_gco2_kwh,
# display_color, display_order.
FUEL_SEED = (
    ("Nuclear", "Baseload", False, 12, "#8B5CF6", 1),
    ("Hydro", "Baseload", True, 24, "#06B6D4", 2),
    ("Wind", "Renewable", True, 11, "#10B981", 3),
    ("Solar", "Renewable", True, 45, "#F59E0B", 4),
    ("Gas", "Peaking", False, 490, "#EF4444", 5),
    ("Biofuel", "Renewable", True, 230, "#84CC16", 6),
)

# Zone seed: zone_code, zone_name, latitude, longitude.
ZONE_SEED = (
    ("NORTHWEST", "Northwest Ontario", 50.0000, -89.0000),
    ("NORTHEAST", "Northeast Ontario", 47.5000, -80.0000),
    ("OTTAWA", "Ottawa", 45.4215, -75.6972),
    ("EAST", "East Ontario", 44.2312, -76.4860),
    ("TORONTO", "Toronto", 43.6532, -79.3832),
    ("ESSA", "Essa", 44.3000, -79.7000),
    ("BRUCE", "Bruce", 44.3264, -81.6000),
    ("SOUTHWEST", "Southwest Ontario", 42.9849, -81.2453),
    ("NIAGARA", "Niagara", 43.0896, -79.0849),
    ("WEST", "West Ontario", 43.2557, -79.8711),
)

# Pivot list of the generation report: the six seed fuels plus "Other",
# whose carbon factor is 0.
FUELS = ("Nuclear", "Hydro", "Wind", "Solar", "Gas", "Biofuel", "Other")
OTHER_FUEL = "Other"
CARBON_FACTORS = {"Nuclear": 12, "Hydro": 24, "Wind": 11, "Solar": 45,
                  "Gas": 490, "Biofuel": 230, "Other": 0}
# Clean share counts nuclear; renewable share (seed flag) does not.
CLEAN_FUELS = ("Nuclear", "Hydro", "Wind", "Solar", "Biofuel")
RENEWABLE_FUELS = ("Hydro", "Wind", "Solar", "Biofuel")
# Fuels that the mix views and panels show, in their order.
MIX_FUELS = ("Nuclear", "Gas", "Hydro", "Wind", "Solar", "Biofuel")
# Fuels the generation report is expected to carry (quality check).
EXPECTED_FUELS = ("Nuclear", "Gas", "Hydro", "Wind", "Solar", "Biofuel")

# Class rules: (operator, bound, label) tried in order, then the default.
DEMAND_CLASSES = ((("<", 15000, "Low"), ("<", 20000, "Medium"),
                   ("<", 25000, "High")), "Extreme")
PRICE_CLASSES = ((("<", 0, "Negative"), ("<", 20, "Low"), ("<", 50, "Medium"),
                  ("<", 100, "High")), "Spike")
TEMPERATURE_CLASSES = ((("<", -10, "Extreme Cold"), ("<", 0, "Cold"),
                        ("<", 15, "Mild"), ("<", 25, "Warm"),
                        ("<", 35, "Hot")), "Extreme Heat")
HVAC_MODES = ((("<", 18, "Heating"), (">", 22, "Cooling")), "Neutral")
FLOW_DIRECTIONS = (((">", 0, "Import"), ("<", 0, "Export")), "Balanced")
CARBON_CLASSES = ((("<", 50, "Very Clean"), ("<", 100, "Clean"),
                   ("<", 200, "Moderate")), "Dirty")
PRICE_REGIMES = (((">", 100, "Spike"), ("<", 0, "Negative")), "Normal")

# Months of each season; any other month is Fall.
SEASONS = (((12, 1, 2), "Winter"), ((3, 4, 5), "Spring"), ((6, 7, 8), "Summer"))
DEFAULT_SEASON = "Fall"
# Peak hours, hour-ending, inclusive.
PEAK_HOURS = (7, 19)
# Hour-ending convention.
HOURS = (1, 24)

# Columns of the carbon mart beside the key and the intensity, grouping columns
# of the daily mart, and the measures whose daily mean is named avg_<measure>.
CARBON_MART_COLUMNS = ("total_generation_mw", "gas_mw", "nuclear_mw", "hydro_mw", "wind_mw",
                       "solar_mw", "clean_energy_pct", "season", "is_peak_hour",
                       "temperature_c")
DAILY_GROUP = ("date", "season", "is_weekday", "day_name", "year", "month")
DAILY_MEAN_COLUMNS = ("nuclear_mw", "gas_mw", "hydro_mw", "wind_mw", "solar_mw")

# Quality bounds.
DEMAND_MIN = 0
DEMAND_MAX = 35000
PRICE_MIN = -100
PRICE_MAX = 10000

# Panel parameters.
PRICE_SPIKE = 100
VERY_CLEAN_LABEL = "Very Clean"
RECENT_DAYS = 7
LAST_DAYS = 14
PREVIEW_ROWS = 100
PRICE_SAMPLE = 500
CARBON_SAMPLE = 800

# --- end of fixed values ----------------------------------------------------

KEYS = ("date", "hour")
# Optional series columns: when a frame carries one (many regions at once),
# it leads every key, grouping and window partition.
SERIES = ("region",)


def series_of(df) -> list[str]:
    """The series columns present in ``df`` (empty for one region)."""
    return [c for c in SERIES if c in df.columns]


def fuel_column(fuel: str, suffix: str = "mw") -> str:
    """``Nuclear`` -> ``nuclear_mw``: lower case, blanks to underscores."""
    return f"{fuel.strip().lower().replace(' ', '_')}_{suffix}"
