"""Readers on small hand-made reports (FIXTURES.md part 3, items 1-5)."""

import datetime as dt


from conftest import write
from voltaic.plans import silver as S
from voltaic.sources import reports as R

DEMAND = """\\Some banner line
\\another banner line
Date,Hour,Market Demand,Ontario Demand
2031-02-03,1,18111,15222
2031-02-03,2,x,15333
2031-02-03,1,18400,15500
"""


def test_demand_report_banner_bad_cell_and_keep_last(spark, tmp_path):
    p = write(f"{tmp_path}/demand/demand_2026.csv", DEMAND)
    raw = R.read_demand_report(spark, p)
    assert raw.columns[:4] == ["date", "hour", "market_demand", "region_demand"]
    rows = {(r.hour, r.market_demand, r.region_demand) for r in raw.collect()}
    assert (2, None, 15333) in rows            # non-numeric cell -> NULL
    assert len(rows) == 3                      # banner lines skipped
    silver = S.demand(raw).orderBy("hour").collect()
    assert [(r.hour, r.region_demand) for r in silver] == [(1, 15500), (2, 15333)]
    assert silver[0].demand_category == "Medium" and silver[0].export_demand == 2900


PRICE = """\\Price report
Date,Hour,HOEP,Hour 1 Predispatch,OR 10 Min Sync
2031-02-03,1,25.5,24.0,1.5
2031-02-03,2,,20.0,1.0
"""


def test_price_report_passes_extra_columns(spark, tmp_path):
    p = write(f"{tmp_path}/prices/p.csv", PRICE)
    raw = R.read_price_report(spark, p)
    assert {"energy_price", "hour_1_predispatch", "or_10_min_sync"} <= set(raw.columns)
    out = S.prices(raw).collect()
    assert len(out) == 1 and out[0].price_category == "Medium"   # NULL price dropped


GEN = """<?xml version="1.0" encoding="UTF-8"?>
<Document xmlns="http://example.org/schema"><DocBody>
<DailyData><Day>2031-02-03</Day>
 <HourlyData><Hour>1</Hour>
  <FuelTotal><Fuel>NUCLEAR</Fuel><EnergyValue><Output>7100</Output></EnergyValue></FuelTotal>
  <FuelTotal><Fuel>GAS</Fuel><EnergyValue><Output></Output></EnergyValue></FuelTotal>
  <FuelTotal><Fuel>WIND</Fuel><EnergyValue><Output>300</Output></EnergyValue></FuelTotal>
 </HourlyData>
 <HourlyData>
  <FuelTotal><Fuel>HYDRO</Fuel><EnergyValue><Output>5</Output></EnergyValue></FuelTotal>
 </HourlyData>
</DailyData>
<DailyData>
 <HourlyData><Hour>2</Hour>
  <FuelTotal><Fuel>HYDRO</Fuel><EnergyValue><Output>5</Output></EnergyValue></FuelTotal>
 </HourlyData>
</DailyData>
</DocBody></Document>
"""


def test_generation_xml(spark, tmp_path):
    p = write(f"{tmp_path}/gen/g.xml", GEN)
    rows = R.read_generation_xml(spark, p).collect()
    got = sorted((r.date, r.hour, r.fuel_type, r.output_mw) for r in rows)
    # empty Output, missing Hour and missing Day are skipped; names title-cased
    assert got == [(dt.date(2031, 2, 3), 1, "Nuclear", 7100.0),
                   (dt.date(2031, 2, 3), 1, "Wind", 300.0)]
    wide = S.generation(R.read_generation_xml(spark, p), features=False).collect()[0]
    assert wide.gas_mw == 0.0 and wide.biofuel_mw == 0.0
    assert wide.total_generation_mw == 7400.0
    assert wide.clean_energy_pct == 100.0


INTERTIE = """<?xml version="1.0"?>
<IMODocument xmlns="http://example.org/imo"><IMODocBody>
<Date>2031-02-03</Date>
<IntertieZone><IntertieZoneName>NORTH</IntertieZoneName>
 <Schedules>
  <Schedule><Hour>1</Hour><Import>10</Import><Export></Export></Schedule>
  <Schedule><Hour>2</Hour><Import>3</Import><Export>4</Export></Schedule>
 </Schedules>
 <Actuals>
  <Actual><Hour>1</Hour><Flow>5</Flow></Actual>
  <Actual><Hour>1</Hour><Flow>6</Flow></Actual>
  <Actual><Hour>1</Hour><Flow>7</Flow></Actual>
  <Actual><Hour>3</Hour><Flow>9</Flow></Actual>
  <Actual><Hour>2</Hour><Flow>4</Flow></Actual>
  <Actual><Hour>2</Hour><Flow></Flow></Actual>
 </Actuals>
</IntertieZone>
</IMODocBody></IMODocument>
"""


def test_intertie_xml_last_actual_wins(spark, tmp_path):
    p = write(f"{tmp_path}/it/i.xml", INTERTIE)
    rows = {r.hour: r for r in R.read_intertie_xml(spark, p).collect()}
    assert set(rows) == {1, 2}                      # actual without schedule dropped
    assert rows[1].schedule_export_mw == 0.0        # empty export is 0
    assert rows[1].actual_flow_mw == 7.0            # last of three actuals
    assert rows[2].actual_flow_mw is None           # empty flow after 4 still wins
    flow = S.intertie(R.read_intertie_xml(spark, p)).orderBy("hour").collect()
    assert [f.flow_direction for f in flow] == ["Import", "Export"]


REALTIME = """SOME TITLE;
\\WRITTEN SOMETIME FOR 2031/02/03
HOUR,INTERVAL,TOTAL ENERGY,TOTAL LOSS,TOTAL LOAD,TOTAL DISP LOAD SCHED OFF,TOTAL 10S,TOTAL 10N,TOTAL 30R

13,1,20100.5,402.1,19698.4,0,1,2,3
13,2,0,0,0,0,1,2,3
"""

REALTIME_NODATE = """SOME TITLE;
HOUR,INTERVAL,TOTAL ENERGY,TOTAL LOSS,TOTAL LOAD
14,1,100,1,99
"""


def test_realtime_report(spark, tmp_path):
    write(f"{tmp_path}/rt/a.csv", REALTIME)
    write(f"{tmp_path}/rt/b.csv", REALTIME_NODATE)
    rows = R.read_realtime_report(spark, f"{tmp_path}/rt").collect()
    good, bad = [r for r in rows if r.date], [r for r in rows if not r.date]
    assert len(good) == 2 and good[0].date == dt.date(2031, 2, 3)
    assert {(r.hour, r.interval, r.total_energy) for r in good} == {(13, 1, 20100.5), (13, 2, 0.0)}
    assert len(bad) == 1 and bad[0].hour == 14     # no FOR banner: NULL date, not today
    ok, rejected = R.split_rejects(R.read_realtime_report(spark, f"{tmp_path}/rt"))
    assert ok.count() == 2 and rejected.count() == 1
    silver = S.realtime(ok).orderBy("interval").collect()
    assert silver[0].loss_pct == round(402.1 / 20100.5 * 100, 2)
    assert silver[1].loss_pct is None              # zero energy: no division error


WEATHER = """{"latitude": 1.0, "hourly": {
 "time": ["2031-02-03T00:00", "2031-02-03T01:00", "2031-02-03T23:00"],
 "temperature_2m": [-3.5, null, 1.0],
 "relative_humidity_2m": [80, 81, 82],
 "wind_speed_10m": [10.0, 11.0, 12.0]}}
"""


def test_weather_json(spark, tmp_path):
    p = write(f"{tmp_path}/w/w.json", WEATHER)
    rows = sorted(R.read_weather_json(spark, p).collect(), key=lambda r: r.hour)
    assert [r.hour for r in rows] == [1, 2, 24]
    assert rows[1].temperature_c is None
    silver = S.weather(R.read_weather_json(spark, p)).orderBy("hour").collect()
    assert len(silver) == 2                         # NULL temperature dropped
    assert (silver[0].temp_category, silver[0].hvac_mode) == ("Cold", "Heating")


def test_backfill_skips_missing_years(spark, tmp_path):
    write(f"{tmp_path}/d/demand_2025.csv",
          "Date,Hour,Market Demand,Ontario Demand\n2025-12-31,24,1,100\n2026-01-01,1,1,200\n")
    write(f"{tmp_path}/d/demand_2026.csv",
          "Date,Hour,Market Demand,Ontario Demand\n2026-01-01,1,1,300\n")
    paths = [f"{tmp_path}/d/demand_{y}.csv" for y in (2024, 2025, 2026)]
    out = R.backfill(spark, R.read_demand_report, paths).collect()
    assert [(r.date.isoformat(), r.hour, r.region_demand) for r in out] == [
        ("2025-12-31", 24, 100), ("2026-01-01", 1, 300)]   # later file wins
    assert R.backfill(spark, R.read_demand_report, [f"{tmp_path}/none.csv"]) is None


def test_canonical_names():
    assert R.canonical_name(" Market Demand ") == "market_demand"


def test_union_of_years_is_by_name(spark, tmp_path):
    """Columns that moved, a column that one file adds, names with blanks."""
    write(f"{tmp_path}/p 1/prices_2024.csv", "\\a banner\nDate,Hour,Hour 1 Predispatch,HOEP\n2024-05-01,1,71.0,60.5\n")
    write(f"{tmp_path}/p 1/prices_2025.csv", "\\a banner\n\\two\nDate,Hour,HOEP,Hour 1 Predispatch,OR 30 Min\n2025-05-01,1,61.5,72.0,3.25\n")
    write(f"{tmp_path}/p 1/prices_2026.csv", "Date,Hour,HOEP,Hour 1 Predispatch,OR 30 Min\n2026-05-01,1,62.5,73.0,\n")
    rows = {r.date.year: r for r in R.read_price_report(spark, f"{tmp_path}/p 1").collect()}
    assert {y: (r.energy_price, r.hour_1_predispatch, r.or_30_min) for y, r in rows.items()} == {
        2024: (60.5, 71.0, None), 2025: (61.5, 72.0, 3.25), 2026: (62.5, 73.0, None)}
    write(f"{tmp_path}/d/demand_2024.csv", "Date,Hour,Ontario Demand,Market Demand\n2024-05-01,1,11000,12000\n")
    write(f"{tmp_path}/d/demand_2025.csv", "Date,Hour,Market Demand,Ontario Demand\n2025-05-01,1,12500,11500\n")
    paths = [f"{tmp_path}/d/demand_{y}.csv" for y in (2024, 2025)]
    out = R.backfill(spark, R.read_demand_report, paths).collect()
    assert [(r.market_demand, r.region_demand) for r in out] == [(12000, 11000), (12500, 11500)]


def test_a_footer_line_has_no_date(spark, tmp_path):
    p = write(f"{tmp_path}/d.csv", "Date,Hour,Market Demand,Ontario Demand\n2024-05-01,1,12000,11000\nTotal,,12000,11000\n")
    ok, rejected = R.split_rejects(R.read_demand_report(spark, p))
    assert ok.count() == 1 and [(r.date, r.hour) for r in rejected.collect()] == [(None, None)]
    x = write(f"{tmp_path}/g.xml", GEN.replace("<Day>2031-02-03</Day>", "<Day>soon</Day>"))
    assert all(r.date is None for r in R.read_generation_xml(spark, x).collect())


def test_intertie_versions_do_not_mix(spark, tmp_path):
    def version(flows, imports):
        actual = "".join(f"<Actual><Hour>1</Hour><Flow>{f}</Flow></Actual>" for f in flows)
        return (f'<D xmlns="http://example.org/i"><IMODocBody><Date>2031-02-03</Date><IntertieZone><IntertieZoneName>NORTH</IntertieZoneName>'
                f"<Schedules><Schedule><Hour>1</Hour><Import>{imports}</Import><Export>0</Export></Schedule></Schedules>"
                f"<Actuals>{actual}</Actuals></IntertieZone></IMODocBody></D>")
    write(f"{tmp_path}/it/i_v1.xml", version([1, 2, 3], 10))
    write(f"{tmp_path}/it/i_v2.xml", version([99], 20))
    rows = R.read_intertie_xml(spark, f"{tmp_path}/it").collect()
    assert [(r.schedule_import_mw, r.actual_flow_mw) for r in rows] == [(20.0, 99.0)]
