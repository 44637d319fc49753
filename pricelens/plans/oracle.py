"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each oracle is one ``WITH`` statement over the raw driver tables: the same
layers (records -> bronze -> silver -> gold -> read) written as plain SQL.
Unreferenced CTEs are never evaluated, so every statement carries the whole
chain.  Rounded columns use the same exact rule as the engine:
``CAST(ROUND(TRY_CAST(x AS DECIMAL(24,8)), n) AS DOUBLE)``.
"""

from __future__ import annotations

import math

from pricelens import config as C
from pricelens.operators import aggregated_fit as AF
from pricelens.operators.forecast import Z80
from pricelens.sources.adapter import (
    NATIONAL_AREA_NAME,
    NATIONAL_DUOAREA,
    PROCESS_NAME,
    PRODUCT_NAMES,
    TYPE_TO_PRODUCT,
    UNITS,
)


def rx(expr: str, n: int) -> str:
    """round_exact in SQL."""
    return f"CAST(ROUND(TRY_CAST(({expr}) AS DECIMAL(24,8)), {n}) AS DOUBLE)"


def _case(col: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} END"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def direction(x: str, null_label: str | None = None) -> str:
    nl = "NULL" if null_label is None else f"'{null_label}'"
    return (f"CASE WHEN ({x}) IS NULL THEN {nl} WHEN ({x}) > 0 THEN 'up' "
            f"WHEN ({x}) < 0 THEN 'down' ELSE 'flat' END")


def floor_zero(x: str) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE GREATEST(0.0::DOUBLE, ({x})) END"


def js_round(x: str) -> str:
    return f"CAST(FLOOR(({x}) + 0.5) AS DOUBLE)"


def nullif_zero(x: str) -> str:
    return f"NULLIF(({x}), 0)"


NAME = _case("product", PRODUCT_NAMES)

_CTES: list[tuple[str, str]] = []


def cte(name: str, body: str) -> None:
    _CTES.append((name, body))


# --- records (source adapter) -------------------------------------------
cte("items", """
  SELECT l_partkey, l_suppkey, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
         CAST(FLOOR(l_extendedprice * 100.0e0 + 0.5e0) AS BIGINT) AS cents,
         CAST(FLOOR(l_quantity + 0.5e0) AS BIGINT) AS qty
  FROM lineitem""")
cte("parts", f"SELECT p_partkey, {_case('p_type', TYPE_TO_PRODUCT)} AS product FROM part")
cte("supplier_region", """
  SELECT s_suppkey, r_regionkey, r_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey""")
cte("regional_agg", """
  SELECT product, 'R' || CAST(r_regionkey AS VARCHAR) AS duoarea, r_name AS area_name,
         CAST(r_regionkey AS INTEGER) AS rk, week, SUM(cents) AS cents, SUM(qty) AS qty
  FROM items JOIN parts ON l_partkey = p_partkey
             JOIN supplier_region ON l_suppkey = s_suppkey
  GROUP BY product, r_regionkey, r_name, week""")
cte("area_agg", f"""
  SELECT product, duoarea, area_name, rk, week, cents, qty FROM regional_agg
  UNION ALL
  SELECT product, '{NATIONAL_DUOAREA}', '{NATIONAL_AREA_NAME}', -1, week, SUM(cents), SUM(qty)
  FROM regional_agg GROUP BY product, week""")
cte("records", f"""
  SELECT strftime(week, '%Y-%m-%d') AS period, duoarea, area_name AS "area-name", product,
         {NAME} AS "product-name", '{PROCESS_NAME}' AS "process-name",
         product || '_' || duoarea AS series,
         area_name || ' ' || {NAME} || ' Retail Price' AS "series-description",
         CASE WHEN week(week) = 53 THEN NULL
              WHEN rk = 4 AND week(week) = 1 THEN 'n/a'
              ELSE CAST(CAST({rx("CAST(cents AS DOUBLE) / CAST(qty AS DOUBLE) / 100000.0e0", 3)}
                             AS DECIMAL(10,3)) AS VARCHAR) END AS value,
         '{UNITS}' AS units
  FROM area_agg""")
# --- bronze / silver -------------------------------------------------------
cte("bronze", f"SELECT DISTINCT * FROM records WHERE product IN {_in(C.INGEST_PRODUCTS)}")
cte("typed", f"""
  SELECT *, TRY_CAST(period AS DATE) AS price_date, TRY_CAST(value AS DOUBLE) AS price_per_gallon,
         CASE WHEN starts_with(product, '{C.DIESEL_PREFIX}') THEN 'Diesel' ELSE 'Gasoline' END
           AS product_category
  FROM bronze""")
cte("silver", """
  SELECT price_date, product, "product-name" AS product_name, product_category, duoarea,
         "area-name" AS area_name, price_per_gallon, series,
         "series-description" AS series_description, units
  FROM typed WHERE price_per_gallon IS NOT NULL""")
# --- gold: weekly summary and regional comparison --------------------------
cte("weekly_w", f"""
  SELECT price_date, product, product_name, product_category, price_per_gallon,
    LAG(price_per_gallon, 1) OVER (PARTITION BY product ORDER BY price_date) AS prev_week_price,
    AVG(price_per_gallon) OVER (PARTITION BY product ORDER BY price_date
                                ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS a4,
    AVG(price_per_gallon) OVER (PARTITION BY product ORDER BY price_date
                                ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS a12,
    LAG(price_per_gallon, 4) OVER (PARTITION BY product ORDER BY price_date) AS price_4wk_ago
  FROM silver
  WHERE area_name = '{C.NATIONAL_AREA}' AND product IN {_in(C.NATIONAL_PRODUCTS)}""")
cte("weekly", f"""
  SELECT price_date, product, product_name, product_category, price_per_gallon, prev_week_price,
    {rx("price_per_gallon - prev_week_price", 4)} AS wow_change,
    {rx("(price_per_gallon - prev_week_price) / NULLIF(prev_week_price, 0) * 100.0", 2)} AS wow_pct_change,
    {rx("a4", 4)} AS avg_4wk,
    {rx("a12", 4)} AS avg_12wk,
    price_4wk_ago,
    {rx("price_per_gallon - price_4wk_ago", 4)} AS mom_change
  FROM weekly_w""")
cte("regional", f"""
  SELECT price_date, product, product_name, product_category, duoarea, area_name,
    price_per_gallon,
    LAG(price_per_gallon, 1) OVER (PARTITION BY product, duoarea ORDER BY price_date) AS prev_week_price,
    {rx("price_per_gallon - LAG(price_per_gallon, 1) OVER (PARTITION BY product, duoarea ORDER BY price_date)", 4)} AS wow_change
  FROM silver WHERE product IN {_in(C.REGIONAL_PRODUCTS)}""")


# --- reads over gold ----------------------------------------------------------
def _latest_regional(product: str) -> str:
    return f"""
  SELECT area_name, duoarea, price_per_gallon, wow_change, price_date, product
  FROM regional
  WHERE product = '{product}'
    AND price_date = (SELECT MAX(price_date) FROM regional WHERE product = '{product}')
    AND area_name <> '{C.NATIONAL_AREA}'"""


cte("diesel_latest", _latest_regional(C.DIESEL_PRODUCT))
cte("snap", """
  SELECT product_name, product_category, price_per_gallon, wow_change, wow_pct_change,
         mom_change, avg_4wk, avg_12wk, price_date, product
  FROM weekly WHERE price_date = (SELECT MAX(price_date) FROM weekly)""")
# --- margins ----------------------------------------------------------------
cte("zones", """
  SELECT 'Z' || CAST(c_custkey AS VARCHAR) AS duoarea, c_name AS zone_name,
         'R' || CAST(n_regionkey AS VARCHAR) AS padd_region,
         CAST(1 + c_custkey % 900 AS INTEGER) AS deliveries_per_week,
         CAST(1 + c_custkey % 60 AS INTEGER) AS avg_miles_per_delivery,
         200.0e0 + CAST(c_custkey % 90 AS DOUBLE) AS revenue_per_delivery,
         100.0e0 + CAST(c_custkey % 80 AS DOUBLE) AS base_cost_per_delivery,
         25.0e0 + CAST(c_custkey % 24 AS DOUBLE) AS latitude,
         -125.0e0 + CAST(c_custkey % 58 AS DOUBLE) AS longitude,
         6.2e0 AS fleet_mpg
  FROM customer JOIN nation ON c_nationkey = n_nationkey""")
cte("latest_prices", f"""
  SELECT duoarea, area_name, price_per_gallon, wow_change, price_date
  FROM regional
  WHERE product = '{C.DIESEL_PRODUCT}'
    AND price_date = (SELECT MAX(price_date) FROM regional WHERE product = '{C.DIESEL_PRODUCT}')""")
_FUEL = "(z.avg_miles_per_delivery / z.fleet_mpg) * p.price_per_gallon"
_MARGIN = f"z.revenue_per_delivery - z.base_cost_per_delivery - {_FUEL}"
cte("margins", f"""
  SELECT z.duoarea, z.zone_name, z.padd_region, p.area_name AS region_name,
         z.deliveries_per_week, z.avg_miles_per_delivery, z.revenue_per_delivery,
         z.base_cost_per_delivery, z.fleet_mpg, z.latitude, z.longitude,
         p.price_per_gallon AS diesel_price, p.wow_change AS diesel_wow_change, p.price_date,
         {rx(_FUEL, 2)} AS fuel_cost_per_delivery,
         {rx(_MARGIN, 2)} AS margin_per_delivery,
         {rx(f"({_MARGIN}) / NULLIF(z.revenue_per_delivery, 0) * 100.0e0", 1)} AS margin_pct,
         {rx(f"{_FUEL} * z.deliveries_per_week", 0)} AS weekly_fuel_cost,
         {rx(f"({_MARGIN}) * z.deliveries_per_week", 0)} AS weekly_margin
  FROM zones z JOIN latest_prices p ON z.padd_region = p.duoarea""")
cte("margin_st", f"""
  SELECT *, CASE WHEN COALESCE(margin_pct, 0) > {C.MARGIN_HEALTHY}e0 THEN 'healthy'
                 WHEN COALESCE(margin_pct, 0) > {C.MARGIN_WATCH}e0 THEN 'watch'
                 WHEN COALESCE(margin_pct, 0) > {C.MARGIN_WARNING}e0 THEN 'warning'
                 ELSE 'critical' END AS status
  FROM margins""")
cte("bridge", """
  SELECT DISTINCT duoarea, state FROM (
    SELECT 'Z' || CAST(c_custkey AS VARCHAR) AS duoarea,
           lpad(CAST(c_custkey % 50 AS VARCHAR), 2, '0') AS state FROM customer
    UNION ALL
    SELECT 'Z' || CAST(c_custkey AS VARCHAR),
           lpad(CAST((c_custkey * 7) % 50 AS VARCHAR), 2, '0') FROM customer)""")
# --- forecasts ----------------------------------------------------------------
cte("fh", f"""
  SELECT product, product_name, price_date, price_per_gallon AS y,
         ROW_NUMBER() OVER (PARTITION BY product ORDER BY price_date) AS t,
         week(price_date) AS woy
  FROM weekly WHERE product IN {_in(C.FORECAST_PRODUCTS)}""")
cte("fstats", """
  SELECT product, COUNT(*) AS n, SUM(t) AS st, SUM(TRY_CAST(y AS DECIMAL(24,8))) AS sy,
         SUM(CAST(t AS BIGINT) * CAST(t AS BIGINT)) AS stt,
         SUM(CAST(t AS DECIMAL(20,0)) * TRY_CAST(y AS DECIMAL(24,8))) AS sty,
         MAX(price_date) AS last_date, arg_min(product_name, price_date) AS first_name
  FROM fh GROUP BY product""")
cte("fcoef", """
  SELECT product, n, last_date, first_name, b,
         (CAST(sy AS DOUBLE) - b * CAST(st AS DOUBLE)) / CAST(n AS DOUBLE) AS a
  FROM (SELECT *, COALESCE(
          (CAST(n AS DOUBLE) * CAST(sty AS DOUBLE) - CAST(st AS DOUBLE) * CAST(sy AS DOUBLE))
          / NULLIF(CAST(n AS DOUBLE) * CAST(stt AS DOUBLE) - CAST(st AS DOUBLE) * CAST(st AS DOUBLE), 0),
          0.0e0) AS b
        FROM fstats)""")
cte("fseason", """
  SELECT s.product, s.woy,
         CAST(s.syw AS DOUBLE) / CAST(s.c AS DOUBLE)
           - (c.a + c.b * (CAST(s.stw AS DOUBLE) / CAST(s.c AS DOUBLE))) AS adj
  FROM (SELECT product, woy, COUNT(*) AS c, SUM(TRY_CAST(y AS DECIMAL(24,8))) AS syw,
               SUM(t) AS stw
        FROM fh GROUP BY product, woy) s
  JOIN fcoef c ON s.product = c.product""")
cte("fhist", """
  SELECT h.product, c.first_name, h.price_date, h.y,
         c.a + c.b * CAST(h.t AS DOUBLE) + COALESCE(s.adj, 0.0e0) AS fit
  FROM fh h JOIN fcoef c ON h.product = c.product
  LEFT JOIN fseason s ON s.product = h.product AND s.woy = h.woy""")
cte("fsigma", "SELECT product, STDDEV_SAMP(y - fit) AS sigma FROM fhist GROUP BY product")
cte("fdates", f"""
  SELECT product, first_name, a, b, n, CAST(k AS INTEGER) AS step, last_date,
         CAST(last_date + CAST((7 - isodow(last_date) % 7) + 7 * (k - 1) AS INTEGER) AS DATE) AS price_date
  FROM fcoef CROSS JOIN generate_series(1, {C.HORIZON_WEEKS}) g(k)""")
cte("ffut", """
  SELECT d.product, d.first_name, d.price_date,
         d.a + d.b * CAST(d.n + d.step AS DOUBLE) + COALESCE(s.adj, 0.0e0) AS fit
  FROM fdates d LEFT JOIN fseason s ON s.product = d.product AND s.woy = week(d.price_date)""")
cte("fcast", f"""
  SELECT price_date, {rx("fit", 6)} AS forecast_price,
         {rx(f"fit - {Z80!r}e0 * sigma", 6)} AS forecast_lower,
         {rx(f"fit + {Z80!r}e0 * sigma", 6)} AS forecast_upper,
         actual_price, product, first_name AS product_name, actual_price IS NULL AS is_forecast
  FROM (SELECT product, first_name, price_date, fit, y AS actual_price FROM fhist
        UNION ALL
        SELECT product, first_name, price_date, fit, NULL FROM ffut) u
  JOIN fsigma USING (product)""")
cte("fwin", f"""
  SELECT price_date, actual_price, forecast_price, forecast_lower, forecast_upper, is_forecast,
         product_name, product
  FROM fcast
  WHERE product = '{C.DIESEL_PRODUCT}'
    AND price_date >= (SELECT MAX(price_date) FROM fcast
                       WHERE actual_price IS NOT NULL AND product = '{C.DIESEL_PRODUCT}')
                      - {C.FORECAST_WINDOW_DAYS}""")
cte("fbridge", """
  SELECT price_date, actual_price, forecast_lower, forecast_upper, is_forecast, product_name,
         product,
         CASE WHEN actual_price IS NOT NULL
                   AND COALESCE(LEAD(is_forecast) OVER (PARTITION BY product ORDER BY price_date), false)
              THEN actual_price ELSE forecast_price END AS forecast_price,
         MIN(CASE WHEN is_forecast THEN price_date END) OVER (PARTITION BY product) AS forecast_start
  FROM fwin""")


def with_chain(select: str, **instead: str) -> str:
    """``select`` behind all layers; ``instead`` names layers defined otherwise."""
    body = ",\n".join(f"{name} AS ({instead.get(name, sql)}\n)" for name, sql in _CTES)
    return f"WITH {body}\n{select}"


def _f(x: float) -> str:
    """A double literal that parses to exactly the same double."""
    return f"{float(x)!r}e0" if "e" not in repr(float(x)) else f"{float(x)!r}"


def _point_sql(avg: str, baseline: str, rate: str, fleet) -> str:
    gal, dl = _f(fleet.gallons_per_delivery), _f(fleet.weekly_deliveries)
    above = f"GREATEST(0.0e0, {avg} - {baseline})"
    extra = f"({above} * {gal})"
    sur = f"({above} / {_f(C.SURCHARGE_STEP)} * {rate})"
    wextra, wrev = f"({extra} * {dl})", f"({sur} * {dl})"
    rec = f"(CASE WHEN {wextra} > 0 THEN {wrev} / {wextra} * 100.0e0 ELSE 100.0e0 END)"
    band = (f"CASE WHEN NOT ({above} > 0) THEN NULL WHEN {rec} >= {_f(C.RECOVERY_GOOD)} THEN 'good' "
            f"WHEN {rec} >= {_f(C.RECOVERY_PARTIAL)} THEN 'partial' ELSE 'poor' END")
    return f"""{rx(avg, 6)} AS avg_price, {baseline} AS baseline_fuel_price, {rate} AS surcharge_rate,
      {rx(above, 6)} AS above_baseline, {rx(extra, 6)} AS extra_fuel_cost_per_delivery,
      {rx(sur, 6)} AS surcharge_per_delivery, {rx(wextra, 6)} AS weekly_extra_fuel_cost,
      {rx(wrev, 6)} AS weekly_surcharge_revenue, {rx(f"{wrev} - {wextra}", 6)} AS weekly_gap,
      {rx(rec, 6)} AS recovery_pct, {rx(f"{gal} * {_f(C.SURCHARGE_STEP)}", 6)} AS break_even_rate,
      {band} AS recovery_band"""


MEAN_SQL = (f"(SELECT COALESCE(CAST(SUM(TRY_CAST(price_per_gallon AS DECIMAL(24,8))) AS DOUBLE)"
            f" / NULLIF(CAST(COUNT(price_per_gallon) AS DOUBLE), 0), {_f(C.DEFAULT_MEAN_PRICE)})"
            f" AS avg_price FROM diesel_latest)")


def gram_sql() -> str:
    """Sums of feature products of the aggregated fit, in whole millionths."""
    turns = [repr(2.0 * math.pi * k / AF.YEAR_DAYS) + "::DOUBLE * d" for k in range(1, AF.YEARLY_ORDER + 1)]
    hinges = [f"greatest(t - {c}, 0)" for c in AF.changepoint_units()]
    waves = [f"CAST(floor({f}({x}) * 1e6::DOUBLE + 0.5::DOUBLE) AS BIGINT)" for f in ("sin", "cos") for x in turns]
    z = ", ".join(["1000000", "t", *hinges, *waves, "yu"])
    return f"""
      SELECT product, i, j, CAST(SUM(CAST(z[i + 1] AS HUGEINT) * z[j + 1]) AS VARCHAR) AS total
      FROM (
        SELECT product, [{z}]::BIGINT[] AS z
        FROM (SELECT product, CAST(price_date - DATE '1970-01-01' AS DOUBLE) AS d,
                     CAST(floor(CAST(price_date - lo AS DOUBLE) / span * 1e6::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS t,
                     CAST(floor(y / top * 1e6::DOUBLE + 0.5::DOUBLE) AS BIGINT) AS yu
              FROM fh JOIN (SELECT product, min(price_date) AS lo, max(abs(y)) AS top,
                                   CAST(greatest(max(price_date) - min(price_date), 1) AS DOUBLE) AS span
                            FROM fh GROUP BY product) USING (product)
              WHERE y IS NOT NULL)),
        (SELECT CAST(range AS INTEGER) AS i FROM range({AF.WIDTH})),
        (SELECT CAST(range AS INTEGER) AS j FROM range({AF.WIDTH}))
      WHERE i <= j GROUP BY product, i, j"""


def oracle_queries(test_baseline: float, test_rate: float) -> dict[str, str]:
    from pricelens.config import Fleet
    fleet = Fleet()
    gal, dl = _f(fleet.gallons_per_delivery), _f(fleet.weekly_deliveries)
    q: dict[str, str] = {}
    rec_cols = ('period, duoarea, "area-name", product, "product-name", "process-name", series, '
                '"series-description", value, units')
    q["paged_ingest"] = with_chain(
        f"SELECT DISTINCT {rec_cols}, 'price_api_v2' AS _source FROM records "
        f"WHERE product IN {_in(C.INGEST_PRODUCTS)}")
    # pages carry the requested products only (the source-side facet)
    asked = f"(SELECT * FROM records WHERE product IN {_in(C.INGEST_PRODUCTS)})"
    q["page_report"] = with_chain(f"""
      SELECT CAST(CEIL(COUNT(*) / {C.PAGE_SIZE}.0) AS BIGINT) AS pages,
             COUNT(*) AS declared_total, COUNT(*) AS records_found,
             (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {asked})) AS distinct_records,
             COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {asked})) AS missing
      FROM {asked}""")
    q["ingest_profile"] = with_chain("""
      SELECT "product-name", COUNT(*) AS row_count, MIN(period) AS earliest, MAX(period) AS latest
      FROM bronze GROUP BY "product-name" """)
    revised = f"CAST(CAST({rx('TRY_CAST(value AS DOUBLE) + 0.01e0', 3)} AS DECIMAL(10,3)) AS VARCHAR)"
    q["keyed_upsert"] = with_chain(f"""
      SELECT {rec_cols}, CAST(_ingested_at AS VARCHAR) AS _ingested_at, _source FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY period, product, duoarea, series
                                     ORDER BY _ingested_at DESC) AS rn
        FROM (SELECT {rec_cols}, TIMESTAMP '2026-01-01 00:00:00' AS _ingested_at,
                     'price_api_v2' AS _source FROM bronze
              UNION ALL
              SELECT period, duoarea, "area-name", product, "product-name", "process-name", series,
                     "series-description", {revised}, units,
                     TIMESTAMP '2026-01-08 00:00:00', 'price_api_v2'
              FROM bronze
              WHERE TRY_CAST(period AS DATE) >= (SELECT MAX(TRY_CAST(period AS DATE)) FROM bronze) - 42))
      WHERE rn = 1""")
    # a first load, then an update: the newest 7 weeks revised, the oldest 10 weeks late
    pdate = "TRY_CAST(period AS DATE)"
    updated = f"""
      SELECT period, duoarea, "area-name", product, "product-name", "process-name", series, "series-description",
             CASE WHEN newest THEN {revised} ELSE value END AS value, units,
             CASE WHEN newest OR late THEN '2026-01-08 00:00:00' ELSE '2026-01-01 00:00:00' END AS _ingested_at
      FROM (SELECT *, {pdate} >= MAX({pdate}) OVER () - 42 AS newest, {pdate} < MIN({pdate}) OVER () + 70 AS late
            FROM records WHERE product IN %s)"""
    q["versioned_merge"] = with_chain(f"SELECT *, 'price_api_v2' AS _source FROM ({updated % _in(C.INGEST_PRODUCTS)})")
    q["incremental_weekly"] = with_chain("SELECT * FROM weekly", bronze=updated % _in(C.NATIONAL_PRODUCTS))
    q["incremental_regional"] = with_chain("SELECT * FROM regional", bronze=updated % _in(C.REGIONAL_PRODUCTS))
    page, per_load = C.TEST_LOAD_PAGE_SIZE, C.TEST_LOAD_PAGE_SIZE * C.TEST_PAGES_PER_LOAD
    q["load_report"] = with_chain(f"""
      SELECT CAST(load AS VARCHAR) AS load, total AS declared_total,
             CAST(CEIL(total / {page}.0) AS BIGINT) AS pages_planned,
             CAST(CEIL(total / {page}.0) AS BIGINT) - lost AS pages_seen, again AS pages_repeated, lost AS pages_lost,
             CASE WHEN lost > 0 THEN CAST({page} AS BIGINT) ELSE -1 END AS first_lost_offset,
             total - missing + again * LEAST({page}, total) AS records_found, total - missing AS records_distinct,
             again * LEAST({page}, total) AS records_overlapping, missing, lost = 0 AS complete
      FROM (SELECT *, CASE WHEN lost > 0 THEN LEAST({page}, total - {page}) ELSE 0 END AS missing
            FROM (SELECT load, total, CAST(load % 3 = 1 AND total > {page} AS BIGINT) AS lost,
                         CAST(load % 3 = 2 AS BIGINT) AS again
                  FROM (SELECT load, LEAST({per_load}, n - load * {per_load}) AS total
                        FROM (SELECT n, UNNEST(RANGE(0, CAST(CEIL(n / {per_load}.0) AS BIGINT))) AS load
                              FROM (SELECT COUNT(*) AS n FROM {asked})))))""")
    q["paged_source"] = with_chain(
        f"SELECT {rec_cols} FROM {asked} WHERE starts_with(product, 'EPM') AND period >= '1995-01-01'")
    q["silver_prices"] = with_chain("SELECT * FROM silver")
    q["silver_rejects"] = with_chain("""
      SELECT * FROM (
        SELECT period, product, duoarea, series, value,
               CASE WHEN value IS NULL THEN 'missing value'
                    WHEN price_per_gallon IS NULL THEN 'unparsable value'
                    WHEN price_date IS NULL THEN 'unparsable period' END AS reason
        FROM typed) WHERE reason IS NOT NULL""")
    q["silver_preview"] = with_chain(f"""
      SELECT * FROM silver WHERE area_name = '{C.NATIONAL_AREA}'
        AND product IN {_in(C.REGIONAL_PRODUCTS)}
      ORDER BY price_date DESC, product, series LIMIT {C.PREVIEW_ROWS}""")
    q["duplicate_keys"] = with_chain("""
      SELECT product, duoarea, series, price_date, COUNT(*) AS n FROM silver
      GROUP BY product, duoarea, series, price_date HAVING COUNT(*) > 1""")
    q["weekly_summary"] = with_chain("SELECT * FROM weekly")
    q["regional_comparison"] = with_chain("SELECT * FROM regional")
    q["weekly_summary_blocked"] = q["weekly_summary"]
    q["regional_comparison_blocked"] = q["regional_comparison"]
    q["weekly_preview"] = with_chain(
        f"SELECT * FROM weekly ORDER BY price_date DESC, product_name, product LIMIT {C.PREVIEW_ROWS}")
    q["snapshot"] = with_chain("SELECT * FROM snap")
    slots = " UNION ALL ".join(f"SELECT {i} AS slot, '{code}' AS slot_product, '{kw}' AS kw"
                               for i, (code, kw) in enumerate(C.SNAPSHOT_SLOTS))
    q["snapshot_cards"] = with_chain(f"""
      SELECT CAST(slot AS INTEGER) AS slot, slot_product, product_name, product, price_per_gallon,
             wow_change, wow_pct_change, avg_4wk, avg_12wk, mom_change, price_date,
             {direction("wow_change")} AS wow_direction, ABS(wow_change) AS wow_abs,
             {direction("wow_pct_change")} AS wow_pct_direction, ABS(wow_pct_change) AS wow_pct_abs
      FROM (SELECT s.slot, s.slot_product, w.*,
                   ROW_NUMBER() OVER (PARTITION BY s.slot
                                      ORDER BY w.product_category, w.product_name, w.product) AS rn
            FROM ({slots}) s JOIN snap w ON contains(w.product_name, s.kw))
      WHERE rn = 1""")
    q["trends"] = with_chain(f"""
      SELECT price_date, price_per_gallon, wow_change, wow_pct_change, avg_4wk, avg_12wk
      FROM weekly WHERE product = 'EPMR' ORDER BY price_date DESC LIMIT {C.DEFAULT_TREND_WEEKS}""")
    q["trends_all"] = with_chain(f"""
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY product ORDER BY price_date DESC) AS rn FROM weekly)
      WHERE rn <= {C.DEFAULT_TREND_WEEKS}""")
    q["products"] = with_chain("SELECT DISTINCT product, product_name, product_category FROM weekly")
    q["regional_latest"] = with_chain("SELECT * FROM diesel_latest")
    q["regional_latest_global"] = with_chain(f"""
      SELECT * FROM regional
      WHERE price_date = (SELECT MAX(price_date) FROM regional) AND product = '{C.DIESEL_PRODUCT}'""")
    both = " UNION ALL ".join(f"({_latest_regional(p)})" for p in C.REGIONAL_PRODUCTS)
    w = "OVER (PARTITION BY product)"
    q["regional_position"] = with_chain(f"""
      SELECT product, price_date, duoarea, area_name, price_per_gallon, wow_change,
             (price_per_gallon - MIN(price_per_gallon) {w})
               / NULLIF(MAX(price_per_gallon) {w} - MIN(price_per_gallon) {w}, 0) * 100.0e0 AS position_pct,
             {direction("wow_change", "flat")} AS direction, ABS(wow_change) AS change_size,
             MIN(price_per_gallon) {w} * 0.9e0 AS axis_min,
             MAX(price_per_gallon) {w} * 1.02e0 AS axis_max
      FROM ({both}) l""")
    q["delivery_margins"] = with_chain("SELECT * FROM margins")
    q["margin_status"] = with_chain("""
      SELECT duoarea, zone_name, margin_pct, status,
             GREATEST(4.0e0, SQRT(deliveries_per_week / 15)) AS marker_radius
      FROM margin_st""")
    q["fleet_totals"] = with_chain("""
      SELECT SUM(weekly_fuel_cost) AS total_weekly_fuel_cost,
             SUM(weekly_margin) AS total_weekly_margin, COUNT(*) AS zone_count,
             COUNT(*) FILTER (WHERE status IN ('warning', 'critical')) AS zones_at_risk
      FROM margin_st""")
    q["state_rollup"] = with_chain("""
      SELECT state, duoarea, zone_name, margin_pct, status, weekly_margin, diesel_price FROM (
        SELECT b.state, m.*, ROW_NUMBER() OVER (PARTITION BY b.state
                                               ORDER BY COALESCE(m.margin_pct, 0), m.duoarea) AS rn
        FROM bridge b JOIN margin_st m ON b.duoarea = m.duoarea)
      WHERE rn = 1""")
    q["fleet_parameters"] = with_chain(f"""
      SELECT *, {rx(f"gallons_per_delivery * {_f(C.SURCHARGE_STEP)}", 6)} AS break_even_rate FROM (
        SELECT CAST(SUM(deliveries_per_week) AS BIGINT) AS weekly_deliveries,
               {rx("SUM(CAST(deliveries_per_week AS DOUBLE) * avg_miles_per_delivery) / SUM(CAST(deliveries_per_week AS DOUBLE))", 6)} AS miles_per_delivery,
               {rx("SUM(CAST(deliveries_per_week AS DOUBLE) * avg_miles_per_delivery / fleet_mpg) / SUM(CAST(deliveries_per_week AS DOUBLE))", 6)} AS gallons_per_delivery
        FROM zones)""")
    q["surcharge_point"] = with_chain(
        f"SELECT {_point_sql('avg_price', _f(test_baseline), _f(test_rate), fleet)} FROM {MEAN_SQL} m")
    lo_b, hi_b, st_b = C.TEST_BASELINE_GRID_CENTS
    lo_r, hi_r, st_r = C.RATE_GRID_CENTS
    q["surcharge_scenarios"] = with_chain(f"""
      SELECT {_point_sql('avg_price', 'b', 'r', fleet)}
      FROM {MEAN_SQL} m,
           (SELECT CAST(i AS DOUBLE) / 100.0e0 AS b FROM generate_series({lo_b}, {hi_b}, {st_b}) g(i)) gb,
           (SELECT CAST(i AS DOUBLE) / 100.0e0 AS r FROM generate_series({lo_r}, {hi_r}, {st_r}) g(i)) gr""")
    q["future_weeks"] = with_chain("SELECT product, last_date, step, price_date FROM fdates")
    q["forecast_linear_seasonal"] = with_chain("SELECT * FROM fcast")
    q["forecast_future"] = with_chain("SELECT * FROM fcast WHERE is_forecast")
    q["forecast_recent"] = with_chain(f"""
      SELECT * FROM fcast WHERE price_date >=
        (SELECT MAX(price_date) FROM fcast WHERE actual_price IS NOT NULL) - {C.FORECAST_RECENT_DAYS}""")
    q["forecast_window"] = with_chain("SELECT * FROM fwin")
    q["trends_sql"], q["regional_sql"] = q["trends"], q["regional_latest"]
    q["forecast_window_sql"] = q["forecast_window"]
    q["forecast_gram"] = with_chain(gram_sql())
    q["forecast_bridge"] = with_chain("SELECT * FROM fbridge")
    above = f"(CASE WHEN price IS NULL THEN NULL ELSE GREATEST(0.0e0, price - {_f(test_baseline)}) END)"
    q["surcharge_series"] = with_chain(f"""
      SELECT product, price_date, {js_round(f"{above} * {gal} * {dl}")} AS extra_fuel_cost,
             {js_round(f"{above} / {_f(C.SURCHARGE_STEP)} * {_f(test_rate)} * {dl}")} AS surcharge_revenue,
             is_forecast
      FROM (SELECT *, COALESCE(NULLIF(actual_price, 0), NULLIF(forecast_price, 0)) AS price FROM fbridge)
      WHERE price_date IS NOT NULL AND price IS NOT NULL""")
    q["data_through"] = with_chain("SELECT MAX(price_date) AS data_through FROM weekly")
    gabove = "(CASE WHEN price IS NULL THEN NULL ELSE GREATEST(0.0e0, price - b) END)"
    q["surcharge_series_grid"] = with_chain(f"""
      SELECT product, price_date, b AS baseline_fuel_price, r AS surcharge_rate,
             {js_round(f"{gabove} * {gal} * {dl}")} AS extra_fuel_cost,
             {js_round(f"{gabove} / {_f(C.SURCHARGE_STEP)} * r * {dl}")} AS surcharge_revenue,
             is_forecast
      FROM (SELECT *, COALESCE(NULLIF(actual_price, 0), NULLIF(forecast_price, 0)) AS price FROM fbridge) s,
           (SELECT CAST(i AS DOUBLE) / 100.0e0 AS b FROM generate_series({lo_b}, {hi_b}, {st_b}) g(i)) gb,
           (SELECT CAST(i AS DOUBLE) / 100.0e0 AS r FROM generate_series({lo_r}, {hi_r}, {st_r}) g(i)) gr
      WHERE price_date IS NOT NULL AND price IS NOT NULL""")
    extra, revenue = f"above * {gal} * {dl}", f"above / {_f(C.SURCHARGE_STEP)} * r * {dl}"
    q["surcharge_totals"] = with_chain(f"""
      SELECT product, b AS baseline_fuel_price, r AS surcharge_rate, weeks_above,
             {rx("above", 6)} AS total_above_baseline, {rx("extra", 6)} AS total_extra_fuel_cost,
             {rx("revenue", 6)} AS total_surcharge_revenue, {rx("revenue - extra", 6)} AS total_gap,
             {rx("recovery", 6)} AS recovery_pct,
             CASE WHEN NOT above > 0 THEN NULL WHEN recovery >= {_f(C.RECOVERY_GOOD)} THEN 'good'
                  WHEN recovery >= {_f(C.RECOVERY_PARTIAL)} THEN 'partial' ELSE 'poor' END AS recovery_band
      FROM (SELECT *, CASE WHEN extra > 0 THEN revenue / extra * 100.0e0 ELSE 100.0e0 END AS recovery
            FROM (SELECT *, {extra} AS extra, {revenue} AS revenue
                  FROM (SELECT product, CAST(i AS DOUBLE) / 100.0e0 AS b,
                               COUNT(*) FILTER (WHERE p > i * 10000) AS weeks_above,
                               CAST(SUM(GREATEST(0, p - i * 10000)) AS DOUBLE) / 1000000.0e0 AS above
                        FROM (SELECT product, CAST(ROUND(CAST(price AS DECIMAL(24,8)), 6) * 1000000 AS BIGINT) AS p
                              FROM (SELECT *, COALESCE(NULLIF(actual_price, 0), NULLIF(forecast_price, 0)) AS price
                                    FROM fcast) f WHERE price IS NOT NULL AND price_date IS NOT NULL) s,
                             generate_series({lo_b}, {hi_b}, {st_b}) g(i)
                        GROUP BY product, i) t,
                       (SELECT CAST(i AS DOUBLE) / 100.0e0 AS r
                        FROM generate_series({lo_r}, {hi_r}, {st_r}) h(i)) gr))""")
    return q
