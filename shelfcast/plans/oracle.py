"""SQL twins of the registered queries, for a second engine on the same tables."""

from __future__ import annotations

import re

IDS = "id, item_id, dept_id, cat_id, store_id, state_id"

# Named steps; each text may use the names of the others.
CTES: dict[str, str] = {
    "cells": """
        SELECT p_type, p_brand, r_regionkey, r_name, CAST(l_shipdate AS DATE) AS date,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS paid
        FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY ALL""",
    "demand": """
        SELECT p_type || '_ALL' AS id, p_type AS item_id, 'CAT_T_0' AS dept_id, 'CAT_T' AS cat_id,
               'ALL' AS store_id, 'CA' AS state_id, date,
               CAST(sum(units) AS BIGINT) AS sales, CAST(sum(paid) AS BIGINT) AS cents
        FROM cells GROUP BY p_type, date
        UNION ALL
        SELECT p_brand || '_' || r_name, p_brand,
               'CAT_' || (num % 2) || '_' || (num % 3), 'CAT_' || (num % 2), r_name, state, date,
               CAST(sum(units) AS BIGINT), CAST(sum(paid) AS BIGINT)
        FROM (SELECT *, CAST(substr(p_brand, 7) AS INTEGER) AS num,
                     CASE r_regionkey % 3 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' ELSE 'WI' END AS state FROM cells)
        GROUP BY p_brand, r_name, num, state, date""",
    "bounds": "SELECT min(date) AS lo, max(date) AS hi FROM demand",
    "days": """
        SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date, lo FROM bounds""",
    "panel": f"""
        SELECT i.*, x.date, 'd_' || (datediff('day', x.lo, x.date) + 1) AS d, coalesce(s.sales, 0) AS sales
        FROM (SELECT DISTINCT {IDS} FROM demand) i CROSS JOIN days x
        LEFT JOIN demand s ON s.id = i.id AND s.date = x.date""",
    "prices": """
        SELECT store_id, item_id, CAST(floor(datediff('day', lo, date) / 7) AS INTEGER) AS wm_yr_wk,
               CAST((2 * sum(cents) + sum(sales)) // (2 * sum(sales)) AS DOUBLE) / 100 AS sell_price
        FROM demand, bounds GROUP BY 1, 2, 3""",
    "calendar": """
        SELECT date, 'd_' || (datediff('day', lo, date) + 1) AS d,
               CAST(floor(datediff('day', lo, date) / 7) AS INTEGER) AS wm_yr_wk,
               dayname(date) AS weekday, CAST(isodow(date) AS INTEGER) AS wday,
               CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
               CASE WHEN md = 101 THEN 'NewYear' WHEN md = 107 THEN 'OrthodoxChristmas'
                    WHEN md = 214 THEN 'ValentinesDay' WHEN bowl THEN 'SuperBowl'
                    WHEN md = 704 THEN 'IndependenceDay' WHEN md = 1031 THEN 'Halloween'
                    WHEN md = 1225 THEN 'Christmas' END AS event_name_1,
               CASE WHEN md IN (101, 704, 1225) THEN 'National' WHEN md = 107 THEN 'Religious'
                    WHEN md IN (214, 1031) THEN 'Cultural' WHEN bowl THEN 'Sporting' END AS event_type_1,
               CASE WHEN md = 214 AND isodow(date) = 7 THEN 'LentStart' END AS event_name_2,
               CASE WHEN md = 214 AND isodow(date) = 7 THEN 'Religious' END AS event_type_2,
               CAST(datediff('day', lo, date) % 14 >= 7 AND isodow(date) <= 5 AS INTEGER) AS snap_CA,
               CAST(day(date) >= 22 AS INTEGER) AS snap_TX,
               CAST(datediff('day', lo, date) % 14 IN (2, 3, 5, 7, 11, 13) AS INTEGER) AS snap_WI
        FROM (SELECT *, month(date) * 100 + day(date) AS md,
                     month(date) = 2 AND isodow(date) = 7 AND day(date) <= 7 AS bowl FROM days)""",
    "master": """
        SELECT s.id, s.item_id, s.dept_id, s.cat_id, s.store_id, s.state_id, c.date, s.d, c.wm_yr_wk, s.sales,
               coalesce(p.sell_price, 0.0::DOUBLE) AS sell_price, c.weekday,
               CAST(month(c.date) AS INTEGER) AS month, CAST(year(c.date) AS INTEGER) AS year,
               coalesce(event_name_1, '') AS event_name_1, coalesce(event_type_1, '') AS event_type_1,
               coalesce(event_name_2, '') AS event_name_2, coalesce(event_type_2, '') AS event_type_2,
               snap_CA, snap_TX, snap_WI
        FROM panel s JOIN calendar c ON s.d = c.d
        LEFT JOIN prices p ON p.store_id = s.store_id AND p.item_id = s.item_id AND p.wm_yr_wk = c.wm_yr_wk""",
    "lagged": """
        SELECT *, row_number() OVER w AS rn, lag(sales) OVER w AS yday, lag(sell_price) OVER w AS pbefore,
               avg(sell_price) OVER (w ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS price_roll30,
               lag(sales, 7) OVER w AS sales_lag_7, lag(sales, 14) OVER w AS sales_lag_14,
               lag(sales, 28) OVER w AS sales_lag_28, lag(sales, 56) OVER w AS sales_lag_56,
               avg(sales) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS rolling_mean_7,
               avg(sales) OVER (w ROWS BETWEEN 34 PRECEDING AND 7 PRECEDING) AS rolling_mean_28,
               coalesce(stddev_samp(sales) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING), 0) AS rolling_std_7,
               coalesce(stddev_samp(sales) OVER (w ROWS BETWEEN 34 PRECEDING AND 7 PRECEDING), 0) AS rolling_std_28,
               min(sales) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS rolling_min_7,
               max(sales) OVER (w ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS rolling_max_7
        FROM master WINDOW w AS (PARTITION BY id ORDER BY date)""",
    "features": """
        SELECT * EXCLUDE (rn, yday, pbefore),
               CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(week(date) AS INTEGER) AS week_of_year,
               CAST(quarter(date) AS INTEGER) AS quarter, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
               CAST(day(date) = 1 AS INTEGER) AS is_month_start,
               CAST(last_day(date) = date AS INTEGER) AS is_month_end,
               round(sin((isodow(date) - 1) * 2 * pi() / 7), 6) AS dow_sin,
               round(cos((isodow(date) - 1) * 2 * pi() / 7), 6) AS dow_cos,
               round(sin(month(date) * 2 * pi() / 12), 6) AS month_sin,
               round(cos(month(date) * 2 * pi() / 12), 6) AS month_cos,
               CAST(event_type_1 = 'Sporting' AS INTEGER) AS is_sporting,
               CAST(event_type_1 = 'Cultural' AS INTEGER) AS is_cultural,
               CAST(event_type_1 = 'National' AS INTEGER) AS is_national,
               CAST(event_type_1 = 'Religious' AS INTEGER) AS is_religious,
               CAST(event_name_1 <> '' AS INTEGER) AS has_event,
               CASE state_id WHEN 'CA' THEN snap_CA WHEN 'TX' THEN snap_TX WHEN 'WI' THEN snap_WI ELSE 0 END AS snap_active,
               round(coalesce((sell_price - pbefore) / nullif(pbefore, 0), 0), 6) AS price_change_pct,
               CAST(sell_price > 0 AND sell_price < price_roll30 * 0.95::DOUBLE AS INTEGER) AS is_promotion,
               CAST(rn - max(CASE WHEN pbefore IS NULL OR sell_price <> pbefore THEN rn END) OVER w AS INTEGER)
                   AS days_since_price_change,
               CAST(rn - max(CASE WHEN yday IS NULL OR yday <> 0 THEN rn END) OVER w AS INTEGER) AS days_since_last_sale,
               avg(CASE WHEN yday > 0 THEN 1.0::DOUBLE ELSE 0 END)
                   OVER (w ROWS BETWEEN 27 PRECEDING AND CURRENT ROW) AS rolling_nonzero_rate_28
        FROM lagged WINDOW w AS (PARTITION BY id ORDER BY date)""",
    "class_stats": f"""
        SELECT {IDS}, count(*) AS n, count(*) FILTER (sales > 0) AS nz,
               coalesce(pow(stddev_samp(sales) FILTER (sales > 0) / avg(sales) FILTER (sales > 0), 2), 0) AS cv2_raw,
               avg(CASE WHEN sales = 0 THEN 1.0::DOUBLE ELSE 0 END) AS zero_raw,
               coalesce(avg(sales) FILTER (sales > 0), 0) AS mean_raw
        FROM master WHERE date >= (SELECT max(date) FROM master) - 365 GROUP BY {IDS}""",
    "classes": f"""
        SELECT {IDS}, round(adi_raw, 4) AS adi, round(cv2_raw, 4) AS cv2,
               CASE WHEN adi_raw >= 1.32::DOUBLE AND cv2_raw >= 0.49::DOUBLE THEN 'Lumpy'
                    WHEN adi_raw >= 1.32::DOUBLE THEN 'Intermittent'
                    WHEN cv2_raw >= 0.49::DOUBLE THEN 'Erratic' ELSE 'Smooth' END AS demand_class,
               round(zero_raw, 4) AS zero_rate, round(mean_raw, 4) AS mean_nonzero_sales,
               n AS total_periods, nz AS nonzero_periods
        FROM (SELECT *, CASE WHEN nz = 0 THEN 'inf'::DOUBLE ELSE CAST(n AS DOUBLE) / nz END AS adi_raw FROM class_stats)""",
    "routing": """
        SELECT c.id, c.demand_class, r.model FROM classes c JOIN (VALUES
            ('Smooth', 'sarima'), ('Smooth', 'prophet'), ('Erratic', 'prophet'), ('Smooth', 'lgbm'),
            ('Intermittent', 'lgbm'), ('Erratic', 'lgbm'), ('Lumpy', 'lgbm'), ('Smooth', 'lstm'),
            ('Erratic', 'lstm'), ('Intermittent', 'dual_phase'), ('Lumpy', 'dual_phase')
        ) r(demand_class, model) ON r.demand_class = c.demand_class""",
    "usable": "SELECT * FROM features WHERE sales_lag_56 IS NOT NULL",
    "pred_lgbm": """
        SELECT id, date, round(rolling_mean_28, 3) AS lgbm_point, CAST(rolling_min_7 AS DOUBLE) AS lgbm_q10,
               round(rolling_mean_7, 3) AS lgbm_q50, CAST(rolling_max_7 AS DOUBLE) AS lgbm_q90
        FROM usable WHERE id IN (SELECT id FROM routing WHERE model = 'lgbm')""",
    "pred_prophet": """
        SELECT id, date, round((sales_lag_7 + sales_lag_14 + sales_lag_28) / 3.0::DOUBLE, 3) AS prophet_point
        FROM usable WHERE id IN (SELECT id FROM routing WHERE model = 'prophet')""",
    "pred_sarima": """
        SELECT id, date, CAST(sales_lag_7 AS DOUBLE) AS sarima_point
        FROM usable WHERE id IN (SELECT id FROM routing WHERE model = 'sarima')""",
    "pred_lstm": """
        SELECT id, date, round(rolling_mean_7, 3) AS lstm_point
        FROM usable WHERE id IN (SELECT id FROM routing WHERE model = 'lstm')""",
    "pred_dual": """
        SELECT id, date, round(rolling_nonzero_rate_28 * rolling_mean_28, 4) AS dual_point
        FROM usable WHERE id IN (SELECT id FROM routing WHERE model = 'dual_phase')""",
    "active": """
        SELECT id FROM pred_lgbm UNION SELECT id FROM pred_prophet UNION SELECT id FROM pred_sarima
        UNION SELECT id FROM pred_lstm UNION SELECT id FROM pred_dual""",
    "merged": """
        SELECT m.id, m.date, m.sales AS actual, lgbm_point, prophet_point, sarima_point, lstm_point, dual_point,
               c.demand_class
        FROM master m
        LEFT JOIN pred_lgbm l ON l.id = m.id AND l.date = m.date
        LEFT JOIN pred_prophet p ON p.id = m.id AND p.date = m.date
        LEFT JOIN pred_sarima s ON s.id = m.id AND s.date = m.date
        LEFT JOIN pred_lstm t ON t.id = m.id AND t.date = m.date
        LEFT JOIN pred_dual u ON u.id = m.id AND u.date = m.date
        LEFT JOIN classes c ON c.id = m.id
        WHERE m.id IN (SELECT id FROM active)""",
    "gram_rows": """
        SELECT * FROM merged WHERE date > (SELECT max(date) FROM merged) - 56 AND lgbm_point IS NOT NULL
        AND CASE demand_class
            WHEN 'Smooth' THEN prophet_point IS NOT NULL AND sarima_point IS NOT NULL AND lstm_point IS NOT NULL
            WHEN 'Erratic' THEN prophet_point IS NOT NULL AND lstm_point IS NOT NULL
            ELSE dual_point IS NOT NULL END""",
    "served": """
        SELECT * FROM (VALUES ('Smooth', 'lgbm_point'), ('Smooth', 'prophet_point'), ('Smooth', 'sarima_point'),
            ('Smooth', 'lstm_point'), ('Erratic', 'lgbm_point'), ('Erratic', 'prophet_point'),
            ('Erratic', 'lstm_point'), ('Intermittent', 'lgbm_point'), ('Intermittent', 'dual_point'),
            ('Lumpy', 'lgbm_point'), ('Lumpy', 'dual_point')) v(demand_class, model)""",
    "gram_long": """
        SELECT id, date, demand_class, model, f FROM (
            UNPIVOT (SELECT id, date, demand_class, lgbm_point, prophet_point, sarima_point, lstm_point, dual_point,
                            CAST(actual AS DOUBLE) AS actual FROM gram_rows)
            ON lgbm_point, prophet_point, sarima_point, lstm_point, dual_point, actual INTO NAME model VALUE f)""",
    "gram": """
        SELECT a.demand_class, (SELECT count(*) FROM gram_rows g WHERE g.demand_class = a.demand_class) AS n_rows,
               a.model AS x, b.model AS y, sum(a.f * b.f) AS value
        FROM gram_long a JOIN gram_long b ON a.id = b.id AND a.date = b.date
        JOIN served s ON s.demand_class = a.demand_class AND s.model = a.model
        LEFT JOIN served t ON t.demand_class = b.demand_class AND t.model = b.model
        WHERE (b.model = 'actual' OR (t.model IS NOT NULL AND a.model <= b.model))
        GROUP BY a.demand_class, a.model, b.model""",
    "wide_gram": """
        SELECT demand_class, max(n_rows) AS n_rows,
        coalesce(max(value) FILTER (x='dual_point' AND y='dual_point'), 0) + 1 AS dd,
        coalesce(max(value) FILTER (x='dual_point' AND y='lgbm_point'), 0) AS dg,
        coalesce(max(value) FILTER (x='lgbm_point' AND y='lgbm_point'), 0) + 1 AS gg,
        coalesce(max(value) FILTER (x='lgbm_point' AND y='lstm_point'), 0) AS gt,
        coalesce(max(value) FILTER (x='lgbm_point' AND y='prophet_point'), 0) AS gp,
        coalesce(max(value) FILTER (x='lgbm_point' AND y='sarima_point'), 0) AS gs,
        coalesce(max(value) FILTER (x='lstm_point' AND y='lstm_point'), 0) + 1 AS tt,
        coalesce(max(value) FILTER (x='lstm_point' AND y='prophet_point'), 0) AS tp,
        coalesce(max(value) FILTER (x='lstm_point' AND y='sarima_point'), 0) AS ts,
        coalesce(max(value) FILTER (x='prophet_point' AND y='prophet_point'), 0) + 1 AS pp,
        coalesce(max(value) FILTER (x='prophet_point' AND y='sarima_point'), 0) AS ps,
        coalesce(max(value) FILTER (x='sarima_point' AND y='sarima_point'), 0) + 1 AS ss,
        coalesce(max(value) FILTER (x='dual_point' AND y='actual'), 0) AS db,
        coalesce(max(value) FILTER (x='lgbm_point' AND y='actual'), 0) AS gb,
        coalesce(max(value) FILTER (x='lstm_point' AND y='actual'), 0) AS tb,
        coalesce(max(value) FILTER (x='prophet_point' AND y='actual'), 0) AS pb,
        coalesce(max(value) FILTER (x='sarima_point' AND y='actual'), 0) AS sb
        FROM gram WHERE n_rows >= 100 GROUP BY demand_class""",
    # Cyclic coordinate descent on the non-negative ridge loss: another road to the same minimum.
    "descent": """
        SELECT w.*, 0 AS step, 0.0::DOUBLE AS wd, 0.0::DOUBLE AS wg, 0.0::DOUBLE AS wt, 0.0::DOUBLE AS wp, 0.0::DOUBLE AS ws
        FROM wide_gram w
        UNION ALL
        SELECT * EXCLUDE (nd, ng, nt, np, wd, wg, wt, wp, ws), nd, ng, nt, np,
               greatest(0, (sb - gs * ng - ts * nt - ps * np) / ss)
        FROM (SELECT *, greatest(0, (pb - gp * ng - tp * nt - ps * ws) / pp) AS np
        FROM (SELECT *, greatest(0, (tb - gt * ng - tp * wp - ts * ws) / tt) AS nt
        FROM (SELECT *, greatest(0, (gb - dg * nd - gt * wt - gp * wp - gs * ws) / gg) AS ng
        FROM (SELECT * REPLACE (step + 1 AS step), greatest(0, (db - dg * wg) / dd) AS nd
        FROM descent WHERE step < 3000))))""",
    "weights": """
        SELECT demand_class, model, round(CASE WHEN total > 0 THEN w / total ELSE w END, 4) AS weight
        FROM (SELECT demand_class, model, wd + wg + wt + wp + ws AS total,
                     CASE model WHEN 'dual_point' THEN wd WHEN 'lgbm_point' THEN wg WHEN 'lstm_point' THEN wt
                     WHEN 'prophet_point' THEN wp ELSE ws END AS w
              FROM descent JOIN served USING (demand_class) WHERE step = 3000)""",
    "class_weights": """
        SELECT demand_class, sum(weight) AS total, coalesce(sum(weight) FILTER (model = 'lgbm_point'), 0) AS wg,
               coalesce(sum(weight) FILTER (model = 'prophet_point'), 0) AS wp,
               coalesce(sum(weight) FILTER (model = 'sarima_point'), 0) AS ws,
               coalesce(sum(weight) FILTER (model = 'lstm_point'), 0) AS wt,
               coalesce(sum(weight) FILTER (model = 'dual_point'), 0) AS wd
        FROM weights GROUP BY demand_class""",
    "blended": """
        SELECT m.*, CASE
            WHEN total IS NULL THEN greatest(coalesce(lgbm_point, 0), 0)
            WHEN total > 0 THEN round(greatest((coalesce(dual_point, 0) * wd + coalesce(lgbm_point, 0) * wg
                + coalesce(lstm_point, 0) * wt + coalesce(prophet_point, 0) * wp
                + coalesce(sarima_point, 0) * ws) / total, 0), 3)
            ELSE 0 END AS ensemble_point
        FROM merged m LEFT JOIN class_weights w USING (demand_class) WHERE m.demand_class IS NOT NULL""",
    "long_preds": """
        SELECT id, date, demand_class, actual, model, forecast FROM (
            UNPIVOT (SELECT id, date, demand_class, CAST(actual AS DOUBLE) AS actual, lgbm_point, prophet_point,
                            sarima_point, lstm_point, dual_point, ensemble_point FROM blended)
            ON lgbm_point, prophet_point, sarima_point, lstm_point, dual_point, ensemble_point
            INTO NAME model VALUE forecast)""",
    "scales": """
        SELECT id, CASE WHEN avg(s * s) > 0 THEN sqrt(avg(s * s)) ELSE 1 END AS scale
        FROM (SELECT id, CAST(sales - lag(sales) OVER (PARTITION BY id ORDER BY date) AS DOUBLE) AS s FROM master
              WHERE date <= (SELECT max(date) FROM master) - 28) GROUP BY id""",
    "revenue": """
        SELECT id, sum(sales * sell_price) AS revenue FROM master
        WHERE date >= (SELECT max(date) FROM master) - 56 AND date <= (SELECT max(date) FROM master) - 28 GROUP BY id""",
    "rmsse": """
        SELECT b.id, sqrt(avg(pow(actual - coalesce(lgbm_point, 0), 2))) / (any_value(scale) + 1e-10) AS lgbm_point,
               sqrt(avg(pow(actual - coalesce(dual_point, 0), 2))) / (any_value(scale) + 1e-10) AS dual_point,
               sqrt(avg(pow(actual - coalesce(ensemble_point, 0), 2))) / (any_value(scale) + 1e-10) AS ensemble_point,
               any_value(revenue) AS weight
        FROM blended b LEFT JOIN scales s ON s.id = b.id LEFT JOIN revenue r ON r.id = b.id
        WHERE date > (SELECT max(date) FROM blended) - 28 GROUP BY b.id""",
    # Both windows of the scaled error end at the newest forecast date less 28 days.
    "wrmsse": """
        SELECT 'lgbm_point' AS col, sum(weight * lgbm_point) / sum(weight) AS WRMSSE FROM rmsse
        UNION ALL SELECT 'dual_point', sum(weight * dual_point) / sum(weight) FROM rmsse
        UNION ALL SELECT 'ensemble_point', sum(weight * ensemble_point) / sum(weight) FROM rmsse""",
    "level_master": """
        SELECT CASE WHEN grouping(item_id) = 0 THEN 'item' WHEN grouping(store_id) = 0 THEN 'store'
                    WHEN grouping(state_id) = 0 THEN 'state' ELSE 'national' END AS level,
               coalesce(item_id, store_id, state_id, 'all') AS key, date, sum(sales) AS s, sum(sales * sell_price) AS rev
        FROM master GROUP BY GROUPING SETS ((date, item_id), (date, store_id), (date, state_id), (date))""",
    "level_preds": """
        SELECT CASE WHEN grouping(item_id) = 0 THEN 'item' WHEN grouping(store_id) = 0 THEN 'store'
                    WHEN grouping(state_id) = 0 THEN 'state' ELSE 'national' END AS level,
               coalesce(item_id, store_id, state_id, 'all') AS key, date, sum(actual) AS a,
               sum(coalesce(lgbm_point, 0)) AS l, sum(coalesce(ensemble_point, 0)) AS e
        FROM blended b JOIN (SELECT DISTINCT id, item_id, store_id, state_id FROM demand) i ON i.id = b.id
        WHERE date > (SELECT max(date) FROM blended) - 28
        GROUP BY GROUPING SETS ((date, item_id), (date, store_id), (date, state_id), (date))""",
    "level_errors": """
        SELECT p.level, p.key, sqrt(avg(pow(a - l, 2))) / (any_value(scale) + 1e-10) AS l,
               sqrt(avg(pow(a - e, 2))) / (any_value(scale) + 1e-10) AS e, any_value(r) AS r
        FROM level_preds p
        JOIN (SELECT level, key, CASE WHEN avg(d * d) > 0 THEN sqrt(avg(d * d)) ELSE 1 END AS scale
              FROM (SELECT level, key, CAST(s - lag(s) OVER (PARTITION BY level, key ORDER BY date) AS DOUBLE) AS d
                    FROM level_master WHERE date <= (SELECT max(date) FROM master) - 28) GROUP BY level, key) c
          ON c.level = p.level AND c.key = p.key
        JOIN (SELECT level, key, sum(rev) AS r FROM level_master WHERE date >= (SELECT max(date) FROM master) - 56
              AND date <= (SELECT max(date) FROM master) - 28 GROUP BY level, key) v
          ON v.level = p.level AND v.key = p.key
        GROUP BY p.level, p.key""",
    "holidays": """
        SELECT y, unnest([
            {'holiday': 'NewYear', 'day': make_date(y, 1, 1), 'lo': -1, 'hi': 1},
            {'holiday': 'MLK', 'day': mlk, 'lo': 0, 'hi': 0},
            {'holiday': 'PresidentsDay', 'day': pres, 'lo': 0, 'hi': 0},
            {'holiday': 'Easter', 'day': make_date(y, CAST(k // 31 AS INTEGER), CAST(k % 31 + 1 AS INTEGER)), 'lo': 0, 'hi': 0},
            {'holiday': 'MemorialDay', 'day': mem, 'lo': -1, 'hi': 0},
            {'holiday': 'IndependenceDay', 'day': make_date(y, 7, 4), 'lo': -1, 'hi': 1},
            {'holiday': 'LaborDay', 'day': lab, 'lo': -1, 'hi': 0},
            {'holiday': 'Thanksgiving', 'day': thx, 'lo': -2, 'hi': 1},
            {'holiday': 'Christmas', 'day': make_date(y, 12, 25), 'lo': -3, 'hi': 2},
            {'holiday': 'SuperBowl', 'day': bowl, 'lo': -1, 'hi': 0},
            {'holiday': 'ValentinesDay', 'day': make_date(y, 2, 14), 'lo': -1, 'hi': 0},
            {'holiday': 'Halloween', 'day': make_date(y, 10, 31), 'lo': -1, 'hi': 0}]) AS h
        FROM (SELECT *, h0 + l0 - 7 * ((g + 11 * h0 + 22 * l0) // 451) + 114 AS k,
                make_date(y, 1, 15) + CAST((8 - isodow(make_date(y, 1, 15))) % 7 AS INTEGER) AS mlk,
                make_date(y, 2, 15) + CAST((8 - isodow(make_date(y, 2, 15))) % 7 AS INTEGER) AS pres,
                make_date(y, 5, 25) + CAST((8 - isodow(make_date(y, 5, 25))) % 7 AS INTEGER) AS mem,
                make_date(y, 9, 1) + CAST((8 - isodow(make_date(y, 9, 1))) % 7 AS INTEGER) AS lab,
                make_date(y, 11, 22) + CAST((11 - isodow(make_date(y, 11, 22))) % 7 AS INTEGER) AS thx,
                make_date(y, 2, 1) + CAST((14 - isodow(make_date(y, 2, 1))) % 7 AS INTEGER) AS bowl
        FROM (SELECT *, (32 + 2 * (c % 4) + 2 * ((y % 100) // 4) - h0 - (y % 4)) % 7 AS l0
        FROM (SELECT *, (19 * g + c - c // 4 - (c - (c + 8) // 25 + 1) // 3 + 15) % 30 AS h0
        FROM (SELECT *, y % 19 AS g, y // 100 AS c
        FROM (SELECT unnest(generate_series(year(lo) - 1, year(hi) + 1)) AS y FROM bounds)))))""",
    "holiday_days": """
        SELECT CAST(h.day + CAST(o AS INTEGER) AS DATE) AS date, h.holiday AS holiday, CAST(o AS INTEGER) AS "offset"
        FROM (SELECT h, unnest(generate_series(h.lo, h.hi)) AS o FROM holidays)""",
    "holiday_keys": """
        SELECT date, string_agg(k, '+' ORDER BY k) AS hk
        FROM (SELECT DISTINCT date, holiday || ':' || "offset" AS k FROM holiday_days) GROUP BY date""",
    # The panel with 28 empty days after each series; empty days change no fitted value.
    "extended": """
        SELECT id, date, CAST(sales AS DOUBLE) AS y FROM panel
        UNION ALL SELECT id, CAST(unnest(generate_series(hi + 1, hi + 28, INTERVAL 1 DAY)) AS DATE), NULL
        FROM (SELECT id, max(date) AS hi FROM panel GROUP BY id)""",
    "trend_sums": """
        SELECT e.*, hk, row_number() OVER w AS rn, coalesce(sum(y) OVER w, 0) AS cum,
               count(y) OVER (PARTITION BY id) AS n, sum(y) OVER (PARTITION BY id) AS total
        FROM extended e LEFT JOIN holiday_keys k ON k.date = e.date WINDOW w AS (PARTITION BY id ORDER BY e.date)""",
    "trends": """
        SELECT *, CASE WHEN rn <= n THEN (coalesce(ahead, total) - coalesce(behind, 0)) / (least(rn + 182, n) - greatest(rn - 183, 0))
                       ELSE greatest(intercept + slope * rn, 0) END AS trend
        FROM (SELECT *, lead(cum, 182) OVER w AS ahead, lag(cum, 183) OVER w AS behind,
                     regr_slope(CASE WHEN rn > n - 182 THEN y END, rn) OVER (PARTITION BY id) AS slope,
                     regr_intercept(CASE WHEN rn > n - 182 THEN y END, rn) OVER (PARTITION BY id) AS intercept,
                     datediff('day', DATE '1970-01-01', date) * 2 % 61 // 2 AS cycle
              FROM trend_sums WHERE n >= 60 WINDOW w AS (PARTITION BY id ORDER BY date))""",
    "weekly": """
        SELECT *, y / nullif(trend, 0) AS ratio,
               (coalesce(sum(y / nullif(trend, 0)) OVER w, 0) + 5) / (count(y / nullif(trend, 0)) OVER w + 5) AS fw
        FROM trends WINDOW w AS (PARTITION BY id, isodow(date))""",
    "yearly": """
        SELECT *, (coalesce(sum(ratio / fw) OVER w, 0) + 5) / (count(ratio) OVER w + 5) AS fy
        FROM weekly WINDOW w AS (PARTITION BY id, month(date))""",
    "monthly": """
        SELECT *, (coalesce(sum(ratio / fw / fy) OVER w, 0) + 5) / (count(ratio) OVER w + 5) AS fm
        FROM yearly WINDOW w AS (PARTITION BY id, cycle)""",
    "products": """
        SELECT *, trend * fw * fy * fm * CASE WHEN hk IS NULL THEN 1 ELSE
               (coalesce(sum(ratio / fw / fy / fm) OVER w, 0) + 5) / (count(ratio) OVER w + 5) END AS point
        FROM monthly WINDOW w AS (PARTITION BY id, hk)""",
    "decomposed": """
        SELECT id, date, rn > n AS ahead_of_data, round(greatest(point, 0), 4) AS prophet_point,
               round(greatest(point * quantile_cont(y / nullif(point, 0), 0.1) OVER w, 0), 4) AS prophet_lower,
               round(greatest(point * quantile_cont(y / nullif(point, 0), 0.9) OVER w, 0), 4) AS prophet_upper,
               round(trend, 4) AS trend
        FROM products WINDOW w AS (PARTITION BY id)""",
    "steps": """
        SELECT id, date, y, rn, before, step, lag(step) OVER w AS a, lag(step, 7) OVER w AS b, lag(step, 8) OVER w AS c
        FROM (SELECT id, date, CAST(sales AS DOUBLE) AS y, row_number() OVER w AS rn, lag(sales) OVER w AS before,
                     CAST(sales - lag(sales) OVER w AS DOUBLE) AS step FROM panel WINDOW w AS (PARTITION BY id ORDER BY date))
        WINDOW w AS (PARTITION BY id ORDER BY date)""",
    # Three regressors, solved by determinants.
    "ar_fit": """
        SELECT id, (ya * (bb * cc - bc * bc) - ab * (yb * cc - bc * yc) + ac * (yb * bc - bb * yc)) / det AS wa,
               (aa * (yb * cc - bc * yc) - ya * (ab * cc - bc * ac) + ac * (ab * yc - yb * ac)) / det AS wb,
               (aa * (bb * yc - yb * bc) - ab * (ab * yc - yb * ac) + ya * (ab * bc - bb * ac)) / det AS wc
        FROM (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det
              FROM (SELECT id, sum(a * a) aa, sum(a * b) ab, sum(a * c) ac, sum(b * b) bb, sum(b * c) bc, sum(c * c) cc,
                           sum(step * a) ya, sum(step * b) yb, sum(step * c) yc
                    FROM steps WHERE rn >= 10 GROUP BY id))""",
    "week_steps": """
        SELECT *, lag(w) OVER (PARTITION BY id ORDER BY date) AS a
        FROM (SELECT id, date, row_number() OVER v AS rn, lag(sales, 7) OVER v AS before, CAST(sales - lag(sales, 7) OVER v AS DOUBLE) AS w
              FROM panel WINDOW v AS (PARTITION BY id ORDER BY date))""",
    "both_steps": """
        SELECT id, date, sales, row_number() OVER v AS rn, count(*) OVER (PARTITION BY id) AS n,
               CAST(sales - lag(sales) OVER v - lag(sales, 7) OVER v + lag(sales, 8) OVER v AS DOUBLE) AS w
        FROM panel WINDOW v AS (PARTITION BY id ORDER BY date)""",
}


def with_steps(body: str) -> str:
    """The query with every step it needs, in order."""
    needed: list[str] = []

    def visit(text: str, seen: tuple[str, ...]) -> None:
        for name in CTES:
            if name not in needed and name not in seen and re.search(rf"(FROM|JOIN|,)\s+{name}\b", text):
                visit(CTES[name], (*seen, name))
                needed.append(name)

    visit(body, ())
    steps = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in needed)
    recursive = "RECURSIVE " if "descent" in needed else ""
    return f"WITH {recursive}{steps}\n{body.strip()}" if steps else body.strip()
