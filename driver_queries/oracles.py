"""The same queries in SQL, written independently for DuckDB."""

from __future__ import annotations

SEED = 4224

OCC = """occ AS (
  SELECT o_orderkey AS occ_id, o_orderdate AS event_ts, n_name AS region, c_name AS locality,
    CAST(CASE WHEN o_orderkey % 53 = 0 THEN -999 WHEN o_orderkey % 59 = 0 THEN NULL
              ELSE o_orderkey % 60 END AS DOUBLE) AS dry_days,
    CASE WHEN o_orderkey % 61 = 0 THEN CAST(-999 AS DOUBLE)
         ELSE CAST((o_orderkey * 7) % 1000 AS DOUBLE) / CAST(10 AS DOUBLE) END AS precip,
    CASE WHEN o_orderkey % 67 = 0 THEN CAST(-999 AS DOUBLE) WHEN o_orderkey % 71 = 0 THEN NULL
         ELSE CAST((o_orderkey * 37) % 101 AS DOUBLE) / CAST(100 AS DOUBLE) END AS risk,
    CASE WHEN o_orderkey % 73 = 0 THEN CAST(-999 AS DOUBLE)
         ELSE o_totalprice / CAST(1000 AS DOUBLE) END AS frp,
    CAST(-24 AS DOUBLE) + CAST(c_custkey % 220 AS DOUBLE) / CAST(10 AS DOUBLE) AS lat,
    CAST(-60 AS DOUBLE) + CAST((c_custkey * 3) % 190 AS DOUBLE) / CAST(10 AS DOUBLE) AS lon
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

MEASURED = """dry_days IS NOT NULL AND precip IS NOT NULL AND risk IS NOT NULL AND frp IS NOT NULL"""
NO_SENTINEL = """dry_days IS DISTINCT FROM -999 AND precip IS DISTINCT FROM -999
  AND risk IS DISTINCT FROM -999 AND frp IS DISTINCT FROM -999"""

HIST = OCC + f""", hist AS (
  SELECT occ_id, event_ts, CAST(event_ts AS DATE) AS event_date, region, locality, dry_days, precip,
    risk * CAST(100 AS DOUBLE) AS risk, frp, lat, lon
  FROM occ WHERE {NO_SENTINEL} AND {MEASURED}
)"""

SCORED = HIST + """, scored AS (
  SELECT *, CAST(year(event_date) AS INTEGER) AS year,
    CAST(round_even(greatest(CAST(0 AS DOUBLE), least(CAST(100 AS DOUBLE),
      risk + CAST((occ_id * 13) % 41 - 20 AS DOUBLE))), 0) AS INTEGER) AS predicted
  FROM hist
)"""

JUDGED = SCORED + """, judged AS (
  SELECT *, abs(risk - predicted) AS off,
    CASE WHEN abs(risk - predicted) <= 10 THEN 'ACERTO'
         WHEN predicted > risk THEN 'SOBRE' ELSE 'SUB' END AS result_margem
  FROM scored
)"""

COLOUR = """CASE result_margem WHEN 'ACERTO' THEN 'green' WHEN 'SOBRE' THEN 'orange'
  WHEN 'SUB' THEN 'red' ELSE 'gray' END"""


def uniform(row_id: str, topic: str, slot: int, seed: int = SEED) -> str:
    text = f"md5(concat(CAST({row_id} AS VARCHAR), ':{topic}:{seed}'))"
    part = f"substring({text}, {1 + 8 * slot}, 8)"
    return f"(CAST(CAST('0x' || {part} AS BIGINT) AS DOUBLE) / CAST(4294967296 AS DOUBLE))"


def half_even(value: str, digits: int) -> str:
    scale = f"CAST({10 ** digits} AS DOUBLE)"
    return f"(round_even(({value}) * {scale}, 0) / {scale})"


def normal(topic: str, slot: int) -> str:
    first, second = uniform("row_id", topic, slot), uniform("row_id", topic, slot + 1)
    return (
        f"(sqrt(CAST(-2 AS DOUBLE) * ln(CAST(1 AS DOUBLE) - {first}))"
        f" * cos(CAST(6.283185307179586 AS DOUBLE) * {second}))"
    )


# --- ingest and cleaning -----------------------------------------------------

SPOILED = OCC + """, spoiled AS (
  SELECT occ_id, CASE WHEN occ_id % 11 <> 0 THEN lat END AS lat,
    CASE WHEN occ_id % 13 <> 0 THEN lon END AS lon,
    CASE WHEN occ_id % 17 <> 0 THEN CAST(event_ts AS DATE) END AS event_date
  FROM occ
)"""

LOCATED = "lat IS NOT NULL AND lon IS NOT NULL AND event_date IS NOT NULL"

# Texts are spelt so that both engines print numbers alike: they are parsed again.
DIRTY = OCC + """, dirty AS (
  SELECT occ_id AS id,
    CASE WHEN occ_id % 23 = 0 THEN 'header' WHEN occ_id % 29 = 0 THEN 'bad'
         WHEN occ_id % 31 = 0 THEN NULL ELSE 'day' END AS day_kind,
    CAST(event_ts AS DATE) AS day,
    CASE WHEN occ_id % 37 <> 0 AND occ_id % 41 <> 0 THEN lat END AS lat,
    CASE WHEN occ_id % 43 <> 0 THEN lon END AS lon, precip
  FROM occ
)"""

DIRTY_TEXT = OCC + """, dirty AS (
  SELECT CAST(occ_id AS VARCHAR) AS occ_id,
    CASE WHEN occ_id % 23 = 0 THEN ' event_date ' WHEN occ_id % 29 = 0 THEN 'not a day'
         WHEN occ_id % 31 = 0 THEN NULL
         WHEN occ_id % 2 = 0 THEN strftime(event_ts, '%Y-%m-%d')
         ELSE strftime(event_ts, '%Y/%m/%d') END AS event_date,
    CASE WHEN occ_id % 37 = 0 THEN '12,5' WHEN occ_id % 41 = 0 THEN 'NaN'
         ELSE ' ' || CAST(lat AS VARCHAR) END AS lat,
    CASE WHEN occ_id % 43 = 0 THEN '1d' ELSE CAST(lon AS VARCHAR) END AS lon,
    CAST(precip AS VARCHAR) AS precip
  FROM occ
)"""

TYPED = f"""WITH {HIST} SELECT * FROM hist"""

# --- calendar and features ---------------------------------------------------

MONTH_FLAGS = ", ".join(
    f"CAST(month(event_date) = {m} AS INTEGER) AS month_{m}" for m in range(1, 13)
)

GAPS = OCC + """, gaps AS (
  SELECT occ_id, CASE WHEN occ_id % 19 <> 0 THEN region END AS region, locality,
    coalesce(CASE WHEN occ_id % 19 <> 0 THEN region END, 'nan') AS region_label
  FROM occ
), coded AS (
  SELECT *, CAST(dense_rank() OVER (ORDER BY region_label) - 1 AS INTEGER) AS region_code,
    CAST(dense_rank() OVER (ORDER BY locality) - 1 AS INTEGER) AS locality_code
  FROM gaps
)"""


def standard(name: str) -> str:
    return (
        f"round(({name} - avg({name}) OVER ()) / CASE WHEN stddev_pop({name}) OVER () = 0"
        f" THEN 1 ELSE stddev_pop({name}) OVER () END, 6) AS {name}"
    )


# --- evaluation --------------------------------------------------------------

SCORES = SCORED + """, spread AS (
  SELECT year, avg(abs(risk - predicted)) AS mae,
    sqrt(avg((risk - predicted) * (risk - predicted))) AS rmse,
    sum((risk - predicted) * (risk - predicted)) AS sse, var_pop(risk) * count(*) AS sst,
    avg(CASE WHEN abs(risk - predicted) <= 10 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END)
      AS accuracy,
    count(*) AS n
  FROM scored GROUP BY year
), scores AS (
  SELECT year, round(mae, 6) AS "MAE", round(rmse, 6) AS "RMSE",
    round(CASE WHEN n < 2 THEN CAST('NaN' AS DOUBLE)
               WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1 ELSE 0 END
               ELSE 1 - sse / sst END, 6) AS "R2",
    n, round(accuracy, 6) AS accuracy_margin
  FROM spread
)"""

ERROR_MAP = f"""SELECT lat, lon, year, event_date, risk, predicted, result_margem,
    {COLOUR} AS colour,
    concat('Ano:', year, '<br>Data:', strftime(event_date, '%Y-%m-%d'),
      '<br>Risco_true:', CAST(trunc(risk) AS INTEGER), ' - Risco_pred:', predicted,
      '<br>Resultado:', result_margem) AS popup
  FROM judged"""

# --- profile -----------------------------------------------------------------

PLACES = HIST + """, places AS (
  SELECT lat, lon, region, locality, count(*) AS frequency FROM hist
  GROUP BY lat, lon, region, locality
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY frequency DESC, lat, lon, region, locality) - 1 AS rank
  FROM places
)"""

SHARES = """shares AS (
  SELECT CAST(month(event_date) AS INTEGER) AS month, count(*) AS count,
    CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM hist) AS share
  FROM hist GROUP BY 1
)"""

# --- scenario ----------------------------------------------------------------


def scenario(history: str, total: str = "SELECT count(*) AS n FROM hist") -> str:
    """Steps from a `hist` table to `measured`, the whole scenario."""
    dry_season = "month BETWEEN 5 AND 10"

    def pick(slot: int, dry: tuple[int, int], wet: tuple[int, int], whole: bool) -> str:
        u = uniform("row_id", "range", slot)

        def span(low: int, high: int) -> str:
            if whole:
                return f"{low} + floor({u} * {high - low})"
            return f"{low} + {u} * CAST({high - low} AS DOUBLE)"

        return f"CASE WHEN {dry_season} THEN {span(*dry)} ELSE {span(*wet)} END"

    return history + f""", {SHARES}, total AS ({total}),
planned AS (
  SELECT CAST(m AS INTEGER) AS month, CAST(floor((SELECT n FROM total)
    * coalesce(share, CAST(1 AS DOUBLE) / CAST(12 AS DOUBLE))) AS BIGINT) AS part
  FROM range(1, 13) AS months(m) LEFT JOIN shares ON shares.month = m
), quotas AS (
  SELECT month, CAST(part + CASE WHEN month = 8
    THEN (SELECT n FROM total) - (SELECT sum(part) FROM planned) ELSE 0 END AS BIGINT) AS quota
  FROM planned
), spans AS (
  SELECT month, CAST(sum(greatest(quota, 0)) OVER (ORDER BY month) AS BIGINT) AS upto,
    greatest(quota, 0) AS size FROM quotas
), numbered AS (
  SELECT month, unnest(range(upto - size, upto)) AS row_id FROM spans
), drawn AS (
  SELECT row_id, month, make_date(2026, month, 1 + CAST(floor({uniform("row_id", "place", 0)}
    * day(last_day(make_date(2026, month, 1)))) AS INTEGER)) AS event_date
  FROM numbered
), places2 AS (
  SELECT lat, lon, region, locality, row_number() OVER
    (ORDER BY count(*) DESC, lat, lon, region, locality) - 1 AS rank
  FROM hist GROUP BY lat, lon, region, locality
), size AS (
  SELECT count(*) AS places, greatest(1, count(*) // 3) AS pool FROM places2
), box AS (
  SELECT min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max
  FROM hist
), picked AS (
  SELECT drawn.*, {uniform("row_id", "place", 1)} < 0.5 AS hot,
    CAST(floor({uniform("row_id", "place", 2)} * CASE WHEN {uniform("row_id", "place", 1)} < 0.5
      THEN pool ELSE places END) AS BIGINT) AS rank
  FROM drawn, size
), placed AS (
  SELECT row_id, month, event_date, region, locality,
    {half_even(f'''CASE WHEN hot THEN lat ELSE greatest(lat_min, least(lat_max,
      lat + (CAST(-0.5 AS DOUBLE) + {uniform("row_id", "move", 0)}))) END''', 6)} AS lat,
    {half_even(f'''CASE WHEN hot THEN lon ELSE greatest(lon_min, least(lon_max,
      lon + (CAST(-0.5 AS DOUBLE) + {uniform("row_id", "move", 1)}))) END''', 6)} AS lon
  FROM picked JOIN places2 USING (rank), box
), means AS (
  SELECT CAST(month(event_date) AS INTEGER) AS month, region, avg(dry_days) AS dry_mean,
    avg(precip) AS precip_mean, avg(frp) AS frp_mean
  FROM hist GROUP BY 1, 2
), measured AS (
  SELECT row_id, month, event_date, lat, lon, region, locality,
    CAST(CASE WHEN dry_mean IS NOT NULL
      THEN greatest(0, trunc(dry_mean + {normal("noise-a", 0)} * CAST(5 AS DOUBLE)))
      ELSE {pick(0, (15, 60), (0, 20), True)} END AS INTEGER) AS dry_days,
    {half_even(f'''CASE WHEN dry_mean IS NOT NULL
      THEN greatest(CAST(0 AS DOUBLE), precip_mean + {normal("noise-a", 2)} * CAST(10 AS DOUBLE))
      ELSE {pick(1, (0, 5), (5, 100), False)} END''', 2)} AS precip,
    {half_even(f'''CASE WHEN dry_mean IS NOT NULL
      THEN greatest(CAST(0 AS DOUBLE), frp_mean + {normal("noise-b", 0)} * CAST(20 AS DOUBLE))
      ELSE {pick(2, (30, 150), (10, 80), False)} END''', 2)} AS frp
  FROM placed LEFT JOIN means USING (month, region)
)"""


SCENARIO = scenario(HIST)

DEFAULT_SIZE = scenario(HIST, f"""SELECT 45000 + CAST(floor({uniform("0", "total", 0)}
  * 15001) AS BIGINT) AS n""")

JANUARY = scenario("""hist AS (
  SELECT CAST(ts AS DATE) AS event_date, event_type AS region,
    'user ' || CAST(user_id AS VARCHAR) AS locality, CAST(event_id % 30 AS DOUBLE) AS dry_days,
    CAST(event_id % 40 AS DOUBLE) AS precip, CAST(value AS DOUBLE) AS frp,
    CAST(event_id % 101 AS DOUBLE) AS risk,
    CAST(-24 AS DOUBLE) + CAST(user_id % 200 AS DOUBLE) / CAST(10 AS DOUBLE) AS lat,
    CAST(-60 AS DOUBLE) + CAST(user_id % 150 AS DOUBLE) / CAST(10 AS DOUBLE) AS lon
  FROM events
)""")

FORECAST = SCENARIO + """, risked AS (
  SELECT *, CAST((row_id * 37) % 97 AS DOUBLE) + dry_days AS cluster FROM measured
), percent AS (
  SELECT *, CAST(ceil(CASE WHEN (SELECT max(cluster) FROM risked) > 0
    THEN greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), cluster / (SELECT max(cluster) FROM risked)))
    ELSE CAST(0.5 AS DOUBLE) END * CAST(100 AS DOUBLE)) AS INTEGER) AS risk
  FROM risked
), adjusted AS (
  SELECT * REPLACE (
    CAST(trunc(dry_days * (CAST(1 AS DOUBLE) + CAST(risk AS DOUBLE) / CAST(100 AS DOUBLE)
      * CAST(0.3 AS DOUBLE))) AS INTEGER) AS dry_days,
    precip * (CAST(1 AS DOUBLE) - CAST(risk AS DOUBLE) / CAST(100 AS DOUBLE) * CAST(0.2 AS DOUBLE))
      AS precip,
    frp * (CAST(1 AS DOUBLE) + CAST(risk AS DOUBLE) / CAST(100 AS DOUBLE) * CAST(1.5 AS DOUBLE))
      AS frp)
  FROM percent
)"""

FORECAST_ROWS = f"""region, locality, risk, dry_days, {half_even("precip", 2)} AS precip,
  {half_even("frp", 2)} AS frp, {half_even("lat", 6)} AS lat, {half_even("lon", 6)} AS lon
  FROM adjusted"""

CLUSTERED = HIST + """, clustered AS (
  SELECT *, CAST((occ_id * 31) % 23 AS INTEGER) AS cluster FROM hist
)"""

CLUSTER_PERCENT = CLUSTERED + """, percent AS (
  SELECT * REPLACE (CAST(ceil(CAST(cluster AS DOUBLE) / (SELECT max(cluster) FROM clustered)
    * CAST(100 AS DOUBLE)) AS INTEGER) AS risk)
  FROM clustered
)"""

MODAL = HIST + """, years AS (
  SELECT region AS source_file, CAST(year(event_date) AS INTEGER) AS y, count(*) AS n
  FROM hist GROUP BY 1, 2
), modal AS (
  SELECT source_file, y AS ano FROM (
    SELECT *, row_number() OVER (PARTITION BY source_file ORDER BY n DESC, y) AS place FROM years
  ) WHERE place = 1
), feed AS (
  SELECT source_file, lat, lon, region, locality, CAST(event_date AS TIMESTAMP) AS event_ts, risk,
    dry_days, precip, frp, ano
  FROM hist JOIN modal ON region = source_file
)"""


def sampled(rows: str, size: str) -> str:
    draw = uniform("occ_id", "sample", 0, 42)
    return f"SELECT * FROM ({rows}) ORDER BY {draw}, occ_id LIMIT {size}"


PLANTED_GROUPS = OCC + """, plain AS (
  SELECT occ_id % 3 AS g, CAST(occ_id % 3 * 100 + occ_id % 7 AS DOUBLE) AS a,
    CAST((occ_id % 3) * (occ_id % 3) * 50 + occ_id % 5 AS DOUBLE) AS b FROM occ
), points AS (
  SELECT g, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS x,
    (b - avg(b) OVER ()) / stddev_pop(b) OVER () AS y FROM plain
), centres AS (
  SELECT g AS c, avg(x) AS cx, avg(y) AS cy, var_pop(x) + var_pop(y) AS inner_spread, count(*) AS n
  FROM points GROUP BY 1
), distances AS (
  SELECT g, x, y, c, n, power(x - cx, 2) + power(y - cy, 2) AS off,
    power(x - cx, 2) + power(y - cy, 2) + inner_spread AS mean_square
  FROM points CROSS JOIN centres
), kinds AS (
  SELECT g, x, y, count(*) FILTER (g = c) AS copies,
    max(CASE WHEN g = c THEN off END) AS off,
    max(CASE WHEN g = c THEN mean_square * n / (n - 1) END) AS own,
    min(CASE WHEN g <> c THEN mean_square END) AS other
  FROM distances GROUP BY g, x, y
)"""


LADDER = OCC + """, plain AS (
  SELECT occ_id % 2 AS b0, occ_id // 2 % 2 AS b1, occ_id // 4 % 2 AS b2 FROM occ
), spots AS (
  SELECT b0, b1, b2, CAST(b0 + 40 * b1 + 1600 * b2 AS DOUBLE) AS a FROM plain
), points AS (
  SELECT b0, b1, b2, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS x,
    (3 * a - avg(3 * a) OVER ()) / stddev_pop(3 * a) OVER () AS y FROM spots
)"""


def ladder_step(k: int, group: str) -> str:
    return f"""SELECT CAST({k} AS INTEGER) AS k, abs(round(sum(copies * off), 4)) AS inertia,
  round(sum(copies * (other - own) / greatest(own, other)) / sum(copies), 6) AS silhouette
FROM (
  SELECT g, x, y, count(*) FILTER (g = c) AS copies, max(CASE WHEN g = c THEN off END) AS off,
    max(CASE WHEN g = c THEN (off + spread) * n / (n - 1) END) AS own,
    min(CASE WHEN g <> c THEN off + spread END) AS other
  FROM (
    SELECT g, x, y, c, n, spread, power(x - cx, 2) + power(y - cy, 2) AS off
    FROM (SELECT {group} AS g, x, y FROM points) CROSS JOIN (
      SELECT {group} AS c, avg(x) AS cx, avg(y) AS cy, var_pop(x) + var_pop(y) AS spread, count(*) AS n
      FROM points GROUP BY 1))
  GROUP BY g, x, y)"""


STEP_SCORE = """CAST(20 + CASE WHEN dry_days >= 30 THEN 40 ELSE 0 END
  + CASE WHEN month = 7 THEN 15 ELSE 0 END AS DOUBLE)"""
PLANTED_FORECAST = FORECAST.replace("CAST((row_id * 37) % 97 AS DOUBLE) + dry_days AS cluster", STEP_SCORE + " AS cluster")

ORACLES: dict[str, str] = {
    "quarantined_numbers": f"""WITH {OCC}
SELECT occ_id, array_to_string(list_filter([CASE WHEN occ_id % 47 = 0 THEN 'precip' END,
  CASE WHEN occ_id % 37 = 0 THEN 'lat' END, CASE WHEN occ_id % 43 = 0 THEN 'lon' END],
  lambda c: c IS NOT NULL), ',') AS columns FROM occ""",
    "merged_in_steps": TYPED,
    "planted_scenario": f"WITH {SCENARIO} SELECT *, {STEP_SCORE} AS cluster FROM measured",
    "planted_forecast": f"""WITH {PLANTED_FORECAST}
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, {FORECAST_ROWS}""",
    "planted_ladder": f"""WITH {LADDER} {ladder_step(2, 'b2')}
UNION ALL {ladder_step(4, 'b2 * 2 + b1')} UNION ALL {ladder_step(8, 'b2 * 4 + b1 * 2 + b0')}""",
    "spoiled_file_numbers": f"""WITH {OCC}
SELECT CASE WHEN year(event_ts) % 2 = 0 THEN 'even' ELSE 'odd' END AS part, count(*) AS rows,
  count(*) FILTER (occ_id % 37 = 0) AS lat, count(*) FILTER (occ_id % 43 = 0) AS lon,
  count(*) FILTER (occ_id % 47 = 0) AS precip
FROM occ GROUP BY 1""",
    "missing_columns": f"""WITH {OCC}
SELECT CASE WHEN year(event_ts) % 2 = 0 THEN '' ELSE 'region, frp' END AS lacking, count(*) AS rows
FROM occ GROUP BY 1""",
    "guarded_occurrences": f"WITH {OCC} SELECT * FROM occ WHERE event_ts IS NOT NULL",
    "features_with_sources": f"""WITH {HIST} SELECT occ_id, event_date, region, locality,
  CAST(year(event_date) AS INTEGER) AS year, CAST(dayofyear(event_date) AS INTEGER) AS day_of_year,
  CAST(dense_rank() OVER (ORDER BY region) - 1 AS INTEGER) AS region_code,
  CAST(dense_rank() OVER (ORDER BY locality) - 1 AS INTEGER) AS locality_code FROM hist""",
    "metric_files": f"""WITH {SCORES}
SELECT year, "MAE", "RMSE", "R2", n, accuracy_margin FROM scores""",
    "holdout_quality": f"""WITH {SCORED}, unseen AS (
  SELECT *, risk - predicted AS off FROM scored WHERE {uniform("occ_id", "split", 0)} >= 0.8)
SELECT round(avg(abs(off)), 6) AS "MAE", round(sqrt(avg(off * off)), 6) AS "RMSE",
  round(1 - avg(off * off) / var_pop(risk), 6) AS "R2", count(*) AS n,
  round(avg(CASE WHEN abs(off) <= 10 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6)
    AS accuracy_margin
FROM unseen""",
    "default_quota": f"WITH {DEFAULT_SIZE} SELECT month, quota FROM quotas",
    "forecast_month_files": f"""WITH {FORECAST}
SELECT event_date, CAST(month(event_date) AS INTEGER) AS month, {FORECAST_ROWS}""",
    "planted_forest": f"""WITH {HIST}, steps AS (
  SELECT * REPLACE (CAST(20 + CASE WHEN dry_days >= 30 THEN 40 ELSE 0 END
    + CASE WHEN month(event_date) = 7 THEN 15 ELSE 0 END AS DOUBLE) AS risk) FROM hist)
SELECT occ_id, event_date, region, locality, risk, CAST(risk AS INTEGER) AS predicted FROM steps""",
    "planted_sweep": f"""WITH {PLANTED_GROUPS}
SELECT CAST(3 AS INTEGER) AS k, round(sum(copies * off), 4) AS inertia,
  round(sum(copies * (other - own) / greatest(own, other)) / sum(copies), 6) AS silhouette
FROM kinds""",
    "best_k_of_table": f"""WITH {HIST}, sweep AS (
  SELECT CAST(occ_id % 18 + 2 AS INTEGER) AS k,
    CAST(((occ_id % 18 + 2) * 7) % 6 AS DOUBLE) / CAST(8 AS DOUBLE) AS silhouette FROM hist)
SELECT min(k) AS k, max(silhouette) AS silhouette,
  (SELECT max(silhouette) FROM sweep WHERE k = 12) AS reported_silhouette
FROM sweep WHERE silhouette = (SELECT max(silhouette) FROM sweep)""",
    "drop_sentinels": f"WITH {OCC} SELECT * FROM occ WHERE {NO_SENTINEL}",
    "drop_nulls": f"WITH {OCC} SELECT * FROM occ WHERE {MEASURED}",
    "drop_missing_coords": f"WITH {SPOILED} SELECT * FROM spoiled WHERE {LOCATED}",
    "clean_counts": f"""WITH {SPOILED} SELECT count(*) AS rows_before,
  count(*) FILTER (WHERE {LOCATED}) AS rows_after,
  count(*) FILTER (WHERE NOT ({LOCATED})) AS rows_removed FROM spoiled""",
    "any_invalid_date": f"""WITH {SPOILED}
SELECT bool_or(event_date IS NULL) AS any_invalid FROM spoiled""",
    "rescale_risk": TYPED,
    "union_years": f"""WITH {OCC}
SELECT occ_id, region, precip, CAST(NULL AS DOUBLE) AS frp FROM occ WHERE year(event_ts) % 2 = 0
UNION ALL
SELECT occ_id, region, CAST(NULL AS DOUBLE), frp FROM occ WHERE year(event_ts) % 2 <> 0""",
    "drop_repeated_header": f"""WITH {DIRTY_TEXT} SELECT * FROM dirty
WHERE trim(event_date) IS DISTINCT FROM 'event_date'""",
    "coerce_text": f"""WITH {DIRTY} SELECT CAST(id AS VARCHAR) AS occ_id,
  CASE WHEN day_kind = 'day' THEN day END AS event_date, lat, lon, precip FROM dirty""",
    "distinct_days": f"""WITH {OCC}, days AS (SELECT DISTINCT CAST(event_ts AS DATE) AS day FROM occ),
placed AS (SELECT day, row_number() OVER (ORDER BY day) AS up,
  row_number() OVER (ORDER BY day DESC) AS down, count(*) OVER () AS distinct_days FROM days)
SELECT day, 'first' AS edge, distinct_days FROM placed WHERE up <= 3
UNION ALL SELECT day, 'last', distinct_days FROM placed WHERE down <= 3""",
    "year_filter": f"WITH {OCC} SELECT * FROM occ WHERE year(event_ts) = 1998",
    "csv_yearly_scan": TYPED,
    "merged_table_scan": TYPED,
    "dirty_forecast_scan": f"""WITH {DIRTY} SELECT day AS event_date,
  CASE WHEN id % 5 <> 0 THEN concat('region ', id % 7) END AS region,
  concat('the "', id % 9, '", inland') AS locality, CAST(id % 101 AS DOUBLE) AS risk,
  CASE WHEN id % 47 <> 0 THEN CAST(id % 60 AS DOUBLE) END AS dry_days, precip,
  CAST(id AS DOUBLE) AS frp, lat, lon
FROM dirty WHERE day_kind = 'day' AND lat IS NOT NULL AND lon IS NOT NULL""",
    "month_one_hot": f"WITH {HIST} SELECT occ_id, event_date, {MONTH_FLAGS} FROM hist",
    "calendar_parts": f"""WITH {OCC} SELECT occ_id, event_ts, CAST(year(event_ts) AS INTEGER) AS year,
  CAST(month(event_ts) AS INTEGER) AS month, CAST(day(event_ts) AS INTEGER) AS day,
  CAST(dayofyear(event_ts) AS INTEGER) AS day_of_year,
  CAST(isodow(event_ts) - 1 AS INTEGER) AS weekday,
  CAST(date_trunc('day', event_ts) AS TIMESTAMP) AS midnight FROM occ""",
    "month_lengths": f"""WITH {OCC}, months AS (
  SELECT DISTINCT CAST(year(event_ts) AS INTEGER) AS year, CAST(month(event_ts) AS INTEGER) AS month
  FROM occ)
SELECT year, month, make_date(year, month, 1) AS first_day,
  CAST(day(last_day(make_date(year, month, 1))) AS INTEGER) AS days,
  strftime(make_date(year, month, 1), '%Y-%m-%d') AS first_day_text FROM months""",
    "label_encode": f"""WITH {GAPS}
SELECT occ_id, region, locality, region_code, locality_code FROM coded""",
    "label_decode": f"""WITH {GAPS}
SELECT occ_id, region_code, locality_code, region_label AS region, locality FROM coded""",
    "standardize": f"""WITH {HIST} SELECT occ_id,
  {", ".join(standard(name) for name in ("dry_days", "precip", "frp", "lat", "lon"))} FROM hist""",
    "numeric_only": f"""WITH {HIST}
SELECT occ_id, dry_days, precip, risk, frp, lat, lon FROM hist""",
    "feature_table": f"""WITH {HIST} SELECT occ_id, dry_days, precip, frp, lat, lon, {MONTH_FLAGS},
  CAST(year(event_ts) AS INTEGER) AS year, CAST(dayofyear(event_ts) AS INTEGER) AS day_of_year,
  CAST(dense_rank() OVER (ORDER BY region) - 1 AS INTEGER) AS region_code,
  CAST(dense_rank() OVER (ORDER BY locality) - 1 AS INTEGER) AS locality_code, risk FROM hist""",
    "metrics_by_year": f'WITH {SCORES} SELECT year, "MAE", "RMSE", "R2", n FROM scores',
    "margin_accuracy_by_year": f"WITH {SCORES} SELECT year, accuracy_margin, n FROM scores",
    "metric_chart_feed": f"""WITH {SCORES}
SELECT year, 'MAE' AS metric, "MAE" AS value FROM scores
UNION ALL SELECT year, 'RMSE', "RMSE" FROM scores
UNION ALL SELECT year, 'R2', "R2" FROM scores
UNION ALL SELECT year, 'accuracy_margin', accuracy_margin FROM scores""",
    "outcome_class": f"""WITH {JUDGED}
SELECT occ_id, risk, predicted, result_margem, {COLOUR} AS colour FROM judged""",
    "error_map": f"WITH {JUDGED} {ERROR_MAP} WHERE year = 1998",
    "error_map_sample": f"""WITH {JUDGED}, drawn AS (
  {sampled("SELECT * FROM judged WHERE year = 1998", "500")})
{ERROR_MAP.replace("FROM judged", "FROM drawn")}""",
    "error_center": f"""WITH {SCORED}
SELECT round(median(lat), 6) AS lat, round(median(lon), 6) AS lon FROM scored""",
    "measure_medians": f"""WITH {HIST} SELECT round(median(dry_days), 6) AS dry_days,
  round(median(precip), 6) AS precip, round(median(frp), 6) AS frp,
  round(median(risk), 6) AS risk FROM hist""",
    "error_heat": f"""WITH {JUDGED}, top AS (SELECT max(off) AS largest FROM judged)
SELECT lat, lon, round(off, 6) AS erro_abs,
  round(CASE WHEN (SELECT largest FROM top) > 0 THEN off / (SELECT largest FROM top) ELSE 0 END, 6)
    AS weight FROM judged""",
    "month_share": f"WITH {HIST}, {SHARES} SELECT month, count, round(share, 6) AS share FROM shares",
    "month_region_stats": f"""WITH {HIST} SELECT CAST(month(event_date) AS INTEGER) AS month, region,
  round(avg(dry_days), 6) AS dry_days, round(avg(precip), 6) AS precip, round(avg(frp), 6) AS frp,
  round(avg(risk), 6) AS risk FROM hist GROUP BY 1, 2""",
    "coord_frequency": f"WITH {PLACES} SELECT * FROM places",
    "bounding_box": f"""WITH {HIST} SELECT min(lat) AS lat_min, max(lat) AS lat_max,
  min(lon) AS lon_min, max(lon) AS lon_max FROM hist""",
    "history_report": f"""WITH {PLACES}, {SHARES}, box AS (
  SELECT min(lat) AS lat_min, max(lat) AS lat_max, min(lon) AS lon_min, max(lon) AS lon_max,
    count(*) AS rows FROM hist)
SELECT month, round(share * 100, 6) AS percent, rows, (SELECT count(*) FROM places) AS places,
  lat_min, lat_max, lon_min, lon_max FROM shares, box""",
    "hotspot_rank": f"WITH {PLACES} SELECT * FROM ranked",
    "top_hotspots": f"""WITH {PLACES} SELECT * FROM ranked
WHERE rank < (SELECT greatest(1, count(*) // 3) FROM ranked)""",
    "distinct_coords": f"""WITH {OCC}
SELECT count(*) AS places FROM (SELECT DISTINCT lat, lon FROM occ)""",
    "date_range": f"""WITH {HIST}
SELECT min(event_date) AS first_date, max(event_date) AS last_date FROM hist""",
    "month_quota": f"WITH {SCENARIO} SELECT month, quota FROM quotas",
    "scenario_rows": f"WITH {SCENARIO} SELECT row_id, month, event_date FROM drawn",
    "scenario_coords": f"WITH {SCENARIO} SELECT * FROM placed",
    "scenario_measures": f"WITH {SCENARIO} SELECT * FROM measured",
    "scenario_defaults": f"WITH {JANUARY} SELECT * FROM measured",
    "risk_from_clusters": f"""WITH {CLUSTERED}, means AS (
  SELECT cluster, avg(risk) / 100 AS mean_risk FROM clustered WHERE cluster < 16 GROUP BY 1)
SELECT occ_id, cluster, round(coalesce(mean_risk, CAST(0.5 AS DOUBLE)), 6) AS risk
FROM clustered LEFT JOIN means USING (cluster)""",
    "risk_from_max": f"WITH {CLUSTER_PERCENT} SELECT occ_id, cluster, risk FROM percent",
    "adjust_measures": f"""WITH {CLUSTER_PERCENT} SELECT occ_id, cluster, risk,
  CAST(trunc(dry_days * (CAST(1 AS DOUBLE) + risk / CAST(100 AS DOUBLE) * CAST(0.3 AS DOUBLE)))
    AS INTEGER) AS dry_days,
  precip * (CAST(1 AS DOUBLE) - risk / CAST(100 AS DOUBLE) * CAST(0.2 AS DOUBLE)) AS precip,
  frp * (CAST(1 AS DOUBLE) + risk / CAST(100 AS DOUBLE) * CAST(1.5 AS DOUBLE)) AS frp
FROM percent""",
    "forecast_output": f"""WITH {FORECAST}
SELECT strftime(event_date, '%Y-%m-%d') AS event_date, {FORECAST_ROWS}""",
    "forecast_csv_round_trip": f"WITH {FORECAST} SELECT event_date, {FORECAST_ROWS}",
    "forecast_by_month": f"""WITH {FORECAST}
SELECT CAST(month(event_date) AS INTEGER) AS month, count(*) AS count FROM adjusted GROUP BY 1""",
    "forecast_summary": f"""WITH {FORECAST} SELECT count(*) AS rows, round(avg(risk), 6) AS risk_mean,
  min(risk) AS risk_min, max(risk) AS risk_max, round(avg(dry_days), 6) AS dry_days_mean,
  round(avg(precip), 6) AS precip_mean, round(avg(frp), 6) AS frp_mean FROM adjusted""",
    "cluster_counts": f"WITH {CLUSTERED} SELECT cluster, count(*) AS count FROM clustered GROUP BY 1",
    "modal_year": f"WITH {MODAL} SELECT source_file, ano FROM modal",
    "yearly_map_feed": f"WITH {MODAL} SELECT * FROM feed",
    "map_year_list": f"WITH {MODAL} SELECT DISTINCT ano FROM feed",
    "year_or_latest": f"WITH {MODAL} SELECT * FROM feed WHERE ano = (SELECT max(ano) FROM feed)",
    "year_if_present": f"WITH {SCORED} SELECT occ_id, year FROM scored WHERE year = 1998",
    "forecast_map_feed": f"WITH {FORECAST} SELECT event_date AS event_ts, {FORECAST_ROWS}",
    "exact_sample": f"""WITH {HIST} {sampled(
        "SELECT occ_id, region FROM hist", "(SELECT count(*) // 10 FROM hist)")}""",
    "train_test_split": f"""WITH {HIST} SELECT occ_id,
  CASE WHEN {uniform("occ_id", "split", 0)} < 0.8 THEN 'train' ELSE 'test' END AS part FROM hist""",
}
