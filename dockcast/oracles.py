"""The same results in plain SQL over the given tables, written independently of the Spark code."""

from __future__ import annotations

_STATUS = """status AS (
  SELECT user_id AS station_id, ts AS ts_local, value AS num_bikes_available, event_id, event_type, props FROM events
)"""
_HOURLY = """hourly AS (
  SELECT * REPLACE (date_trunc('hour', ts_local)::TIMESTAMP AS ts_local) FROM status
)"""
_UNIQ = """uniq AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id, ts_local ORDER BY event_id) AS rn FROM hourly
  ) WHERE rn = 1
)"""
_READY = """hist AS (
  SELECT *,
    lag(num_bikes_available, 1) OVER w AS y_lag1,
    lag(num_bikes_available, 2) OVER w AS y_lag2,
    CASE WHEN count(num_bikes_available) OVER w3 = 3 THEN avg(num_bikes_available) OVER w3 END AS y_ma3
  FROM uniq
  WINDOW w AS (PARTITION BY station_id ORDER BY ts_local),
         w3 AS (PARTITION BY station_id ORDER BY ts_local ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)
), ready AS (
  SELECT *,
    hour(ts_local)::INTEGER AS hour,
    (isodow(ts_local) - 1)::INTEGER AS dow,
    (CASE WHEN isodow(ts_local) >= 6 THEN 1 ELSE 0 END)::INTEGER AS is_weekend,
    month(ts_local)::INTEGER AS month,
    sin(2 * pi() * hour(ts_local) / 24.0::DOUBLE) AS hour_sin,
    cos(2 * pi() * hour(ts_local) / 24.0::DOUBLE) AS hour_cos
  FROM hist WHERE y_lag1 IS NOT NULL AND y_lag2 IS NOT NULL AND y_ma3 IS NOT NULL
)"""
_TIMES = """times AS (
  SELECT ts_local, row_number() OVER (ORDER BY ts_local) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT DISTINCT ts_local FROM ready)
)"""
_LABELLED = """cuts AS (
  SELECT max(ts_local) FILTER (WHERE i = trunc(n * 0.7::DOUBLE)) AS c1,
         max(ts_local) FILTER (WHERE i = trunc(n * (0.7::DOUBLE + 0.15::DOUBLE))) AS c2
  FROM times
), labelled AS (
  SELECT r.*, CASE WHEN ts_local <= c1 THEN 'train' WHEN ts_local <= c2 THEN 'val' ELSE 'test' END AS split
  FROM ready r, cuts
)"""
_FOLDS = """shares(fold, p) AS (VALUES (1, 0.5::DOUBLE), (2, 0.625::DOUBLE), (3, 0.75::DOUBLE)),
folds AS (
  SELECT fold::INTEGER AS fold, max(ts_local) FILTER (WHERE i = trunc(n * p)) AS train_end,
         max(ts_local) FILTER (WHERE i = least(n - 1, trunc(n * (p + 0.15::DOUBLE)))) AS val_end
  FROM times, shares GROUP BY fold
), folded AS (
  SELECT r.*, f.*, CASE WHEN r.ts_local <= f.train_end THEN 'train' ELSE 'val' END AS part
  FROM ready r JOIN folds f ON r.ts_local <= f.val_end
)"""
_STATIONS = """stations AS (
  SELECT c_custkey AS station_id, c_name AS name,
    -34.60::DOUBLE + (c_custkey % 100)::DOUBLE * 0.001::DOUBLE AS lat,
    -58.40::DOUBLE + ((c_custkey * 7) % 100)::DOUBLE * 0.001::DOUBLE AS lon,
    (40 + c_custkey % 60)::DOUBLE AS capacity
  FROM customer
)"""
_OBS = """obs AS (SELECT station_id, ts_local AS ts, num_bikes_available AS y, event_id FROM status)"""


def _grid(slots: str = "('09:00'), ('13:00'), ('16:00'), ('20:00')") -> str:
    return f"""labels(slot_label) AS (VALUES {slots}), span AS (SELECT min(ts) AS low, max(ts) AS high FROM obs),
grid AS (
  SELECT station_id, d + (slot_label || ':00')::INTERVAL AS t_slot, slot_label
  FROM (SELECT DISTINCT station_id FROM obs), span, labels,
       unnest(generate_series(date_trunc('day', low)::TIMESTAMP, date_trunc('day', high)::TIMESTAMP, INTERVAL 1 DAY)) AS g(d)
  WHERE d + (slot_label || ':00')::INTERVAL BETWEEN low AND high
)"""


def _targets(minutes: int) -> str:
    return f"""{_grid()}, targets AS (
  SELECT g.station_id, g.t_slot, g.slot_label,
    CASE WHEN g.t_slot - o.ts <= INTERVAL {minutes} MINUTE THEN o.y END AS y,
    'preprocess/slots_v1' AS generated_from, 10::INTEGER AS lead_minutes,
    CASE WHEN g.t_slot - o.ts <= INTERVAL {minutes} MINUTE THEN o.ts END AS ts_matched
  FROM grid g ASOF LEFT JOIN obs o ON g.station_id = o.station_id AND g.t_slot >= o.ts
)"""


def _latest_forecast(clip: bool = False) -> str:
    """The recursion h = 1, 3, 6, 12 written out step by step."""
    bound = "least(greatest({}, 0.0::DOUBLE), capacity)" if clip else "{}"
    score = bound.format("0.6::DOUBLE * l1 + 0.3::DOUBLE * l2 + 0.1::DOUBLE * m")
    steps, source = [], "s0"
    for i, h in enumerate((1, 3, 6, 12), start=1):
        steps.append(
            f"""s{i} AS (
  SELECT station_id, capacity, t0, yhat, {h} AS h, yhat AS l1, l1 AS l2, (yhat + l1 + l2) / 3 AS m
  FROM (SELECT *, {score} AS yhat FROM (SELECT station_id, capacity, t0, l1, l2, m FROM {source}))
)"""
        )
        source = f"s{i}"
    every = " UNION ALL ".join(f"SELECT station_id, t0, h, yhat FROM s{i}" for i in range(1, 5))
    return f"""latest AS (
  SELECT * FROM ready QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ts_local DESC) = 1
), s0 AS (
  SELECT station_id, s.capacity, (SELECT max(ts_local) FROM latest) AS t0, y_lag1 AS l1, y_lag2 AS l2, y_ma3 AS m
  FROM latest JOIN stations s USING (station_id)
), {", ".join(steps)}, forecast AS (
  SELECT station_id, t0 + h * INTERVAL 1 HOUR AS timestamp_pred, h::INTEGER AS h, yhat FROM ({every})
)"""


def _r(expr: str, digits: int = 6, name: str | None = None) -> str:
    return f"round({expr}, {digits}) + 0.0::DOUBLE AS {name or expr}"


def _metrics(y: str, p: str) -> dict[str, str]:
    known = f"FILTER (({y}) IS NOT NULL AND ({p}) IS NOT NULL)"
    sse, sst = f"sum(({y} - {p}) * ({y} - {p}))", f"(var_pop({y}) {known} * count(*) {known})"
    return {
        "rmse": f"sqrt(avg(({y} - {p}) * ({y} - {p})))",
        "mae": f"avg(abs({y} - {p}))",
        "r2": f"CASE WHEN {sst} > 0 THEN 1 - {sse} / {sst} WHEN {sse} = 0 THEN 1.0 ELSE 0.0 END",
    }


def _metric_list(y: str, p: str, digits: int = 6) -> str:
    return ", ".join(_r(e, digits, n) for n, e in _metrics(y, p).items())


def _raw_metric_list(y: str, p: str) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in _metrics(y, p).items())


_Y = "num_bikes_available"
_BASE = ", ".join([_STATUS, _HOURLY, _UNIQ, _READY])
_SPLIT = ", ".join([_BASE, _TIMES, _LABELLED])
_FOLDED = ", ".join([_BASE, _TIMES, _FOLDS])
_METRICS_LONG = f"""metrics_long AS (
  SELECT event_type AS framework, split, {_raw_metric_list(_Y, "coalesce(y_lag1, 0)")} FROM labelled GROUP BY event_type, split
)"""
_WIDE_COLUMNS = ("val_rmse", "val_mae", "val_r2", "test_rmse", "test_mae", "test_r2")
_WIDE_CELLS = ", ".join(
    f"{f}({m}) FILTER (WHERE split = '{s}') AS {s}_{m}" for s in ("val", "test") for m, f in (("rmse", "min"), ("mae", "min"), ("r2", "max"))
)
_BOARD = f"""{_SPLIT}, {_METRICS_LONG}, board AS (
  SELECT framework, {_WIDE_CELLS} FROM metrics_long WHERE split IN ('val', 'test') GROUP BY framework
)"""
_WIDE_ROUNDED = ", ".join(_r(c) for c in _WIDE_COLUMNS)
_FORECAST = ", ".join([_BASE, _STATIONS, _latest_forecast()])
_CLIPPED = ", ".join([_BASE, _STATIONS, _latest_forecast(clip=True)])
_SLOT_BASE = f"{_STATUS}, {_OBS}"
_LIGHT = """CASE WHEN pct IS NULL THEN 'gris' WHEN bikes <= 0 THEN 'rojo' WHEN pct >= 50 THEN 'verde'
  WHEN pct > 0 THEN 'amarillo' ELSE 'rojo' END"""
_LIGHT_HEX = "CASE light WHEN 'verde' THEN '#2ecc71' WHEN 'amarillo' THEN '#f1c40f' WHEN 'rojo' THEN '#e74c3c' ELSE '#95a5a6' END"
_LIGHT_RGB = "CASE light WHEN 'verde' THEN '0,180,0' WHEN 'amarillo' THEN '240,200,0' WHEN 'rojo' THEN '220,0,0' ELSE '160,160,160' END"
_SERVED = f"""{_FORECAST}, served AS (
  SELECT *, {_LIGHT} AS light FROM (
    SELECT station_id, name, lat, lon, capacity, round_even(yhat, 1) AS bikes, round_even(capacity - yhat, 1) AS docks_pred,
      round_even(yhat / capacity * 100, 1) AS pct, round_even((capacity - yhat) / capacity * 100, 1) AS pct_docks
    FROM forecast JOIN stations USING (station_id) WHERE h = 1
  )
)"""


def _haversine(a: str, b: str) -> str:
    lat1, lon1, lat2, lon2 = f"{a}lat", f"{a}lon", f"{b}lat", f"{b}lon"
    inner = (
        f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
    )
    return f"(2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE, greatest(0.0::DOUBLE, {inner})))))"


_NEAR = f"""{_SERVED}, near AS (
  SELECT f.station_id AS focus_id, o.*, {_haversine("f.", "o.")} AS distance
  FROM served f JOIN served o ON f.station_id <> o.station_id AND o.light IN ('verde', 'amarillo')
  WHERE {_haversine("f.", "o.")} <= 800
)"""
def _cube(lat: str, lon: str, side: float) -> str:
    """The cube of a side that a position lies in, as text."""
    r = "6371000.0::DOUBLE"
    axes = (f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))")
    return " || ',' || ".join(f"floor({r} * {a} / {side})::INTEGER" for a in axes)


_PLACED = f"""{_STATIONS}, blocks AS (SELECT station_id, lat, lon, {_cube("lat", "lon", 2000.0)} AS block FROM stations),
drawn AS (SELECT *, ('0x' || substr(md5(block || ':42'), 1, 8))::BIGINT % 1000000 < 200000 AS held FROM blocks),
placed AS (
  SELECT station_id, block, CASE WHEN held THEN 'test'
    WHEN EXISTS (SELECT 1 FROM drawn o WHERE o.held AND {_haversine("d.", "o.")} <= 250) THEN 'buffer' ELSE 'train' END AS part
  FROM drawn d
)"""
_TEXT_TIMES = f"""{_STATUS}, texts AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN event_type ELSE strftime(ts_local, '%Y-%m-%d %H:%M:%S') END AS t FROM status
)"""
_LAGS12 = ", ".join(f"lag({_Y}, {k}) OVER w AS y_lag{k}" for k in range(1, 13))
_SLOT_HISTORY = f"""{_SLOT_BASE}, {_targets(720)}, full_hist AS (
  SELECT station_id, ts, y AS y_hist_at_cut, {", ".join(f"lag(y, {k}) OVER w AS y_lag{k}" for k in range(1, 13))},
    {", ".join(f"avg(y) OVER (PARTITION BY station_id ORDER BY ts, event_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS y_ma{n}" for n in (3, 6, 12))},
    y - lag(y, 1) OVER w AS y_diff1
  FROM obs WINDOW w AS (PARTITION BY station_id ORDER BY ts, event_id)
), slot_features AS (
  SELECT t.station_id, t.t_slot, t.slot_label, t.y, t.lead_minutes, t.generated_from, f.* EXCLUDE (station_id, ts),
    hour(t.t_slot)::INTEGER AS hour, (isodow(t.t_slot) - 1)::INTEGER AS dow,
    (CASE WHEN isodow(t.t_slot) >= 6 THEN 1 ELSE 0 END)::INTEGER AS is_weekend,
    sin(2 * pi() * hour(t.t_slot) / 24.0::DOUBLE) AS hour_sin, cos(2 * pi() * hour(t.t_slot) / 24.0::DOUBLE) AS hour_cos
  FROM (SELECT *, t_slot - INTERVAL 10 MINUTE AS t_cut FROM targets) t
  ASOF LEFT JOIN full_hist f ON t.station_id = f.station_id AND t.t_cut >= f.ts
)"""
_KS = f"""{_FOLDED}, bounds AS (SELECT min(val_end) AS first_cut, max(val_end) AS last_cut FROM folds),
sample AS (
  SELECT y_lag1 AS v, (ts_local <= first_cut) AS is_early FROM ready, bounds WHERE ts_local <= last_cut AND y_lag1 IS NOT NULL
), counted AS (
  SELECT v, count(*) FILTER (WHERE is_early) AS a, count(*) FILTER (WHERE NOT is_early) AS b FROM sample GROUP BY v
), running AS (
  SELECT sum(a) OVER (ORDER BY v) AS ca, sum(b) OVER (ORDER BY v) AS cb, sum(a) OVER () AS na, sum(b) OVER () AS nb FROM counted
), stat AS (
  SELECT max(na)::BIGINT AS n_early, max(nb)::BIGINT AS n_late, max(abs(ca::DOUBLE / na - cb::DOUBLE / nb)) AS ks_stat FROM running
), drift AS (
  SELECT 'y_lag1' AS feature, n_early, n_late, ks_stat, CASE WHEN lam2 < 0.04 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * (
    SELECT sum((CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0::DOUBLE * k * k * lam2)) FROM generate_series(1, 100) AS g(k)))) END AS pvalue
  FROM (SELECT *, ks_stat * ks_stat * (n_early::DOUBLE * n_late::DOUBLE / (n_early + n_late)) AS lam2 FROM stat)
  WHERE n_early > 100 AND n_late > 100
)"""
_PATHS = "'models/' || framework || '/best_model'"
_GAPS = """gaps AS (
  SELECT round_even(epoch_us(ts_local - lag(ts_local) OVER ({over}))::DOUBLE / 60000000.0::DOUBLE, 0) AS minutes FROM {source}
), mode_of AS (
  SELECT minutes AS freq_minutes_mode FROM gaps WHERE minutes IS NOT NULL GROUP BY minutes ORDER BY count(*) DESC, minutes LIMIT 1
)"""
_GLOBAL_GAPS = _GAPS.format(over="ORDER BY ts_local, event_id", source="status")
_HOURS = """days AS (SELECT ts_local::DATE AS day, min(ts_local) AS low, max(ts_local) AS high FROM status GROUP BY 1),
hours AS (
  SELECT count(*) AS n_days, median(hour(low))::DOUBLE AS hours_min, median(hour(high))::DOUBLE AS hours_max FROM days
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes} {select}"


def _best(metric: str, column: str, order: str) -> str:
    return f"(SELECT '{metric}' AS metric, framework FROM board WHERE {column} IS NOT NULL ORDER BY {order}, framework LIMIT 1)"


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}

    # scans and sinks
    sql["scan_status"] = _with(_STATUS, f"SELECT station_id, ts_local, {_Y} FROM status")
    sql["load_stations"] = _with(_STATIONS, f"SELECT station_id, name, {_r('lat')}, {_r('lon')}, capacity FROM stations")
    sql["scan_glob_provenance"] = _with(
        f"{_SLOT_BASE}, {_targets(720)}", "SELECT slot_label, count(*) AS n_rows, count(y) AS n_known FROM targets GROUP BY slot_label"
    )
    sql["load_predictions"] = _with(f"{_SLOT_BASE}, {_targets(720)}", "SELECT station_id, t_slot, slot_label, y AS yhat FROM targets")
    sql["slot_from_path"] = _with(f"{_SLOT_BASE}, {_targets(720)}", "SELECT station_id, t_slot, slot_label FROM targets")
    sql["roundtrip_parquet"] = _with(_STATUS, "SELECT * FROM status")
    sql["roundtrip_csv"] = _with(_BASE, f"SELECT station_id, ts_local, {_Y}, hour, y_lag1, y_lag2 FROM ready")
    sql["metrics_append"] = _with(
        f"{_SPLIT}, {_METRICS_LONG}",
        f"SELECT framework, split, {_r('rmse')}, {_r('mae')}, {_r('r2')}, run_id FROM metrics_long, (VALUES ('first'), ('second')) AS runs(run_id)",
    )
    sql["publish_latest"] = _with(_FORECAST, f"SELECT station_id, timestamp_pred, h, {_r('yhat')} FROM forecast")
    sql["champion_manifest"] = _with(
        _BOARD,
        f"""SELECT framework AS winner_framework, 'val_rmse' AS metric_used, {_PATHS} AS winner_model_path,
            'availability_champion' AS registered_name, 'Production' AS stage, 'models/champion' AS champion_path
            FROM board ORDER BY val_rmse, framework LIMIT 1""",
    )

    # typing and contracts
    sql["parse_ts_drop"] = _with(_TEXT_TIMES, "SELECT event_id, TRY_CAST(t AS TIMESTAMP) AS ts_local FROM texts WHERE TRY_CAST(t AS TIMESTAMP) IS NOT NULL")
    sql["ts_contract"] = _with(_TEXT_TIMES, "SELECT count(*) AS n_rows, count(*) FILTER (WHERE TRY_CAST(t AS TIMESTAMP) IS NULL) AS n_bad FROM texts")
    sql["to_naive"] = _with(
        _STATUS,
        "SELECT event_id, date_trunc('second', ts_local)::TIMESTAMP + INTERVAL 3 HOUR AS ts_utc, date_trunc('second', ts_local)::TIMESTAMP AS ts_wall FROM status",
    )
    sql["ensure_tz"] = _with(
        _STATUS,
        "SELECT event_id, ts_local + INTERVAL 3 HOUR AS instant_utc, date_trunc('second', ts_local)::TIMESTAMP AS wall_clock FROM status",
    )
    sql["normalize_id"] = _with(_STATUS, "SELECT event_id, station_id::BIGINT AS digits, event_type::VARCHAR AS words FROM status")
    sql["to_numeric"] = _with(_STATUS, f"SELECT event_id, {_Y} AS from_text, TRY_CAST(event_type AS DOUBLE) AS from_word FROM status")
    sql["contract_report"] = _with(
        _STATUS,
        f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE station_id = 0) AS null_id, count(*) FILTER (WHERE ts_local IS NULL) AS null_ts,
            count(*) FILTER (WHERE {_Y} - 50 < 0) AS negative_y FROM status""",
    )
    sql["union_by_name"] = _with(
        _STATUS,
        f"""SELECT station_id, ts_local, {_Y}, NULL::VARCHAR AS event_type FROM status
            UNION ALL SELECT station_id, ts_local, NULL::DOUBLE, event_type FROM status""",
    )
    sql["string_norm"] = _with(
        _STATUS,
        """SELECT event_id, lower(trim(props)) AS norm, starts_with(props, '{') AS opens, ends_with(props, '}') AS closes,
           contains(props, 'k') AS has_k, split_part(props, ':', 1) AS head FROM status""",
    )
    sql["sanitize"] = _with(_STATUS, "SELECT event_id, regexp_replace(props, '[^A-Za-z0-9_-]', '', 'g') AS safe FROM status")
    sql["clip"] = _with(
        _STATUS,
        f"SELECT event_id, {_r(f'greatest({_Y} - 20, 0.0::DOUBLE)', 6, 'low')}, {_r(f'least(greatest({_Y} - 20, 0.0::DOUBLE), 50.0::DOUBLE)', 6, 'both')} FROM status",
    )
    sql["add_minutes"] = _with(
        _STATUS, "SELECT event_id, ts_local + INTERVAL 60 MINUTE AS plus_hour, ts_local - station_id * INTERVAL 1 MINUTE AS minus_id FROM status"
    )
    sql["days_distinct"] = _with(_STATUS, "SELECT station_id, count(DISTINCT ts_local::DATE) AS n_days FROM status GROUP BY station_id")
    sql["calendar"] = _with(
        _STATUS,
        f"""SELECT event_id, hour(ts_local)::INTEGER AS hour, (isodow(ts_local) - 1)::INTEGER AS dow,
            (CASE WHEN isodow(ts_local) >= 6 THEN 1 ELSE 0 END)::INTEGER AS is_weekend, month(ts_local)::INTEGER AS month,
            {_r("sin(2 * pi() * hour(ts_local) / 24.0::DOUBLE)", 6, "hour_sin")}, {_r("cos(2 * pi() * hour(ts_local) / 24.0::DOUBLE)", 6, "hour_cos")}
            FROM status""",
    )

    # history
    sql["dedup_pk"] = _with(f"{_STATUS}, {_HOURLY}, {_UNIQ}", f"SELECT station_id, ts_local, {_Y}, event_id FROM uniq")
    sql["lags"] = _with(_BASE, f"SELECT station_id, ts_local, {_Y}, y_lag1, y_lag2 FROM hist")
    sql["lags_n"] = _with(
        f"{_STATUS}, {_HOURLY}, {_UNIQ}",
        f"SELECT station_id, ts_local, {_LAGS12} FROM uniq WINDOW w AS (PARTITION BY station_id ORDER BY ts_local)",
    )
    means = ", ".join(
        _r(f"avg({_Y}) OVER (PARTITION BY station_id ORDER BY ts_local ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)", 6, f"y_ma{n}") for n in (3, 6, 12)
    )
    sql["rolling_means"] = _with(
        f"{_STATUS}, {_HOURLY}, {_UNIQ}",
        f"SELECT station_id, ts_local, {means}, {_r(f'{_Y} - lag({_Y}) OVER (PARTITION BY station_id ORDER BY ts_local)', 6, 'y_diff1')} FROM uniq",
    )
    sql["model_ready"] = _with(
        _BASE,
        f"SELECT * EXCLUDE (props, event_type) REPLACE (round(y_ma3, 6) + 0.0::DOUBLE AS y_ma3, round(hour_sin, 6) + 0.0::DOUBLE AS hour_sin, round(hour_cos, 6) + 0.0::DOUBLE AS hour_cos) FROM ready",
    )
    sql["latest_per_station"] = _with(
        _STATUS,
        f"SELECT station_id, ts_local, {_Y}, event_id FROM status QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY ts_local DESC, event_id DESC) = 1",
    )
    sql["resolve_asof"] = _with(_STATUS, "SELECT max(ts_local) AS asof, count(*) AS n_rows FROM status")

    # encoding
    sql["json_like_ratio"] = _with(
        _STATUS,
        " UNION ALL ".join(
            f"SELECT '{c}' AS feature, avg(CASE WHEN trim({c}) LIKE '{{%}}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS ratio FROM status"
            for c in ("event_type", "props")
        ),
    )
    sql["json_expand"] = _with(_STATUS, "SELECT event_id, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0::DOUBLE) AS props_k FROM status")
    kinds = ("error", "purchase", "signup", "view")
    sql["onehot"] = _with(
        _STATUS, "SELECT event_id, " + ", ".join(f"(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END)::INTEGER AS event_type_{k}" for k in kinds) + " FROM status"
    )
    plain = ["hour", "dow", "is_weekend", "month"]
    numeric = ", ".join(
        [f"{c}::DOUBLE AS {c}" for c in [*plain, "y_lag1", "y_lag2"]] + [_r(c) for c in ("hour_sin", "hour_cos", "y_ma3")]
    )
    sql["model_ready_zoned"] = _with(
        _BASE,
        f"""SELECT station_id, ts_local + INTERVAL 3 HOUR AS ts_local, {_Y}, hour(ts_local + INTERVAL 3 HOUR)::INTEGER AS hour,
            (isodow(ts_local + INTERVAL 3 HOUR) - 1)::INTEGER AS dow, y_lag1, y_lag2, {_r("y_ma3")} FROM ready""",
    )
    sql["numeric_features"] = _with(_BASE, f"SELECT event_id::DOUBLE AS event_id, {numeric} FROM ready")
    sql["make_xy"] = _with(
        _BASE,
        f"""SELECT station_id, ts_local, {_Y}, {numeric}, coalesce(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE), 0.0::DOUBLE) AS props_k,
            {", ".join(f"(CASE WHEN event_type = '{k}' THEN 1 ELSE 0 END)::DOUBLE AS event_type_{k}" for k in kinds)} FROM ready""",
    )
    sql["align_schema"] = _with(_BASE, "SELECT station_id, ts_local, y_lag2, 0.0::DOUBLE AS absent, hour::DOUBLE AS hour, y_lag1 FROM ready")
    slot_numeric = ["lead_minutes", "y_hist_at_cut", *[f"y_lag{k}" for k in range(1, 13)], "y_ma3", "y_ma6", "y_ma12", "y_diff1", "hour", "dow", "is_weekend", "hour_sin", "hour_cos"]
    sql["screen_features"] = _with(
        _SLOT_HISTORY,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS feature, {_r(f"avg(CASE WHEN {c} IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", 4, "known_share")},
                {_r(f"var_pop({c}::DOUBLE)", 4, "variance")},
                avg(CASE WHEN {c} IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) >= 0.2 AND coalesce(var_pop({c}::DOUBLE), 0) > 0 AS keep FROM slot_features"""
            for c in slot_numeric
        ),
    )
    leaky = {**{c: f"{c}::DOUBLE" for c in [*plain, "hour_sin", "hour_cos", "y_lag1", "y_lag2", "y_ma3"]}}
    leaky |= {"twin": _Y, "constant": "7.0::DOUBLE", "scaled": f"({_Y} * 3 + 1)", "Num_Bikes_Available_x": "y_lag1"}
    sql["leak_guard"] = _with(
        _BASE,
        "SELECT *, NOT (by_name OR is_equal OR by_corr) AS keep FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{n}' AS feature, contains(lower('{n}'), '{_Y}') AS by_name, bool_and({e} IS NOT DISTINCT FROM {_Y}) AS is_equal,
                coalesce(abs(covar_pop({e}, {_Y}) / nullif(stddev_pop({e}) * stddev_pop({_Y}), 0)) > 0.999999, false) AS by_corr FROM ready"""
            for n, e in leaky.items()
        )
        + ")",
    )
    sql["feature_cardinality"] = _with(
        _BASE,
        " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM ready" for c in ("hour", "dow", "month", "is_weekend", "y_lag1", "y_lag2")),
    )

    # splits and metrics
    sql["temporal_split"] = _with(_SPLIT, "SELECT station_id, ts_local, split FROM labelled")
    sql["split_report"] = _with(_SPLIT, "SELECT split, min(ts_local) AS first_ts, max(ts_local) AS last_ts, count(*) AS n_rows FROM labelled GROUP BY split")
    sql["reg_metrics"] = _with(_SPLIT, f"SELECT split, count(*) AS n_rows, {_metric_list(_Y, 'y_ma3')} FROM labelled GROUP BY split")
    sql["reg_metrics_gaps"] = _with(
        _SPLIT, f"SELECT split, count(*) AS n_rows, {_metric_list(_Y, 'CASE WHEN hour <> 5 THEN y_ma3 END')} FROM labelled GROUP BY split"
    )
    sql["baseline_metrics"] = _with(_SPLIT, f"SELECT split, count(*) AS n_rows, {_metric_list(_Y, 'coalesce(y_lag1, 0)')} FROM labelled GROUP BY split")
    sql["backtest_folds"] = _with(
        _FOLDED, "SELECT fold, part, min(train_end) AS train_end, min(val_end) AS val_end, count(*) AS n_rows FROM folded GROUP BY fold, part"
    )
    sql["backtest_persistence"] = _with(
        _FOLDED,
        f"SELECT fold, train_end, val_end, count(*) AS n_rows, {_metric_list(_Y, 'coalesce(y_lag1, 0)')} FROM folded WHERE part = 'val' GROUP BY fold, train_end, val_end",
    )
    sql["backtest_sample"] = _with(
        _FOLDED,
        f"""SELECT fold, station_id, ts_local, {_Y} AS y_true, coalesce(y_lag1, 0) AS y_pred FROM folded WHERE part = 'val'
            QUALIFY row_number() OVER (PARTITION BY fold ORDER BY station_id, ts_local) <= 50""",
    )
    sql["error_by_hour_h"] = _with(
        f"""{_BASE}, scored AS (
          SELECT ((f.hour + x.h) % 24)::INTEGER AS hour, x.h::INTEGER AS h, a.{_Y} AS y,
            0.6::DOUBLE * f.y_lag1 + 0.3::DOUBLE * f.y_lag2 + 0.1::DOUBLE * f.y_ma3 AS p
          FROM ready f, (VALUES (1), (3), (6), (12)) AS x(h), ready a
          WHERE a.station_id = f.station_id AND a.ts_local = f.ts_local + x.h * INTERVAL 1 HOUR
        )""",
        f"""SELECT hour, h, count(*) AS n_rows, {_metric_list("y", "p", 4)},
            {_r("avg(CASE WHEN y <> 0 THEN abs((y - p) / y) END) * 100", 4, "mape")} FROM scored GROUP BY hour, h""",
    )
    sql["holdout_month"] = _with(
        _BASE,
        f"""SELECT strftime(ts_local, '%Y-%m') AS month_of, count(*) AS n_rows, {_metric_list(_Y, "coalesce(y_lag1, 0)")} FROM ready
            WHERE strftime(ts_local, '%Y-%m') = (SELECT max(strftime(ts_local, '%Y-%m')) FROM ready) GROUP BY 1""",
    )

    # slots and as-of joins
    sql["slot_grid"] = _with(f"{_SLOT_BASE}, {_grid()}", "SELECT station_id, t_slot, slot_label FROM grid")
    sql["slot_exact"] = _with(
        f"{_STATUS}, {_HOURLY}, obs AS (SELECT station_id, ts_local AS ts, {_Y} AS y FROM hourly), {_grid()}",
        """SELECT g.station_id, g.t_slot, g.slot_label, o.y, g.t_slot AS ts_matched
           FROM grid g LEFT JOIN obs o ON g.station_id = o.station_id AND g.t_slot = o.ts""",
    )
    sql["asof_tolerance"] = _with(f"{_SLOT_BASE}, {_targets(720)}", "SELECT station_id, t_slot, slot_label, y, ts_matched AS ts FROM targets")
    sql["asof_lead"] = _with(
        f"{_SLOT_BASE}, {_grid()}, probes AS (SELECT *, t_slot - INTERVAL 10 MINUTE AS t_cut FROM grid)",
        """SELECT p.station_id, p.t_slot, p.slot_label, o.y, o.ts
           FROM probes p ASOF LEFT JOIN obs o ON p.station_id = o.station_id AND p.t_cut >= o.ts""",
    )
    sql["slot_targets"] = _with(f"{_SLOT_BASE}, {_targets(720)}", "SELECT * FROM targets")
    sql["slot_targets_short"] = _with(f"{_SLOT_BASE}, {_targets(60)}", "SELECT * FROM targets")
    replaced = ", ".join(f"round({c}, 6) + 0.0::DOUBLE AS {c}" for c in ("y_ma3", "y_ma6", "y_ma12", "y_diff1", "hour_sin", "hour_cos"))
    sql["slot_features"] = _with(_SLOT_HISTORY, f"SELECT * REPLACE ({replaced}) FROM slot_features")
    sql["slot_features_reduced"] = sql["slot_features"]
    sql["slot_features_found"] = sql["slot_features"]
    sql["slot_predictions"] = _with(
        _SLOT_HISTORY,
        f"""SELECT station_id, t_slot, slot_label, {_r("coalesce(CASE slot_label WHEN '09:00' THEN y_lag1 ELSE y_ma3 END, 0)", 6, "yhat")}
            FROM slot_features WHERE slot_label IN ('09:00', '13:00')""",
    )
    sql["newest_file"] = _with(_STATUS, "SELECT event_type AS batch, count(*) AS n_rows, max(ts_local) AS last_ts FROM status WHERE event_type = 'view' GROUP BY 1")
    sql["gated_split"] = _with(_SPLIT, "SELECT split, min(ts_local) AS first_ts, max(ts_local) AS last_ts, count(*) AS n_rows FROM labelled GROUP BY split")
    sql["slot_features_lead"] = _with(
        _SLOT_HISTORY.replace("10::INTEGER AS lead_minutes", "240::INTEGER AS lead_minutes").replace("INTERVAL 10 MINUTE", "INTERVAL 240 MINUTE"),
        f"SELECT * REPLACE ({replaced}) FROM slot_features",
    )
    sql["slot_targets_zoned"] = sql["slot_targets"]
    sql["filter_slot"] = _with(f"{_SLOT_BASE}, {_targets(720)}", "SELECT station_id, t_slot, y FROM targets WHERE slot_label = '09:00' AND y IS NOT NULL")
    five = "('09:00'), ('13:00'), ('16:00'), ('20:00'), ('07:30')"
    sql["slot_order"] = _with(
        f"{_SLOT_BASE}, {_grid(five)}",
        """SELECT slot_label, count(*) AS n_rows,
           (CASE slot_label WHEN '09:00' THEN 1 WHEN '13:00' THEN 2 WHEN '16:00' THEN 3 WHEN '20:00' THEN 4 ELSE 5 END)::INTEGER AS position
           FROM grid GROUP BY slot_label""",
    )

    # forecasts
    sql["forecast_recursive"] = _with(_FORECAST, f"SELECT station_id, timestamp_pred, h, {_r('yhat')} FROM forecast")
    sql["forecast_clipped"] = _with(_CLIPPED, f"SELECT station_id, timestamp_pred, h, {_r('yhat')} FROM forecast")
    at = "(t0 + x.h * INTERVAL 1 HOUR)"
    static = f"""1.0::DOUBLE + 0.001::DOUBLE * event_id + 0.5::DOUBLE * json_extract_string(props, '$.k')::DOUBLE + 0.25::DOUBLE * s.capacity
              + 2.0::DOUBLE * sin(2 * pi() * hour{at} / 24.0::DOUBLE) + 0.75::DOUBLE * (isodow{at} - 1)"""
    sql["forecast_static"] = _with(
        _FORECAST,
        f"""SELECT station_id, {at} AS timestamp_pred, x.h::INTEGER AS h, {_r(static, 6, "yhat")}
            FROM latest JOIN stations s USING (station_id), (SELECT max(ts_local) AS t0 FROM latest), (VALUES (1), (3), (6), (12)) AS x(h)""",
    )
    sql["forecast_oneshot"] = _with(
        _FORECAST,
        f"""SELECT station_id, t0 + x.h * INTERVAL 1 HOUR AS timestamp_pred, x.h::INTEGER AS h,
            {_r("greatest(0.6::DOUBLE * l1 + 0.3::DOUBLE * l2 + 0.1::DOUBLE * m, 0.0::DOUBLE)", 6, "yhat")}
            FROM s0, (VALUES (1), (3), (6), (12)) AS x(h)""",
    )
    sql["future_frame"] = _with(
        f"""{_BASE}, future AS (
          SELECT r.*, x.h, ts_local + x.h * INTERVAL 1 HOUR AS t, (hour + x.h) % 24 AS hh FROM ready r, (VALUES (1), (3), (6), (12)) AS x(h)
        )""",
        f"""SELECT station_id, ts_local, h::INTEGER AS h, t AS timestamp_pred, hh::INTEGER AS hour, (isodow(t) - 1)::INTEGER AS dow,
            (CASE WHEN isodow(t) >= 6 THEN 1 ELSE 0 END)::INTEGER AS is_weekend, month(t)::INTEGER AS month,
            {_r("sin(2 * pi() * hh / 24.0::DOUBLE)", 6, "hour_sin")}, {_r("cos(2 * pi() * hh / 24.0::DOUBLE)", 6, "hour_cos")},
            {_r("0.6::DOUBLE * y_lag1 + 0.3::DOUBLE * y_lag2 + 0.1::DOUBLE * y_ma3", 6, "yhat")} FROM future""",
    )
    sql["horizon_summary"] = _with(
        _FORECAST, "SELECT h, round_even(avg(yhat), 2) AS mean, round_even(min(yhat), 2) AS min, round_even(max(yhat), 2) AS max FROM forecast GROUP BY h"
    )
    quartiles = ", ".join(_r(f"quantile_cont(yhat, {q})", 6, n) for n, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
    sql["horizon_describe"] = _with(
        _FORECAST,
        f"""SELECT h, count(yhat) AS count, {_r("avg(yhat)", 6, "mean")}, {_r("stddev_samp(yhat)", 6, "std")}, {_r("min(yhat)", 6, "min")},
            {quartiles}, {_r("max(yhat)", 6, "max")} FROM forecast GROUP BY h""",
    )
    sql["horizon_invariance"] = _with(
        _FORECAST,
        """SELECT count(*) AS n_horizons, count(DISTINCT mean) AS n_means, count(*) > 1 AND count(DISTINCT mean) <= 1 AS looks_equal
           FROM (SELECT h, avg(yhat) AS mean FROM forecast GROUP BY h)""",
    )

    # serving and distances
    sql["enrich_stations"] = _with(
        _FORECAST, f"SELECT station_id, timestamp_pred, h, {_r('yhat')}, name, {_r('lat')}, {_r('lon')}, capacity FROM forecast LEFT JOIN stations USING (station_id)"
    )
    sql["spatial_split"] = _with(_PLACED, "SELECT station_id, block, part FROM placed")
    sql["spatial_holdout"] = _with(
        f"""{_BASE}, {_PLACED}, profile AS (
          SELECT dow, hour, avg({_Y}) AS p FROM ready JOIN placed USING (station_id) WHERE part = 'train' GROUP BY ALL
        ), scored AS (
          SELECT r.*, block, p FROM ready r JOIN placed USING (station_id) LEFT JOIN profile USING (dow, hour) WHERE part = 'test'
        )""",
        f"""SELECT block, count(DISTINCT station_id) AS n_stations, count(*) AS n_rows, {_metric_list(_Y, "p")} FROM scored GROUP BY block""",
    )
    sql["tiles"] = _with(
        f"""{_FORECAST}, t AS (
          SELECT station_id, name, lat, lon, timestamp_pred, h, greatest(coalesce(yhat, 0), 0) AS yhat FROM forecast LEFT JOIN stations USING (station_id)
        ), leveled AS (SELECT *, CASE WHEN yhat >= 10 THEN 'high' WHEN yhat >= 3 THEN 'medium' ELSE 'low' END AS level FROM t)""",
        f"""SELECT station_id, name, {_r('lat')}, {_r('lon')}, timestamp_pred, h, {_r('yhat')}, level,
            CASE level WHEN 'high' THEN '#2ECC71' WHEN 'medium' THEN '#F1C40F' ELSE '#E74C3C' END AS color FROM leveled""",
    )
    sql["tiles_published"] = sql["tiles"]
    forecasts = " UNION ALL ".join(f"SELECT '{c}' AS framework, fold, {_Y} AS y, coalesce({c}, 0) AS p FROM folded WHERE part = 'val'" for c in ("y_lag1", "y_lag2", "y_ma3"))
    sql["trial_ranking"] = _with(
        f"""{_FOLDED}, candidates AS ({forecasts}), per_fold AS (
          SELECT framework, fold, {_raw_metric_list("y", "p")} FROM candidates GROUP BY ALL
        ), means AS (SELECT framework, count(*) AS n_folds, avg(rmse) AS rmse, avg(mae) AS mae, avg(r2) AS r2 FROM per_fold GROUP BY framework)""",
        f"""SELECT framework, n_folds, {_r("rmse")}, {_r("mae")}, {_r("r2")}, 0::INTEGER AS fitted_again,
            (row_number() OVER (ORDER BY rmse, mae, r2 DESC, framework))::INTEGER AS place FROM means""",
    )
    sql["run_record"] = _with(
        _SPLIT, f"SELECT split, count(*) AS n_rows, {_metric_list(_Y, 'coalesce(y_lag1, 0)')}, '1' AS lag, count(*) AS n_stored FROM labelled GROUP BY split"
    )
    sql["capacity_metrics"] = _with(
        _FORECAST,
        f"""SELECT station_id, h, {_r("capacity - yhat", 6, "docks_pred")}, {_r("yhat / capacity * 100", 6, "pct_bikes")},
            {_r("(capacity - yhat) / capacity * 100", 6, "pct_docks")} FROM forecast JOIN stations USING (station_id)""",
    )
    sql["traffic_light"] = _with(
        f"""{_STATUS}, {_STATIONS}, lit AS (
          SELECT event_id, {_LIGHT} AS light FROM (
            SELECT event_id, {_Y} AS bikes, {_Y} / capacity * 100 AS pct FROM status LEFT JOIN stations USING (station_id))
        )""",
        f"SELECT event_id, light, {_LIGHT_HEX} AS hex, {_LIGHT_RGB} AS rgb FROM lit",
    )
    sql["serving_map"] = _with(
        _SERVED,
        f"""SELECT station_id, name, capacity, bikes AS yhat, docks_pred, pct AS pct_bikes, pct_docks, light,
            {_LIGHT_HEX} AS color_hex, {_LIGHT_RGB} AS rgb FROM served""",
    )
    sql["haversine"] = _with(
        f"{_STATIONS}, c AS (SELECT -34.6037::DOUBLE AS lat, -58.3816::DOUBLE AS lon)",
        f"SELECT s.station_id, {_r(_haversine('c.', 's.'), 3, 'distance_m')} FROM stations s, c",
    )
    sql["nearest_station"] = _with(
        f"""{_STATIONS}, points AS (
          SELECT s_suppkey, -34.6::DOUBLE + (s_suppkey * 37 % 1000)::DOUBLE * 0.0002::DOUBLE AS lat,
            -58.4::DOUBLE + (s_suppkey * 91 % 1000)::DOUBLE * 0.0002::DOUBLE AS lon FROM supplier
        ), pairs AS (SELECT s_suppkey, station_id, {_haversine("p.", "s.")} AS distance_m FROM points p, stations s)""",
        f"""SELECT s_suppkey, station_id, {_r("distance_m", 3)} FROM pairs
            QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY round(distance_m, 3), station_id) = 1""",
    )
    sql["nearest_station_gaps"] = f"""SELECT s_suppkey,
        CASE WHEN s_suppkey % 5 <> 0 THEN station_id ELSE -1 END AS station_id, CASE WHEN s_suppkey % 5 <> 0 THEN distance_m END AS distance_m
        FROM ({sql["nearest_station"]})"""
    sql["within_radius"] = _with(
        f"{_SERVED}, spots AS (SELECT DISTINCT lat, lon FROM served)",
        f"""SELECT {_r("p.lat", 6, "focus_lat")}, {_r("p.lon", 6, "focus_lon")}, o.station_id, o.light, {_r(_haversine("p.", "o."), 3, "distance_m")}
            FROM spots p JOIN served o ON o.light IN ('verde', 'amarillo') WHERE {_haversine("p.", "o.")} <= 800""",
    )
    sql["top5_nearby"] = _with(
        f"""{_NEAR}, placed AS (
          SELECT *, row_number() OVER (PARTITION BY focus_id ORDER BY bikes DESC, round(distance, 3), station_id) AS place FROM near
        )""",
        """SELECT focus_id, place::INTEGER AS place, station_id, name, round_even(bikes, 0)::BIGINT AS bikes, round_even(docks_pred, 0)::BIGINT AS free_docks,
           pct AS pct_bikes, light, round_even(distance, 0)::BIGINT AS distance_m FROM placed WHERE place <= 5""",
    )

    # monitoring
    sql["zero_share"] = _with(
        _STATUS, f"SELECT station_id, {_r(f'avg(CASE WHEN floor({_Y}) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)', 6, 'p_zero')} FROM status GROUP BY station_id"
    )
    sql["interarrival_mode"] = _with(f"{_STATUS}, {_GLOBAL_GAPS}", "SELECT * FROM mode_of")
    per_station = _GAPS.format(over="PARTITION BY station_id ORDER BY ts_local", source="uniq")
    sql["interarrival_mode_per_station"] = _with(f"{_STATUS}, {_HOURLY}, {_UNIQ}, {per_station}", "SELECT * FROM mode_of")
    sql["hours_coverage"] = _with(f"{_STATUS}, {_HOURS}", "SELECT * FROM hours")
    sql["time_profile"] = _with(
        f"{_STATUS}, {_GLOBAL_GAPS}, {_HOURS}",
        """SELECT (SELECT count(*) FROM status) AS n_rows, n_days, hours_min, hours_max, freq_minutes_mode,
           coalesce(abs(freq_minutes_mode - 1) > 0.1, false) AS warn_step, coalesce(hours_min > 8, false) AS warn_first_hour,
           coalesce(hours_max < 21, false) AS warn_last_hour, n_days > 0 AND n_days < 18 AS warn_days FROM hours, mode_of""",
    )
    sql["ks_drift"] = _with(_KS, f"SELECT feature, n_early, n_late, {_r('ks_stat')}, {_r('pvalue')} FROM drift")
    sql["monitoring"] = _with(
        _KS,
        f"""SELECT 'zero_share' AS "check", station_id::VARCHAR AS subject,
              {_r(f"avg(CASE WHEN {_Y} = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)", 6, "value")}, NULL::DOUBLE AS pvalue FROM ready GROUP BY station_id
            UNION ALL SELECT 'ks_drift', feature, {_r("ks_stat", 6, "value")}, {_r("pvalue")} FROM drift""",
    )
    sql["health_checks"] = _with(
        _FORECAST,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS "table", {ok} AS columns_ok, count(*) AS n_rows, count(DISTINCT station_id) AS n_stations, {ok} AND count(*) > 0 AS healthy FROM {source}"""
            for name, source, ok in (
                ("status", "status", "true"), ("model_ready", "ready", "true"), ("predictions", "forecast", "true"), ("stations", "stations", "false"),
            )
        ),
    )

    # leaderboard
    sql["split_canon"] = _with(
        _SPLIT,
        """SELECT CASE split WHEN 'val' THEN 'Validation' WHEN 'test' THEN 'TEST' ELSE split END AS raw,
           CASE split WHEN 'train' THEN NULL ELSE split END AS canonical, count(*) AS n_rows FROM labelled GROUP BY split""",
    )
    sql["leaderboard_wide"] = _with(_BOARD, f"SELECT framework, {_WIDE_ROUNDED} FROM board")
    sql["leaderboard_upsert"] = _with(
        f"""{_BOARD}, whole AS (
          SELECT split, {_raw_metric_list(_Y, "coalesce(y_lag1, 0)")} FROM labelled GROUP BY split
        ), added AS (SELECT 'persistence' AS framework, {_WIDE_CELLS} FROM whole)""",
        f"SELECT framework, {_WIDE_ROUNDED} FROM (SELECT * FROM board UNION ALL SELECT * FROM added)",
    )
    sql["model_paths"] = _with(_BOARD, f"SELECT framework, {_PATHS} AS model_path FROM board")
    sql["rank_models"] = _with(
        _BOARD, "SELECT framework, row_number() OVER (ORDER BY val_rmse, val_mae, val_r2 DESC, framework)::INTEGER AS place FROM board"
    )
    sql["choose_best"] = _with(
        _BOARD,
        " UNION ALL ".join(
            [
                _best("rmse", "val_rmse", "val_rmse"),
                _best("r2", "val_r2", "val_r2 DESC, val_mae"),
                _best("test_mae", "test_mae", "test_mae, val_rmse"),
            ]
        ),
    )
    sql["champion"] = _with(
        _BOARD, f"SELECT framework, {_WIDE_ROUNDED}, {_PATHS} AS model_path FROM board b ORDER BY b.val_rmse, b.val_mae, b.val_r2 DESC, framework LIMIT 1"
    )
    sql["registry_table"] = _with(
        f"""{_FOLDED}, per_fold AS (
          SELECT val_end, event_type AS framework, {_raw_metric_list(_Y, "coalesce(y_lag1, 0)")} FROM folded WHERE part = 'val' GROUP BY fold, val_end, event_type
        ), best AS (SELECT * FROM per_fold QUALIFY row_number() OVER (PARTITION BY val_end ORDER BY rmse, framework) = 1)""",
        f"""SELECT 'availability_champion' AS name, framework, {_r("rmse")}, val_end AS registered_at,
            row_number() OVER (ORDER BY val_end)::INTEGER AS version,
            CASE WHEN val_end = max(val_end) OVER () THEN 'Production' ELSE 'Archived' END AS stage FROM best""",
    )
    sql["compare_summary"] = _with(
        f"{_SPLIT}, {_METRICS_LONG}",
        f"""SELECT count(DISTINCT framework) AS models_evaluated, {_r("min(rmse)", 6, "best_rmse")}, {_r("min(mae)", 6, "best_mae")},
            {_r("max(r2)", 6, "best_r2")} FROM metrics_long WHERE split = 'val'""",
    )
    return sql
