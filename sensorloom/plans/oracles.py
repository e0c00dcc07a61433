"""The registered queries once more, as plain SQL over the same tables.

Written for DuckDB and for clarity, not for scale: whole-series windows and exploded windows.
Names match ``catalog``. Forest, spline and fitted models are solved in SQL as well.
"""

from __future__ import annotations

from statistics import NormalDist

from sensorloom.functions import window_features as wf
from sensorloom.operators import backtest as bt
from sensorloom.operators import forecast as fc
from sensorloom.operators.inject import FAULTS
from sensorloom.operators.windows import MODEL_FEATURES
from sensorloom.plans.catalog import (
    BAND,
    BURST_US,
    CALM,
    CONTAMINATION,
    CORRELATED,
    ENTITY_STEPS,
    FAULT_SHARE,
    HOT,
    LONG_STEPS,
    MAX_GAP,
    NUDGE,
    N_CLOSE,
    N_OPEN,
    PEAK_LEVEL,
    RISK,
    SKETCH_FROM,
    SKETCH_TO,
    SURROGATE,
    WINDOW_MINUTES,
    digits,
)

VALUES = {
    "plain": "value",
    "nulls": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END",
    "nan": "CASE WHEN event_id % 17 <= 2 THEN NULL ELSE value END",
    "stuck": "CASE WHEN (event_id // 1000) % 4 = 1 THEN 95.0::DOUBLE"
    " ELSE 90.0::DOUBLE + floor(least(value, 100.0::DOUBLE) / 10) END",
}
E, ES = ["entity_id"], ["entity_id", "split"]
STEPS = 7 * 24 * 60
ENTITIES = 10


def r6(expression: str, name: str, solved: bool = False) -> str:
    return f"round({expression}, {digits(name, solved)}) + 0.0 AS {name}"


def r3(expression: str, name: str) -> str:
    return r6(expression, name, True)


def readings(variant: str = "plain") -> str:
    return f"""r AS (
  SELECT event_id AS row_key, ts AS time, 'EQ' || (user_id % 2) AS equipment, event_type AS system,
         'EQ' || (user_id % 2) || '_' || event_type AS entity_id, {VALUES[variant]} AS value
  FROM events)"""


SPLIT = """s AS (
  SELECT *, CASE WHEN time < max(time) OVER (PARTITION BY entity_id) - INTERVAL 7 DAY
            THEN 'train' ELSE 'test' END AS split FROM r)"""
GAPS = """g AS (
  SELECT *, date_diff('microsecond', lag(time) OVER (PARTITION BY entity_id ORDER BY time, row_key), time) / 6e7
         AS gap_minutes FROM r)"""
SEGMENTS = f"""{GAPS}, sg AS (
  SELECT *, sum(CASE WHEN gap_minutes > {MAX_GAP} THEN 1 ELSE 0 END)
              OVER (PARTITION BY entity_id ORDER BY time, row_key)::BIGINT AS segment_id FROM g)"""


def with_(*parts: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n"


def windows(source: str, keys: list[str], size: int = 60, step: int = 1) -> str:
    """p: one row per (window, position o) with the window's times."""
    k = ", ".join(keys)
    same = " AND ".join(f"n.{c} = w.{c}" for c in keys)
    wk = ", ".join(f"w.{c}" for c in keys)
    return f"""n AS (
  SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY time, row_key) AS rn,
         count(*) OVER (PARTITION BY {k}) AS cnt FROM {source}),
w AS (SELECT {k}, rn AS win FROM n WHERE rn + {size - 1} <= cnt AND (rn - 1) % {step} = 0),
wo AS (SELECT *, unnest(range({size})) AS o FROM w),
p AS (SELECT {wk}, w.win, w.o, n.time, n.value FROM wo w JOIN n ON {same} AND n.rn = w.win + w.o),
st0 AS (
  SELECT {k}, win, min(time) FILTER (o = 0) AS window_start, min(time) FILTER (o = {size - 1}) AS window_end,
         min(time) FILTER (o = {size // 2}) AS window_center, count(*) AS n_points, avg(value) AS m,
         min(value) AS mn, max(value) AS mx, stddev_pop(value) AS sd0,
         quantile_cont(value, 0.05) AS p5, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
         quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.95) AS p95, count(value) AS n_values
  FROM p GROUP BY {k}, win),
st AS (SELECT *, CASE WHEN mx = mn THEN 0 ELSE sd0 END AS sd FROM st0 WHERE n_values = {size}),
d AS (
  SELECT p.*, value - lag(value) OVER v AS dv, lag(value) OVER v AS v1, lag(value, 5) OVER v AS v5
  FROM p WINDOW v AS (PARTITION BY {k}, win ORDER BY o)),
e AS (
  SELECT *, abs(dv) AS adv, dv - lag(dv) OVER v AS d2, abs(dv) - lag(abs(dv)) OVER v AS dadv,
         CASE WHEN o >= 2 THEN (sign(dv) <> sign(lag(dv) OVER v))::INT END AS turn
  FROM d WINDOW v AS (PARTITION BY {k}, win ORDER BY o))"""


def _corr(x: str, y: str, where: str) -> str:
    flat = " OR ".join(f"max({c}) FILTER ({where}) = min({c}) FILTER ({where})" for c in (x, y))
    return f"CASE WHEN {flat} THEN NULL ELSE corr({x}, {y}) FILTER ({where}) END"


def _dev(x: str, where: str) -> str:
    return f"CASE WHEN max({x}) FILTER ({where}) = min({x}) FILTER ({where}) THEN 0 ELSE stddev_pop({x}) FILTER ({where}) END"


def _run(name: str, flag: str, k: str) -> str:
    return f"""{name} AS (
  SELECT {k}, win, max(c) AS {name} FROM (
    SELECT {k}, win, o - rk AS island, count(*) AS c FROM (
      SELECT {k}, win, o, row_number() OVER (PARTITION BY {k}, win ORDER BY o) AS rk FROM e WHERE o >= 1 AND {flag})
    GROUP BY {k}, win, island) GROUP BY {k}, win)"""


def features(keys: list[str], groups=tuple(wf.GROUPS), size: int = 60) -> str:
    """f: one row per window with the columns of the asked groups (and the metadata)."""
    k = ", ".join(keys)
    using = f"USING ({k}, win)"
    parts, joins, columns = [], [], []
    z = "round(abs(value - m) / sd, 9)"
    if "point" in groups or "fault" in groups:
        parts.append(f"""pt AS (
  SELECT {k}, win, CASE WHEN any_value(sd) = 0 THEN NULL ELSE max(abs(value - m)) / any_value(sd) END AS max_zscore,
    CASE WHEN any_value(sd) = 0 THEN NULL ELSE avg(abs(value - m)) / any_value(sd) END AS mean_abs_zscore,
    sum(CASE WHEN sd > 0 AND {z} > 3 THEN 1 ELSE 0 END)::DOUBLE AS n_zscore_outliers,
    any_value(p75 - p25) AS iqr,
    sum(CASE WHEN round(value - (p25 - 1.5 * (p75 - p25)), 9) < 0 OR round(value - (p75 + 1.5 * (p75 - p25)), 9) > 0
        THEN 1 ELSE 0 END)::DOUBLE AS n_iqr_outliers,
    max(abs(value - p50)) AS max_deviation_from_median,
    sum(CASE WHEN round(value - p95, 9) > 0 THEN 1 ELSE 0 END)::DOUBLE AS n_values_above_upper_fence,
    sum(CASE WHEN round(value - p5, 9) < 0 THEN 1 ELSE 0 END)::DOUBLE AS n_values_below_lower_fence
  FROM p JOIN st {using} GROUP BY {k}, win)""")
        joins.append("pt")
    if "point" in groups:
        columns += [f"pt.{c}" for c in wf.POINT]
    if "collective" in groups or "fault" in groups or "contextual" in groups:
        parts.append(f"""co AS (
  SELECT {k}, win, max(adv) AS max_roc, avg(adv) AS mean_roc, {_dev("adv", "o >= 1")} AS std_roc,
    {_dev("dadv", "o >= 2")} AS roc_volatility, abs({_corr("o", "value", "o >= 0")}) AS trend_strength,
    sum(turn)::DOUBLE AS n_direction_changes, (min(dv) >= 0)::INT::DOUBLE AS is_monotonic_increasing,
    (max(dv) <= 0)::INT::DOUBLE AS is_monotonic_decreasing,
    {_corr("value", "v1", "o >= 1")} AS autocorr_lag1, {_corr("value", "v5", "o >= 5")} AS autocorr_lag5,
    max(adv / (abs(v1) + 1e-6)) AS max_pct_change,
    sum(CASE WHEN adv <= 0.01::DOUBLE THEN 1 ELSE 0 END)::DOUBLE AS n_constant_values,
    {_dev("dv", "o >= 1")} AS derivative_std, sqrt(avg(d2 * d2)) AS high_frequency_noise
  FROM e GROUP BY {k}, win)""")
        joins.append("co")
    if "collective" in groups:
        parts += [_run("up_run", "dv > 0", k), _run("down_run", "dv < 0", k)]
        joins += ["up_run", "down_run"]
        for c in wf.COLLECTIVE:
            run = {"consecutive_increases": "up_run", "consecutive_decreases": "down_run"}.get(c)
            columns.append(f"coalesce({run}, 0)::DOUBLE AS {c}" if run else f"co.{c}")
    if "contextual" in groups:
        parts.append(f"""ro AS (
  SELECT {k}, win, max(CASE WHEN c5 = 5 THEN abs(value - a5) ELSE 0 END) AS deviation_from_rolling_mean_5,
    max(CASE WHEN c10 = 10 THEN abs(value - a10) ELSE 0 END) AS deviation_from_rolling_mean_10
  FROM (SELECT {k}, win, value, avg(value) OVER f5 AS a5, count(*) OVER f5 AS c5, avg(value) OVER f10 AS a10,
          count(*) OVER f10 AS c10 FROM p
        WINDOW f5 AS (PARTITION BY {k}, win ORDER BY o ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING),
               f10 AS (PARTITION BY {k}, win ORDER BY o ROWS BETWEEN 5 PRECEDING AND 4 FOLLOWING))
  GROUP BY {k}, win),
so AS (SELECT {k}, win, row_number() OVER (PARTITION BY {k}, win ORDER BY value, o) AS i, value FROM p),
near AS (
  SELECT {k}, win, list_sort(list(abs(a.value - b.value)))[6] AS dist FROM
    (SELECT {k}, win, i, value, unnest(range(i - 5, i + 6)) AS j FROM so) a
    JOIN (SELECT {k}, win, i AS j, value FROM so) b USING ({k}, win, j) GROUP BY {k}, win, i),
lo AS (SELECT {k}, win, max(dist) AS max_local_outlier_factor FROM near GROUP BY {k}, win),
mo AS (
  SELECT {k}, win, CASE WHEN any_value(sd) = 0 THEN 0 ELSE avg(pow(value - m, 3)) / pow(any_value(sd), 3) END AS skewness,
    CASE WHEN any_value(sd) = 0 THEN 0 ELSE avg(pow(value - m, 4)) / pow(any_value(sd), 4) - 3 END AS kurtosis
  FROM p JOIN st {using} GROUP BY {k}, win)""")
        joins += ["ro", "lo", "mo"]
        columns += list(wf.CONTEXTUAL)
    if "fault" in groups:
        parts.append(_run("flat_run", "adv <= 0.01::DOUBLE", k))
        parts.append(f"""zv AS (
  SELECT {k}, win, sum(CASE WHEN o <= {size - 6} AND s5 < 1e-6 THEN 1 ELSE 0 END) / {size - 5}.0::DOUBLE AS zero_variance_ratio
  FROM (SELECT {k}, win, o, stddev_pop(value) OVER (PARTITION BY {k}, win ORDER BY o
          ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS s5 FROM p) GROUP BY {k}, win)""")
        joins += ["flat_run", "zv"]
        special = {
            "consecutive_constants": "coalesce(flat_run, 0)::DOUBLE",
            "fraction_constant": f"n_constant_values / {size}.0::DOUBLE",
            "max_abs_change": "max_roc",
            "n_spikes": "n_zscore_outliers",
            "spike_ratio": f"n_zscore_outliers / {size}.0::DOUBLE",
        }
        columns += [f"{special[c]} AS {c}" if c in special else c for c in wf.FAULT]
    if "distribution" in groups:
        bins = min(20, size)
        parts.append(f"""hi AS (
  SELECT {k}, win, -sum(c / {size}.0::DOUBLE * log2(c / {size}.0::DOUBLE + 1e-10)) AS entropy FROM (
    SELECT {k}, win, bin, count(*) AS c FROM (
      SELECT {k}, win, CASE WHEN mx = mn THEN 0 ELSE least(floor((value - mn) * {bins} / (mx - mn)), {bins - 1}) END AS bin
      FROM p JOIN st {using}) GROUP BY {k}, win, bin) GROUP BY {k}, win)""")
        joins.append("hi")
        special = {
            "mean": "m",
            "std": "sd",
            "median": "p50",
            "range": "mx - mn",
            "coefficient_variation": "sd / nullif(m + 1e-6, 0)",
            "percentile_25": "p25",
            "percentile_75": "p75",
        }
        columns += [f"{special[c]} AS {c}" if c in special else c for c in wf.DISTRIBUTION]
    meta = ["window_start", "window_end", "window_center", "n_points"]
    meta += ["m AS mean_oxygen", "sd AS std_oxygen", "mn AS min_oxygen", "mx AS max_oxygen"]
    picked = ", ".join([*[f"st.{c}" for c in keys], "st.win", *meta, *columns])
    froms = "st " + " ".join(f"LEFT JOIN {j} {using}" for j in joins)
    picked_k = picked.replace("st.entity_id", "entity_id").replace("st.split", "split").replace("st.win", "win")
    return ",\n".join([*parts, f"f AS (SELECT {picked_k} FROM {froms})"])


def rounded_columns(names) -> str:
    return ", ".join("n_points" if n == "n_points" else r6(n, n) for n in names)


def feature_query(names, variant="plain", keys=E, groups=tuple(wf.GROUPS), times=("window_start",)) -> str:
    source = [readings(variant)] + ([SPLIT] if "split" in keys else [])
    base = with_(*source, windows("s" if "split" in keys else "r", keys), features(keys, groups))
    return base + f"SELECT {', '.join([*keys, *times])}, {rounded_columns(names)} FROM f"


TIMES = ("window_start", "window_end", "window_center")


def uniform(key: str, salt: str) -> str:
    return f"(('0x' || substr(md5({key} || '|{salt}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def hash32(key: str, salt: str) -> str:
    return f"('0x' || substr(md5({key} || '|{salt}'), 1, 8))::BIGINT"


def _injection() -> str:
    """i: test rows of the first series with event_no/type; x: those rows after injection."""
    kinds = ", ".join(f"'{t}'" for t in FAULTS)
    case = lambda col: " ".join(f"WHEN '{t}' THEN {v[col]}" for t, v in FAULTS.items())
    shift = f"(CASE v.type {case(1)} END)::DOUBLE"
    moved = f"""v.base + {shift} + CASE v.type WHEN 'stuck_sensor' THEN {uniform("v.start_key", "stuck_sensor")} * 2.0::DOUBLE - 1.0
      WHEN 'high_noise' THEN {uniform("i.row_key", "high_noise")} * 6.0::DOUBLE - 3.0 ELSE 0 END"""
    return f"""{SPLIT},
t AS (
  SELECT *, row_number() OVER (ORDER BY time, row_key) AS rn, count(*) OVER () AS cnt,
         row_number() OVER (ORDER BY {hash32("row_key", "pick")}, row_key) AS rk
  FROM s WHERE split = 'test' AND entity_id = (SELECT min(entity_id) FROM s)),
i AS (
  SELECT *, CASE WHEN rk <= greatest(1, floor(cnt * {FAULT_SHARE}::DOUBLE)) THEN rk END AS event_no,
         CASE WHEN rk <= greatest(1, floor(cnt * {FAULT_SHARE}::DOUBLE))
              THEN ([{kinds}])[floor({uniform("row_key", "type")} * 6)::INT + 1] END AS type FROM t),
v0 AS (
  SELECT event_no, type, value AS base, row_key AS start_key,
         unnest(range(rn, least(rn + CASE type {case(0)} END, cnt + 1))) AS rn FROM i WHERE event_no IS NOT NULL),
v AS (SELECT rn, max(event_no) AS event_no, arg_max(type, event_no) AS type, arg_max(base, event_no) AS base,
             arg_max(start_key, event_no) AS start_key FROM v0 GROUP BY rn),
x AS (
  SELECT i.row_key, i.time, i.entity_id, i.split, i.rn, i.value AS original_value,
         CASE WHEN v.rn IS NULL THEN i.value ELSE {moved} END AS value,
         (v.rn IS NOT NULL)::INT AS anomaly_label
  FROM i LEFT JOIN v ON v.rn = i.rn),
il AS (
  SELECT i.entity_id, i.event_no, i.rn, i.type, i.time, {moved} AS injected_value, i.value AS original_value
  FROM i JOIN (SELECT rn, event_no, type, base, start_key FROM v0) v ON v.event_no = i.event_no AND v.rn = i.rn)"""


def _surrogate() -> str:
    """sc: scaled features of all windows; rw: their rounded raw scores."""
    fit = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SURROGATE)
    scaled = ", ".join(f"({c} - m_{c}) / (CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END) AS {c}" for c in SURROGATE)
    total = " + ".join(f"abs({c})" for c in SURROGATE)
    base = ", ".join(
        [
            readings(),
            SPLIT,
            windows("s", ES),
            features(ES, ("collective", "fault", "distribution")),
        ]
    )
    return f"""{base},
fit AS (SELECT {fit} FROM f WHERE split = 'train'),
sc AS (SELECT entity_id, split, window_start, window_end, window_center, {scaled} FROM f, fit),
rw AS (SELECT entity_id, split, window_start, window_end, window_center, round(-({total}) / {len(SURROGATE)}, 9) AS raw FROM sc),
off AS (SELECT quantile_cont(raw, {CONTAMINATION}) AS o FROM rw WHERE split = 'train'),
sd_ AS (
  SELECT entity_id, split, window_start, window_end, window_center, round(raw - o, 9) + 0.0 AS anomaly_score,
         (entity_id LIKE '%\\_error' ESCAPE '\\')::INT AS label, (round(raw - o, 9) < 0)::INT AS flag
  FROM rw, off WHERE split = 'test')"""


TREES, SAMPLE, SEED, DEPTH = 100, 256, 42, 8


def _u52(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)!r}::DOUBLE)"


def _path(n: str) -> str:
    return (
        f"(CASE WHEN {n} > 2 THEN 2 * (ln({n} - 1.0::DOUBLE) + 0.5772156649::DOUBLE) - 2 * ({n} - 1.0::DOUBLE) / {n}"
        f" WHEN {n} = 2 THEN 1.0 ELSE 0.0 END)"
    )


def _forest(train: str, scored: str) -> str:
    """Grow the forest on the windows of ``train`` level by level and score ``train`` and ``scored``.

    sd_: windows of ``scored`` with score and flag; td_: the same for the training windows.
    """
    n_features = len(MODEL_FEATURES)
    safe = lambda c: f"(CASE WHEN {c} IS NULL OR isnan({c}::DOUBLE) OR isinf({c}::DOUBLE) THEN 0 ELSE {c} END)::DOUBLE"
    fit = ", ".join(f"avg({safe(c)}) AS m_{c}, stddev_pop({safe(c)}) AS s_{c}" for c in MODEL_FEATURES)
    # A column whose spread is rounding noise has none.
    scaled = ", ".join(
        f"round(({safe(c)} - m_{c}) / (CASE WHEN s_{c} < 1e-12 THEN 1 ELSE s_{c} END), 9)" for c in MODEL_FEATURES
    )
    levels = []
    for d in range(DEPTH):
        u = lambda what: _u52(f"'{SEED}|' || tree || '|' || node || '|{what}'")
        levels.append(f"""mm{d} AS MATERIALIZED (
  SELECT tree, node, k, min(x) AS lo, max(x) AS hi FROM a{d} JOIN lx USING (id) GROUP BY tree, node, k HAVING max(x) > min(x)),
ch{d} AS (SELECT tree, node, list_sort(list(k)) AS ks FROM mm{d} GROUP BY tree, node),
sp{d} AS MATERIALIZED (
  SELECT tree, node, k, lo + {u("cut")} * (hi - lo) AS cut
  FROM (SELECT tree, node, ks[floor({u("feature")} * len(ks))::INT + 1] AS k FROM ch{d}) JOIN mm{d} USING (tree, node, k)),
a{d + 1} AS MATERIALIZED (
  SELECT a.id, a.tree, 2 * a.node + (x > cut)::INT AS node
  FROM a{d} a JOIN sp{d} s USING (tree, node) JOIN lx ON lx.id = a.id AND lx.k = s.k)""")
        levels.append(f"""d{d + 1} AS (
  SELECT q.id, q.tree, CASE WHEN s.k IS NULL THEN q.node ELSE 2 * q.node + (x > cut)::INT END AS node
  FROM d{d} q LEFT JOIN sp{d} s USING (tree, node) LEFT JOIN lx ON lx.id = q.id AND lx.k = s.k)""")
    sizes = " UNION ALL ".join(f"SELECT tree, node, {d} AS depth, count(*) AS n FROM a{d} GROUP BY tree, node" for d in range(DEPTH + 1))
    times = "entity_id, window_start, window_end, window_center"
    return f"""bo AS (SELECT {times}, true AS is_train, * EXCLUDE ({times}) FROM {train}
  UNION ALL BY NAME SELECT {times}, false AS is_train, * EXCLUDE ({times}) FROM {scored}),
fit AS (SELECT {fit} FROM {train}),
wx AS MATERIALIZED (
  SELECT entity_id || '|' || epoch_us(window_start) AS rid, is_train || '|' || entity_id || '|' || epoch_us(window_start) AS id,
         {times}, is_train, [{scaled}] AS xs FROM bo, fit),
lx AS MATERIALIZED (SELECT id, unnest(xs) AS x, unnest(range({n_features})) AS k FROM wx),
sh AS (SELECT least(1.0::DOUBLE, 4.0::DOUBLE * {SAMPLE} / count(*)) AS share FROM wx WHERE is_train),
ring AS (
  SELECT id, rid, tree FROM (SELECT id, rid, {_u52(f"'{SEED}|' || rid")} AS u, share, unnest(range({TREES})) AS tree
                             FROM wx, sh WHERE is_train)
  WHERE u - tree * share - floor(u - tree * share) < share),
a0 AS MATERIALIZED (
  SELECT id, tree, 1 AS node FROM (
    SELECT id, tree, row_number() OVER (PARTITION BY tree ORDER BY {_u52(f"'{SEED}|' || tree || '|' || rid")}, rid) AS k FROM ring)
  WHERE k <= {SAMPLE}),
d0 AS (SELECT id, unnest(range({TREES})) AS tree, 1 AS node FROM wx),
{", ".join(levels)},
sz AS MATERIALIZED ({sizes}),
cn AS (SELECT {_path("least(s, " + str(SAMPLE) + ")")} AS c FROM (SELECT count(*)::DOUBLE AS s FROM wx WHERE is_train)),
rs AS MATERIALIZED (
  SELECT id, round(-pow(2.0::DOUBLE, -avg(depth + {_path("n")}) / any_value(c)), 12) AS raw
  FROM d{DEPTH} JOIN sz USING (tree, node), cn GROUP BY id),
off AS (SELECT quantile_cont(raw, {CONTAMINATION}) AS o FROM rs JOIN wx USING (id) WHERE is_train),
al_ AS (SELECT {times}, is_train, raw - o AS anomaly_score, (raw - o < 0)::INT AS flag FROM rs JOIN wx USING (id), off),
sd_ AS (SELECT * FROM al_ WHERE NOT is_train), td_ AS (SELECT * FROM al_ WHERE is_train)"""


def _spline() -> str:
    """sy: every reading with its spline value; the tridiagonal system is swept by recursion."""
    return f"""n AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY time, row_key) AS rn,
         count(value) OVER (PARTITION BY entity_id ORDER BY time, row_key) AS seen FROM r),
k AS (
  SELECT entity_id, seen AS i, rn::DOUBLE AS x, value AS y, count(*) OVER e AS cnt,
         lead(rn) OVER w - rn AS h, (lead(value) OVER w - value) / (lead(rn) OVER w - rn) AS s
  FROM n WHERE value IS NOT NULL WINDOW e AS (PARTITION BY entity_id), w AS (PARTITION BY entity_id ORDER BY rn)),
h3 AS (SELECT *, lag(h) OVER w AS hb, lag(h, 2) OVER w AS hbb, lead(h) OVER w AS hn, lag(s) OVER w AS sb
       FROM k WINDOW w AS (PARTITION BY entity_id ORDER BY i)),
sys AS MATERIALIZED (
  SELECT entity_id, i, cnt, 6 * (s - sb) AS r,
         hb - CASE WHEN i = cnt - 1 THEN h * h / hb ELSE 0 END AS a,
         2 * (hb + h) + CASE WHEN i = 2 THEN hb + hb * hb / h ELSE 0 END + CASE WHEN i = cnt - 1 THEN h + h * h / hb ELSE 0 END AS b,
         h - CASE WHEN i = 2 THEN hb * hb / h ELSE 0 END AS c
  FROM h3 WHERE i BETWEEN 2 AND cnt - 1),
fw AS (
  SELECT entity_id, i, cnt, c / b AS cp, r / b AS rp FROM sys WHERE i = 2
  UNION ALL
  SELECT y.entity_id, y.i, y.cnt, y.c / (y.b - y.a * f.cp), (y.r - y.a * f.rp) / (y.b - y.a * f.cp)
  FROM fw f JOIN sys y ON y.entity_id = f.entity_id AND y.i = f.i + 1),
fm AS MATERIALIZED (SELECT * FROM fw),
bw AS (
  SELECT entity_id, i, rp AS m FROM fm WHERE i = cnt - 1
  UNION ALL
  SELECT f.entity_id, f.i, f.rp - f.cp * b.m FROM bw b JOIN fm f ON f.entity_id = b.entity_id AND f.i = b.i - 1),
inner_ AS (SELECT entity_id, i, m FROM bw),
ends AS (
  SELECT h.entity_id, 1 AS i, m2.m - h.h / h.hn * (m3.m - m2.m) AS m FROM h3 h
  JOIN inner_ m2 ON m2.entity_id = h.entity_id AND m2.i = 2 JOIN inner_ m3 ON m3.entity_id = h.entity_id AND m3.i = 3 WHERE h.i = 1
  UNION ALL
  SELECT h.entity_id, h.i, m2.m + h.hb / h.hbb * (m2.m - m3.m) FROM h3 h
  JOIN inner_ m2 ON m2.entity_id = h.entity_id AND m2.i = h.cnt - 1
  JOIN inner_ m3 ON m3.entity_id = h.entity_id AND m3.i = h.cnt - 2 WHERE h.i = h.cnt),
mm AS (SELECT * FROM inner_ UNION ALL SELECT * FROM ends),
pc AS (
  SELECT k.entity_id, k.i, k.x, k.y, k.s - k.h * (2 * a.m + b.m) / 6 AS b, a.m / 2 AS c, (b.m - a.m) / (6 * k.h) AS d, k.cnt
  FROM k JOIN mm a ON a.entity_id = k.entity_id AND a.i = k.i JOIN mm b ON b.entity_id = k.entity_id AND b.i = k.i + 1),
sy AS (
  SELECT n.row_key, n.entity_id,
         CASE WHEN n.value IS NOT NULL THEN n.value
              ELSE p.y + (n.rn - p.x) * (p.b + (n.rn - p.x) * (p.c + (n.rn - p.x) * p.d)) END AS value
  FROM n JOIN (SELECT entity_id, max(cnt) AS cnt FROM k GROUP BY 1) t USING (entity_id)
  JOIN pc p ON p.entity_id = n.entity_id AND p.i = least(greatest(n.seen, 1), t.cnt - 1))"""


CONFUSION = """cm AS (
  SELECT count(*) FILTER (label = 0 AND flag = 0) AS tn, count(*) FILTER (label = 0 AND flag = 1) AS fp,
         count(*) FILTER (label = 1 AND flag = 0) AS fn, count(*) FILTER (label = 1 AND flag = 1) AS tp FROM sd_)"""
PRF = ", ".join(
    [
        r6("CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END", "precision"),
        r6("CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END", "recall"),
        r6("CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END", "f1"),
    ]
)
AUC = """au AS (
  SELECT (sum(CASE WHEN label = 1 THEN rk END) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0)
         / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS roc_auc
  FROM (SELECT label, rank() OVER (ORDER BY -anomaly_score)
                 + (count(*) OVER (PARTITION BY anomaly_score) - 1) / 2.0 AS rk FROM sd_))"""
PREDICTIONS = """pr AS (
  SELECT *, trunc((anomaly_score - lo) / (hi - lo) * 100)::INT AS severity_score,
         trunc((1 - (anomaly_score - lo) / (hi - lo)) * 100)::INT AS severity_high_is_bad
  FROM sd_, (SELECT min(anomaly_score) AS lo, max(anomaly_score) AS hi FROM sd_))"""


def _histogram(source: str, col: str, bins: int) -> str:
    return f"""SELECT flag AS anomaly_prediction, bin::BIGINT AS bin, {r6(f"any_value(l) + bin * ((any_value(h) - any_value(l)) / {bins})", "bin_start")}, count(*) AS n
FROM (SELECT flag, l, h, CASE WHEN h = l THEN 0 ELSE least(floor(({col} - l) * {bins} / (h - l)), {bins - 1}) END AS bin
      FROM {source} JOIN (SELECT flag, min({col}) AS l, max({col}) AS h FROM {source} GROUP BY flag) USING (flag))
GROUP BY flag, bin"""


def _basis_sql(us: str, low: str, high: str) -> list[str]:
    t = f"(({us} - {low}) / ({high} - {low}))"
    columns = ["1.0::DOUBLE", t]
    columns += [f"greatest(0.0::DOUBLE, {t} - {fc.HINGE_RANGE * j / fc.HINGES!r}::DOUBLE)" for j in range(1, fc.HINGES + 1)]
    for days, order in ((1.0, fc.DAILY_ORDER), (7.0, fc.WEEKLY_ORDER)):
        for k in range(1, order + 1):
            angle = f"({us} / 86400000000.0::DOUBLE * (2 * pi() * {k} / {days}::DOUBLE))"
            columns += [f"sin({angle})", f"cos({angle})"]
    return columns


def _moments() -> str:
    basis = _basis_sql("us", "lo", "hi")
    width = len(basis)
    named = ", ".join(f"{c} AS x{i}" for i, c in enumerate(basis))
    pairs = [(i, j) for i in range(width + 1) for j in range(i, width + 1)]
    cells = ", ".join(f"avg(x{i} * x{j})" for i, j in pairs)
    index = ", ".join(f"{{'i': {i}, 'j': {j}}}" for i, j in pairs)
    return with_(
        readings(),
        SPLIT,
        f"""tr AS (SELECT epoch_us(time)::DOUBLE AS us, value AS x{width} FROM s WHERE split = 'train'),
b AS (SELECT {named}, x{width} FROM tr, (SELECT min(us) AS lo, max(us) AS hi FROM tr)),
m AS (SELECT unnest([{cells}]) AS moment, unnest([{index}]) AS ij FROM b)""",
    ) + f"SELECT ij.i::BIGINT AS i, ij.j::BIGINT AS j, {r6('moment', 'moment')} FROM m"


def grid(steps: int = STEPS) -> str:
    return f"""tr AS (SELECT time, value FROM s WHERE split = 'train'),
gr AS (
  SELECT DISTINCT time AS timestamp, NULL::INT AS step FROM tr
  UNION ALL
  SELECT last + to_minutes(k) AS timestamp, k::INT AS step
  FROM (SELECT max(time) AS last FROM tr), (SELECT unnest(range(1, {steps + 1})) AS k)),
fo AS (SELECT timestamp, step, 50.0::DOUBLE + minute(timestamp) AS forecast_point FROM gr)"""


GRID = grid()


def errors(solved: bool) -> str:
    return f"""SELECT count(*) AS n, {r6("avg(abs(a - f))", "mae", solved)}, {r6("sqrt(avg((a - f) * (a - f)))", "rmse", solved)},
  {r6("100 * avg(CASE WHEN a <> 0 THEN abs((a - f) / a) END)", "mape", solved)} FROM al"""


ERRORS = errors(False)


def _gauss(name: str, start: str, size: str, keys: str = "") -> str:
    """Solve [A | b] held as a list of rows in column ``m`` of ``start``; ``size`` rows."""
    k = f"{keys}, " if keys else ""
    return f"""{name}_g AS (
  SELECT {k}0 AS step, m FROM {start}
  UNION ALL
  SELECT {k}step + 1, list_transform(m, lambda r, i: CASE WHEN i = step + 1
      THEN list_transform(r, lambda x: x / r[step + 1])
      ELSE list_transform(r, lambda x, j: x - r[step + 1] * m[step + 1][j] / m[step + 1][step + 1]) END)
  FROM {name}_g WHERE step < {size}),
{name} AS MATERIALIZED (SELECT {k}list_transform(m, lambda r: r[len(r)]) AS coef FROM {name}_g WHERE step = {size})"""


def _seasonal() -> str:
    """fit3: coefficients and variance; ss: the seasonal forecast of every grid time."""
    basis = _basis_sql("us", "lo", "hi")
    width = len(basis)
    named = ", ".join(f"{c} AS x{i}" for i, c in enumerate(basis))
    matrix = lambda last: ", ".join(
        "[" + ", ".join(f"avg(x{i} * x{j})" for j in range(last)) + "]" for i in range(last)
    )
    wide = ["NULL", "NULL"] + [f"{fc.HINGE_SCALE}"] * fc.HINGES + [f"{fc.SEASON_SCALE}"] * (width - 2 - fc.HINGES)
    parts = [
        f"""tn AS (SELECT epoch_us(time)::DOUBLE AS us, value AS x{width} FROM s WHERE split = 'train'),
ends AS (SELECT min(us) AS lo, max(us) AS hi, count(*) AS n, max(abs(x{width})) AS scale FROM tn),
bs AS (SELECT {named}, x{width} FROM tn, ends),
gm AS MATERIALIZED (SELECT [{matrix(width + 1)}] AS g FROM bs),
v0 AS (SELECT greatest(g[{width + 1}][{width + 1}] - g[1][{width + 1}] * g[1][{width + 1}], 0) AS v FROM gm)"""
    ]
    for r in range(1, 4):
        parts.append(f"""st{r} AS (
  SELECT list_transform(g[1:{width}], lambda row, i: list_transform(row, lambda x, j: x + CASE WHEN i = j THEN 1e-9
      + coalesce(v / n / pow(([{", ".join(wide)}])[i]::DOUBLE * scale, 2), 0) ELSE 0 END)) AS m FROM gm, ends, v{r - 1})""")
        parts.append(_gauss(f"co{r}", f"st{r}", str(width)))
        parts.append(f"""v{r} AS MATERIALIZED (
  SELECT greatest(g[{width + 1}][{width + 1}] - 2 * list_dot_product(coef, g[{width + 1}][1:{width}])
      + list_dot_product(coef, list_transform(g[1:{width}], lambda row: list_dot_product(row[1:{width}], coef))), 0) AS v
  FROM gm, co{r})""")
    point = " + ".join(f"coef[{i + 1}] * x{i}" for i in range(width))
    parts.append(f"""ss AS (
  SELECT timestamp, step, {point} AS seasonal_point, sqrt(v) * 1.6448536269514722 AS half
  FROM (SELECT timestamp, step, {named} FROM (SELECT *, epoch_us(timestamp)::DOUBLE AS us FROM gr), ends), co3, v3)""")
    return ",\n".join(parts)


def _widening() -> str:
    """sw: the seasonal forecast with the variance of the trend; follows ``_seasonal``."""
    width = len(fc.basis_names())
    hinges = f"range(3, {3 + fc.HINGES})"
    wide = ["NULL", "NULL"] + ["NULL"] * fc.HINGES + [f"{fc.SEASON_SCALE}"] * (width - 2 - fc.HINGES)
    rest = 1 - fc.HINGE_RANGE
    parts = [f"d0 AS (SELECT pow({fc.HINGE_SCALE} * scale, 2) AS size, v FROM ends, v3)"]
    for r in range(1, fc.DRIFT_ROUNDS + 1):
        parts.append(f"""ds{r} AS (
  SELECT list_transform(g[1:{width}], lambda row, i: list_concat(list_transform(row, lambda x, j: x + CASE WHEN i = j THEN 1e-9
      + CASE WHEN i BETWEEN 3 AND {2 + fc.HINGES} THEN v / n / size ELSE coalesce(v / n / pow(([{", ".join(wide)}])[i]::DOUBLE * scale, 2), 0) END
      ELSE 0 END), list_transform({hinges}, lambda j: CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END))) AS m FROM gm, ends, d{r - 1})""")
        parts.append(_gauss(f"di{r}", f"ds{r}", str(width)))
        parts.append(f"""dc{r} AS MATERIALIZED (
  SELECT m, coef, greatest(g[{width + 1}][{width + 1}] - 2 * list_dot_product(coef, g[{width + 1}][1:{width}])
      + list_dot_product(coef, list_transform(g[1:{width}], lambda row: list_dot_product(row[1:{width}], coef))), 0) AS v
  FROM (SELECT m, list_transform(m, lambda r: r[{width + 1}]) AS coef FROM di{r}_g WHERE step = {width}), gm),
d{r} AS MATERIALIZED (
  SELECT greatest(list_sum(list_transform({hinges}, lambda j: pow(coef[j], 2)))
           / greatest(list_sum(list_transform({hinges}, lambda j: 1 - least(m[j][{width - 1} + j] * dc{r}.v / n / size, 1))), 1e-3),
         pow({fc.LEAST_DRIFT} * scale, 2)) AS size, dc{r}.v AS v
  FROM dc{r}, ends, d{r - 1})""")
    parts.append(f"dr AS (SELECT size AS drift2 FROM d{fc.DRIFT_ROUNDS})")
    return ",\n".join(parts) + f""",
sw AS (
  SELECT timestamp, step, seasonal_point, {NormalDist().inv_cdf(0.95)!r} * sqrt(v + CASE WHEN u > 0 THEN drift2 * {fc.HINGES / fc.HINGE_RANGE}
           * ({rest} * ({rest * rest / 105} + {11 * rest / 105} * u + {13 / 35} * u * u) + u * u * u / 3) ELSE 0 END) AS half
  FROM (SELECT ss.*, (epoch_us(timestamp)::DOUBLE - hi) / (hi - lo) AS u FROM ss, ends), v3, dr)"""


def _backtest(k: int) -> str:
    """Pairs (model, a, f) of one origin, all series pooled."""
    horizon = bt.HORIZON

    def known(period: int) -> str:
        slot = lambda at: f"(epoch({at})::BIGINT // 3600) % {period}"
        return f"""(SELECT step, coalesce(last, (SELECT avg(value) FROM s WHERE split = 'train')) AS f FROM gr
          LEFT JOIN (SELECT {slot("time")} AS slot, arg_max(value, time) AS last FROM s WHERE split = 'train' GROUP BY 1) ON slot = {slot("timestamp")})"""

    return with_(
        readings(),
        f"""hh AS (SELECT date_trunc('hour', time) AS hour, avg(value) AS y FROM r WHERE value IS NOT NULL GROUP BY 1),
og AS (SELECT max(hour) - to_hours({horizon - 1 + k * bt.STRIDE}) AS origin FROM hh),
s AS (SELECT hour AS time, y AS value, CASE WHEN hour < origin THEN 'train' ELSE 'test' END AS split FROM hh, og),
gr AS (SELECT origin + to_hours(h) AS timestamp, (h + 1)::INT AS step FROM og, (SELECT unnest(range(0, {horizon})) AS h))""",
        _seasonal(),
        _arima(horizon),
        f"""pr AS (
  SELECT 'seasonal' AS model, step, seasonal_point AS f FROM ss
  UNION ALL SELECT 'arima', h, level FROM ah WHERE h > 0
  UNION ALL SELECT 'blend', step, 0.6::DOUBLE * seasonal_point + 0.4::DOUBLE * level FROM ss JOIN ah ON h = step
  UNION ALL SELECT 'day_before', step, f FROM {known(24)}
  UNION ALL SELECT 'week_before', step, f FROM {known(168)}
  UNION ALL SELECT 'mean', step, (SELECT avg(value) FROM s WHERE split = 'train') FROM gr)""",
    ) + "SELECT model, value AS a, f FROM pr JOIN gr USING (step) JOIN s ON time = timestamp AND split = 'test'"


def _baselines() -> str:
    """al: pairs (entity_id, model, a, f) of the models that look up known hours, over all origins."""
    slot = lambda at, period: f"(epoch({at})::BIGINT // 3600) % {period}"
    part = lambda model, period: f"""SELECT t.entity_id, '{model}' AS model, t.y AS a, coalesce(any_value(p.last), any_value(m.y)) AS f
  FROM ts t JOIN ms m USING (entity_id, origin)
  LEFT JOIN (SELECT entity_id, origin, {slot("hour", period)} AS slot, arg_max(y, hour) AS last FROM kn GROUP BY ALL) p
    ON p.entity_id = t.entity_id AND p.origin = t.origin AND p.slot = {slot("t.hour", period)}
  GROUP BY t.entity_id, t.origin, t.hour, t.y"""  # noqa: E731
    return f"""hh AS (SELECT entity_id, date_trunc('hour', time) AS hour, avg(value) AS y FROM r WHERE value IS NOT NULL GROUP BY 1, 2),
og AS (SELECT max(hour) - to_hours({bt.HORIZON - 1} + {bt.STRIDE} * k) AS origin FROM hh, (SELECT unnest(range(0, {bt.ORIGINS})) AS k) GROUP BY k),
kn AS (SELECT * FROM hh JOIN og ON hour < origin),
ts AS (SELECT * FROM hh JOIN og ON hour >= origin AND hour < origin + to_hours({bt.HORIZON})),
ms AS (SELECT entity_id, origin, avg(y) AS y FROM kn GROUP BY ALL),
al AS ({part("day_before", 24)} UNION ALL {part("week_before", 168)}
  UNION ALL SELECT entity_id, 'mean', t.y, m.y FROM ts t JOIN ms m USING (entity_id, origin))"""


def _arima(hours: int = fc.HOURS_AHEAD) -> str:
    """fits: every order with coefficients and AIC; ah: so many hours ahead by the best order."""
    lag_w = ", ".join(f"lag(w, {i}) OVER t AS w{i}" for i in range(1, 13))
    long_cols = ["1.0", *[f"w{i}" for i in range(1, 13)]]
    gram = lambda cols, y: "[" + ", ".join("[" + ", ".join(f"sum({a} * {b})" for b in [*cols, y]) + "]" for a in cols) + "]"
    short = ["1.0", "w1", "w2", "e1", "e2"]
    orders = ", ".join(str({"p": p, "d": d, "q": q}) for p, d, q in fc.ARIMA_ORDERS)
    return f"""hr AS (SELECT date_trunc('hour', time) AS hour, avg(value) AS y FROM s WHERE split = 'train' GROUP BY 1),
hn AS (SELECT y, row_number() OVER (ORDER BY hour) - 1 AS t, y - lag(y) OVER (ORDER BY hour) AS dy, count(*) OVER () AS n_hours FROM hr),
ww AS (SELECT 0 AS d, t, y AS w, n_hours FROM hn UNION ALL SELECT 1, t - 1, dy, n_hours FROM hn WHERE t >= 1),
wl AS MATERIALIZED (SELECT d, t, w, n_hours, {lag_w} FROM ww WINDOW t AS (PARTITION BY d ORDER BY t)),
lg AS (SELECT d, {gram(long_cols, "w")} AS m FROM wl WHERE t >= 12 GROUP BY d),
{_gauss("lc", "lg", "13", "d")},
en AS (SELECT wl.*, CASE WHEN t >= 12 THEN w - list_dot_product(coef, [{", ".join(long_cols)}]::DOUBLE[]) ELSE 0 END AS e
       FROM wl JOIN lc USING (d)),
el AS MATERIALIZED (SELECT *, lag(e) OVER t AS e1, lag(e, 2) OVER t AS e2 FROM en WINDOW t AS (PARTITION BY d ORDER BY t)),
sg AS (SELECT d, {gram(short, "w")} AS g, sum(w * w) AS yy, count(*) AS n, any_value(n_hours) AS n_hours
       FROM el WHERE t >= 15 - d GROUP BY d),
od AS (SELECT unnest([{orders}]) AS o),
ix AS (SELECT o.p AS p, o.d AS d, o.q AS q, list_concat(CASE WHEN o.d = 0 THEN [1] ELSE [] END,
         list_concat(([2, 3])[1:o.p], ([4, 5])[1:o.q])) AS cols FROM od),
om AS (SELECT p, q, d, len(cols) AS size,
         list_transform(cols, lambda i: list_concat(list_transform(cols, lambda j: g[i][j]), [g[i][6]])) AS m, cols, g, yy, n, n_hours
       FROM ix JOIN sg USING (d)),
os_g AS (
  SELECT p, q, d, size, 0 AS step, m FROM om
  UNION ALL
  SELECT p, q, d, size, step + 1, list_transform(m, lambda r, i: CASE WHEN i = step + 1
      THEN list_transform(r, lambda x: x / r[step + 1])
      ELSE list_transform(r, lambda x, j: x - r[step + 1] * m[step + 1][j] / m[step + 1][step + 1]) END)
  FROM os_g WHERE step < size),
os AS (SELECT p, q, d, list_transform(m, lambda r: r[len(r)])::DOUBLE[] AS coef FROM os_g WHERE step = size),
fits AS MATERIALIZED (
  SELECT p, d, q, n_hours, ar1, ar2, ma1, ma2, c0,
         CASE WHEN (p = 1 AND abs(ar1) >= 1) OR (p = 2 AND (abs(ar2) >= 1 OR ar2 + ar1 >= 1 OR ar2 - ar1 >= 1)) THEN NULL
              ELSE n * ln((yy - explained) / n) + 2 * (size + 1) END AS aic
  FROM (SELECT *, coalesce(CASE WHEN d = 0 THEN coef[1] END, 0) AS c0,
          coalesce(CASE WHEN p >= 1 THEN coef[2 - d] END, 0) AS ar1, coalesce(CASE WHEN p >= 2 THEN coef[3 - d] END, 0) AS ar2,
          coalesce(CASE WHEN q >= 1 THEN coef[2 - d + p] END, 0) AS ma1, coalesce(CASE WHEN q >= 2 THEN coef[3 - d + p] END, 0) AS ma2,
          CASE WHEN size = 0 THEN 0 ELSE list_dot_product(coef, list_transform(cols, lambda i: g[i][6])::DOUBLE[]) END AS explained
        FROM om JOIN os USING (p, q, d))),
be AS (SELECT * FROM fits WHERE aic IS NOT NULL ORDER BY aic, p, d, q LIMIT 1),
rs_ AS (SELECT be.*, t, w, w1, w - c0 - ar1 * w1 - ar2 * w2 - ma1 * e1 - ma2 * e2 AS shock, lag(w - c0 - ar1 * w1 - ar2 * w2 - ma1 * e1 - ma2 * e2)
          OVER (ORDER BY t) AS shock1 FROM be JOIN el USING (d)),
ah AS (
  SELECT 0 AS h, c0, ar1, ar2, ma1, ma2, d, w AS a, w1 AS b, shock AS u, shock1 AS v, (SELECT arg_max(y, t) FROM hn) AS level
  FROM rs_ WHERE t = (SELECT max(t) FROM rs_)
  UNION ALL
  SELECT h + 1, c0, ar1, ar2, ma1, ma2, d, c0 + ar1 * a + ar2 * b + ma1 * u + ma2 * v, a, 0, u,
         CASE WHEN d = 1 THEN level ELSE 0 END + c0 + ar1 * a + ar2 * b + ma1 * u + ma2 * v
  FROM ah WHERE h < {hours})"""


def ensemble(hours: int = fc.HOURS_AHEAD) -> str:
    return f"""es AS (
  SELECT timestamp, step, seasonal_point, seasonal_point - half AS forecast_lower, seasonal_point + half AS forecast_upper,
         CASE WHEN step IS NULL THEN seasonal_point ELSE 0.6::DOUBLE * seasonal_point + 0.4::DOUBLE * level END AS ensemble_point
  FROM ss LEFT JOIN (SELECT h, level FROM ah WHERE h > 0) ON h = least((step - 1) // 60 + 1, {hours}) AND step IS NOT NULL)"""


ENSEMBLE = ensemble()


def _statistics(variant: str = "plain") -> str:
    return with_(readings(variant), windows("r", E), features(E))


def _per_feature(names, columns) -> str:
    """One row per feature from one aggregation over f."""
    lists = [
        f"unnest([{', '.join(expr.format(c=n) for n in names)}]) AS {out}" for out, expr in columns.items()
    ]
    labels = "unnest([" + ", ".join(f"'{n}'" for n in names) + "]) AS feature"
    return f"SELECT {labels}, {', '.join(lists)}, count(*) AS n_windows FROM f"


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    r, rn = readings(), readings("nulls")

    # sources and filters
    sql["load_profile"] = with_(rn) + f"""SELECT count(*) AS n_records, min(time) AS min_time, max(time) AS max_time,
      count(*) FILTER (value IS NULL) AS null_count, {r6("100.0 * count(*) FILTER (value IS NULL) / count(*)", "null_pct")},
      count(DISTINCT equipment) AS n_equipment, count(DISTINCT system) AS n_systems FROM r"""
    sql["ts_parse"] = """SELECT event_id, CASE event_id % 3 WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL 2 HOUR
      ELSE date_trunc('second', ts) END AS time FROM events"""
    sql["numeric_coercion"] = f"SELECT event_id, {r6('value', 'value')} FROM events WHERE event_id % 23 > 3"
    sql["entity_ids"] = with_(r) + "SELECT DISTINCT entity_id FROM r"
    sql["null_key_entities"] = """SELECT coalesce(CASE WHEN user_id % 3 = 0 THEN NULL ELSE 'EQ' || (user_id % 2) END, 'nan')
      || '_' || event_type AS entity_id, count(*) AS n FROM events GROUP BY 1"""
    sql["missing_key_default"] = "SELECT 'global' AS entity_id, count(*) AS n FROM events"
    sql["null_filter"] = with_(readings("nan")) + f"SELECT row_key AS event_id, entity_id, {r6('value', 'value')} FROM r WHERE value IS NOT NULL"
    sql["new_data_scan"] = with_(rn) + "SELECT entity_id, count(*) AS n, count(*) FILTER (value IS NULL) AS n_null FROM r GROUP BY 1"
    sql["entity_lookup"] = with_(r) + f"SELECT row_key AS event_id, time, {r6('value', 'value')} FROM r WHERE entity_id = 'EQ0_click'"
    sql["csv_roundtrip"] = with_(rn) + f"SELECT time, entity_id, {r6('value', 'value')} FROM r"

    # quality
    sql["entity_profile"] = with_(rn) + f"""SELECT entity_id, count(value) AS n_records,
      {r6("date_diff('microsecond', min(time) FILTER (value IS NOT NULL), max(time) FILTER (value IS NOT NULL)) / 3.6e9", "time_span_hours")},
      {r6("avg(value)", "mean_value")}, {r6("stddev_samp(value)", "std_value")}, count(*) FILTER (value IS NULL) AS null_count
      FROM r GROUP BY entity_id HAVING count(value) > 0"""
    sql["time_delta"] = with_(r, GAPS) + f"SELECT row_key AS event_id, {r6('gap_minutes', 'gap_minutes')} FROM g"
    sql["gap_report"] = with_(r, GAPS) + f"""SELECT entity_id, count(*) FILTER (gap_minutes > {MAX_GAP}) AS n_gaps,
      {r6(f"max(gap_minutes) FILTER (gap_minutes > {MAX_GAP})", "max_gap_minutes")} FROM g GROUP BY entity_id"""
    sql["segments"] = with_(r, SEGMENTS) + "SELECT row_key AS event_id, entity_id, segment_id FROM sg"
    sql["segment_counts"] = with_(r, SEGMENTS) + "SELECT entity_id, max(segment_id) + 1 AS n_segments FROM sg GROUP BY entity_id"
    sql["segment_stats"] = with_(r, SEGMENTS) + f"""SELECT entity_id, segment_id, count(*) AS n_rows, min(time) AS start_time,
      max(time) AS end_time, {r6("avg(value)", "mean_value")} FROM sg GROUP BY entity_id, segment_id"""
    sql["stream_segment_stats"] = sql["segment_stats"]
    sql["train_test_split"] = with_(r, SPLIT) + "SELECT row_key AS event_id, entity_id, split FROM s"
    sql["split_report"] = with_(r, SPLIT) + """SELECT entity_id, count(*) FILTER (split = 'train') AS train_size,
      count(*) FILTER (split = 'test') AS test_size, min(time) FILTER (split = 'train') AS train_start,
      max(time) FILTER (split = 'train') AS train_end, min(time) FILTER (split = 'test') AS test_start,
      max(time) FILTER (split = 'test') AS test_end FROM s GROUP BY entity_id"""

    # imputation
    last = "last_value(value IGNORE NULLS) OVER (PARTITION BY entity_id ORDER BY time, row_key ROWS UNBOUNDED PRECEDING)"
    mean = "coalesce(value, avg(value) OVER (PARTITION BY entity_id))"
    sql["forward_fill"] = with_(rn) + f"SELECT row_key AS event_id, entity_id, {r6(last, 'value')} FROM r"
    sql["impute_knn"] = with_(rn) + f"SELECT row_key AS event_id, entity_id, {r6(mean, 'value')} FROM r"
    sql["impute_ensemble"] = sql["impute_knn"]
    sql["impute_spline"] = with_(rn, _spline()) + f"SELECT row_key AS event_id, entity_id, {r6('value', 'value')} FROM sy"
    # Of each side no more than five rows can be among the five nearest.
    sql["impute_knn_time"] = with_(rn) + f"""
      , o AS (SELECT *, row_number() OVER w AS rn, count(value) OVER (w ROWS UNBOUNDED PRECEDING) AS kn FROM r WINDOW w AS (PARTITION BY entity_id ORDER BY time, row_key)),
      near AS (
        SELECT a.row_key, b.value FROM o a JOIN o b ON a.entity_id = b.entity_id AND a.value IS NULL AND b.value IS NOT NULL AND b.kn BETWEEN a.kn - 4 AND a.kn + 5
        QUALIFY row_number() OVER (PARTITION BY a.row_key ORDER BY abs(date_diff('microsecond', a.time, b.time)), abs(a.rn - b.rn), b.rn) <= 5),
      m AS (SELECT row_key, avg(value) AS guess FROM near GROUP BY row_key)
      SELECT row_key AS event_id, entity_id, {r6('coalesce(value, guess)', 'value')} FROM o LEFT JOIN m USING (row_key)"""
    sql["missing_counts"] = with_(rn) + f"""SELECT entity_id, count(*) FILTER (value IS NULL) AS nulls_before,
      count(*) FILTER (filled IS NULL) AS nulls_after FROM (SELECT entity_id, value, {last} AS filled FROM r) GROUP BY entity_id"""

    # windows and features
    frame = lambda a, b: f"OVER (PARTITION BY entity_id ORDER BY time, row_key ROWS BETWEEN {a} PRECEDING AND {b} FOLLOWING)"
    roll = lambda a, b: f"CASE WHEN count(*) {frame(a, b)} = {a + b + 1} THEN avg(value) {frame(a, b)} ELSE value END"
    sql["rolling_means"] = with_(r) + f"SELECT row_key AS event_id, {r6(roll(2, 2), 'rolling_5')}, {r6(roll(5, 4), 'rolling_10')} FROM r"
    sql["series_lengths"] = with_(r, SPLIT) + "SELECT entity_id, split, count(*) AS n_rows FROM s GROUP BY ALL HAVING count(*) >= 60"
    sql["window_counts"] = with_(rn, windows("r", E)) + """SELECT entity_id, count(*) AS n_total,
      count(*) FILTER (n_values = 60) AS n_processed, count(*) FILTER (n_values < 60) AS n_skipped FROM st0 GROUP BY entity_id"""
    meta = rounded_columns(MODEL_FEATURES[:5])
    sql["window_meta"] = with_(r, SPLIT, windows("s", ES), features(ES, ())) + f"SELECT entity_id, split, {', '.join(TIMES)}, {meta} FROM f"
    sql["window_step"] = with_(r, windows("r", E, step=7), features(E, ())) + f"""SELECT entity_id, {', '.join(TIMES)},
      n_points, {r6("mean_oxygen", "mean_oxygen")} FROM f"""
    sk = ["entity_id", "segment_id"]
    sql["segment_windows"] = with_(r, SEGMENTS, windows("sg", sk, 10, 5)) + f"""SELECT entity_id, segment_id, {', '.join(TIMES)},
      n_points, {r6("m", "mean_oxygen")}, {r6("p50", "median")} FROM st"""
    for group, names in wf.GROUPS.items():
        sql[f"{group}_features"] = feature_query(names, "stuck", groups=(group,))
    sql["all_features"] = feature_query(MODEL_FEATURES, times=TIMES)
    sql["split_features"] = feature_query(MODEL_FEATURES, keys=ES, times=TIMES)
    sql["alert_episodes"] = with_(r, SPLIT, windows("s", ES), features(ES, ("point",)), GRID, f"""ft AS (SELECT * FROM f WHERE split = 'test'),
      bd AS (SELECT entity_id, win, avg(forecast_point) AS band FROM ft LEFT JOIN fo ON fo.timestamp BETWEEN window_start AND window_end GROUP BY ALL),
      sc AS (SELECT ft.*, round(max_zscore, 6) AS score, coalesce(abs(mean_oxygen - band) > {BAND}, false) AS off FROM ft JOIN bd USING (entity_id, win)),
      x AS (
        SELECT *, coalesce(score >= {HOT} OR (score >= {CALM} AND off), false) AS hot, coalesce(score < {CALM} AND NOT off, false) AS calm,
               row_number() OVER (PARTITION BY entity_id ORDER BY window_start, window_end, window_center) AS i,
               count(*) OVER (PARTITION BY entity_id) AS rows_of FROM sc),
      m AS (
        SELECT entity_id, i, hot::INT AS hots, calm::INT AS calms, hot AND {N_OPEN} = 1 AS is_open FROM x WHERE i = 1
        UNION ALL
        SELECT x.entity_id, x.i, CASE WHEN hot THEN hots + 1 ELSE 0 END, CASE WHEN calm THEN calms + 1 ELSE 0 END,
               CASE WHEN NOT is_open THEN hot AND hots + 1 >= {N_OPEN} ELSE NOT (calm AND calms + 1 >= {N_CLOSE}) END
        FROM m JOIN x ON x.entity_id = m.entity_id AND x.i = m.i + 1),
      o AS (SELECT x.*, is_open, is_open AND NOT coalesce(lag(is_open) OVER (PARTITION BY entity_id ORDER BY i), false) AS begins FROM x JOIN m USING (entity_id, i)),
      ep AS (SELECT *, sum(begins::INT) OVER (PARTITION BY entity_id ORDER BY i)::BIGINT AS episode FROM o)""") + f"""
      SELECT entity_id, episode, min(window_start) AS start_time, max(window_end) AS end_time, count(*) AS n_windows, {r6("max(score)", "peak_score")},
             count(*) FILTER (off) AS n_off_forecast, max(i) < max(rows_of) AS is_closed
      FROM ep WHERE is_open GROUP BY entity_id, episode"""
    nan = readings("nan")
    fortnight = f"value IS NOT NULL AND time::DATE BETWEEN DATE '{SKETCH_FROM}' AND DATE '{SKETCH_TO}'"
    sql["sketch_profile"] = with_(nan) + f"""SELECT entity_id, count(*) AS n_records, true AS distinct_near, true AS p50_near, true AS p95_near,
      true AS p99_near FROM r WHERE {fortnight} GROUP BY entity_id"""
    sql["sketch_rollup"] = with_(nan) + f"""SELECT equipment, count(value) FILTER ({fortnight}) AS n_records,
      count(DISTINCT system) AS n_systems FROM r WHERE time::DATE BETWEEN DATE '{SKETCH_FROM}' AND DATE '{SKETCH_TO}' GROUP BY equipment"""

    def peaks(level: float, sign: int = 1) -> str:
        return f"""v AS (SELECT *, {sign} * value AS x FROM r WHERE value IS NOT NULL),
          o AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY x) AS k, count(*) OVER (PARTITION BY entity_id) AS n FROM v),
          t AS (SELECT entity_id, n, x AS t FROM o WHERE k = greatest(ceil({level}::DOUBLE * n), 1)),
          y AS (
            SELECT entity_id, n, t, count(*) FILTER (x > t) AS c, avg(x - t) FILTER (x > t) AS m, var_pop(x - t) FILTER (x > t) AS v
            FROM o JOIN t USING (entity_id, n) GROUP BY ALL),
          q AS (SELECT *, CASE WHEN v > 1e-12 * m * m THEN m * m / v END AS ratio FROM y),
          g AS (SELECT *, coalesce(0.5 * (1 - ratio), 0) AS shape, coalesce(0.5 * m * (1 + ratio), m, 0) AS scale, {RISK} * n / c AS share FROM q),
          l AS (SELECT *, t + greatest(CASE WHEN c = 0 THEN 0 WHEN abs(shape) < 1e-9 THEN -scale * ln(share)
                                       ELSE scale / shape * (pow(share, -shape) - 1) END, 0) AS z FROM g)"""

    sql["series_quantiles"] = with_(rn, peaks(PEAK_LEVEL)) + f"SELECT entity_id, n, {r6('t', 'value')} FROM t"
    sql["peak_thresholds"] = with_(rn, peaks(PEAK_LEVEL)) + f"""SELECT entity_id, n AS n_rows, {r6("t", "peak_level")}, c AS n_peaks,
      {r6("shape", "shape")}, {r6("scale", "scale")}, {r6("z", "alert_level")} FROM l"""
    sql["peak_alerts"] = with_(rn, peaks(0.9, -1)) + f"SELECT row_key AS event_id, entity_id, {r6('value', 'value')} FROM v JOIN l USING (entity_id) WHERE x > z"

    def in_time(source: str) -> str:
        return f"""SELECT DISTINCT entity_id, time AS window_end, count(value) OVER w AS n_points, {r6(f"avg(value) OVER w + {NUDGE}", "mean")},
          {r6("CASE WHEN min(value) OVER w = max(value) OVER w THEN 0 ELSE stddev_pop(value) OVER w END", "std")},
          {r6("min(value) OVER w", "min")}, {r6("max(value) OVER w", "max")} FROM {source}
          WINDOW w AS (PARTITION BY entity_id ORDER BY time RANGE BETWEEN INTERVAL {WINDOW_MINUTES} MINUTE PRECEDING AND CURRENT ROW)"""

    squeezed = f"""b AS (SELECT * REPLACE (CASE WHEN row_key % 3 = 0 THEN make_timestamp({BURST_US} + row_key * 500) ELSE time END AS time) FROM r)"""
    sql["time_windows"] = with_(rn) + in_time("r")
    sql["time_windows_burst"] = with_(rn, squeezed) + in_time("b")
    sql["stream_features"] = sql["all_features"]
    sql["incremental_features"] = sql["split_features"]
    flagship = ["mean_oxygen", "std_oxygen", "percentile_25", "median", "max_roc", "autocorr_lag1", "trend_strength", "max_zscore"]
    sql["outlier_windows"] = (
        feature_query(flagship, groups=("point", "collective", "distribution"), times=TIMES) + " WHERE round(max_zscore, 9) > 3"
    )
    filled = f"rf AS (SELECT * REPLACE ({mean} AS value) FROM r)"
    new = ["n_points", "mean_oxygen", "std_oxygen", "median", "max_roc"]
    sql["new_data_features"] = with_(rn, filled, windows("rf", E), features(E, ("collective", "distribution"))) + f"""SELECT
      entity_id, {', '.join(TIMES)}, {rounded_columns(new)} FROM f"""
    stat = {"mean": "round(avg({c}), 6) + 0.0", "std": "round(stddev_samp({c}), 6) + 0.0"}
    sql["feature_stats"] = _statistics() + _per_feature(MODEL_FEATURES, stat)
    sql["top_features"] = (
        _statistics()
        + f"SELECT feature, std FROM ({_per_feature(MODEL_FEATURES, {'std': stat['std']})}) ORDER BY std DESC NULLS LAST, feature LIMIT 15"
    )
    pairs = [(a, b) for a in CORRELATED for b in CORRELATED]
    corr = lambda a, b: f"CASE WHEN max({a}) = min({a}) OR max({b}) = min({b}) THEN NULL ELSE round(corr({a}, {b}), 6) + 0.0 END"
    sql["feature_corr"] = _statistics() + f"""SELECT unnest([{', '.join(f"'{a}'" for a, _ in pairs)}]) AS feature_a,
      unnest([{', '.join(f"'{b}'" for _, b in pairs)}]) AS feature_b, unnest([{', '.join(corr(a, b) for a, b in pairs)}]) AS corr FROM f"""

    # injection and labels
    inj = with_(r, _injection())
    sql["inject_events"] = inj + f"""SELECT entity_id, event_no, rn, type, time, {r6("injected_value", "injected_value")},
      {r6("original_value", "original_value")} FROM il"""
    sql["inject_rows"] = inj + f"""SELECT row_key AS event_id, rn, {r6("value", "value")}, {r6("original_value", "original_value")},
      anomaly_label FROM x"""
    sql["inject_counts"] = inj + "SELECT type, count(*) AS n FROM il GROUP BY type ORDER BY n DESC, type"
    sql["uncovered_events"] = inj + """SELECT a.row_key AS event_id, a.event_no, a.rn, a.type FROM i a WHERE a.event_no IS NOT NULL
      AND NOT EXISTS (SELECT 1 FROM v0 b JOIN i c ON c.event_no = b.event_no WHERE b.rn = a.rn AND b.event_no < a.event_no AND c.rn < a.rn)"""
    lengths = " ".join(f"WHEN '{f}' THEN {n}" for f, (n, _, _) in FAULTS.items())
    sql["greedy_events"] = inj + f""", ev AS (
        SELECT row_key, event_no, rn, type, rn + CASE type {lengths} END - 1 AS z, row_number() OVER (ORDER BY rn) AS k FROM i WHERE event_no IS NOT NULL),
      gr AS (
        SELECT k, [{{'no': event_no, 'z': z}}] AS live, true AS ok FROM ev WHERE k = 1
        UNION ALL
        SELECT k, CASE WHEN ok THEN list_append(live, {{'no': event_no, 'z': z}}) ELSE live END, ok FROM (
          SELECT k, event_no, z, live, len(list_filter(live, lambda x: x.no < event_no)) = 0 AS ok FROM (
            SELECT ev.k, event_no, z, list_filter(live, lambda x: x.z >= rn) AS live FROM gr JOIN ev ON ev.k = gr.k + 1)))
      SELECT row_key AS event_id, event_no, rn, type FROM ev JOIN gr USING (k) WHERE ok"""
    side = "SELECT row_key, system, time FROM r WHERE equipment = 'EQ0'"
    sql["nearest_label"] = with_(r, f"""a AS (SELECT row_key, system, time FROM r WHERE equipment = 'EQ1'), b AS ({side}),
lo AS (SELECT a.row_key, a.time, b.time AS bt, b.row_key AS bk FROM a ASOF LEFT JOIN b ON a.system = b.system AND a.time >= b.time),
hi AS (SELECT a.row_key, a.time, b.time AS bt, b.row_key AS bk FROM a ASOF LEFT JOIN b ON a.system = b.system AND a.time <= b.time)""") + """
SELECT lo.row_key AS event_id, (CASE WHEN hi.bk IS NULL OR (lo.bk IS NOT NULL AND lo.time - lo.bt <= hi.bt - hi.time)
  THEN lo.bk ELSE hi.bk END % 2)::INT AS label FROM lo JOIN hi USING (row_key)"""
    sql["window_labels"] = with_(r, _injection(), windows("x", ES), features(ES, ())) + f"""SELECT f.entity_id, f.split, window_start,
      window_end, window_center, {r6("mean_oxygen", "mean_oxygen")}, anomaly_label, anomaly_label AS label
      FROM f JOIN x ON x.time = f.window_center"""
    sql["union_batches"] = with_(
        r,
        _injection(),
        "u AS (SELECT entity_id, split, time, row_key, value, NULL::INT AS anomaly_label FROM s WHERE split = 'train'"
        " UNION ALL SELECT entity_id, split, time, row_key, value, anomaly_label FROM x)",
        windows("u", ES),
        features(ES, ()),
    ) + """SELECT entity_id, split, count(*) AS n_windows, count(u.anomaly_label) AS n_labelled,
      sum(coalesce((u.anomaly_label = 1)::INT, 0))::BIGINT AS n_positive
      FROM f JOIN u USING (entity_id, split) WHERE u.time = f.window_center GROUP BY ALL"""

    # scaling, scores, evaluation
    clean = "CASE WHEN {c} IS NULL OR isnan({c}::DOUBLE) OR isinf({c}::DOUBLE) THEN 0 ELSE {c} END"
    fitted = {"mean": f"round(avg({clean}), 6) + 0.0", "std": f"round(stddev_pop({clean}), 6) + 0.0"}
    sql["scaler_fit"] = _statistics("stuck") + f"SELECT feature, mean, std FROM ({_per_feature(MODEL_FEATURES, fitted)})"
    sur = with_(_surrogate())
    sql["scaled_features"] = sur + f"SELECT entity_id, split, window_start, {rounded_columns(SURROGATE)} FROM sc WHERE split = 'test'"
    sql["surrogate_threshold"] = sur + f"""SELECT {r6("any_value(o)", '"offset"')}, count(*) FILTER (raw < o) AS n_below
      FROM rw, off WHERE split = 'train'"""
    sql["anomaly_predictions"] = with_(_surrogate(), PREDICTIONS) + f"""SELECT entity_id, {', '.join(TIMES)}, flag AS anomaly_prediction,
      {r6("anomaly_score", "anomaly_score")}, flag = 1 AS is_anomaly, severity_score, severity_high_is_bad FROM pr"""
    sql["detection_summary"] = sur + f"""SELECT count(*) AS n_windows, coalesce(sum(flag), 0)::BIGINT AS n_anomalies,
      {r6("100.0 * sum(flag) / count(*)", "anomaly_rate_pct")}, {r6("min(anomaly_score)", "min_score")},
      {r6("max(anomaly_score)", "max_score")} FROM sd_"""
    sql["confusion_matrix"] = with_(_surrogate(), CONFUSION) + "SELECT * FROM cm"
    sql["precision_recall"] = with_(_surrogate(), CONFUSION) + f"SELECT {PRF} FROM cm"
    sql["roc_auc"] = with_(_surrogate(), AUC) + f"SELECT {r6('roc_auc', 'roc_auc')} FROM au"
    sql["roc_points"] = sur + f"""SELECT {r6("anomaly_score", "threshold")},
      {r6("sum(sum(1 - label)) OVER v / (SELECT sum(1 - label) FROM sd_)", "fpr")},
      {r6("sum(sum(label)) OVER v / (SELECT sum(label) FROM sd_)", "tpr")}
      FROM sd_ GROUP BY anomaly_score WINDOW v AS (ORDER BY anomaly_score)"""
    sql["evaluation"] = with_(_surrogate(), CONFUSION, AUC) + f"SELECT tn, fp, fn, tp, {PRF}, {r6('roc_auc', 'roc_auc')} FROM cm, au"
    sql["score_histogram"] = sur + _histogram("sd_", "anomaly_score", 50)
    sql["severity_histogram"] = with_(_surrogate(), PREDICTIONS) + _histogram("pr", "severity_score", 30)
    sql["run_summary"] = with_(r, SPLIT) + """SELECT count(DISTINCT entity_id) AS n_entities, count(DISTINCT entity_id) FILTER (c >= 60)
      AS n_successful FROM (SELECT entity_id, split, count(*) AS c FROM s GROUP BY ALL)"""

    # forest
    split_windows = ",\n".join([r, SPLIT, windows("s", ES), features(ES)])
    halves = "ft AS (SELECT * FROM f WHERE split = 'train'), fs AS (SELECT * FROM f WHERE split = 'test')"
    grown = with_(split_windows, halves, _forest("ft", "fs"), PREDICTIONS)
    shown = f"""SELECT entity_id, {', '.join(TIMES)}, flag AS anomaly_prediction, {r6("anomaly_score", "anomaly_score")},
      flag = 1 AS is_anomaly, severity_score, severity_high_is_bad FROM pr"""
    sql["forest_scores"] = grown + shown
    sql["forest_training_summary"] = grown + sql["detection_summary"][len(sur) :].replace("sd_", "td_")

    # stores
    trained = "SELECT entity_id FROM s WHERE split = 'train' GROUP BY entity_id HAVING count(*) >= 60"
    sql["feature_cache"] = with_(r, SPLIT) + f"""SELECT DISTINCT entity_id, CASE WHEN equipment = 'EQ0' AND entity_id IN ({trained})
      THEN 'existing' ELSE 'missing' END AS status FROM s"""
    sql["feature_store"] = with_(r, SPLIT, windows("s", ES)) + f"""SELECT entity_id, split, window_start, {r6("m", "mean_oxygen")},
      {r6("p50", "median")} FROM st WHERE split = 'test'"""
    sql["stored_entities"] = with_(r, SPLIT) + trained
    sql["prediction_store"] = with_(_surrogate(), PREDICTIONS) + """SELECT entity_id, count(*) AS n, sum(flag)::BIGINT AS n_anomalies,
      max(severity_score) AS max_severity FROM pr GROUP BY entity_id"""

    # forecasting
    hour = "date_trunc('hour', time) AS hour"
    sql["hourly_resample"] = with_(rn) + f"SELECT {hour}, {r6('avg(value)', 'hourly_mean')} FROM r WHERE value IS NOT NULL GROUP BY 1"
    sql["hourly_resample_by_entity"] = with_(rn) + f"""SELECT entity_id, {hour}, {r6("avg(value)", "hourly_mean")} FROM r
      WHERE value IS NOT NULL GROUP BY 1, 2"""
    sql["future_grid"] = with_(r, SPLIT, GRID) + "SELECT timestamp, coalesce(step, 0) AS step FROM gr"
    sql["step_hold_blend"] = with_(r, SPLIT, GRID) + f"""SELECT step, timestamp,
      {r6("0.6::DOUBLE * forecast_point + 0.4::DOUBLE * hv", "ensemble_point")} FROM fo
      JOIN (SELECT hour(time) AS h, avg(value) AS hv FROM tr GROUP BY 1) ON h = least((step - 1) // 60, 23) WHERE step IS NOT NULL"""
    sql["forecast_metrics"] = with_(r, SPLIT, GRID, """al AS (
  SELECT s.value AS a, forecast_point AS f FROM s JOIN fo ON date_trunc('minute', s.time) = date_trunc('minute', fo.timestamp)
  WHERE split = 'test' AND step IS NOT NULL)""") + ERRORS
    sql["forecast_metrics_by_position"] = with_(r, SPLIT, GRID, """al AS (
  SELECT a.value AS a, b.forecast_point AS f
  FROM (SELECT value, row_number() OVER (ORDER BY time, row_key) AS k FROM s WHERE split = 'test') a
  JOIN (SELECT forecast_point, row_number() OVER (ORDER BY timestamp) AS k FROM fo) b USING (k))""") + ERRORS
    sql["forecast_head"] = with_(r, SPLIT, GRID) + f"""SELECT timestamp, {r6("forecast_point", "forecast_point")} FROM fo
      ORDER BY timestamp LIMIT (SELECT count(*) FROM s WHERE split = 'test')"""
    sql["forecast_moments"] = _moments()

    sql["seasonal_forecast"] = with_(r, SPLIT, GRID, _seasonal()) + f"""SELECT timestamp, coalesce(step, 0) AS step,
      {r3("seasonal_point", "seasonal_point")}, {r3("seasonal_point - half", "forecast_lower")},
      {r3("seasonal_point + half", "forecast_upper")} FROM ss"""
    sql["widening_interval"] = with_(r, SPLIT, GRID, _seasonal(), _widening()) + f"""SELECT timestamp, coalesce(step, 0) AS step,
      {r3("seasonal_point", "seasonal_point")}, {r3("seasonal_point - half", "forecast_lower")},
      {r3("seasonal_point + half", "forecast_upper")} FROM sw"""
    pairs = " UNION ALL ".join(f"(SELECT * FROM ({_backtest(k)}))" for k in range(bt.ORIGINS))
    sql["backtest_errors"] = errors(True).replace("SELECT count(*)", "SELECT model, count(*)").replace("FROM al", f"FROM ({pairs}) GROUP BY model")
    sql["baseline_choice"] = with_(r, _baselines(), f"""er AS (
  SELECT entity_id, model, count(*) AS n, sqrt(avg((a - f) * (a - f))) AS rmse, avg(abs(a - f)) AS mae,
         100 * avg(CASE WHEN a <> 0 THEN abs((a - f) / a) END) AS mape, list_position({list(bt.MODELS)}, model) AS place
  FROM al GROUP BY entity_id, model)""") + f"""SELECT entity_id, model, {r3("rmse", "rmse")}, {r3("mae", "mae")}, n, models
      FROM (SELECT *, count(*) OVER (PARTITION BY entity_id) AS models,
              row_number() OVER (PARTITION BY entity_id ORDER BY n DESC, round(rmse, 9), place) AS k FROM er) WHERE k = 1"""
    sql["arima_orders"] = with_(r, SPLIT, _arima()) + f"SELECT p, d, q, n_hours, {r3('aic', 'aic')} FROM fits"
    both = with_(r, SPLIT, GRID, _seasonal(), _arima(), ENSEMBLE)
    sql["ensemble_forecast"] = both + f"""SELECT timestamp, coalesce(step, 0) AS step, {r3("seasonal_point", "seasonal_point")},
      {r3("ensemble_point", "ensemble_point")}, {r3("ensemble_point", "forecast_point")},
      {r3("forecast_lower", "forecast_lower")}, {r3("forecast_upper", "forecast_upper")} FROM es"""
    sql["forecast_evaluation"] = with_(r, SPLIT, GRID, _seasonal(), _arima(), ENSEMBLE, """al AS (
  SELECT s.value AS a, ensemble_point AS f FROM s JOIN es ON date_trunc('minute', s.time) = date_trunc('minute', es.timestamp)
  WHERE split = 'test' AND step IS NOT NULL)""") + errors(True)
    ahead = LONG_STEPS // 60
    sql["ensemble_forecast_long"] = with_(r, SPLIT, grid(LONG_STEPS), _seasonal(), _arima(ahead), ensemble(ahead)) + f"""SELECT timestamp, step,
      {r3("seasonal_point", "seasonal_point")}, {r3("ensemble_point", "ensemble_point")}, {r3("ensemble_point", "forecast_point")},
      {r3("forecast_lower", "forecast_lower")}, {r3("forecast_upper", "forecast_upper")} FROM es WHERE step IS NOT NULL"""

    def each_entity(columns: str, *parts: str) -> str:
        """The pooled query over one series after the other."""
        pick = "(SELECT entity_id FROM (SELECT DISTINCT entity_id FROM r) ORDER BY 1 LIMIT 1 OFFSET {k})"
        one = []
        for k in range(ENTITIES):
            own = SPLIT.replace("FROM r)", f"FROM r WHERE entity_id = {pick.format(k=k)})")
            one.append(f"(SELECT * FROM ({with_(r, own, *parts)} SELECT (SELECT any_value(entity_id) FROM s) AS entity_id, {columns}))")
        return " UNION ALL ".join(one)

    hours = ENTITY_STEPS // 60
    sql["ensemble_forecast_by_entity"] = each_entity(
        f"""timestamp, coalesce(step, 0) AS step, {r3("seasonal_point", "seasonal_point")}, {r3("ensemble_point", "ensemble_point")},
      {r3("ensemble_point", "forecast_point")}, {r3("forecast_lower", "forecast_lower")}, {r3("forecast_upper", "forecast_upper")} FROM es""",
        grid(ENTITY_STEPS), _seasonal(), _arima(hours), ensemble(hours),
    )
    sql["inference_forecast"] = each_entity(
        f"""timestamp, {r3("seasonal_point", "seasonal_point")}, {r3("seasonal_point - half", "forecast_lower")},
      {r3("seasonal_point + half", "forecast_upper")} FROM ss""",
        grid(ENTITY_STEPS), _seasonal(),
    )

    # jobs
    sql["preprocessing_job"] = with_(
        f"r0 AS ({with_(rn)} SELECT * FROM r WHERE value IS NOT NULL)",
        "r AS (SELECT * FROM r0)",
        SEGMENTS,
        _injection().replace("FROM r)", "FROM sg)", 1),
    ) + """SELECT s.entity_id, s.split, count(*) AS n, max(segment_id) AS last_segment, coalesce(sum(x.anomaly_label), 0)::BIGINT AS n_labelled
      FROM s LEFT JOIN x USING (row_key) GROUP BY s.entity_id, s.split"""
    merged = """u AS (SELECT entity_id, split, time, row_key, value, NULL::INT AS anomaly_label FROM s
    WHERE split = 'train' OR entity_id <> (SELECT min(entity_id) FROM s)
  UNION ALL SELECT entity_id, split, time, row_key, value, anomaly_label FROM x)"""
    labelled = """sl_ AS (SELECT q.*, coalesce(x.anomaly_label, 0) AS label FROM sd_ q
  LEFT JOIN x ON x.entity_id = q.entity_id AND x.time = q.window_center)"""
    sql["training_job"] = with_(
        r, _injection(), merged, windows("u", ES), features(ES), halves, _forest("ft", "fs"), labelled,
        CONFUSION.replace("sd_", "sl_"), AUC.replace("sd_", "sl_"),
    ) + f"SELECT tn, fp, fn, tp, {PRF}, {r6('roc_auc', 'roc_auc')} FROM cm, au"
    sources = f"""u AS (SELECT 'old' AS src, entity_id, split, time, row_key, value FROM s WHERE split = 'train'
  UNION ALL SELECT 'new', entity_id, 'all', time, row_key, coalesce(v, avg(v) OVER (PARTITION BY entity_id))
  FROM (SELECT *, CASE WHEN row_key % 17 = 0 THEN NULL ELSE value END AS v FROM r))"""
    sk = ["src", *ES]
    sql["inference_job"] = with_(
        r, SPLIT, sources, windows("u", sk), features(sk),
        "ft AS (SELECT * FROM f WHERE src = 'old'), fs AS (SELECT * FROM f WHERE src = 'new')",
        _forest("ft", "fs"), PREDICTIONS,
    ) + shown
    sql["clean_store"] = with_(f"r0 AS ({with_(readings('nan'))} SELECT * FROM r WHERE value IS NOT NULL)", "r AS (SELECT * FROM r0)", SEGMENTS) + """
      SELECT entity_id, count(*) AS n, min(time) AS start_time, max(time) AS end_time, max(segment_id) AS last_segment FROM sg GROUP BY 1"""
    sql["model_roundtrip"] = sql["forest_scores"]
    sql["feature_job"] = with_(r, SPLIT, windows("s", ES)) + f"""SELECT entity_id, split, count(*) AS n_windows,
      {r6("avg(p50)", "mean_median")} FROM st GROUP BY 1, 2"""
    sql["forecast_training_job"] = sql["forecast_evaluation"]
    sql["pipeline_job"] = with_(f"r0 AS ({with_(rn)} SELECT * FROM r WHERE value IS NOT NULL)", "r AS (SELECT * FROM r0)", SPLIT) + f"""
      SELECT split AS part, sum(greatest(c - 59, 0))::BIGINT AS n FROM (SELECT entity_id, split, count(*) AS c FROM s GROUP BY ALL) GROUP BY 1
      UNION ALL SELECT 'forecast', {STEPS}
      UNION ALL SELECT 'labelled', count(*) FROM s WHERE split = 'test' AND entity_id = (SELECT min(entity_id) FROM s)"""
    return sql
