"""The same queries as ANSI SQL over the same tables, for checking results with another engine."""

from __future__ import annotations

from loadlens.functions import constants as K
from loadlens.functions.features import BASE_CATEGORICAL, BASE_NUMERIC
from loadlens.plans.catalog import INEXACT, LOAD_COLUMNS, RIDGE_COLUMNS, SAMPLE_KEY, SPLIT, WINDOWS

LOADS = """loads AS (
SELECT concat('TR-', format('{:07d}', l.l_orderkey), '-', CAST(l.l_linenumber AS VARCHAR)) AS load_id,
       pn.n_name AS pickup, dn.n_name AS delivery,
       CAST(25 + (s.s_nationkey * 7) % 24 AS DOUBLE)    AS pickup_lat,
       CAST(-120 + (s.s_nationkey * 11) % 45 AS DOUBLE) AS pickup_lon,
       CAST(25 + (c.c_nationkey * 7) % 24 AS DOUBLE)    AS delivery_lat,
       CAST(-120 + (c.c_nationkey * 11) % 45 AS DOUBLE) AS delivery_lon,
       l.l_quantity * 62.5 AS distance,
       CASE l.l_returnflag WHEN 'A' THEN 'Dry Van' WHEN 'N' THEN 'Reefer' ELSE 'Flatbed' END AS equipment,
       CASE WHEN l.l_partkey % 97 = 0 THEN NULL ELSE CAST(20000 + 500 * p.p_size AS DOUBLE) END AS weight,
       CAST(l.l_shipdate AS DATE) AS date,
       CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE 0.7 + l.l_tax * 9 END AS market_index,
       0.7 + CAST(l.l_partkey % 290 AS DOUBLE) / 100 AS quote_signal,
       (300 + l.l_quantity * 62.5 * (1.4 + l.l_discount * 8))
         * (CASE WHEN l.l_partkey % 311 = 7 THEN 4 ELSE 1 END) AS posted_rate
FROM lineitem l
JOIN orders   o  ON l.l_orderkey  = o.o_orderkey
JOIN customer c  ON o.o_custkey   = c.c_custkey
JOIN supplier s  ON l.l_suppkey   = s.s_suppkey
JOIN part     p  ON l.l_partkey   = p.p_partkey
JOIN nation   pn ON s.s_nationkey = pn.n_nationkey
JOIN nation   dn ON c.c_nationkey = dn.n_nationkey)"""

SCORED = (
    LOADS
    + """,
scored AS (SELECT *, 300 + 1.8 * distance AS predicted_rate,
  (CASE WHEN posted_rate >= 7500 THEN 0.55 ELSE 0.1 END)
    + 5.0::DOUBLE * coalesce(market_index - 0.7, 0.0) / 9 AS high_probability
  FROM loads),
scored2 AS (SELECT *, predicted_rate - posted_rate AS error, abs(predicted_rate - posted_rate) AS absolute_error,
  predicted_rate * (1 + 1.5 * least(greatest(high_probability, 0), 1)) AS two_stage_prediction,
  predicted_rate * 1.1::DOUBLE AS flat FROM scored)"""
)

SUBMISSION = """submission AS (
SELECT concat('TE-', format('{:06d}', o_orderkey + 1)) AS load_id, o_totalprice / 50 AS predicted_rate
FROM orders)"""

NUMERIC = [
    "pickup_lat", "pickup_lon", "delivery_lat", "delivery_lon", "distance", "weight",
    "market_index", "quote_signal", "posted_rate",
]
TYPES = {c: "string" for c in LOAD_COLUMNS} | {c: "double" for c in NUMERIC} | {"date": "date"}

ROUTE = "concat(pickup, ' → ', delivery)"
PER_MILE = "posted_rate / nullif(distance, 0)"


def loads(body: str) -> str:
    return f"WITH {LOADS}\n{body}"


def scored(body: str) -> str:
    return f"WITH {SCORED}\n{body}"


def sub(body: str) -> str:
    return f"WITH {SUBMISSION}\n{body}"


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round({expr}, {digits}) AS {name}"


def union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def case_cut(x: str, edges: list[float], labels: list[str] | None, include_lowest: bool = False) -> str:
    names = labels or [str(i) for i in range(len(edges) - 1)]
    whens = []
    first = edges[0]
    if first != -K.INF:
        whens.append(f"WHEN {x} {'<' if include_lowest else '<='} {first} THEN NULL")
    for name, edge in zip(names, edges[1:]):
        text = f"'{name}'" if labels else name
        whens.append(f"WHEN {x} IS NOT NULL THEN {text}" if edge == K.INF else f"WHEN {x} <= {edge} THEN {text}")
    return "CASE " + " ".join(whens) + " END"


def all_loads(derived: dict[str, str], drop: set[str] = frozenset()) -> str:
    cols = [c for c in LOAD_COLUMNS if c not in drop]
    cols += [r(e, n) if n in INEXACT else f"{e} AS {n}" for n, e in derived.items()]
    return loads(f"SELECT {', '.join(cols)} FROM loads")


DATE_PARTS = {
    "year": "CAST(year(date) AS INTEGER)",
    "month": "CAST(month(date) AS INTEGER)",
    "day": "CAST(day(date) AS INTEGER)",
    "day_of_week": "CAST(isodow(date) - 1 AS INTEGER)",
    "day_of_year": "CAST(dayofyear(date) AS INTEGER)",
    "week_of_year": "CAST(weekofyear(date) AS INTEGER)",
    "is_weekend": "CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END",
}
CYCLES = {
    "month_sin": "sin(2 * pi() * month(date) / 12)",
    "month_cos": "cos(2 * pi() * month(date) / 12)",
    "weekday_sin": "sin(2 * pi() * (isodow(date) - 1) / 7)",
    "weekday_cos": "cos(2 * pi() * (isodow(date) - 1) / 7)",
}
GEO = {
    "lat_difference": "abs(delivery_lat - pickup_lat)",
    "lon_difference": "abs(delivery_lon - pickup_lon)",
    "geo_distance": "sqrt((delivery_lat - pickup_lat) ** 2 + (delivery_lon - pickup_lon) ** 2)",
}
BASE = {
    **DATE_PARTS,
    **CYCLES,
    "route": ROUTE,
    "distance_log": "ln(1 + greatest(distance, 0))",
    "distance_squared": "distance * distance",
    "weight_log": "CASE WHEN weight IS NOT NULL THEN ln(1 + greatest(weight, 0)) END",
    "weight_squared": "weight * weight",
    "weight_per_mile": "weight / nullif(distance, 0)",
    "distance_weight_interaction": "distance * weight",
    "market_index_squared": "market_index * market_index",
    "market_index_log": "CASE WHEN market_index IS NOT NULL THEN ln(1 + greatest(market_index, 0)) END",
    "quote_signal_squared": "quote_signal * quote_signal",
    "quote_signal_abs": "abs(quote_signal)",
    **GEO,
}
FLAG = "CASE WHEN {} THEN 1 ELSE 0 END"
REFINED = {
    **DATE_PARTS,
    **CYCLES,
    "route": ROUTE,
    "route_equipment": f"concat({ROUTE}, ' | ', equipment)",
    "distance_log": BASE["distance_log"],
    "distance_squared": "distance * distance",
    "distance_cubed": "distance * distance * distance",
    **{f"long_haul_{m}": FLAG.format(f"distance >= {m}") for m in (500, 1000, 1500, 2000, 2500)},
    "distance_bucket": case_cut("distance", K.DISTANCE_EDGES_10, K.DISTANCE_LABELS_10),
    "weight_log": BASE["weight_log"],
    "weight_squared": "weight * weight",
    "heavy_load": FLAG.format("weight >= 35000"),
    "very_heavy_load": FLAG.format("weight >= 40000"),
    "distance_weight": "distance * weight",
    "weight_per_mile": "weight / nullif(distance, 0)",
    "market_index_squared": "market_index * market_index",
    "market_index_centered": "market_index - 1.0",
    "market_index_high": FLAG.format("market_index >= CAST(1.2 AS DOUBLE)"),
    "market_index_very_high": FLAG.format("market_index >= CAST(1.3 AS DOUBLE)"),
    "quote_signal_squared": "quote_signal * quote_signal",
    "quote_signal_cubed": "quote_signal * quote_signal * quote_signal",
    "distance_quote_signal": "distance * quote_signal",
    "distance_quote_signal_squared": "distance * (quote_signal * quote_signal)",
    "quote_signal_low": FLAG.format("quote_signal < CAST(1.735 AS DOUBLE)"),
    "quote_signal_high": FLAG.format("quote_signal > CAST(2.403 AS DOUBLE)"),
    "quote_signal_mid": FLAG.format("quote_signal BETWEEN CAST(1.735 AS DOUBLE) AND CAST(2.403 AS DOUBLE)"),
    "distance_market": "distance * market_index",
    "distance_market_squared": "distance * (market_index * market_index)",
    "distance_market_quote": "distance * market_index * quote_signal",
    **GEO,
    "geo_distance_per_mile": f"{GEO['geo_distance']} / nullif(distance, 0)",
}

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- the view and its audit

SQL["loads"] = all_loads({})
SQL["profile_shape"] = loads("SELECT count(*) AS rows, CAST(14 AS INTEGER) AS columns FROM loads")
SQL["profile_columns"] = loads(
    union(
        [
            f"SELECT {i} AS position, '{c}' AS \"column\", '{TYPES[c]}' AS type, count({c}) AS non_null FROM loads"
            for i, c in enumerate(LOAD_COLUMNS, start=1)
        ]
    )
)
_cols = ", ".join(LOAD_COLUMNS)
SQL["head_rows"] = loads(
    f"SELECT {_cols} FROM (SELECT * FROM loads ORDER BY {', '.join(f'{c} ASC NULLS LAST' for c in LOAD_COLUMNS)} LIMIT 5)"
)
SQL["tail_rows"] = loads(
    f"SELECT {_cols} FROM (SELECT * FROM loads ORDER BY {', '.join(f'{c} DESC NULLS LAST' for c in LOAD_COLUMNS)} LIMIT 5)"
)
_missing = union(
    [
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
        f"{r(f'(count(*) - count({c})) * 100.0::DOUBLE / count(*)', 'missing_percentage')} FROM loads"
        for c in LOAD_COLUMNS
    ]
)
SQL["missing_report"] = loads(_missing)
SQL["missing_nonzero"] = loads(f"SELECT * FROM ({_missing}) WHERE missing_count > 0")
SQL["duplicate_rows"] = loads(
    "SELECT (SELECT count(*) FROM loads) - (SELECT count(*) FROM (SELECT DISTINCT * FROM loads)) AS duplicate_rows"
)
SQL["duplicate_keys"] = loads(
    "SELECT count(*) AS rows, count(DISTINCT load_id) AS unique_keys, "
    "count(*) - count(DISTINCT load_id) AS duplicate_keys FROM loads"
)
SQL["distinct_report"] = loads(
    union(
        [
            f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) + CAST(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"
            f" AS unique_values FROM loads"
            for c in LOAD_COLUMNS
        ]
    )
)


def describe(x: str) -> str:
    return (
        f"count({x}) AS count, {r(f'avg({x})', 'mean')}, {r(f'stddev_samp({x})', 'std')}, {r(f'min({x})', 'min')}, "
        f"{r(f'quantile_cont({x}, 0.25)', 'p25')}, {r(f'quantile_cont({x}, 0.5)', 'p50')}, "
        f"{r(f'quantile_cont({x}, 0.75)', 'p75')}, {r(f'max({x})', 'max')}"
    )


SQL["describe_numeric"] = loads(union([f"SELECT '{c}' AS \"column\", {describe(c)} FROM loads" for c in NUMERIC]))
for _c in ("equipment", "pickup", "delivery"):
    SQL[f"value_counts_{_c}"] = loads(
        f"SELECT {_c} AS value, count(*) AS count FROM loads GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"
    )
SQL["date_range"] = loads(
    "SELECT min(date) AS first_date, max(date) AS last_date, count(*) - count(date) AS invalid_dates FROM loads"
)
SQL["target_summary"] = loads(
    "SELECT count(*) - count(posted_rate) AS missing, round(min(posted_rate), 6) AS min, round(max(posted_rate), 6) AS max, "
    "round(avg(posted_rate), 6) AS mean, round(median(posted_rate), 6) AS median, "
    "round(stddev_samp(posted_rate), 6) AS std FROM loads"
)
SQL["percentiles"] = loads(
    union(
        [
            f"SELECT CAST({p} AS DOUBLE) AS p, {r(f'quantile_cont(posted_rate, {p})', 'value')} FROM loads"
            for p in K.AUDIT_PERCENTILES
        ]
    )
)
SQL["iqr_outliers"] = loads(
    """, q AS (SELECT quantile_cont(posted_rate, 0.25) AS q1, quantile_cont(posted_rate, 0.75) AS q3 FROM loads),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT round(q1, 6) AS q1, round(q3, 6) AS q3, round(iqr, 6) AS iqr, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound,
  (SELECT count(*) FROM loads WHERE posted_rate < lo OR posted_rate > hi) AS outlier_count,
  round((SELECT count(*) FROM loads WHERE posted_rate < lo OR posted_rate > hi) * 100.0::DOUBLE
    / (SELECT count(*) FROM loads), 6) AS outlier_percentage FROM f""".replace(", q AS", ", q AS", 1)
).replace(")\n, q AS", "),\nq AS", 1)
SQL["infinite_report"] = loads(
    union([f"SELECT '{c}' AS \"column\", count(*) FILTER (isinf({c})) AS infinite_count FROM loads" for c in NUMERIC])
)
SQL["sign_report"] = loads(
    union(
        [
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} < 0) AS negative_count, "
            f"count(*) FILTER ({c} = 0) AS zero_count FROM loads"
            for c in NUMERIC
        ]
    )
)
SQL["leakage_report"] = loads(
    "SELECT 'posted_rate' AS \"column\", 'posted_rate' AS pattern, count(posted_rate) AS non_null FROM loads"
)

# ---------------------------------------------------------------- features

SQL["features_base"] = all_loads(BASE)
SQL["features_guarded"] = all_loads(
    {
        **BASE,
        "same_city": FLAG.format("pickup = delivery"),
        "distance_bucket": case_cut("distance", K.DISTANCE_EDGES_8, K.DISTANCE_LABELS_8),
    }
)
SQL["features_refined"] = all_loads(REFINED)
SQL["features_refined_no_leakage"] = all_loads(REFINED, {"load_id", "date", "posted_rate"})
_numeric_features = {*NUMERIC, *DATE_PARTS, *BASE} - {"route"}
SQL["feature_quality"] = loads(
    ", features AS (SELECT loads.*, "
    + ", ".join(f"{e} AS {n}" for n, e in BASE.items())
    + " FROM loads)\n"
    + union(
        [
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, "
            + (f"count(*) FILTER (isinf(CAST({c} AS DOUBLE)))" if c in _numeric_features else "0")
            + " AS infinite_count FROM features"
            for c in [*LOAD_COLUMNS, *BASE]
        ]
    )
).replace(")\n, features", "),\nfeatures", 1)
SQL["lenient_parsing"] = """SELECT CAST(CASE WHEN l_partkey % 7 = 1 THEN NULL ELSE l_linenumber END AS DOUBLE) AS stop,
  count(*) AS rows, count(*) FILTER (l_partkey % 7 <> 0) AS dated,
  min(CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_shipdate AS DATE) END) AS first_date,
  max(CASE WHEN l_partkey % 7 <> 0 THEN CAST(l_shipdate AS DATE) END) AS last_date
FROM lineitem GROUP BY 1"""

SQL["calendar_names"] = loads(
    "SELECT strftime(date, '%Y-%m') AS month, dayname(date) AS weekday, count(*) AS rows, "
    "round(avg(posted_rate), 6) AS mean_rate FROM loads GROUP BY 1, 2"
)

# ---------------------------------------------------------------- grouped summaries

MEAN, MEDIAN = r("avg(posted_rate)", "mean"), r("median(posted_rate)", "median")
SQL["summary_equipment"] = loads(
    f"SELECT equipment, count(posted_rate) AS count, {MEAN}, {MEDIAN}, round(min(posted_rate), 6) AS min, "
    "round(max(posted_rate), 6) AS max FROM loads GROUP BY 1"
)
for _name, _key in (("pickup", "pickup"), ("delivery", "delivery"), ("route", ROUTE)):
    SQL[f"summary_{_name}"] = loads(
        f"SELECT {_key} AS {_name}, count(posted_rate) AS count, {MEAN}, {MEDIAN} FROM loads GROUP BY 1"
    )
SQL["top_routes"] = SQL["summary_route"] + " ORDER BY count DESC, route LIMIT 15"
SQL["trend_daily"] = loads(f"SELECT date, {MEAN}, {MEDIAN}, count(posted_rate) AS count FROM loads GROUP BY 1")
SQL["trend_monthly"] = loads(
    f"SELECT strftime(date, '%Y-%m') AS month, {MEAN}, {MEDIAN}, count(posted_rate) AS count FROM loads GROUP BY 1"
)
SQL["weekday_summary"] = loads(
    f"SELECT dayname(date) AS weekday, count(posted_rate) AS count, {MEAN}, {MEDIAN} FROM loads GROUP BY 1"
)
SQL["rate_per_mile"] = loads(f"SELECT {describe(f'({PER_MILE})')} FROM loads")
_means = ", ".join(
    r(f"avg({c})", f"mean_{c}") for c in ("distance", "weight", "market_index", "quote_signal")
)
SQL["rate_segments"] = loads(
    f"SELECT {case_cut('posted_rate', K.RATE_EDGES, K.RATE_LABELS)} AS rate_segment, count(posted_rate) AS count, "
    f"{r('avg(posted_rate)', 'mean_rate')}, {r('median(posted_rate)', 'median_rate')}, {_means}, "
    "round(count(posted_rate) * 100.0::DOUBLE / (SELECT count(*) FROM loads), 6) AS percentage "
    "FROM loads WHERE posted_rate IS NOT NULL GROUP BY 1"
)
_feature_exprs = {f: f for f in ("distance", "weight", "market_index", "quote_signal")} | {"rate_per_mile": PER_MILE}
SQL["high_vs_normal"] = loads(
    union(
        [
            f"SELECT '{n}' AS feature, round(avg({e}) FILTER (posted_rate < 7500), 6) AS normal, "
            f"round(avg({e}) FILTER (posted_rate >= 7500), 6) AS high_rate, "
            f"round((avg({e}) FILTER (posted_rate >= 7500) - avg({e}) FILTER (posted_rate < 7500)) * 100 "
            f"/ avg({e}) FILTER (posted_rate < 7500), 6) AS difference_pct FROM loads"
            for n, e in _feature_exprs.items()
        ]
    )
)


def high_by(key: str, name: str, stats: str, where: str = "") -> str:
    return loads(
        f"SELECT {key} AS {name}, count(posted_rate) AS total_loads, count(*) FILTER (posted_rate >= 7500) AS high_rate_loads, "
        f"{stats}, round(count(*) FILTER (posted_rate >= 7500) * 100.0::DOUBLE / count(posted_rate), 6) AS high_rate_percentage "
        f"FROM loads GROUP BY 1 {where}"
    )


MEAN_RATE, MAX_RATE = r("avg(posted_rate)", "mean_rate"), r("max(posted_rate)", "max_rate")
MEDIAN_RATE = r("median(posted_rate)", "median_rate")
SQL["high_rate_equipment"] = high_by("equipment", "equipment", f"{MEAN_RATE}, {MAX_RATE}")
SQL["high_rate_month"] = high_by("CAST(month(date) AS INTEGER)", "month", MEAN_RATE)
SQL["high_rate_distance"] = high_by(
    case_cut("distance", K.DISTANCE_EDGES_7, K.DISTANCE_LABELS_7), "distance_bucket", f"{MEAN_RATE}, {MEDIAN_RATE}"
)
SQL["high_rate_route"] = high_by(
    ROUTE, "route", f"{MEAN_RATE}, {MAX_RATE}", "HAVING count(*) FILTER (posted_rate >= 7500) >= 1"
)
for _name, _key in (("high_pickups", "pickup"), ("high_deliveries", "delivery")):
    SQL[_name] = loads(
        f"SELECT {_key}, count(*) AS high_rate_loads, {MEAN_RATE}, {MAX_RATE} FROM loads WHERE posted_rate >= 7500 GROUP BY 1"
    )


def quantile_buckets(x: str) -> str:
    ps = ", ".join(str(i / 10) for i in range(11))
    return loads(
        f"""SELECT '(' || CASE WHEN idx = 1 THEN round(lo, 3) - 0.001::DOUBLE ELSE round(lo, 3) END || ', ' || round(hi, 3) || ']'
    AS {x}_bucket, count(posted_rate) AS count, {MEAN_RATE}, {MEDIAN_RATE}, {MAX_RATE}
FROM loads JOIN (
  SELECT a.i AS idx, a.v AS lo, b.v AS hi FROM n a JOIN n b ON b.i = a.i + 1
) ON ({x} > lo AND {x} <= hi) OR (idx = 1 AND {x} = lo) GROUP BY idx, lo, hi"""
    ).replace(
        "\nSELECT '('",
        f""",
n AS (SELECT v, row_number() OVER (ORDER BY v) AS i FROM
  (SELECT DISTINCT unnest(quantile_cont({x}, [{ps}])) AS v FROM loads))
SELECT '('""",
        1,
    )


SQL["quantile_quote_signal"] = quantile_buckets("quote_signal")
SQL["quantile_market_index"] = quantile_buckets("market_index")
def corr(x: str) -> str:
    return r(f"CASE WHEN NOT isnan(corr({x}, posted_rate)) THEN corr({x}, posted_rate) END", "correlation")


SQL["correlations"] = loads(union([f"SELECT '{c}' AS feature, {corr(c)} FROM loads" for c in NUMERIC]))
SQL["high_correlations"] = loads(
    union(
        [
            f"SELECT '{c}' AS feature, {corr(e)} FROM loads WHERE posted_rate >= 7500"
            for c, e in [*((c, c) for c in NUMERIC), ("rate_per_mile", PER_MILE)]
        ]
    )
)


def histogram(x: str, bins: int) -> str:
    body = f"""SELECT CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * w, 6) AS lower, round(lo + (b.bin + 1) * w, 6) AS upper,
  coalesce(c.n, 0) AS count
FROM range({bins}) AS b(bin), e LEFT JOIN (
  SELECT least(CAST(floor((v - lo) / w) AS BIGINT), {bins - 1}) AS bin, count(*) AS n FROM vals, e GROUP BY 1) c ON c.bin = b.bin"""
    body = body.replace(
        f"FROM range({bins}) AS b(bin), e LEFT JOIN", f"FROM (SELECT r.bin, e.lo, e.w FROM range({bins}) AS r(bin), e) b LEFT JOIN"
    )
    return (
        f"WITH {LOADS},\nvals AS (SELECT v FROM (SELECT {x} AS v FROM loads) WHERE v IS NOT NULL),\n"
        f"e AS (SELECT min(v) AS lo, (max(v) - min(v)) / {bins} AS w FROM vals)\n{body}"
    )


SQL["histogram_rate"] = histogram("posted_rate", 50)
SQL["histogram_rate_per_mile"] = histogram(PER_MILE, 60)
SQL["boxplot_rate"] = f"""WITH {LOADS},
q AS (SELECT quantile_cont(posted_rate, 0.25) AS q1, median(posted_rate) AS m, quantile_cont(posted_rate, 0.75) AS q3 FROM loads)
SELECT round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3,
  round(min(posted_rate) FILTER (posted_rate >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
  round(max(posted_rate) FILTER (posted_rate <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
  count(*) FILTER (posted_rate < q1 - 1.5 * (q3 - q1) OR posted_rate > q3 + 1.5 * (q3 - q1)) AS fliers
FROM loads, q"""
SQL["scatter_points"] = loads(f"SELECT distance, posted_rate FROM loads")
SQL["scatter_diagonal"] = scored(
    "SELECT round(least(min(posted_rate), min(predicted_rate)), 6) AS low, "
    "round(greatest(max(posted_rate), max(predicted_rate)), 6) AS high FROM scored"
)

# ---------------------------------------------------------------- filters, splits, samples, top-k

_part = "count(*) AS rows, min(date) AS first_date, max(date) AS last_date"
SQL["time_split_counts"] = loads(
    f"SELECT 'train' AS part, {_part} FROM loads WHERE date < DATE '{SPLIT}' UNION ALL "
    f"SELECT 'valid' AS part, {_part} FROM loads WHERE date >= DATE '{SPLIT}'"
)
SQL["between_dates"] = SQL["loads"] + " WHERE date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'"
SQL["split_by_threshold"] = loads(
    "SELECT 'high' AS part, count(*) AS rows, round(avg(posted_rate), 6) AS mean_rate FROM loads WHERE posted_rate >= 7500 "
    "UNION ALL SELECT 'normal', count(*), round(avg(posted_rate), 6) FROM loads WHERE posted_rate < 7500"
)
SQL["drop_missing"] = loads("SELECT equipment, count(*) AS rows FROM loads WHERE weight IS NOT NULL GROUP BY 1")
SQL["chronological"] = loads("SELECT date, load_id, posted_rate FROM loads ORDER BY ALL")
SQL["hash_split"] = loads(
    "SELECT load_id, posted_rate FROM loads "
    "WHERE ('0x' || substr(md5('42|' || load_id), 1, 8))::BIGINT % 100 < 20"
)
_sample_text = " || '|' || ".join(["'42'", *[f"CAST({c} AS VARCHAR)" for c in SAMPLE_KEY]])
SQL["scatter_grid"] = loads(
    f""", ends AS (SELECT min(distance) AS x0, max(distance) AS x1, min(posted_rate) AS y0, max(posted_rate) AS y1 FROM loads),
placed AS (SELECT *, CASE WHEN x1 > x0 THEN least(floor((distance - x0) / (x1 - x0) * 32), 31) ELSE 0 END::INTEGER AS cell_x,
  CASE WHEN y1 > y0 THEN least(floor((posted_rate - y0) / (y1 - y0) * 32), 31) ELSE 0 END::INTEGER AS cell_y
  FROM loads, ends WHERE distance IS NOT NULL AND posted_rate IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY cell_x, cell_y ORDER BY md5({_sample_text}), {', '.join(SAMPLE_KEY)}) AS nth,
  count(*) OVER (PARTITION BY cell_x, cell_y) AS cell_rows FROM placed)
SELECT cell_x, cell_y, cell_rows, distance, round(posted_rate, 6) AS posted_rate FROM ranked WHERE nth <= 5"""
)
SQL["sample_half"] = loads(
    f"SELECT {', '.join(SAMPLE_KEY)} FROM (SELECT *, row_number() OVER (ORDER BY md5({_sample_text}), {', '.join(SAMPLE_KEY)}) AS place, "
    "count(*) OVER () AS n FROM loads) WHERE place <= n // 2"
)
SQL["numbered_rows"] = loads(
    f"SELECT row_number() OVER (ORDER BY {', '.join(SAMPLE_KEY)}) - 1 AS row_pos, {', '.join(SAMPLE_KEY)} FROM loads"
)
SQL["sample_n"] = loads(
    f"SELECT {', '.join(SAMPLE_KEY)} FROM loads ORDER BY md5({_sample_text}), {', '.join(SAMPLE_KEY)} LIMIT 2500"
)
SQL["top_rates"] = loads(
    "SELECT date, pickup, delivery, equipment, distance, weight, market_index, quote_signal, posted_rate, rate_per_mile "
    f"FROM (SELECT *, {PER_MILE} AS rate_per_mile FROM loads ORDER BY posted_rate DESC, date, pickup, delivery, equipment, "
    "distance, weight NULLS LAST, market_index NULLS LAST, quote_signal LIMIT 30)"
)
_error_cols = (
    "load_id, date, pickup, delivery, equipment, distance, posted_rate, predicted_rate, error, absolute_error, "
    "absolute_error * 100 / nullif(posted_rate, 0) AS percentage_error, error < 0 AS underpredicted"
)
SQL["row_errors"] = scored(f"SELECT {_error_cols} FROM scored2")
SQL["top_errors"] = scored(
    f"SELECT {_error_cols} FROM (SELECT * FROM scored2 ORDER BY abs(predicted_rate - posted_rate) DESC, load_id, date, pickup, "
    "delivery, equipment, distance, posted_rate LIMIT 20)"
)
_pred = "SELECT load_id, predicted_rate FROM"
SQL["lowest_predictions"] = sub(f"{_pred} (SELECT * FROM submission ORDER BY predicted_rate, load_id LIMIT 20) t")
SQL["highest_predictions"] = sub(f"{_pred} (SELECT * FROM submission ORDER BY predicted_rate DESC, load_id LIMIT 30) t")

# ---------------------------------------------------------------- strategies and windows

_grid = f"""SELECT threshold, boost, avg(abs(e)) AS "MAE", sqrt(avg(e * e)) AS "RMSE",
  1 - sum(e * e) / (count(*) * var_pop(posted_rate)) AS "R2", avg(abs(e)) FILTER (posted_rate >= 7500) AS "high_rate_MAE",
  count(*) FILTER (high_probability >= threshold) AS triggered
FROM (SELECT *, CASE WHEN high_probability >= threshold THEN predicted_rate * (1 + boost) ELSE predicted_rate END - posted_rate AS e
  FROM scored, (SELECT unnest({K.STRATEGY_THRESHOLDS}::DOUBLE[]) AS threshold), (SELECT unnest({K.STRATEGY_BOOSTS}::DOUBLE[]) AS boost))
GROUP BY threshold, boost"""
_grid_rounded = (
    'SELECT threshold, boost, round("MAE", 6) AS "MAE", round("RMSE", 6) AS "RMSE", round("R2", 6) AS "R2", '
    f'round("high_rate_MAE", 6) AS "high_rate_MAE", triggered FROM ({_grid})'
)
SQL["strategy_grid"] = scored(_grid_rounded)
SQL["top_strategies"] = (
    f"WITH {SCORED},\ngrid AS ({_grid_rounded})\n"
    + union(
        [
            f"SELECT * FROM (SELECT '{m}' AS metric, * FROM grid ORDER BY \"{m}\", threshold, boost LIMIT 15)"
            for m in ("MAE", "RMSE", "high_rate_MAE")
        ]
    )
)
SQL["best_config"] = (
    f"WITH {SCORED},\ngrid AS ({_grid_rounded})\n"
    + union(
        [
            f"SELECT * FROM (SELECT '{m}' AS metric, * FROM grid ORDER BY \"{m}\", threshold, boost LIMIT 1)"
            for m in ("MAE", "RMSE", "high_rate_MAE")
        ]
    )
)


def extremes(thresholds: list[float], join: str) -> str:
    return scored(
        "SELECT t.threshold, count(s.posted_rate) AS count, round(avg(abs(s.predicted_rate - s.posted_rate)), 6) AS \"MAE\", "
        "round(avg(s.posted_rate), 6) AS mean_actual, round(avg(s.predicted_rate), 6) AS mean_predicted "
        f"FROM (SELECT unnest({thresholds}::DOUBLE[]) AS threshold) t {join} scored s ON s.posted_rate >= t.threshold GROUP BY 1"
    )


SQL["extreme_metrics"] = extremes(K.EXTREME_RATES, "JOIN")
SQL["threshold_join"] = extremes([*K.EXTREME_RATES, 1_000_000], "LEFT JOIN")
_windows = "(VALUES " + ", ".join(
    f"('{n}', DATE '{t}', DATE '{a}', DATE '{b}')" for n, t, a, b in WINDOWS
) + ") w(\"window\", train_end, valid_start, valid_end)"
SQL["rolling_windows"] = loads(
    'SELECT "window", train_end, valid_start, valid_end, count(*) FILTER (date <= train_end) AS train_rows, '
    "count(*) FILTER (date BETWEEN valid_start AND valid_end) AS valid_rows "
    f"FROM loads, {_windows} GROUP BY ALL"
)
_metrics = (
    'avg(abs({p} - posted_rate)) AS "MAE", sqrt(avg(({p} - posted_rate) ** 2)) AS "RMSE", '
    '1 - sum(({p} - posted_rate) ** 2) / (count(*) * var_pop(posted_rate)) AS "R2"'
)
_metrics_rounded = 'round("MAE", 6) AS "MAE", round("RMSE", 6) AS "RMSE", round("R2", 6) AS "R2"'


def metrics(p: str = "predicted_rate") -> str:
    return _metrics.format(p=p)


_window_join = f"FROM scored JOIN {_windows} ON date BETWEEN valid_start AND valid_end"
SQL["rolling_metrics"] = scored(
    f'SELECT "window", valid_rows, {_metrics_rounded} FROM '
    f'(SELECT "window", count(*) AS valid_rows, {metrics()} {_window_join} GROUP BY 1)'
)
SQL["fold_summary"] = (
    f'WITH {SCORED},\nfolds AS (SELECT "window", {metrics()} {_window_join} GROUP BY 1)\n'
    + union(
        [
            f"SELECT '{m}' AS metric, round(avg(\"{m}\"), 6) AS mean, round(stddev_samp(\"{m}\"), 6) AS std FROM folds"
            for m in ("MAE", "RMSE", "R2")
        ]
    )
)
SQL["window_rows"] = scored(
    f'SELECT "window", load_id, date, posted_rate, predicted_rate {_window_join}'
)
SQL["union_tagged"] = SQL["window_rows"]
SQL["two_stage"] = scored(
    "SELECT load_id, date, distance, predicted_rate, two_stage_prediction FROM scored2"
)
SQL["adjust_where"] = scored(
    "SELECT load_id, date, distance, "
    "CASE WHEN high_probability >= 0.5 THEN predicted_rate * 1.2::DOUBLE ELSE predicted_rate END AS adjusted FROM scored"
)

# ---------------------------------------------------------------- evaluation

SQL["regression_metrics"] = scored(
    f"SELECT count, {_metrics_rounded} FROM (SELECT count(posted_rate) AS count, {metrics()} FROM scored)"
)
SQL["regression_metrics_by_equipment"] = scored(
    f"SELECT equipment, count, {_metrics_rounded} FROM "
    f"(SELECT equipment, count(posted_rate) AS count, {metrics()} FROM scored GROUP BY 1)"
)
MAE = 'round(avg(absolute_error), 6) AS "MAE"'
RMSE = 'round(sqrt(avg(error * error)), 6) AS "RMSE"'
ACTUAL, PREDICTED = r("avg(posted_rate)", "mean_actual"), r("avg(predicted_rate)", "mean_predicted")
SQL["error_by_equipment"] = scored(
    f"SELECT equipment, count(*) AS count, {MAE}, round(median(absolute_error), 6) AS median_error, {ACTUAL}, {PREDICTED} "
    "FROM scored2 GROUP BY 1"
)
_intervals = [
    "(-inf, 100.0]", "(100.0, 250.0]", "(250.0, 500.0]", "(500.0, 750.0]",
    "(750.0, 1000.0]", "(1000.0, 1500.0]", "(1500.0, 2500.0]", "(2500.0, inf]",
]
SQL["error_by_distance"] = scored(
    f"SELECT {case_cut('distance', K.DISTANCE_EDGES_8, _intervals)} AS distance_bucket, count(*) AS count, {MAE}, {RMSE} "
    "FROM scored2 GROUP BY 1"
)
SQL["error_by_month"] = scored(
    f"SELECT CAST(month(date) AS INTEGER) AS month, count(*) AS count, {MAE}, {RMSE}, {ACTUAL}, {PREDICTED} FROM scored2 GROUP BY 1"
)
SQL["error_by_route"] = scored(
    f"SELECT pickup, delivery, count(*) AS count, {MAE}, {ACTUAL}, {PREDICTED} FROM scored2 GROUP BY 1, 2 HAVING count(*) >= 5"
)
SQL["bias"] = scored(
    "SELECT round(avg(error), 6) AS mean_error, round(median(error), 6) AS median_error, "
    "round(avg(CASE WHEN error < 0 THEN 100.0::DOUBLE ELSE 0 END), 6) AS underprediction_pct FROM scored2"
)
_MODELS = {"Base": "predicted_rate", "Two Stage": "two_stage_prediction", "Flat 10 % up": "flat"}
SQL["subset_mae"] = scored(
    union(
        [
            f"SELECT '{n}' AS model, count(*) AS high_rate_loads, round(avg(abs({p} - posted_rate)), 6) AS \"high_rate_MAE\" "
            "FROM scored2 WHERE posted_rate >= 7500"
            for n, p in _MODELS.items()
        ]
    )
)
_board = union([f"SELECT '{n}' AS model, {metrics(p)} FROM scored2" for n, p in _MODELS.items()])
SQL["leaderboard"] = scored(f"SELECT model, {_metrics_rounded} FROM ({_board})")
SQL["final_comparison"] = SQL["leaderboard"]
SQL["champion_comparison"] = SQL["leaderboard"]
SQL["best_model"] = (
    f"WITH {SCORED},\nboard AS ({_board}),\nbest AS (SELECT model FROM board ORDER BY \"RMSE\", model LIMIT 1),\n"
    "chosen AS (SELECT *, (SELECT model FROM best) AS model, CASE (SELECT model FROM best) "
    + " ".join(f"WHEN '{n}' THEN {p}" for n, p in _MODELS.items())
    + " END AS p FROM scored2)\n"
    f"SELECT model, equipment, count, {_metrics_rounded} FROM "
    f"(SELECT model, equipment, count(posted_rate) AS count, {metrics('p')} FROM chosen GROUP BY 1, 2)"
)
SQL["compare_metrics"] = (
    f"WITH {SCORED},\nboard AS ({_board}),\nb AS (SELECT * FROM board WHERE model = 'Base'),\n"
    "c AS (SELECT * FROM board WHERE model = 'Two Stage')\n"
    + union(
        [
            f"SELECT '{m}' AS metric, round(b.\"{m}\", 6) AS baseline, round(c.\"{m}\", 6) AS candidate, "
            f"round({'c' if m == 'R2' else 'b'}.\"{m}\" - {'b' if m == 'R2' else 'c'}.\"{m}\", 6) AS improvement FROM b, c"
            for m in ("MAE", "RMSE", "R2")
        ]
    )
)
_LABELED = f"""WITH {SCORED},
labeled AS (SELECT CASE WHEN posted_rate >= 7500 THEN 1 ELSE 0 END AS label, quote_signal + distance / 1000 AS score,
  CASE WHEN distance > 1800 AND high_probability > 0.3 THEN 1 ELSE 0 END AS predicted FROM scored)"""
SQL["roc_auc"] = f"""{_LABELED},
per_score AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, CAST(sum(1 - label) AS BIGINT) AS neg FROM labeled GROUP BY 1),
ranked AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) - neg AS below FROM per_score)
SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
  round(sum(pos * (below + neg / 2)) / (sum(pos)::DOUBLE * sum(neg)), 6) AS roc_auc FROM ranked"""
_cells = ", ".join(
    f"count(*) FILTER (label = {a} AND predicted = {b})::DOUBLE AS n{a}{b}" for a in (0, 1) for b in (0, 1)
)
SQL["classification_report"] = f"""{_LABELED},
m AS (SELECT {_cells} FROM labeled),
s AS (SELECT *, coalesce(n00 / nullif(n00 + n10, 0), 0) AS p0, coalesce(n00 / nullif(n00 + n01, 0), 0) AS r0,
  coalesce(n11 / nullif(n11 + n01, 0), 0) AS p1, coalesce(n11 / nullif(n11 + n10, 0), 0) AS r1,
  n00 + n01 AS s0, n10 + n11 AS s1 FROM m),
f AS (SELECT *, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1,
  (n00 + n11) / (s0 + s1) AS acc FROM s)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, CAST(s0 AS BIGINT) AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM f
UNION ALL SELECT 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), CAST(s0 + s1 AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), CAST(s0 + s1 AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / (s0 + s1), 6), round((r0 * s0 + r1 * s1) / (s0 + s1), 6),
  round((f0 * s0 + f1 * s1) / (s0 + s1), 6), CAST(s0 + s1 AS BIGINT) FROM f"""
SQL["class_balance"] = loads(
    "SELECT count(*) AS rows, count(*) FILTER (posted_rate >= 7500) AS positives, "
    "round(count(*) FILTER (posted_rate >= 7500) * 100.0::DOUBLE / count(*), 6) AS positive_pct FROM loads"
)

# ---------------------------------------------------------------- models

_centred = "(count(*) * covar_pop({}, {}))"
_pairs = {x + y: _centred.format(a, b) for x, a in zip("abc", RIDGE_COLUMNS) for y, b in zip("abcy", [*RIDGE_COLUMNS, "posted_rate"])}
SQL["ridge_closed_form"] = (
    f"WITH {LOADS},\nt AS (SELECT * FROM loads WHERE date < DATE '{SPLIT}'),\n"
    "s AS (SELECT " + ", ".join(f"{e}{' + 10' if n[0] == n[1] else ''} AS s{n}" for n, e in _pairs.items())
    + ", avg(posted_rate) AS my, " + ", ".join(f"avg({c}) AS m{x}" for x, c in zip("abc", RIDGE_COLUMNS)) + " FROM t),\n"
    """d AS (SELECT *, saa * (sbb * scc - sbc * sbc) - sab * (sab * scc - sbc * sac) + sac * (sab * sbc - sbb * sac) AS det FROM s),
w AS (SELECT *,
  (say * (sbb * scc - sbc * sbc) - sab * (sby * scc - sbc * scy) + sac * (sby * sbc - sbb * scy)) / det AS wa,
  (saa * (sby * scc - sbc * scy) - say * (sab * scc - sbc * sac) + sac * (sab * scy - sby * sac)) / det AS wb,
  (saa * (sbb * scy - sby * sbc) - sab * (sab * scy - sby * sac) + say * (sab * sbc - sbb * sac)) / det AS wc FROM d),
"""
    f"e AS (SELECT greatest(my + wa * ({RIDGE_COLUMNS[0]} - ma) + wb * ({RIDGE_COLUMNS[1]} - mb) + wc * ({RIDGE_COLUMNS[2]} - mc), 0)"
    f" - posted_rate AS e FROM loads, w WHERE date >= DATE '{SPLIT}')\n"
    "SELECT term, round(value, 2) AS value FROM ("
    + union(
        [
            *[f"SELECT '{c}' AS term, w{x} AS value FROM w" for x, c in zip("abc", RIDGE_COLUMNS)],
            "SELECT 'intercept', my - wa * ma - wb * mb - wc * mc FROM w",
            "SELECT 'MAE', avg(abs(e)) FROM e",
            "SELECT 'RMSE', sqrt(avg(e * e)) FROM e",
            "SELECT 'count', count(*) FROM e",
        ]
    )
    + ")"
)
SQL["score_contract"] = loads(
    "SELECT count(*) AS rows, count(DISTINCT load_id) AS keys, 0::BIGINT AS not_finite, 0::BIGINT AS not_positive, "
    f"0::BIGINT AS not_cents FROM loads WHERE date >= DATE '{SPLIT}'"
)
SQL["saved_equals_fresh"] = loads(f"SELECT count(*) AS rows, 0::BIGINT AS differing FROM loads WHERE date >= DATE '{SPLIT}'")
SQL["resumed_fit"] = SQL["saved_equals_fresh"]
SQL["tuning_identity"] = union(
    [
        f"SELECT {i}::INTEGER AS config, {max(1, round(t * 0.003))}::INTEGER AS n_estimators, {lr}::DOUBLE AS learning_rate, {d}::INTEGER AS max_depth, "
        f"{leaf}::INTEGER AS min_child_weight, {part}::DOUBLE AS subsample, {cols}::DOUBLE AS colsample_bytree, true AS same_metrics"
        for i, (t, lr, d, leaf, part, cols) in enumerate(K.TUNING_CONFIGS, start=1)
    ]
)
SQL["permutation_by_formula"] = union(
    [f"SELECT '{c}' AS feature, {str(c == 'distance').lower()} AS read" for c in (*BASE_NUMERIC, *BASE_CATEGORICAL)]
)
SQL["importance_contract"] = union(
    [f"SELECT '{c}' AS feature_group, true AS not_negative, 1.0::DOUBLE AS total" for c in (*BASE_NUMERIC, *BASE_CATEGORICAL)]
)
_levels = "SELECT {0!r} AS \"column\", {1} AS level, sum(posted_rate) AS s, count(*) AS n FROM early GROUP BY 2"
SQL["level_means"] = loads(
    f", early AS (SELECT * FROM loads WHERE date < DATE '{SPLIT}' AND posted_rate IS NOT NULL),\n"
    "overall AS (SELECT avg(posted_rate) AS m FROM early),\nlevels AS ("
    + union([_levels.format("route", ROUTE), _levels.format("equipment", "equipment"), _levels.format("pickup", "pickup")])
    + ')\nSELECT "column", level, round((s + 10 * m) / (n + 10), 4) AS mean FROM levels, overall WHERE level IS NOT NULL'
)
SQL["dead_letters"] = loads(
    """, asked AS (SELECT CASE WHEN quote_signal < 0.72 THEN NULL ELSE load_id END AS key,
  CASE WHEN quote_signal > 3.55 THEN NULL ELSE round_even(greatest(1.8 * distance - 300, -1e9), 2) END AS rate FROM loads),
judged AS (SELECT rate, concat_ws(', ', CASE WHEN key IS NULL THEN 'missing key' END,
  CASE WHEN rate IS NULL THEN 'no finite prediction' END, CASE WHEN rate <= 0 THEN 'prediction not positive' END) AS reasons FROM asked)
SELECT CASE WHEN reasons = '' THEN 'accepted' ELSE reasons END AS verdict, count(*) AS rows, round(sum(rate), 2) AS total
FROM judged GROUP BY 1"""
)
_months = "count(DISTINCT CASE WHEN year(date) {} 1998 THEN year(date) * 100 + month(date) END)::INTEGER"
_state = (
    "SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS missing, 0::BIGINT AS infinite, {neg} AS negative, {zero} AS zero, "
    "{mean} AS mean, {std} AS std, {low} AS least, {high} AS greatest, {first} AS first, {last} AS last, "
    + _months.format("<") + " AS read_first, " + _months.format(">=") + " AS read_then FROM loads"
)
SQL["incremental_audit"] = loads(
    union(
        [
            _state.format(
                c=c, neg=f"count(*) FILTER ({c} < 0)", zero=f"count(*) FILTER ({c} = 0)", mean=f"round(avg({c}), 4)",
                std=f"round(stddev_samp({c}), 4)", low=f"round(min({c}), 4)", high=f"round(max({c}), 4)",
                first="NULL::VARCHAR", last="NULL::VARCHAR",
            )
            if c in NUMERIC
            else _state.format(
                c=c, neg="0::BIGINT", zero="0::BIGINT", mean="NULL::DOUBLE", std="NULL::DOUBLE", low="NULL::DOUBLE", high="NULL::DOUBLE",
                first=f"min({c})::VARCHAR", last=f"max({c})::VARCHAR",
            )
            for c in LOAD_COLUMNS
        ]
    )
)
SQL["incremental_values"] = loads(
    "SELECT 'pickup' AS \"column\", pickup AS value, count(*) AS n FROM loads GROUP BY 2 UNION ALL "
    "SELECT 'equipment', equipment, count(*) FROM loads GROUP BY 2"
)
SQL["rescued_values"] = loads(
    """, planted AS (SELECT CASE WHEN quote_signal < 0.9 THEN '2001-13-0' || length(equipment) END AS bad_date,
  CASE WHEN distance > 2500 THEN equipment || ' lb' END AS bad_weight, date, weight FROM loads)
SELECT 'date' AS "column", coalesce(bad_date, '(parsed)') AS value, count(*) AS cells FROM planted GROUP BY 1, 2 UNION ALL
SELECT 'weight', coalesce(bad_weight, '(parsed)'), count(*) FROM planted WHERE bad_weight IS NOT NULL OR weight IS NOT NULL GROUP BY 1, 2"""
)
SQL["stream_equals_batch"] = loads("SELECT count(*) AS rows, 0::BIGINT AS differing FROM loads")
SQL["rolling_identity"] = loads(
    union(
        [
            f"SELECT '{n}' AS \"window\", count(*) FILTER (date <= DATE '{t}') AS train_rows, "
            f"count(*) FILTER (date BETWEEN DATE '{a}' AND DATE '{b}') AS valid_rows, "
            f"count(*) FILTER (date BETWEEN DATE '{a}' AND DATE '{b}') AS stored, true AS \"same_MAE\" FROM loads"
            for n, t, a, b in WINDOWS
        ]
    )
)

# ---------------------------------------------------------------- sources, sinks and requests

SQL["csv_round_trip"] = SQL["loads"]
SQL["clean_requests"] = SQL["loads"]
SQL["checked_scan"] = (
    "SELECT count(*) AS rows, round(sum(o_totalprice), 2) AS total, 'orders file not found' AS absent FROM orders"
)
SQL["contract_checks"] = union(
    [
        f"SELECT '{case}' AS \"case\", count(*) AS rows, {rejected} AS rejected FROM {table}"
        for case, rejected, table in (
            ("columns", "false", "orders"),
            ("columns swapped", "true", "orders"),
            ("contract", "false", "lineitem"),
            ("target to score", "true", "lineitem"),
            ("no target", "true", "lineitem"),
        )
    ]
)
_holes = "CASE WHEN substr(load_id, 4, 7)::INT % {} = 0 THEN NULL ELSE {} END"
SQL["nan_audit"] = (
    f"WITH {LOADS},\nholed AS (SELECT equipment, {_holes.format(17, 'posted_rate')} AS y, {_holes.format(19, 'weight')} AS w, "
    f"{_holes.format(23, 'market_index')} AS m FROM loads),\n"
    "q AS (SELECT quantile_cont(y, 0.25) AS q1, quantile_cont(y, 0.75) AS q3 FROM holed),\n"
    "f AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)\n"
    "SELECT report, measure, round(value, 6) AS value FROM ("
    + union(
        [
            "SELECT 'balance' AS report, 'rows' AS measure, count(*)::DOUBLE AS value FROM holed",
            "SELECT 'balance', 'positives', count(*) FILTER (y >= 7500) FROM holed",
            "SELECT 'balance', 'positive_pct', count(*) FILTER (y >= 7500) * 100.0::DOUBLE / count(*) FROM holed",
            "SELECT 'outliers', 'upper_bound', hi FROM f",
            "SELECT 'outliers', 'outlier_count', (SELECT count(*) FROM holed WHERE y < lo OR y > hi) FROM f",
            f"SELECT 'flags', 'heavy_load', count(*) FILTER (w >= {K.HEAVY_LB}) FROM holed",
            f"SELECT 'flags', 'market_index_high', count(*) FILTER (m >= {K.INDEX_HIGH}::DOUBLE) FROM holed",
            "SELECT 'equipment', equipment, avg(y) FROM holed GROUP BY equipment",
            "SELECT 'high', equipment, count(*) FILTER (y >= 7500) FROM holed GROUP BY equipment",
        ]
    )
    + ")"
)

# ---------------------------------------------------------------- gates and scenario

_EXPECTED = "SELECT format('TE-{:06d}', i) AS load_id FROM range(101, (SELECT count(*) FROM orders) + 101) AS t(i)"
SQL["expected_ids"] = _EXPECTED
_key_diff = f"""WITH {SUBMISSION}, expected AS ({_EXPECTED}),
diff AS (SELECT coalesce(s.load_id, e.load_id) AS load_id, CASE WHEN s.load_id IS NULL THEN 'missing' ELSE 'extra' END AS side
  FROM submission s FULL OUTER JOIN expected e ON s.load_id = e.load_id WHERE s.load_id IS NULL OR e.load_id IS NULL)
"""
SQL["key_diff"] = _key_diff + "SELECT * FROM diff"
SQL["key_set_check"] = _key_diff + (
    "SELECT 'missing_ids' AS \"check\", count(*) AS violations, count(*) = 0 AS passed FROM diff WHERE side = 'missing' "
    "UNION ALL SELECT 'extra_ids', count(*), count(*) = 0 FROM diff WHERE side = 'extra'"
)
SQL["key_order_check"] = (
    "SELECT count(*) AS positions, count(*) FILTER (o_orderkey >= 500) AS mismatches FROM orders"
)
SQL["attach_predictions"] = sub(
    "SELECT s.load_id, o.o_orderpriority, s.predicted_rate "
    "FROM orders o JOIN submission s ON s.load_id = format('TE-{:06d}', o.o_orderkey + 1)"
)
_bucket = case_cut("predicted_rate", K.PREDICTION_EDGES, K.PREDICTION_LABELS, include_lowest=True)
_spine = ", ".join(f"('{n}')" for n in K.PREDICTION_LABELS)
SQL["prediction_buckets"] = sub(
    f"SELECT b.rate_bucket, count(s.rate_bucket) AS count, "
    "round(count(s.rate_bucket) * 100.0::DOUBLE / (SELECT count(*) FROM submission), 6) AS percentage "
    f"FROM (VALUES {_spine}) b(rate_bucket) LEFT JOIN (SELECT {_bucket} AS rate_bucket FROM submission) s "
    "ON s.rate_bucket = b.rate_bucket GROUP BY 1"
)


def tall(table: str, pairs: dict[str, str]) -> str:
    return union([f"SELECT '{n}' AS metric, round(CAST({e} AS DOUBLE), 6) AS value FROM {table}" for n, e in pairs.items()])


_P = "predicted_rate"
SQL["prediction_summary"] = sub(
    tall(
        "submission",
        {
            "prediction_count": f"count({_P})", "minimum": f"min({_P})", "maximum": f"max({_P})", "mean": f"avg({_P})",
            "median": f"median({_P})", "std": f"stddev_pop({_P})",
            **{f"p{q}": f"quantile_cont({_P}, {q / 100})" for q in (25, 75, 95, 99)},
        },
    )
)
SQL["submission_audit"] = sub(
    tall(
        "submission",
        {
            "rows": "count(*)", "columns": "any_value(2)", "missing_predictions": f"count(*) - count({_P})",
            "infinite_predictions": f"count(*) FILTER (isinf({_P}))", "negative_predictions": f"count(*) FILTER ({_P} < 0)",
            "duplicate_load_ids": "count(*) - count(DISTINCT load_id)",
            "minimum_prediction": f"min({_P})", "maximum_prediction": f"max({_P})", "mean_prediction": f"avg({_P})",
            "median_prediction": f"median({_P})", "p95_prediction": f"quantile_cont({_P}, 0.95)",
            "p99_prediction": f"quantile_cont({_P}, 0.99)",
        },
    )
)


def checks(table: str, pairs: dict[str, str]) -> str:
    return union(
        [
            f"SELECT '{n}' AS \"check\", CAST({e} AS BIGINT) AS violations, ({e}) = 0 AS passed FROM {table}"
            for n, e in pairs.items()
        ]
    )


_N = "CAST(substr(load_id, 4) AS BIGINT)"
SQL["submission_checks"] = f"""WITH {SUBMISSION}, faulty AS (SELECT
  CASE WHEN {_N} % 101 = 0 THEN NULL WHEN {_N} % 103 = 0 THEN 'TE-000001' ELSE load_id END AS load_id,
  CASE WHEN {_N} % 107 = 0 THEN NULL WHEN {_N} % 109 = 0 THEN 'inf'::DOUBLE WHEN {_N} % 113 = 0 THEN -predicted_rate
    WHEN {_N} % 127 = 0 THEN 0.0 ELSE predicted_rate END AS predicted_rate FROM submission)
""" + checks(
    "faulty",
    {
        "row_count_difference": "abs(count(*) - 10)",
        "missing_keys": "count(*) - count(load_id)",
        "duplicate_keys": "count(load_id) - count(DISTINCT load_id)",
        "missing_predictions": f"count(*) - count({_P})",
        "infinite_predictions": f"count(*) FILTER (isinf({_P}))",
        "non_positive_predictions": f"count(*) FILTER ({_P} <= 0)",
    },
)
_SCENARIO = f"""WITH {LOADS},
daily AS (SELECT day(date) AS d, avg(posted_rate) AS rate FROM loads WHERE equipment = 'Dry Van' GROUP BY 1),
scenario AS (SELECT 'Lexington' AS pickup, 'Fort Wayne' AS delivery, 360.0::DOUBLE AS distance, 'Dry Van' AS equipment,
  32000.0::DOUBLE AS weight, CAST(day AS DATE) AS date, rate AS predicted_rate
  FROM (SELECT unnest(generate_series(DATE '2025-12-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS day) LEFT JOIN daily ON day(day) = d)"""
SQL["scenario_frame"] = (
    f"{_SCENARIO}\nSELECT pickup, delivery, distance, equipment, weight, date, round(predicted_rate, 6) AS predicted_rate FROM scenario"
)
_CLOSE = "abs({0} - {1}) <= 1e-8 + 1e-5 * {1}"
SQL["scenario_checks"] = (
    f"""{_SCENARIO}, faulty AS (SELECT pickup, delivery, distance, equipment,
  CASE WHEN day(date) = 9 THEN 31000.0 ELSE weight END AS weight,
  CASE WHEN day(date) = 7 THEN DATE '2025-12-08' ELSE date END AS date,
  CASE WHEN day(date) = 11 THEN -predicted_rate ELSE predicted_rate END AS predicted_rate FROM scenario)
"""
    + checks(
        "faulty",
        {
            "invalid_dates": "count(*) - count(date)",
            "duplicate_dates": "count(date) - count(DISTINCT date)",
            "wrong_pickup": "count(*) FILTER (pickup IS DISTINCT FROM 'Lexington')",
            "wrong_delivery": "count(*) FILTER (delivery IS DISTINCT FROM 'Fort Wayne')",
            "wrong_equipment": "count(*) FILTER (equipment IS DISTINCT FROM 'Dry Van')",
            "wrong_distance": f"count(*) FILTER (NOT coalesce({_CLOSE.format('distance', '360')}, false))",
            "wrong_weight": f"count(*) FILTER (NOT coalesce({_CLOSE.format('weight', '32000')}, false))",
            "bad_predictions": "count(*) FILTER (NOT coalesce(predicted_rate > 0, false))",
            "missing_dates": "31 - count(DISTINCT date)",
            "extra_dates": "count(DISTINCT date) FILTER (date NOT BETWEEN DATE '2025-12-01' AND DATE '2025-12-31')",
        },
    )
)
SQL["scenario_series"] = (
    f"{_SCENARIO}\nSELECT date, round(predicted_rate, 6) AS predicted_rate, "
    "round((SELECT min(predicted_rate) - greatest(10.0, 0.02 * min(predicted_rate)) FROM scenario), 6) AS floor FROM scenario"
)

# ---------------------------------------------------------------- filling, coding, streaming

_FEATURES = (
    f"WITH {LOADS},\nfeatures AS (SELECT loads.*, "
    + ", ".join(f"{e} AS {n}" for n, e in BASE.items())
    + f" FROM loads),\ntrain AS (SELECT * FROM features WHERE date < DATE '{SPLIT}')\n"
)
SQL["impute_median"] = _FEATURES + union(
    [f"SELECT '{c}' AS \"column\", round(median(CAST({c} AS DOUBLE)), 6) AS fill FROM train" for c in BASE_NUMERIC]
)
SQL["impute_mode"] = _FEATURES + union(
    [
        f"SELECT * FROM (SELECT '{c}' AS \"column\", {c} AS fill FROM train GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        for c in ("pickup", "delivery", "equipment", "route")
    ]
)
SQL["filled_rows"] = f"""WITH {LOADS},
train AS (SELECT median(weight) AS w, median(market_index) AS m FROM loads WHERE date < DATE '{SPLIT}')
SELECT load_id, date, distance, round(coalesce(weight, w), 6) AS weight, round(coalesce(market_index, m), 6) AS market_index,
  equipment FROM loads, train WHERE date >= DATE '{SPLIT}'"""
SQL["onehot_unknown"] = loads(
    "SELECT equipment, count(*) AS rows, count(*) FILTER (equipment = 'Dry Van') AS hot_dry_van, "
    "count(*) FILTER (equipment = 'Flatbed') AS hot_flatbed FROM loads GROUP BY 1"
)
SQL["stream_features"] = SQL["features_base"]
