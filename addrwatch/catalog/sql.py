"""Common table expressions of the comparison SQL."""

from __future__ import annotations

_FIRST_RATIOS = """
  looped / nullif(count + 1e-6, 0) AS looped_per_count,
  looped / nullif(length + 1e-6, 0) AS looped_per_length,
  income / nullif(length + 1e-6, 0) AS income_per_length,
  income / nullif(count + 1e-6, 0) AS income_per_count,
  neighbors / nullif(length + 1e-6, 0) AS neighbors_per_length,
  neighbors / nullif(weight + 1e-6, 0) AS neighbors_per_weight,
  weight / nullif(length + 1e-6, 0) AS weight_per_length"""

_LOGS = """
  CASE WHEN count > -1 THEN ln(1.0::DOUBLE + count) END AS log_count,
  CASE WHEN neighbors > -1 THEN ln(1.0::DOUBLE + neighbors) END AS log_neighbors,
  CASE WHEN income > -1 THEN ln(1.0::DOUBLE + income) END AS log_income"""

_SECOND_RATIOS = """
  log_income / nullif(log_neighbors + 1e-6, 0) AS log_income_per_log_neighbors,
  weight / nullif(log_neighbors + 1e-6, 0) AS weight_per_log_neighbors,
  length / nullif(log_neighbors + 1e-6, 0) AS length_per_log_neighbors"""

_SCALED = ["length", "log_count", "log_income", "log_neighbors", "neighbors_per_length"]


def _z(name: str) -> str:
    return (
        f"({name} - (SELECT mean FROM stats WHERE col = '{name}')) / "
        f"(SELECT CASE WHEN std > 1e-6 THEN std ELSE 1.0 END FROM stats WHERE col = '{name}') AS {name}"
    )


_STAT_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS col, avg({c}) AS mean, stddev_samp({c}) AS std FROM first_pass" for c in _SCALED
)

_HASH = "CAST('0x' || substr(md5('{seed}:' || address || '|' || CAST(partition_date AS VARCHAR)), 1, 8) AS BIGINT)"

_Z_COLS = ", ".join(_z(c) for c in _SCALED)

# name -> (what it builds on, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "tx": ((), """
SELECT CAST(o.o_orderkey AS VARCHAR) AS address,
  CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(dayofyear(o.o_orderdate) AS INTEGER) AS day,
  CAST(count(l.l_linenumber) AS BIGINT) AS length,
  round(coalesce(sum(l.l_discount), 0), 4) AS weight,
  CAST(coalesce(sum(l.l_quantity), 0) AS BIGINT) AS count,
  CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS looped,
  count(DISTINCT l.l_suppkey) AS neighbors,
  o.o_totalprice AS income,
  CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderstatus = 'F' THEN 'familyA'
       WHEN o.o_orderpriority = '2-HIGH' AND o.o_orderstatus = 'F' AND o.o_orderkey % 4 = 0 THEN 'familyB'
       ELSE 'white' END AS label
FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey, o.o_orderdate, o.o_totalprice, o.o_orderstatus, o.o_orderpriority"""),
    "act": (("tx",), "SELECT *, CAST(make_date(year, 1, 1) + (day - 1) AS DATE) AS partition_date FROM tx"),
    "prep": (("act",), """
SELECT address, partition_date, length, weight, count, looped, neighbors, income,
  CASE WHEN label = 'white' THEN 0 ELSE 1 END AS is_ransomware FROM act"""),
    "counts": (("prep",), """
SELECT count(*) FILTER (is_ransomware = 1) AS positives, count(*) FILTER (is_ransomware = 0) AS negatives
FROM prep"""),
    "hashed": (("prep",), f"""
SELECT *, {_HASH.format(seed='42')} AS h_keep, {_HASH.format(seed='42/split')} AS h_split FROM prep"""),
    "sampled": (("hashed", "counts"), """
SELECT *, CASE WHEN h_split < floor(0.8 * 4294967296) THEN 'train' ELSE 'test' END AS split
FROM hashed WHERE is_ransomware = 1 OR h_keep < (
  SELECT coalesce(least(floor(positives * 5.0::DOUBLE) / nullif(negatives, 0), 1.0), 0.0) FROM counts
) * 4294967296.0"""),
    "first_pass": (("prep",), f"""
SELECT address, partition_date, is_ransomware, length, weight, looped, {_LOGS}, {_FIRST_RATIOS} FROM prep"""),
    "stats": (("first_pass",), _STAT_ROWS),
    "unscaled": (("first_pass",), f"SELECT *, {_SECOND_RATIOS} FROM first_pass"),
    "second_pass": (("unscaled", "stats"), f"SELECT * REPLACE ({_Z_COLS}) FROM unscaled"),
    # Fixed term table of the scoring queries: one row per term and bin.
    "bins": ((), """
SELECT * FROM (VALUES
  ('length', '-inf'::DOUBLE, -0.55::DOUBLE, -0.42::DOUBLE), ('length', -0.55, 0.45, 0.11), ('length', 0.45, 'inf', 0.63),
  ('log_income', '-inf', -1.05, -0.71), ('log_income', -1.05, 0.05, -0.23), ('log_income', 0.05, 0.95, 0.34),
  ('log_income', 0.95, 'inf', 0.82),
  ('neighbors_per_length', '-inf', -0.35, 0.27), ('neighbors_per_length', -0.35, 'inf', -0.13),
  ('weight', '-inf', 0.101, -0.31), ('weight', 0.101, 0.251, 0.08), ('weight', 0.251, 'inf', 0.22),
  ('looped_per_count', '-inf', 0.0101, -0.17), ('looped_per_count', 0.0101, 'inf', 0.19),
  ('income_per_count', '-inf', 1000.5, 0.29), ('income_per_count', 1000.5, 5000.5, -0.05),
  ('income_per_count', 5000.5, 'inf', -0.37)
) AS b(term, lo, hi, score)"""),
    "gaps": ((), """
SELECT * FROM (VALUES ('length', 0.02::DOUBLE), ('log_income', -0.12), ('neighbors_per_length', 0.03),
  ('weight', 0.04), ('looped_per_count', 0.06), ('income_per_count', 0.07)) AS g(term, score)"""),
    "scorable": (("second_pass",), "SELECT *, address AS id FROM second_pass"),
    "pred": ((), """
SELECT event_id AS request_id, ts, round(1 - exp(-value / 50), 4) AS confidence,
  CASE WHEN round(1 - exp(-value / 50), 4) >= 0.5 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN (event_id * 7 + user_id) % 10 < floor(10 * (1 - exp(-value / 50))) THEN 1 ELSE 0 END AS y
FROM events WHERE event_type <> 'view'"""),
    "labelled_pred": (("pred",), """
SELECT *, CASE WHEN prediction = 1 THEN 'ransomware' ELSE 'white' END AS label,
  CASE WHEN prediction = 0 THEN 'low' WHEN confidence >= 0.9 THEN 'very high'
       WHEN confidence >= 0.7 THEN 'high' ELSE 'medium' END AS confidence_level FROM pred"""),
    "lookups": ((), """
SELECT event_id AS lookup_id, ts,
  event_id - CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS request_id
FROM events WHERE event_type = 'view'"""),
    "marked": (("lookups", "pred"), """
SELECT l.lookup_id, l.ts, l.request_id, coalesce(row_number() OVER (
    PARTITION BY p.request_id ORDER BY l.ts, l.lookup_id) = 1 AND p.request_id IS NOT NULL, false) AS hit
FROM lookups l LEFT JOIN pred p ON l.request_id = p.request_id AND p.ts <= l.ts"""),
    "running": (("marked",), """
SELECT lookup_id, ts, CAST(sum(CAST(hit AS INTEGER)) OVER w AS BIGINT) AS hits, count(*) OVER w AS seen
FROM marked WINDOW w AS (ORDER BY ts, lookup_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "http_log": ((), """
SELECT event_id, ts, 'api' AS job, concat('i', CAST(user_id % 3 AS VARCHAR)) AS instance,
  CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status FROM events"""),
    "requests": (("tx",), """
SELECT address AS request_id,
  CAST(make_date(year, 1, 1) + (day - 1) AS TIMESTAMP) + to_seconds(CAST(address AS BIGINT) * 7919 % 86400) AS ts,
  CASE WHEN CAST(address AS BIGINT) % 10 <> 0 THEN CAST(length AS DOUBLE) END AS length,
  CASE WHEN CAST(address AS BIGINT) % 7 = 0 THEN -weight ELSE weight END AS weight,
  CAST(count AS DOUBLE) AS count, CAST(looped AS DOUBLE) AS looped,
  CASE WHEN CAST(address AS BIGINT) % 15 <> 0 THEN CAST(neighbors AS DOUBLE) END AS neighbors,
  income - 100000.0 AS income
FROM tx"""),
    "valid": (("requests",), """
SELECT * FROM requests WHERE length IS NOT NULL AND weight IS NOT NULL AND count IS NOT NULL
  AND looped IS NOT NULL AND neighbors IS NOT NULL AND income IS NOT NULL"""),
    "issues": (("valid",), """
SELECT request_id, ts, 'neg_length' AS quality_rule FROM valid WHERE length < 0
UNION ALL SELECT request_id, ts, 'neg_weight' FROM valid WHERE weight < 0
UNION ALL SELECT request_id, ts, 'neg_count' FROM valid WHERE count < 0
UNION ALL SELECT request_id, ts, 'neg_looped' FROM valid WHERE looped < 0
UNION ALL SELECT request_id, ts, 'neg_neighbors' FROM valid WHERE neighbors < 0
UNION ALL SELECT request_id, ts, 'neg_income' FROM valid WHERE income < 0"""),
    "request_unscaled": (("valid",), f"""
SELECT *, {_SECOND_RATIOS} FROM (
  SELECT request_id, ts, length, weight, looped, {_LOGS}, {_FIRST_RATIOS} FROM valid)"""),
    "request_second": (("request_unscaled", "stats"), f"SELECT *, request_id AS id FROM (SELECT * REPLACE ({_Z_COLS}) FROM request_unscaled)"),
    "runs": ((), """
SELECT 'run_' || CAST(o_orderkey AS VARCHAR) AS run_id,
  'addrwatch_' || CASE o_orderkey % 3 WHEN 0 THEN 'baseline' WHEN 1 THEN 'feature_eng_1' ELSE 'feature_eng_2' END AS run_name,
  CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
  o_orderdate AS start_ts, CAST(floor(o_totalprice / 1000) AS DOUBLE) AS fn
FROM orders"""),
    # Drift baseline of the monitoring queries: the labels of the predictions.
    "base": (("pred",), """
SELECT avg(CAST(y = 1 AS INTEGER)) + 1e-6 AS t, avg(CAST(y = 0 AS INTEGER)) + 1e-6 AS f FROM pred"""),
    "latest": (("pred",), "SELECT * FROM pred ORDER BY ts DESC, request_id DESC LIMIT 100"),
    "live": (("latest",), """
SELECT avg(CAST(prediction = 1 AS INTEGER)) + 1e-6 AS t, avg(CAST(prediction = 0 AS INTEGER)) + 1e-6 AS f,
  count(*) AS n FROM latest"""),
    "trailing_share": (("pred",), """
SELECT request_id, ts, row_number() OVER o AS i,
  sum(prediction) OVER (ORDER BY ts, request_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) / 100.0::DOUBLE AS share
FROM pred WINDOW o AS (ORDER BY ts, request_id)"""),
    "psi_series": (("trailing_share", "base"), """
SELECT request_id, ts, (share + 1e-6 - t) * ln((share + 1e-6) / t)
  + (1 - share + 1e-6 - f) * ln((1 - share + 1e-6) / f) AS psi
FROM trailing_share, base WHERE i >= 100"""),
}


def with_(names: str | tuple[str, ...], body: str, **extra: str) -> str:
    """``body`` below the named expressions and all they build on; ``extra`` come last."""
    names = (names,) if isinstance(names, str) else names
    order: list[str] = []

    def add(name: str) -> None:
        for needed in CTES[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [f"{n} AS ({CTES[n][1].strip()})" for n in order]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in extra.items()]
    return f"WITH {', '.join(parts)} {body.strip()}" if parts else body.strip()


def sliding(source: str, by: str = "", window: int = 3600, slide: int = 900, ts: str = "ts") -> str:
    """Event counts in sliding windows: ``(w, *by, n)``, ``w`` the start in seconds."""
    cols = f", {by}" if by else ""
    return f"""
SELECT (epoch_us({ts}) // {slide * 1_000_000} - k) * {slide} AS w{cols}, count(*) AS n
FROM {source}, range({window // slide}) r(k) GROUP BY w{cols}"""


def held(ticks: str, condition: str, by: str = "", hold: int = 3600, step: int = 900) -> str:
    """``(tick, *by, state)`` from ``(k, *by, value)``, ``k`` counting steps."""
    cols = f", {by}" if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return f"""
SELECT make_timestamp(k * {step} * 1000000) AS tick{cols},
  CASE WHEN NOT ({condition}) THEN 'inactive'
       WHEN sum(CAST({condition} AS INTEGER)) OVER (
         {part}ORDER BY k RANGE BETWEEN {hold // step} PRECEDING AND CURRENT ROW) >= {hold // step + 1}
       THEN 'firing' ELSE 'pending' END AS state
FROM {ticks}"""


def gauge(samples: str, by: str = "", tie: str = "event_id", step: int = 900) -> str:
    """``(k, *by, value)``: the last value at or before each step."""
    cols = f", {by}" if by else ""
    part = f"PARTITION BY {by} " if by else ""
    using = "k" + cols
    return f"""
SELECT k{cols}, last_value(v IGNORE NULLS) OVER ({part}ORDER BY k) AS value FROM (
  SELECT unnest(range(lo, hi + 1)) AS k{cols} FROM (
    SELECT min(ceil(epoch_us(ts) / {step * 1_000_000.0}))::BIGINT AS lo,
      (SELECT max(ceil(epoch_us(ts) / {step * 1_000_000.0}))::BIGINT FROM {samples}) AS hi{cols}
    FROM {samples} {f'GROUP BY {by}' if by else ''})
) LEFT JOIN (
  SELECT ceil(epoch_us(ts) / {step * 1_000_000.0})::BIGINT AS k{cols}, arg_max(value, (ts, {tie})) AS v
  FROM {samples} GROUP BY k{cols}
) USING ({using})"""


TERM_NAMES = [
    "length", "log_income", "neighbors_per_length", "weight", "looped_per_count",
    "income_per_count", "length & weight",
]


def terms(source: str) -> str:
    """``(id, term, value)`` for the rows of ``source``, by a range join on the term table."""
    singles = TERM_NAMES[:-1]
    long = " UNION ALL ".join(f"SELECT id, '{c}' AS term, {c} AS x FROM {source}" for c in singles)
    return f"""
SELECT x.id, x.term, coalesce(b.score, g.score) AS value
FROM ({long}) x LEFT JOIN bins b ON b.term = x.term AND x.x >= b.lo AND x.x < b.hi
LEFT JOIN gaps g ON g.term = x.term
UNION ALL
SELECT id, 'length & weight', CASE WHEN length IS NULL OR weight IS NULL THEN 0.0
  WHEN length < 0.05 AND weight < 0.15 THEN -0.09 WHEN length < 0.05 THEN 0.14
  WHEN weight < 0.15 THEN 0.46 ELSE -0.25 END FROM {source}"""
