"""SQL twins of the adapters, shared by the reference queries."""

CONDITIONS = {
    "twf": "tool_wear_minutes >= CASE {t} WHEN 'L' THEN 200 WHEN 'M' THEN 220 WHEN 'H' THEN 240 ELSE 240 END",
    "hdf": "(rotational_speed_rpm < 1380 AND process_temperature_kelvin - air_temperature_kelvin < 8.6::DOUBLE)",
    "pwf": "(torque_nm * rotational_speed_rpm * 2 * 3.14159::DOUBLE / 60 < 3500"
    " OR torque_nm * rotational_speed_rpm * 2 * 3.14159::DOUBLE / 60 > 9000)",
    "osf": "torque_nm * tool_wear_minutes > CASE {t} WHEN 'L' THEN 11000 WHEN 'M' THEN 12000 WHEN 'H' THEN 13000 ELSE 11000 END",
}


def condition(name: str, type_col: str = "type") -> str:
    return CONDITIONS[name].format(t=type_col)


def _sensors(source: str) -> str:
    return f"""
    SELECT *, CASE WHEN a % 10 < 6 THEN 'L' WHEN a % 10 < 9 THEN 'M' ELSE 'H' END AS type,
      CAST(2953 + b % 93 AS DOUBLE) / 10 AS air_temperature_kelvin,
      CAST(2953 + b % 93 + 76 + c % 46 AS DOUBLE) / 10 AS process_temperature_kelvin,
      CAST(1340 + a % 200 + d % 201 AS INTEGER) AS rotational_speed_rpm,
      CAST(140 + a % 131 + b % 131 + c % 131 + d % 131 AS DOUBLE) / 10 AS torque_nm,
      CAST((c + d) % 216 AS INTEGER) AS tool_wear_minutes
    FROM (SELECT *, (k * 7919 + 104729) % 1000003 AS a, (k * 15487 + 32452843) % 1000003 AS b,
      (k * 49979 + 67867967) % 1000003 AS c, (k * 86028 + 15485863) % 1000003 AS d FROM ({source}))"""


def rule_percent(t: str) -> str:
    return f"""CAST(least(99, 5 + 45 * ({condition('pwf', t)})::INT + 40 * ({condition('hdf', t)})::INT
      + 35 * ({condition('osf', t)})::INT + 15 * ({condition('twf', t)})::INT
      + floor(tool_wear_minutes / 24.0)::INT + floor(abs(rotational_speed_rpm - 1500) / 50.0)::INT) AS INTEGER)"""


def rule_type(t: str) -> str:
    cases = " ".join(f"WHEN {condition(n, t)} THEN '{n}'" for n in ("twf", "hdf", "pwf", "osf"))
    return f"CASE {cases} ELSE 'none' END"


LABEL = "CASE WHEN twf = 1 THEN 'twf' WHEN hdf = 1 THEN 'hdf' WHEN pwf = 1 THEN 'pwf' WHEN osf = 1 THEN 'osf' ELSE 'none' END"

TRAINING = f"""training AS (
  SELECT udi, type || lpad(CAST(20000 + udi AS VARCHAR), 5, '0') AS product_id, type, air_temperature_kelvin,
    process_temperature_kelvin, rotational_speed_rpm, torque_nm, tool_wear_minutes, machine_failure,
    CAST(CASE WHEN twf0 THEN machine_failure ELSE 0 END AS INTEGER) AS twf,
    CAST(CASE WHEN hdf0 THEN machine_failure ELSE 0 END AS INTEGER) AS hdf,
    CAST(CASE WHEN pwf0 THEN machine_failure ELSE 0 END AS INTEGER) AS pwf,
    CAST(CASE WHEN osf0 THEN machine_failure ELSE 0 END AS INTEGER) AS osf,
    CAST(0 AS INTEGER) AS rnf
  FROM (SELECT *, CAST(CASE WHEN hdf0 OR pwf0 OR osf0 OR (twf0 AND k % 10 = 0) THEN 1 ELSE 0 END AS INTEGER) AS machine_failure
    FROM (SELECT *, {condition('twf')} AS twf0, {condition('hdf')} AS hdf0, {condition('pwf')} AS pwf0, {condition('osf')} AS osf0
      FROM ({_sensors("SELECT l_orderkey * 8 + l_linenumber AS k, row_number() OVER (ORDER BY l_orderkey * 8 + l_linenumber) AS udi FROM lineitem")}))))"""

FEATURED = """featured AS (SELECT *, torque_nm * rotational_speed_rpm * 2 * 3.14159::DOUBLE / 60 / 1000 AS power_kw,
  process_temperature_kelvin - air_temperature_kelvin AS temp_diff_kelvin, torque_nm * tool_wear_minutes AS mechanical_stress
  FROM training)"""

SCORED = f"""scored AS (SELECT *, pct / 100.0::DOUBLE AS probability, CAST(CASE WHEN pct > 50 THEN 1 ELSE 0 END AS INTEGER) AS predicted
  FROM (SELECT *, {LABEL} AS failure_type, {rule_percent('type')} AS pct, {rule_type('type')} AS predicted_type FROM featured))"""

READINGS = f"""readings AS (
  SELECT id, "timestamp", reading_number, machine_id, machine_type, air_temperature_kelvin, process_temperature_kelvin,
    rotational_speed_rpm, torque_nm, tool_wear_minutes, power_kw, temp_diff_kelvin, mechanical_stress, predicted_failure,
    predicted_failure_type, failure_probability, injected_failure, mode,
    CASE WHEN predicted_failure_type IS NULL THEN 'binary' ELSE 'multiclass' END AS target,
    CASE WHEN mode = 'gradual-drift' THEN 0.034::DOUBLE + (reading_number - 1) / greatest(n - 1, 1)::DOUBLE * (0.25::DOUBLE - 0.034::DOUBLE)
         WHEN mode = 'sudden-spike' AND reading_number - 1 >= n // 2 THEN 0.40::DOUBLE ELSE 0.034::DOUBLE END AS effective_failure_rate
  FROM (SELECT *, CASE WHEN predicted_failure = 1 AND rtype <> 'none' THEN rtype END AS predicted_failure_type
    FROM (SELECT *, CAST(CASE WHEN pct > 50 THEN 1 ELSE 0 END AS INTEGER) AS predicted_failure, pct / 100.0::DOUBLE AS failure_probability
      FROM (SELECT *, {rule_percent('machine_type')} AS pct, {rule_type('machine_type')} AS rtype,
          torque_nm * rotational_speed_rpm * 2 * 3.14159::DOUBLE / 60 / 1000 AS power_kw,
          process_temperature_kelvin - air_temperature_kelvin AS temp_diff_kelvin, torque_nm * tool_wear_minutes AS mechanical_stress,
          CASE id % 3 WHEN 0 THEN 'normal' WHEN 1 THEN 'gradual-drift' ELSE 'sudden-spike' END AS mode,
          (SELECT count(*) FROM events) AS n
        FROM (SELECT event_id + 1 AS id, ts AS "timestamp", event_id + 1 AS reading_number,
            'machine_' || lpad(CAST(user_id % 5 + 1 AS VARCHAR), 2, '0') AS machine_id, type AS machine_type, air_temperature_kelvin,
            CASE WHEN inj = 1 AND k % 3 = 0 THEN round(air_temperature_kelvin + 8.2::DOUBLE, 1) ELSE process_temperature_kelvin END AS process_temperature_kelvin,
            CAST(CASE WHEN inj = 1 AND k % 3 <> 0 THEN greatest(500, rotational_speed_rpm - 350) ELSE rotational_speed_rpm END AS DOUBLE) AS rotational_speed_rpm,
            CASE WHEN inj = 1 AND k % 3 <> 0 THEN torque_nm + 18.0::DOUBLE ELSE torque_nm END AS torque_nm,
            CAST(tool_wear_minutes AS DOUBLE) AS tool_wear_minutes, inj AS injected_failure
          FROM ({_sensors("SELECT *, event_id + 500000000 AS k, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INTEGER) AS inj FROM events")}))))))"""

NUMERIC = [
    "air_temperature_kelvin", "process_temperature_kelvin", "rotational_speed_rpm", "torque_nm",
    "tool_wear_minutes", "power_kw", "temp_diff_kelvin", "mechanical_stress",
]


def with_training(body: str, *more: str) -> str:
    return "WITH " + ", ".join([TRAINING, FEATURED, *more]) + " " + body


def with_scored(body: str, *more: str) -> str:
    return with_training(body, SCORED, *more)


def with_readings(body: str, *more: str) -> str:
    return "WITH " + ", ".join([READINGS, *more]) + " " + body


def with_both(body: str, *more: str) -> str:
    return "WITH " + ", ".join([TRAINING, FEATURED, READINGS, *more]) + " " + body


def _melt(table: str, where: str = "true") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {table} WHERE {where}" for c in NUMERIC)


def numeric_counts(current_where: str = "true") -> str:
    """CTEs ``vc`` (feature, v, r, c) and ``ec`` (with running shares and the next value)."""
    return f"""vc AS (SELECT feature, v, CAST(sum(r) AS BIGINT) AS r, CAST(sum(c) AS BIGINT) AS c FROM (
        SELECT feature, v, 1 AS r, 0 AS c FROM ({_melt('featured')})
        UNION ALL SELECT feature, v, 0, 1 FROM ({_melt('readings', current_where)})) GROUP BY 1, 2),
    sz AS (SELECT feature, sum(r)::DOUBLE AS nr, sum(c)::DOUBLE AS nc, sum(v * r) / sum(r) AS mu FROM vc GROUP BY 1),
    ec AS (SELECT vc.*, nr, nc, mu, abs(sum(r) OVER w / nr - sum(c) OVER w / nc) AS gap, lead(v) OVER w AS nv
        FROM vc JOIN sz USING (feature) WINDOW w AS (PARTITION BY feature ORDER BY v))"""


def numeric_stats() -> str:
    """CTE ``ns``: one row per numeric feature with KS distance and normalised Wasserstein."""
    return """ns AS (SELECT feature, nr, nc, max(gap) AS ks_d,
        coalesce(sum(gap * (nv - v)), 0) / greatest(sqrt(sum(r * (v - mu) * (v - mu)) / max(nr)), 0.001) AS wasserstein
        FROM ec GROUP BY feature, nr, nc)"""


def type_stats(current_where: str = "true") -> str:
    """CTE ``ts``: one row with Jensen-Shannon and chi-squared of the machine type."""
    return f"""tc AS (SELECT t, CAST(sum(r) AS DOUBLE) AS r, CAST(sum(c) AS DOUBLE) AS c FROM (
        SELECT type AS t, 1 AS r, 0 AS c FROM featured UNION ALL
        SELECT machine_type, 0, 1 FROM readings WHERE {current_where}) GROUP BY 1),
    tt AS (SELECT *, r / sum(r) OVER () AS p, c / sum(c) OVER () AS q, sum(c) OVER () AS nc FROM tc),
    ts AS (SELECT 'type' AS feature, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js,
        sum((c - p * nc) * (c - p * nc) / (p * nc)) AS chi_square FROM tt)"""
