"""Independent DuckDB SQL for every catalog key (the correctness oracle).

Written from the rules in plain SQL — windows, CASE, UNION ALL — over the
pre-registered test tables, so it shares no code path with the Spark side.
"""

from __future__ import annotations

EVENT_TYPES_SQL = "('ad_request','ad_impression','ad_click','ad_quartile','ad_error')"


def hu(num: str, den: str, scale: int) -> str:
    """round(num / den, scale), halves away from zero, from the exact quotient and remainder (den > 0)."""
    n, d = f"(abs(CAST({num} AS HUGEINT)) * {10**scale})", f"CAST({den} AS HUGEINT)"
    up = f"CASE WHEN ({n} % {d}) >= {d} - ({n} % {d}) THEN 1 ELSE 0 END"
    return f"CAST(sign({num}) * ({n} // {d} + {up}) AS DOUBLE) / {10**scale}"


def rate(num: str, den: str, scale: int = 6) -> str:
    return f"CASE WHEN {den} > 0 THEN {hu(num, den, scale)} END"

SILVER_COLS = (
    "event_id, event_type, event_ts, ingest_ts, event_date, session_id, content_id, pod_id, slot_index, "
    "break_type, platform, market, campaign_id, creative_id, advertiser_id, quartile, error_code, "
    "bid_floor_micros, clearing_price_micros, is_late"
)

# slots: one row per events row with the derived slot attributes
SLOTS_CTE = """
s0 AS (
  SELECT event_id AS e, user_id AS u, CAST(FLOOR(event_id / 3) AS BIGINT) AS p,
         CAST(ts AS TIMESTAMP) AS event_ts,
         CAST(ROUND(value * 10000) AS BIGINT) + 80000 AS floor_micros,
         (event_id * 13 + user_id) % 100 AS q
  FROM events
),
s1 AS (
  SELECT *,
    CASE WHEN p % 20 < 5 THEN 'preroll' WHEN p % 20 < 17 THEN 'midroll' ELSE 'postroll' END AS break_type,
    CASE p % 4 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' WHEN 2 THEN 'web' ELSE 'tv' END AS platform,
    CASE WHEN p % 10 < 7 THEN 'IN' WHEN p % 10 = 7 THEN 'US' WHEN p % 10 = 8 THEN 'GB' ELSE 'AE' END AS market
  FROM s0
),
slots AS (
  SELECT *,
    (e * 37 + u) % 100 < CASE break_type WHEN 'preroll' THEN 92 WHEN 'midroll' THEN 78 ELSE 85 END AS filled
  FROM s1
)"""

BEACONS_CTE = SLOTS_CTE + """,
kinds AS (
  SELECT *, 'req' AS kind, 'ad_request' AS event_type, CAST(NULL AS INTEGER) AS quartile FROM slots
  UNION ALL SELECT *, 'err', 'ad_error', NULL FROM slots WHERE NOT filled
  UNION ALL SELECT *, 'imp', 'ad_impression', NULL FROM slots WHERE filled
  UNION ALL SELECT *, 'late', 'ad_impression', NULL FROM slots WHERE filled AND e % 50 = 0
  UNION ALL SELECT *, 'clk', 'ad_click', NULL FROM slots WHERE filled AND platform <> 'tv' AND e % 23 = 0
  UNION ALL SELECT *, 'q25', 'ad_quartile', 25 FROM slots WHERE filled
  UNION ALL SELECT *, 'q50', 'ad_quartile', 50 FROM slots WHERE filled AND q >= 18
  UNION ALL SELECT *, 'q75', 'ad_quartile', 75 FROM slots WHERE filled AND q >= 35
  UNION ALL SELECT *, 'q100', 'ad_quartile', 100 FROM slots WHERE filled AND q >= 48
),
b0 AS (
  SELECT
    'bcn-' || CASE WHEN kind = 'late' THEN 'imp' ELSE kind END || '-' || CAST(e AS VARCHAR) AS event_id,
    event_type,
    event_ts,
    CASE WHEN kind = 'late' THEN event_ts + INTERVAL 12 HOUR ELSE event_ts END AS ingest_ts,
    'sess_' || CAST(u AS VARCHAR) AS session_id,
    'cnt_' || CAST(p % 40 AS VARCHAR) AS content_id,
    'pod_' || CAST(p AS VARCHAR) AS pod_id,
    CAST(e % 3 AS INTEGER) AS slot_index,
    break_type, platform, market,
    'cmp_' || CAST(p % 7 AS VARCHAR) AS campaign_id,
    CASE WHEN kind NOT IN ('req', 'err') THEN 'cr_' || CAST(p % 7 AS VARCHAR) END AS creative_id,
    CASE WHEN kind NOT IN ('req', 'err') THEN 'adv_' || CAST(p % 7 AS VARCHAR) END AS advertiser_id,
    CAST(quartile AS INTEGER) AS quartile,
    CASE WHEN kind = 'err' THEN CASE e % 3 WHEN 0 THEN 'NO_AD' WHEN 1 THEN 'TIMEOUT' ELSE 'VAST_ERROR' END END
      AS error_code,
    CAST(CASE WHEN kind = 'req' THEN floor_micros END AS BIGINT) AS bid_floor_micros,
    CAST(CASE WHEN kind = 'imp' THEN floor_micros + (e % 7) * 1000
              WHEN kind = 'late' THEN floor_micros + 500 END AS BIGINT) AS clearing_price_micros,
    kind = 'late' AS is_late
  FROM kinds
),
beacons AS (SELECT *, CAST(ingest_ts AS DATE) AS dt FROM b0)"""

# Latest ingest wins, then the late copy. The Spark side breaks any remaining tie
# on a 64-bit row digest; here the rest of the row is compared column by
# column. Both are deterministic total orders and agree whenever (event_id,
# ingest_ts, is_late) identifies a row, as it does in the fixture mapping.
WINNER_ORDER = (
    "ingest_ts DESC NULLS LAST, is_late DESC NULLS LAST, event_type DESC NULLS LAST, event_ts DESC NULLS LAST, "
    "session_id DESC NULLS LAST, content_id DESC NULLS LAST, pod_id DESC NULLS LAST, slot_index DESC NULLS LAST, "
    "break_type DESC NULLS LAST, platform DESC NULLS LAST, market DESC NULLS LAST, campaign_id DESC NULLS LAST, "
    "creative_id DESC NULLS LAST, advertiser_id DESC NULLS LAST, quartile DESC NULLS LAST, "
    "error_code DESC NULLS LAST, bid_floor_micros DESC NULLS LAST, clearing_price_micros DESC NULLS LAST"
)


def silver_cte(partition_by: str) -> str:
    """beacons -> typed -> ranked -> silver (per-dt when partition_by includes dt)."""
    return BEACONS_CTE + f""",
typed AS (SELECT *, CAST(event_ts AS DATE) AS event_date FROM beacons),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY {partition_by} ORDER BY {WINNER_ORDER}) AS rn FROM typed
),
silver AS (
  SELECT {SILVER_COLS}, dt FROM ranked WHERE rn = 1 AND event_type IN {EVENT_TYPES_SQL}
)"""


# the marts are built from the cross-partition silver
GOLD_SILVER = silver_cte("event_id")

CAMPAIGN_METRICS_CTE = GOLD_SILVER + """,
metrics AS (
  SELECT event_date, campaign_id, market, platform, break_type,
    CAST(count_if(event_type = 'ad_request') AS BIGINT) AS requests,
    CAST(count_if(event_type = 'ad_impression') AS BIGINT) AS impressions,
    CAST(count_if(event_type = 'ad_click') AS BIGINT) AS clicks,
    CAST(count_if(event_type = 'ad_error') AS BIGINT) AS errors,
    CAST(count_if(event_type = 'ad_quartile' AND quartile = 100) AS BIGINT) AS completions,
    CAST(coalesce(sum(CASE WHEN event_type = 'ad_impression' THEN clearing_price_micros ELSE 0 END), 0) AS BIGINT)
      AS revenue_micros
  FROM silver
  GROUP BY 1, 2, 3, 4, 5
)"""

CAMPAIGN_RATES = f"""
  CAST(revenue_micros AS DOUBLE) / 1000000 AS revenue,
  {rate('impressions', 'requests')} AS fill_rate,
  {rate('clicks', 'impressions')} AS ctr,
  {rate('completions', 'impressions')} AS completion_rate,
  {rate('revenue_micros', 'impressions * 1000', 4)} AS ecpm"""

CAMPAIGN_DAILY_CTE = CAMPAIGN_METRICS_CTE + f""",
campaign_daily AS (
  SELECT event_date, campaign_id, market, platform, break_type,
    requests, impressions, clicks, errors, completions, revenue_micros,{CAMPAIGN_RATES}
  FROM metrics
)"""

POD_FILL_CTE = GOLD_SILVER + """,
pod_base AS (
  SELECT event_date, pod_id, break_type, content_id, platform, market,
    CAST(count_if(event_type = 'ad_request') AS BIGINT) AS requests,
    CAST(count_if(event_type = 'ad_impression') AS BIGINT) AS impressions,
    CAST(count_if(event_type = 'ad_error') AS BIGINT) AS errors
  FROM silver
  GROUP BY 1, 2, 3, 4, 5, 6
),
pod_fill AS (
  SELECT *,
    CASE WHEN impressions > 0 THEN 1 ELSE 0 END AS filled,
    """ + rate("impressions", "requests") + """ AS pod_fill_rate
  FROM pod_base
)"""


def _with(cte: str, select: str) -> str:
    return "WITH " + cte.strip() + "\n" + select.strip()


ORACLE: dict[str, str] = {}

ORACLE["beacons_raw"] = _with(BEACONS_CTE, "SELECT * FROM beacons")

ORACLE["silver_dedup"] = _with(silver_cte("dt, event_id"), "SELECT * FROM silver")
ORACLE["silver_dedup_maxby"] = ORACLE["silver_dedup"]
ORACLE["silver_cross_partition"] = _with(GOLD_SILVER, "SELECT * FROM silver")

ORACLE["campaign_metrics"] = _with(CAMPAIGN_METRICS_CTE, "SELECT * FROM metrics")
ORACLE["campaign_daily"] = _with(CAMPAIGN_DAILY_CTE, "SELECT * FROM campaign_daily")

# The pandas universe written as six filtered group-bys + full outer joins
ORACLE["campaign_daily_active"] = _with(
    GOLD_SILVER
    + """,
nn AS (
  SELECT * FROM silver
  WHERE event_date IS NOT NULL AND campaign_id IS NOT NULL AND market IS NOT NULL
    AND platform IS NOT NULL AND break_type IS NOT NULL
),
req AS (SELECT event_date, campaign_id, market, platform, break_type, count(*) AS requests
        FROM nn WHERE event_type = 'ad_request' GROUP BY ALL),
imp AS (SELECT event_date, campaign_id, market, platform, break_type, count(*) AS impressions,
               coalesce(sum(clearing_price_micros), 0) AS revenue_micros
        FROM nn WHERE event_type = 'ad_impression' GROUP BY ALL),
clk AS (SELECT event_date, campaign_id, market, platform, break_type, count(*) AS clicks
        FROM nn WHERE event_type = 'ad_click' GROUP BY ALL),
err AS (SELECT event_date, campaign_id, market, platform, break_type, count(*) AS errors
        FROM nn WHERE event_type = 'ad_error' GROUP BY ALL),
q100 AS (SELECT event_date, campaign_id, market, platform, break_type, count(*) AS completions
         FROM nn WHERE event_type = 'ad_quartile' AND quartile = 100 GROUP BY ALL),
joined AS (
  SELECT
    CAST(coalesce(requests, 0) AS BIGINT) AS requests,
    CAST(coalesce(impressions, 0) AS BIGINT) AS impressions,
    CAST(coalesce(clicks, 0) AS BIGINT) AS clicks,
    CAST(coalesce(errors, 0) AS BIGINT) AS errors,
    CAST(coalesce(completions, 0) AS BIGINT) AS completions,
    CAST(coalesce(revenue_micros, 0) AS BIGINT) AS revenue_micros,
    event_date, campaign_id, market, platform, break_type
  FROM req
  FULL JOIN imp USING (event_date, campaign_id, market, platform, break_type)
  FULL JOIN clk USING (event_date, campaign_id, market, platform, break_type)
  FULL JOIN err USING (event_date, campaign_id, market, platform, break_type)
  FULL JOIN q100 USING (event_date, campaign_id, market, platform, break_type)
)""",
    f"""SELECT event_date, campaign_id, market, platform, break_type,
  requests, impressions, clicks, errors, completions, revenue_micros,{CAMPAIGN_RATES}
FROM joined""",
)

ORACLE["campaign_daily_raw_rates"] = _with(
    GOLD_SILVER,
    """SELECT event_date, campaign_id, market, platform, break_type,
  CAST(count_if(event_type = 'ad_request') AS BIGINT) AS requests,
  CAST(count_if(event_type = 'ad_impression') AS BIGINT) AS impressions,
  CAST(count_if(event_type = 'ad_click') AS BIGINT) AS clicks,
  CAST(coalesce(sum(CASE WHEN event_type = 'ad_impression' THEN clearing_price_micros ELSE 0 END), 0) AS BIGINT)
    AS revenue_micros,
  CASE WHEN count_if(event_type = 'ad_request') > 0
       THEN CAST(count_if(event_type = 'ad_impression') AS DOUBLE) / count_if(event_type = 'ad_request') END
    AS fill_rate,
  CASE WHEN count_if(event_type = 'ad_impression') > 0
       THEN CAST(coalesce(sum(CASE WHEN event_type = 'ad_impression' THEN clearing_price_micros ELSE 0 END), 0)
                 AS DOUBLE) / 1e6 / count_if(event_type = 'ad_impression') * 1000.0 END AS ecpm
FROM silver
GROUP BY 1, 2, 3, 4, 5""",
)

ORACLE["pod_fill"] = _with(POD_FILL_CTE, "SELECT * FROM pod_fill")


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


# ---------------------------------------------------------------------------
# Landing: request beacons as JSON lines with one defect per `e % 40`.
# The expected class of each defect is known by construction (FIXTURES §4).
# ---------------------------------------------------------------------------
def _landing_oracle() -> None:
    from slotwise.sources.fixtures import DEFECT_MODULUS, DEFECT_OUTCOME, DEFECTS

    ts = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"
    base = (
        "'{\"event_id\":\"bcn-req-' || CAST(e AS VARCHAR) || '\",\"event_type\":\"ad_request\",\"event_ts\":\"' || "
        + ts
        + " || '\",\"ingest_ts\":\"' || "
        + ts
        + " || '\",\"session_id\":\"sess_' || CAST(u AS VARCHAR) || '\",\"content_id\":\"cnt_' || CAST(p % 40 AS VARCHAR)"
        " || '\",\"pod_id\":\"pod_' || CAST(p AS VARCHAR) || '\",\"slot_index\":' || CAST(e % 3 AS VARCHAR)"
        " || ',\"break_type\":\"' || break_type || '\",\"platform\":\"' || platform || '\",\"market\":\"' || market"
        " || '\",\"campaign_id\":\"cmp_' || CAST(p % 7 AS VARCHAR) || '\",\"creative_id\":null,\"advertiser_id\":null,"
        "\"quartile\":null,\"error_code\":null,\"bid_floor_micros\":' || CAST(floor_micros AS VARCHAR)"
        " || ',\"clearing_price_micros\":null,\"is_late\":false}'"
    )

    def lit(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def scalar(key: str) -> str:
        return lit(f'"{key}":("[^"]*"|null|true|false|-?[0-9.eE+]+)')

    def apply(defect) -> str:
        form, arg = defect
        if form == "cut_last_char":
            return "substring(base, 1, length(base) - 1)"
        if form == "whole_line":
            return lit(arg)
        if form == "replace":
            return f"replace(base, {lit(arg[0])}, {lit(arg[1])})"
        if form == "drop_key":
            return f"regexp_replace(base, ',' || {scalar(arg)}, '')"
        if form == "extra_key":
            return f"substring(base, 1, length(base) - 1) || {lit(',' + arg + '}')}"
        key, val = arg
        return f"regexp_replace(base, {scalar(key)}, {lit(f'\"{key}\":' + val)})"

    line_case = "CASE d " + " ".join(f"WHEN {i} THEN {apply(x)}" for i, x in enumerate(DEFECTS)) + " ELSE base END"
    blank = [i for i, o in enumerate(DEFECT_OUTCOME) if o is None]
    status_case = (
        "CASE d "
        + " ".join(f"WHEN {i} THEN {lit(o[0])}" for i, o in enumerate(DEFECT_OUTCOME) if o is not None)
        + " ELSE 'ok' END"
    )
    error_case = (
        "CASE d "
        + " ".join(f"WHEN {i} THEN {lit(o[1])}" for i, o in enumerate(DEFECT_OUTCOME) if o is not None and o[1])
        + " END"
    )
    cte = SLOTS_CTE + f""",
l0 AS (SELECT e, CAST(event_ts AS DATE) AS dt, e % {DEFECT_MODULUS} AS d, {base} AS base FROM slots),
lines AS (
  SELECT e, dt, d, {line_case} AS raw, {status_case} AS status, {error_case} AS error
  FROM l0 WHERE d NOT IN ({", ".join(str(i) for i in blank)})
)"""
    ORACLE["land_classify"] = _with(cte, "SELECT e, status, error FROM lines")
    ORACLE["land_counts"] = _with(
        cte,
        """SELECT dt, CAST(count_if(status = 'ok') AS BIGINT) AS n_ok, CAST(count_if(status = 'bad') AS BIGINT) AS n_bad
FROM lines GROUP BY dt""",
    )
    bad = "status = 'bad' OR raw LIKE '%\"event_ts\":\"garbage\"%'"
    ORACLE["land_report"] = _with(
        cte,
        f"""SELECT 'drop-' || CAST(e % 4 AS VARCHAR) AS src, CAST(count_if(NOT ({bad})) AS BIGINT) AS n_ok,
  CAST(count_if({bad}) AS BIGINT) AS n_bad,
  CAST(count_if(NOT ({bad}) AND raw NOT LIKE '%"ingest_ts"%') AS BIGINT) AS n_stamped FROM lines GROUP BY 1""",
    )
    ORACLE["quarantine_rows"] = _with(cte, "SELECT e, raw, error, dt FROM lines WHERE status = 'bad'")
    ORACLE["land_written"] = _with(
        cte,
        """SELECT dt, 'drop-' || CAST(e % 4 AS VARCHAR) AS src, status, error, raw FROM lines
WHERE NOT (e % 4 = 1 AND status = 'bad')""",
    )
    ORACLE["stream_landing"] = _with(cte, "SELECT dt, status, error, raw FROM lines")
    ORACLE["drop_records"] = _with(
        cte,
        """SELECT json_extract_string(raw, '$.event_id') AS event_id, json_extract_string(raw, '$.market') AS market,
  json_extract_string(raw, '$.event_type') AS event_type, CAST(NULL AS VARCHAR) AS rejected
FROM lines WHERE error IS DISTINCT FROM 'V1'
UNION ALL SELECT NULL, NULL, NULL, raw FROM lines WHERE error = 'V1'""",
    )


_landing_oracle()


# ---------------------------------------------------------------------------
# Reads, reports, analysis questions, publishing, quality
# ---------------------------------------------------------------------------
MARTS_CTE = CAMPAIGN_DAILY_CTE + POD_FILL_CTE.removeprefix(GOLD_SILVER)

CAMPAIGN_ORDER = (
    "event_date DESC NULLS LAST, revenue_micros DESC NULLS LAST, campaign_id ASC NULLS FIRST, "
    "market ASC NULLS FIRST, platform ASC NULLS FIRST, break_type ASC NULLS FIRST"
)
POD_ORDER = (
    "event_date DESC NULLS LAST, requests DESC NULLS LAST, pod_id ASC NULLS FIRST, break_type ASC NULLS FIRST, "
    "content_id ASC NULLS FIRST, platform ASC NULLS FIRST, market ASC NULLS FIRST"
)

SUMMARY_SELECT = """SELECT event_date AS ds,
  CAST(sum(requests) AS BIGINT) AS requests,
  CAST(sum(impressions) AS BIGINT) AS impressions,
  CAST(sum(clicks) AS BIGINT) AS clicks,
  CAST(sum(revenue_micros) AS DOUBLE) / 1000000 AS revenue,
  """ + hu("sum(impressions)", "greatest(sum(requests), 1)", 4) + """ AS fill_rate,
  CAST(count(DISTINCT campaign_id) AS BIGINT) AS campaigns
FROM campaign_daily GROUP BY event_date"""


def fixed_sql(x: str, decimals: int, shift: int = 0) -> str:
    """Half-up fixed-decimal text from the value at 6 stored decimals (integer math)."""
    drop = 6 - shift - decimals
    step, unit = 10**drop, 10**decimals
    n = f"CAST(round(({x}) * 1000000) AS BIGINT)"
    q = f"((abs({n}) + {step // 2}) // {step})" if drop else f"abs({n})"
    text = f"CAST({q} // {unit} AS VARCHAR) || '.' || lpad(CAST({q} % {unit} AS VARCHAR), {decimals}, '0')"
    return f"(CASE WHEN {n} < 0 THEN '-' || {text} ELSE {text} END)"


def pct_sql(x: str) -> str:
    return f"coalesce({fixed_sql(x, 1, 2)} || '%', '—')"


def num_sql(x: str, d: int) -> str:
    return f"coalesce({fixed_sql(x, d)}, '—')"


ORACLE["campaigns_top"] = _with(MARTS_CTE, f"SELECT * FROM campaign_daily ORDER BY {CAMPAIGN_ORDER} LIMIT 100")
ORACLE["campaigns_top_filtered"] = _with(
    MARTS_CTE,
    f"SELECT * FROM campaign_daily WHERE campaign_id = 'cmp_3' AND market = 'IN' ORDER BY {CAMPAIGN_ORDER} LIMIT 50",
)
ORACLE["pods_top"] = _with(MARTS_CTE, f"SELECT * FROM pod_fill ORDER BY {POD_ORDER} LIMIT 100")
ORACLE["pods_top_midroll"] = _with(
    MARTS_CTE, f"SELECT * FROM pod_fill WHERE break_type = 'midroll' ORDER BY {POD_ORDER} LIMIT 200"
)
ORACLE["day_summary"] = _with(MARTS_CTE, SUMMARY_SELECT)
ORACLE["report_cards"] = _with(
    MARTS_CTE + f""",
summary AS ({SUMMARY_SELECT})""",
    f"""SELECT ds, 1 AS position, 'Day' AS label, CAST(ds AS VARCHAR) AS value FROM summary
UNION ALL SELECT ds, 2, 'Requests', CAST(requests AS VARCHAR) FROM summary
UNION ALL SELECT ds, 3, 'Impressions', CAST(impressions AS VARCHAR) FROM summary
UNION ALL SELECT ds, 4, 'Fill rate', {pct_sql('fill_rate')} FROM summary
UNION ALL SELECT ds, 5, 'Clicks', CAST(clicks AS VARCHAR) FROM summary
UNION ALL SELECT ds, 6, 'Revenue', {num_sql('revenue', 3)} FROM summary""",
)
ORACLE["report_campaigns"] = _with(
    MARTS_CTE,
    f"""SELECT CAST(event_date AS VARCHAR) AS event_date, campaign_id, market, platform, break_type,
  requests, impressions, {pct_sql('fill_rate')} AS fill_rate, {num_sql('ecpm', 2)} AS ecpm,
  {num_sql('revenue', 3)} AS revenue
FROM campaign_daily ORDER BY {CAMPAIGN_ORDER} LIMIT 25""",
)
ORACLE["report_pods"] = _with(
    MARTS_CTE,
    f"""SELECT CAST(event_date AS VARCHAR) AS event_date, substring(pod_id, 1, 14) AS pod, break_type, platform,
  market, requests, impressions, CASE WHEN filled <> 0 THEN 'yes' ELSE 'no' END AS filled,
  {pct_sql('pod_fill_rate')} AS pod_fill_rate
FROM pod_fill ORDER BY {POD_ORDER} LIMIT 20""",
)
ORACLE["fill_by_slice"] = _with(
    MARTS_CTE,
    """SELECT event_date, campaign_id, platform, market,
  CAST(sum(requests) AS BIGINT) AS requests, CAST(sum(impressions) AS BIGINT) AS impressions,
  CAST(sum(revenue_micros) AS BIGINT) AS revenue_micros,
  """ + rate("sum(impressions)", "sum(requests)") + """ AS fill_rate,
  """ + rate("sum(revenue_micros)", "sum(impressions) * 1000", 4) + """ AS ecpm
FROM campaign_daily GROUP BY event_date, campaign_id, platform, market""",
)
ORACLE["midroll_break_rate"] = _with(
    MARTS_CTE,
    """SELECT event_date, CAST(count(*) AS BIGINT) AS pods,
  CAST(count_if(requests > 0 AND impressions = 0) AS BIGINT) AS broken_pods,
  """ + rate("count_if(filled = 0)", "count(*)") + """ AS break_rate
FROM pod_fill WHERE break_type = 'midroll' GROUP BY event_date""",
)
ORACLE["midroll_broken_pods"] = _with(
    MARTS_CTE, "SELECT * FROM pod_fill WHERE break_type = 'midroll' AND requests > 0 AND impressions = 0"
)
ORACLE["completion_reconcile"] = _with(
    GOLD_SILVER
    + """,
imp AS (SELECT session_id, pod_id, slot_index, min(event_date) AS d FROM silver
        WHERE event_type = 'ad_impression' GROUP BY ALL),
done AS (SELECT session_id, pod_id, slot_index, min(event_date) AS d FROM silver
         WHERE event_type = 'ad_quartile' AND quartile = 100 GROUP BY ALL),
slots_j AS (
  SELECT least(imp.d, done.d) AS event_date, imp.d IS NOT NULL AS has_imp, done.d IS NOT NULL AS has_done
  FROM imp FULL JOIN done
    ON imp.session_id = done.session_id AND imp.pod_id = done.pod_id AND imp.slot_index = done.slot_index
)""",
    """SELECT event_date,
  CAST(count_if(has_imp AND has_done) AS BIGINT) AS both,
  CAST(count_if(NOT has_imp AND has_done) AS BIGINT) AS completion_only,
  CAST(count_if(has_imp AND NOT has_done) AS BIGINT) AS impression_only
FROM slots_j GROUP BY event_date""",
)
ORACLE["publish_payload"] = _with(
    GOLD_SILVER,
    """SELECT event_id AS key, event_id, event_type, event_ts, campaign_id, quartile, clearing_price_micros, is_late,
  19 AS n_keys FROM silver""",
)

GATE_CTE = (
    silver_cte("dt, event_id").replace("silver AS (", "silver_dt AS (", 1)
    + """,
ranked_all AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY """
    + WINNER_ORDER
    + """) AS rn_all FROM typed
),
silver AS (SELECT * FROM ranked_all WHERE rn_all = 1 AND event_type IN """
    + EVENT_TYPES_SQL
    + """),
campaign_daily AS (
  SELECT event_date, campaign_id, market, platform, break_type,
    CAST(count_if(event_type = 'ad_request') AS BIGINT) AS requests,
    CAST(count_if(event_type = 'ad_impression') AS BIGINT) AS impressions,
    CAST(coalesce(sum(CASE WHEN event_type = 'ad_impression' THEN clearing_price_micros END), 0) AS BIGINT) AS revenue_micros
  FROM silver GROUP BY 1, 2, 3, 4, 5
),
camp AS (
  SELECT *, """ + rate("impressions", "requests") + """ AS fill_rate
  FROM campaign_daily
),
s_day AS (
  SELECT dt AS ds, count(*) AS silver_rows, count_if(event_type = 'ad_request') AS requests,
    count_if(event_type = 'ad_impression') AS impressions
  FROM silver_dt GROUP BY dt
),
g0 AS (
  SELECT event_date AS ds, count(*) AS gold_rows, count_if(revenue_micros < 0) AS neg,
    sum(CAST(round(fill_rate * 1000000) AS BIGINT)) AS fs, count(fill_rate) AS fn
  FROM camp GROUP BY event_date
),
g_day AS (
  SELECT ds, gold_rows, neg,
    CASE WHEN fn > 0 THEN CAST((CAST(fs AS BIGINT) * 2 + fn) // (fn * 2) AS DOUBLE) / 1000000 END AS fill
  FROM g0
),
day AS (
  SELECT coalesce(s_day.ds, g_day.ds) AS ds, coalesce(silver_rows, 0) AS n, coalesce(requests, 0) AS req,
    coalesce(impressions, 0) AS imp, coalesce(gold_rows, 0) AS g, coalesce(neg, 0) AS neg, fill
  FROM s_day FULL JOIN g_day ON s_day.ds = g_day.ds
),
checks AS (
  SELECT ds, 1 AS check_no, 'silver_exists' AS "check", 'error' AS severity, CAST(n AS DOUBLE) AS observed,
    '>= 1' AS threshold, n > 0 AS passed, 'no silver rows arrived on ' || CAST(ds AS VARCHAR) AS msg FROM day
  UNION ALL SELECT ds, 2, 'silver_min_rows', 'error', n, '>= 50', n >= 50,
    'only ' || CAST(n AS VARCHAR) || ' silver rows arrived on ' || CAST(ds AS VARCHAR) FROM day
  UNION ALL SELECT ds, 3, 'requests_present', 'error', req, '> 0', req > 0, 'day holds no ad requests' FROM day
  UNION ALL SELECT ds, 4, 'impressions_vs_requests', 'error', imp, '<= requests * 1.15', imp <= req * 1.15,
    CAST(imp AS VARCHAR) || ' impressions against ' || CAST(req AS VARCHAR) || ' requests' FROM day
  UNION ALL SELECT ds, 5, 'gold_rows_for_day', 'error', g, '> 0', g > 0,
    'campaign mart has no rows dated ' || CAST(ds AS VARCHAR) FROM day
  UNION ALL SELECT ds, 6, 'no_negative_revenue', 'error', neg, '= 0', neg = 0, 'campaign mart holds negative revenue'
    FROM day
  UNION ALL SELECT ds, 7, 'mean_fill_rate_band', 'error', fill, '[0.2, 0.99]',
    fill IS NULL OR (fill BETWEEN 0.2 AND 0.99), 'mean fill rate out of bounds: ' || """
    + num_sql("fill", 3)
    + """ FROM day
  UNION ALL SELECT ds, 12, 'mean_fill_rate_soft_band', 'warn', fill, '[0.55, 0.95]',
    fill IS NULL OR (fill BETWEEN 0.55 AND 0.95),
    'mean fill rate ' || """
    + num_sql("fill", 3)
    + """ || ' lies outside the usual band' FROM day
)"""
)
ORACLE["gate_report"] = _with(
    GATE_CTE,
    """SELECT ds, check_no, "check", severity, round(observed, 6) AS observed, threshold, passed,
  CASE WHEN NOT passed THEN msg END AS message FROM checks""",
)
ORACLE["gate_verdicts"] = _with(
    GATE_CTE,
    """SELECT ds, bool_and(passed) AS passed, arg_min(CASE WHEN NOT passed THEN msg END,
  CASE WHEN NOT passed THEN check_no END) AS message
FROM checks WHERE severity = 'error' GROUP BY ds""",
)
ORACLE["not_null_report"] = _with(
    MARTS_CTE,
    """SELECT 'fct_campaign_daily' AS "table", 'not_null(event_date)' AS "check",
  CAST(count_if(event_date IS NULL) AS BIGINT) AS failures FROM campaign_daily
UNION ALL SELECT 'fct_campaign_daily', 'not_null(campaign_id)', count_if(campaign_id IS NULL) FROM campaign_daily
UNION ALL SELECT 'fct_campaign_daily', 'revenue_micros >= 0', count_if(revenue_micros < 0) FROM campaign_daily
UNION ALL SELECT 'fct_campaign_daily', 'sum(requests) > 0', CASE WHEN sum(requests) > 0 THEN 0 ELSE 1 END
  FROM campaign_daily
UNION ALL SELECT 'fct_campaign_daily', 'sum(impressions) > 0', CASE WHEN sum(impressions) > 0 THEN 0 ELSE 1 END
  FROM campaign_daily
UNION ALL SELECT 'fct_campaign_daily', '0 <= fill_rate <= 1.15',
  count_if(requests > 0 AND NOT (fill_rate BETWEEN 0 AND 1.15)) FROM campaign_daily
UNION ALL SELECT 'fct_pod_fill', 'not_null(pod_id)', count_if(pod_id IS NULL) FROM pod_fill
UNION ALL SELECT 'fct_pod_fill', 'not_null(filled)', count_if(filled IS NULL) FROM pod_fill
UNION ALL SELECT 'silver', 'unique(event_id)', coalesce(sum(n - 1), 0)
  FROM (SELECT event_id, count(*) AS n FROM silver GROUP BY event_id HAVING count(*) > 1)
UNION ALL SELECT 'silver', 'event_type in contract', count_if(event_type NOT IN """
    + EVENT_TYPES_SQL
    + """) FROM silver""",
)
ORACLE["not_null_report"] = (
    "SELECT \"table\", \"check\", CAST(failures AS BIGINT) AS failures, failures = 0 AS passed FROM ("
    + ORACLE["not_null_report"]
    + ")"
)


# written-table queries: the full rebuild / the per-dt silver, read back
ORACLE["staging_projection"] = _with(silver_cte("dt, event_id"), f"SELECT {SILVER_COLS} FROM silver")
ORACLE["latest_partition"] = _with(silver_cte("dt, event_id"), "SELECT max(dt) AS latest_dt FROM silver")
ORACLE["gold_replace_day"] = ORACLE["campaign_daily"]
ORACLE["gold_refresh_touched"] = ORACLE["pod_fill"]
# the newest arrival day with more than late copies, delivered again with corrections
ORACLE["gold_corrected_day"] = ORACLE["campaign_daily"].replace(
    "beacons AS (SELECT *, CAST(ingest_ts AS DATE) AS dt FROM b0)",
    """b1 AS (SELECT *, CAST(ingest_ts AS DATE) AS dt FROM b0),
b2 AS (SELECT *, dt = (SELECT max(dt) FROM b1 WHERE NOT is_late) AS newest FROM b1),
beacons AS (
  SELECT * EXCLUDE (newest) REPLACE (
    clearing_price_micros + CASE WHEN newest THEN 700 ELSE 0 END AS clearing_price_micros,
    CASE WHEN newest AND CAST(regexp_extract(event_id, '([0-9]+)$', 1) AS BIGINT) % 40 = 0
         THEN event_ts - INTERVAL 1 DAY ELSE event_ts END AS event_ts)
  FROM b2 WHERE NOT (newest AND is_late)
)""",
)
_VERDICTS = """SELECT ds, bool_and(passed) AS passed, arg_min(CASE WHEN NOT passed THEN msg END,
  CASE WHEN NOT passed THEN check_no END) AS message
FROM checks WHERE severity = 'error' GROUP BY ds"""
ORACLE["day_flow_gate"] = _with(
    GATE_CTE.replace(
        "FROM s_day FULL JOIN g_day ON s_day.ds = g_day.ds",
        "FROM (SELECT DISTINCT dt AS ds FROM silver_dt UNION SELECT CAST(max(dt) + INTERVAL 7 DAY AS DATE) FROM silver_dt) w"
        " LEFT JOIN s_day ON s_day.ds = w.ds LEFT JOIN g_day ON g_day.ds = w.ds",
    ).replace("SELECT coalesce(s_day.ds, g_day.ds) AS ds", "SELECT w.ds AS ds"),
    _VERDICTS,
)

# streaming: the same rows as the batch rules
ORACLE["stream_dedup_lww"] = _with(
    GOLD_SILVER, f"SELECT {SILVER_COLS}, (ingest_ts - event_ts) > INTERVAL 36 HOUR AS too_late FROM silver"
)
ORACLE["stream_daily_counts"] = _with(
    GOLD_SILVER,
    """SELECT event_date, campaign_id, market, platform, break_type,
  CAST(count_if(event_type = 'ad_request') AS BIGINT) AS requests,
  CAST(count_if(event_type = 'ad_impression') AS BIGINT) AS impressions,
  CAST(count_if(event_type = 'ad_click') AS BIGINT) AS clicks,
  CAST(count_if(event_type = 'ad_error') AS BIGINT) AS errors,
  CAST(count_if(event_type = 'ad_quartile' AND quartile = 100) AS BIGINT) AS completions
FROM silver GROUP BY 1, 2, 3, 4, 5""",
)

ORACLE["silver_sql"] = _with(GOLD_SILVER, f"SELECT {SILVER_COLS} FROM silver")
ORACLE["full_refresh"] = ORACLE["gold_corrected_day"]

ORACLE["report_snapshot_rows"] = _with(
    MARTS_CTE
    + f""",
c AS (
  SELECT event_date, 'campaign' AS section,
    ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY revenue_micros DESC, campaign_id ASC NULLS FIRST,
      market ASC NULLS FIRST, platform ASC NULLS FIRST, break_type ASC NULLS FIRST) AS rank,
    concat_ws('|', campaign_id, market, platform, break_type) AS item, revenue_micros AS measure
  FROM campaign_daily
),
p AS (
  SELECT event_date, 'pod' AS section,
    ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY requests DESC, pod_id ASC NULLS FIRST,
      break_type ASC NULLS FIRST, content_id ASC NULLS FIRST, platform ASC NULLS FIRST, market ASC NULLS FIRST)
      AS rank,
    concat_ws('|', pod_id, break_type, content_id, platform, market) AS item, requests AS measure
  FROM pod_fill
)""",
    """SELECT event_date, section, CAST(rank AS BIGINT) AS rank, item, measure FROM c WHERE rank <= 40
UNION ALL SELECT event_date, section, CAST(rank AS BIGINT) AS rank, item, measure FROM p WHERE rank <= 30""",
)


# ---------------------------------------------------------------------------
# Variations of the beacons: the rows that a rule needs, written as SQL over the plain ones
# ---------------------------------------------------------------------------
_ARRIVED = "beacons AS (SELECT *, CAST(ingest_ts AS DATE) AS dt FROM b0)"
_NO = "CAST(regexp_extract(event_id, '([0-9]+)$', 1) AS BIGINT)"


def varied(sql: str, select: str) -> str:
    """A query over other beacons: ``select`` reads the plain ones from ``b1`` (with ``dt`` and the slot number ``no``)."""
    return sql.replace(_ARRIVED, f"b1 AS (SELECT *, CAST(ingest_ts AS DATE) AS dt, {_NO} AS no FROM b0),\nbeacons AS ({select})", 1)


STRAGGLERS = """SELECT * EXCLUDE (no) FROM b1
  UNION ALL SELECT * EXCLUDE (no) REPLACE (event_ts + INTERVAL 40 HOUR AS ingest_ts, clearing_price_micros + 900 AS clearing_price_micros,
    true AS is_late, CAST(event_ts + INTERVAL 40 HOUR AS DATE) AS dt)
  FROM b1 WHERE event_type = 'ad_impression' AND NOT is_late AND no % 120 = 60"""
MOVED = """SELECT * EXCLUDE (no) FROM b1
  UNION ALL SELECT * EXCLUDE (no) REPLACE (event_ts - INTERVAL 1 DAY AS event_ts, ingest_ts + INTERVAL 20 HOUR AS ingest_ts,
    clearing_price_micros + 300 AS clearing_price_micros, CAST(ingest_ts + INTERVAL 20 HOUR AS DATE) AS dt)
  FROM b1 WHERE event_type = 'ad_impression' AND NOT is_late AND no % 90 = 7"""
ODD_DAYS = """SELECT * EXCLUDE (no) REPLACE (CASE WHEN day(event_ts) = 4 THEN -clearing_price_micros ELSE clearing_price_micros END AS clearing_price_micros)
  FROM b1 WHERE NOT (day(event_ts) = 6 AND event_type = 'ad_request')
    AND NOT (day(event_ts) = 10 AND event_type = 'ad_impression' AND no % 20 <> 0)
  UNION ALL SELECT * EXCLUDE (no) REPLACE ('x' || event_id AS event_id) FROM b1 WHERE day(event_ts) = 8 AND event_type = 'ad_impression'"""
GAPS = """SELECT * EXCLUDE (no) REPLACE (
    CASE WHEN event_type = 'ad_quartile' AND quartile < 100 AND no % 13 = 5 THEN 'cmp_quiet_' || CAST(no % 3 AS VARCHAR) ELSE campaign_id END AS campaign_id,
    CASE WHEN no % 17 <> 4 THEN market END AS market) FROM b1"""
AS_TEXT = """SELECT * EXCLUDE (no) REPLACE (
    CASE WHEN no % 4 = 0 THEN 0 ELSE slot_index END AS slot_index,
    CASE WHEN clearing_price_micros IS NULL OR no % 5 IN (2, 3) THEN NULL WHEN no % 5 = 0 THEN 9007199254740993 ELSE clearing_price_micros END AS clearing_price_micros,
    CASE WHEN quartile = 25 AND no % 11 = 0 THEN 'ad_heartbeat' ELSE event_type END AS event_type) FROM b1"""
TWO_DAYS = f"SELECT * FROM ({ODD_DAYS}) WHERE day(dt) IN (5, 6)"
RAISED = """SELECT * EXCLUDE (no) REPLACE (clearing_price_micros + 700 AS clearing_price_micros) FROM b1
  WHERE NOT (event_type = 'ad_request' AND day(event_ts) = 6)"""

ORACLE["unmatched_slots"] = _with(
    GOLD_SILVER
    + """,
imp AS (SELECT session_id, pod_id, slot_index, min(event_date) AS event_date, count(*) AS beacons FROM silver
        WHERE event_type = 'ad_impression' GROUP BY ALL),
done AS (SELECT session_id, pod_id, slot_index, min(event_date) AS event_date, count(*) AS beacons FROM silver
         WHERE event_type = 'ad_quartile' AND quartile = 100 GROUP BY ALL)""",
    """SELECT session_id, pod_id, slot_index, 'impression_only' AS side, event_date, beacons
FROM imp ANTI JOIN done USING (session_id, pod_id, slot_index)
UNION ALL SELECT session_id, pod_id, slot_index, 'completion_only', event_date, beacons
FROM done ANTI JOIN imp USING (session_id, pod_id, slot_index)""",
)
ORACLE["campaign_daily_joined"] = varied(ORACLE["campaign_daily"], GAPS) + """
WHERE greatest(requests, impressions, clicks, errors, completions) > 0 AND market IS NOT NULL"""
ORACLE["silver_text"] = varied(_with(GOLD_SILVER, f"SELECT {SILVER_COLS} FROM silver"), AS_TEXT)
ORACLE["silver_text_sql"] = ORACLE["silver_text"]
ORACLE["gate_odd_days"] = varied(ORACLE["gate_report"], ODD_DAYS)
ORACLE["day_gate_observed"] = varied(ORACLE["gate_report"], TWO_DAYS) + " WHERE day(ds) IN (5, 6)"
ORACLE["moved_events"] = varied(
    _with(
        silver_cte("dt, event_id"),
        """SELECT event_id, event_date, dt FROM silver
WHERE event_id IN (SELECT event_id FROM silver GROUP BY event_id HAVING min(event_date) <> max(event_date))""",
    ),
    MOVED,
)
_PASSED = f"(SELECT ds FROM ({varied(ORACLE['gate_verdicts'], RAISED)}) WHERE passed)"
ORACLE["backfill_gated"] = f"""SELECT * FROM ({varied(ORACLE["campaign_daily"], RAISED)}) WHERE event_date IN {_PASSED}
UNION ALL SELECT * FROM ({ORACLE["campaign_daily"]}) WHERE event_date NOT IN {_PASSED}"""

# reads of the written marts with a day: the newest one
_NEWEST = "event_date = (SELECT max(event_date) FROM campaign_daily)"
ORACLE["written_campaigns_day"] = _with(
    MARTS_CTE, f"SELECT * FROM campaign_daily WHERE {_NEWEST} AND campaign_id = 'cmp_3' ORDER BY {CAMPAIGN_ORDER} LIMIT 100"
)
ORACLE["written_pods_day"] = _with(
    MARTS_CTE, f"SELECT * FROM pod_fill WHERE {_NEWEST} AND break_type = 'midroll' ORDER BY {POD_ORDER} LIMIT 100"
)
ORACLE["written_day_summary"] = _with(
    MARTS_CTE + f",\nsummary AS ({SUMMARY_SELECT})",
    """SELECT *, '{"ds":"' || CAST(ds AS VARCHAR) || '","requests":' || CAST(requests AS VARCHAR) || ',"impressions":'
  || CAST(impressions AS VARCHAR) || ',"clicks":' || CAST(clicks AS VARCHAR) || ',"campaigns":' || CAST(campaigns AS VARCHAR) || '}' AS record
FROM summary WHERE ds = (SELECT max(ds) FROM summary)""",
)
ORACLE["health"] = """SELECT t AS "table", s AS stage, s = 'built' AND (SELECT count(*) FROM events) > 0 AS available
FROM (VALUES ('campaign_daily'), ('pod_fill')) a(t), (VALUES ('empty'), ('built')) b(s)"""

# streaming with state
ORACLE["stream_lww_state"] = ORACLE["stream_dedup_lww"]
ORACLE["stream_closed_days"] = (
    ORACLE["stream_daily_counts"].replace("FROM silver GROUP BY", "FROM silver\nWHERE event_date + INTERVAL 1 DAY <= (SELECT max(event_ts) - INTERVAL 36 HOUR FROM beacons) GROUP BY")
)
ORACLE["stream_late_split"] = varied(
    _with(
        BEACONS_CTE,
        """SELECT event_id, CAST(event_ts AS DATE) AS event_date, ingest_ts, is_late, clearing_price_micros,
  CASE WHEN ingest_ts - event_ts > INTERVAL 36 HOUR THEN 'too_late' ELSE 'on_time' END AS side FROM beacons""",
    ),
    STRAGGLERS,
)
ORACLE["topic_landing"] = ORACLE["stream_landing"]


# R8 as text: amounts and rates are decimals of six places, so both engines print them alike
def _document(columns: str, rates: str) -> str:
    parts = [f"{c} := {c}" for c in columns.split()] + [f"{c} := CAST({c} AS DECIMAL(28, 6))" for c in rates.split()]
    return f"struct_pack({', '.join(parts)})"


ORACLE["report_snapshot"] = _with(
    MARTS_CTE
    + f""",
summary AS ({SUMMARY_SELECT}),
c AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY {CAMPAIGN_ORDER}) AS rank FROM campaign_daily),
p AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY event_date ORDER BY {POD_ORDER}) AS rank FROM pod_fill),
cs AS (SELECT event_date, list({_document("event_date campaign_id market platform break_type requests impressions clicks errors completions revenue_micros", "revenue fill_rate ctr completion_rate ecpm")} ORDER BY rank) AS campaigns
       FROM c WHERE rank <= 40 GROUP BY event_date),
ps AS (SELECT event_date, list({_document("event_date pod_id break_type content_id platform market requests impressions errors filled", "pod_fill_rate")} ORDER BY rank) AS pods
       FROM p WHERE rank <= 30 GROUP BY event_date)""",
    """SELECT ds AS event_date, CAST(to_json(struct_pack(
  summary := struct_pack(ds := CAST(ds AS VARCHAR), requests := requests, impressions := impressions, clicks := clicks,
    revenue := CAST(revenue AS DECIMAL(28, 6)), fill_rate := CAST(fill_rate AS DECIMAL(28, 6)), campaigns := summary.campaigns),
  campaigns := cs.campaigns, pods := ps.pods)) AS VARCHAR) AS payload
FROM summary LEFT JOIN cs ON cs.event_date = ds LEFT JOIN ps ON ps.event_date = ds""",
)
