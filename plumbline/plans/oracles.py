"""The registered queries as SQL for DuckDB, written independently of the DataFrame programs."""

from __future__ import annotations

TYPES = ["null_user", "extreme_amount", "negative_amount", "invalid_currency", "future_ts", "schema_drift"]
ROOT_CAUSES = {
    "null_user": "producer sent no user id or the message could not be decoded",
    "extreme_amount": "amount is above the accepted limit",
    "negative_amount": "amount is below zero",
    "invalid_currency": "currency is missing or not an accepted code",
    "future_ts": "event time lies after the processing time",
    "schema_drift": "payload keys differ from the expected set",
}
REMEDIES = {
    "null_user": "reject", "extreme_amount": "filter", "negative_amount": "reject or impute", "invalid_currency": "filter",
    "future_ts": "impute", "schema_drift": "alert_upstream",
}
ANOMALY_TASK = (
    "Explain the data-quality anomalies below. Group them by anomaly_type. Give for every group the ROOT CAUSE, the BUSINESS IMPACT "
    "(low, medium, high, critical), a remediation, example ids, and any pattern across records. Answer with one JSON object holding "
    "anomaly_groups, overall_pipeline_health, executive_summary and recommended_actions."
)

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

TXN = f"""txn AS (
  SELECT event_id AS n,
    'EVT-' || CAST(event_id AS VARCHAR) AS event_id,
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE 'USR-' || CAST(user_id AS VARCHAR) END AS user_id,
    'PRD-' || json_extract_string(props, '$.k') AS product_id,
    CASE WHEN event_id % 127 = 0 THEN NULL WHEN event_id % 89 = 0 THEN value + 50000 WHEN event_id % 83 = 0 THEN -value ELSE value END AS amount,
    CASE WHEN event_id % 113 = 0 THEN NULL WHEN event_id % 79 = 0 THEN 'XYZ' WHEN event_id % 13 = 0 THEN 'JPY' WHEN user_id % 5 IN (0, 4) THEN 'USD'
         WHEN user_id % 5 = 1 THEN 'GBP' ELSE 'EUR' END AS currency,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'purchase' WHEN event_type = 'error' THEN 'refund' ELSE 'cart_add' END AS event_type,
    CASE WHEN event_id % 109 = 0 THEN NULL WHEN event_id % 73 = 0 THEN TIMESTAMP '2099-01-01 00:00:00' ELSE CAST(ts AS TIMESTAMP) END AS event_ts,
    CASE user_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' ELSE 'CA' END AS country,
    CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'card' WHEN event_id % 3 = 1 THEN 'paypal' ELSE 'crypto' END AS payment_method,
    event_id % 71 = 0 AS drifted,
    CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'undecodable' WHEN event_id % 103 = 0 THEN 'amount_as_text'
         WHEN event_id % 107 = 0 THEN 'two_objects' END AS defect
  FROM events
), decoded AS (
  SELECT n, drifted, defect IS NOT NULL AND NOT (defect = 'amount_as_text' AND amount IS NULL) AS malformed, defect, event_type AS sent_type,
    CASE WHEN readable THEN event_id END AS event_id, CASE WHEN readable THEN user_id END AS user_id,
    CASE WHEN readable THEN product_id END AS product_id, CASE WHEN readable AND defect IS DISTINCT FROM 'amount_as_text' THEN amount END AS amount,
    CASE WHEN readable THEN currency END AS currency, CASE WHEN readable THEN event_type END AS event_type,
    CASE WHEN readable THEN event_ts END AS event_ts, CASE WHEN readable THEN country END AS country,
    CASE WHEN readable THEN payment_method END AS payment_method
  FROM (SELECT *, defect IS DISTINCT FROM 'undecodable' AS readable FROM txn)
), flags AS (
  SELECT *, CAST(event_ts AS DATE) AS date_part,
    user_id IS NULL AS flag_null_user,
    coalesce(amount > 10000, false) AS flag_extreme_amount,
    coalesce(amount < 0, false) AS flag_negative_amount,
    coalesce(currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CAD', 'AUD'), true) AS flag_invalid_currency,
    coalesce(event_ts > {AS_OF}, false) AS flag_future_ts,
    drifted OR malformed AS flag_schema_drift
  FROM decoded
), flagged AS (
  SELECT *,
    flag_null_user OR flag_extreme_amount OR flag_negative_amount OR flag_invalid_currency OR flag_future_ts OR flag_schema_drift AS is_anomaly,
    CAST(CAST(flag_null_user AS INT) + CAST(flag_extreme_amount AS INT) + CAST(flag_negative_amount AS INT)
       + CAST(flag_invalid_currency AS INT) + CAST(flag_future_ts AS INT) AS DOUBLE) AS anomaly_score
  FROM flags
)"""

TYPED = "typed AS (" + " UNION ALL ".join(
    f"SELECT *, '{name}' AS anomaly_type FROM flagged WHERE flag_{name}" for name in TYPES
) + ")"


def case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items()) + " END"


def impact(part: str, whole: str) -> str:
    ratio = f"(CAST({part} AS DOUBLE) / {whole})"
    return f"CASE WHEN {ratio} < 0.01 THEN 'low' WHEN {ratio} < 0.05 THEN 'medium' WHEN {ratio} < 0.2 THEN 'high' ELSE 'critical' END"


FLAG_LIST = ", ".join(f"flag_{name}" for name in TYPES)

RANKED = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date_part ORDER BY anomaly_score DESC, event_id NULLS FIRST) AS rank FROM flagged WHERE is_anomaly
)"""

HEALTH = """daily AS (
  SELECT date_part, count(*) FILTER (WHERE is_anomaly) AS anomaly_count,
    max(event_ts) FILTER (WHERE event_ts <= TIMESTAMP '2024-01-30 12:00:00') AS last_event_ts
  FROM flagged WHERE date_part IS NULL OR date_part <= DATE '2024-01-30' GROUP BY date_part
), aged AS (
  SELECT *, date_sub('minute', last_event_ts, least(TIMESTAMP '2024-01-30 12:00:00', CAST(date_part + 1 AS TIMESTAMP))) AS age_minutes FROM daily
), health AS (
  SELECT *, anomaly_count > 20 AS is_over, coalesce(age_minutes >= 10, true) AS is_stale,
    CASE WHEN anomaly_count > 20 AND coalesce(age_minutes >= 10, true) THEN 'critical'
         WHEN anomaly_count > 20 OR coalesce(age_minutes >= 10, true) THEN 'degraded' ELSE 'healthy' END AS pipeline_health
  FROM aged
)"""

# Column names and engine type names of the tables, for the catalog queries.
COLUMNS = {
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "labels": "doc_id bigint, quality int, toxic int",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}
FIELDS = {t: [tuple(c.split(" ")) for c in ddl.split(", ")] for t, ddl in COLUMNS.items()}


def union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def null_rates(relation: str, table: str, columns: list[str]) -> str:
    return union(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
        round(100 * CAST(count(*) - count({c}) AS DOUBLE) / count(*), 2) AS null_pct FROM {relation}"""
        for c in columns
    )


def document(table: str) -> str:
    names = [name for name, _ in FIELDS[table]]
    return f"""SELECT '{table}' AS table_name, 'warehouse/{table}' AS table_path, count(*) AS row_count,
      'TABLE: {table}' || chr(10) || 'DESCRIPTION: Table {table} with ' || CAST(count(*) AS VARCHAR) || ' rows and {len(names)} columns.' || chr(10)
      || 'COLUMNS: {", ".join(names)}' || chr(10) || 'ROW COUNT: ' || format('{{:,}}', count(*)) || chr(10) || 'PATH: warehouse/{table}' AS document
      FROM {table}"""


def described(table: str, version: int) -> str:
    text = f"'Table {table} with ' || CAST(count(*) AS VARCHAR) || ' rows and {len(FIELDS[table])} columns.'"
    if table == "orders":
        text = "'One row per order.'"
    return f"SELECT '{table}' AS table_name, count(*) AS row_count, {text} AS description, CAST({version} AS BIGINT) AS version FROM {table}"


ENRICHED = """points AS (
  SELECT *, TRY_CAST(regexp_extract(product_id, '^PRD-([0-9]+)$', 1) AS INT) AS k,
    coalesce((country, currency) NOT IN (('US', 'USD'), ('UK', 'GBP'), ('DE', 'EUR'), ('FR', 'EUR'), ('CA', 'USD')), true) AS geo_risk_flag
  FROM txn
), enriched AS (
  SELECT *,
    CASE WHEN amount IS NULL THEN 'unknown' WHEN pts >= 4 THEN 'high' WHEN pts >= 2 THEN 'medium' ELSE 'low' END AS fraud_risk,
    CASE WHEN event_type IS NULL THEN 'unknown' WHEN event_type = 'refund' THEN 'refund_request'
      WHEN event_type = 'purchase' AND k BETWEEN 90 AND 99 THEN 'subscription'
      WHEN event_type = 'purchase' AND amount < 20 THEN 'impulse_buy' ELSE 'planned_purchase' END AS customer_intent,
    CASE WHEN k BETWEEN 0 AND 24 THEN 'electronics' WHEN k BETWEEN 25 AND 49 THEN 'clothing' WHEN k BETWEEN 50 AND 74 THEN 'home'
      WHEN k BETWEEN 75 AND 99 THEN 'grocery' ELSE 'unknown' END AS product_category,
    CAST((amount IS NOT NULL)::INT + (country IS NOT NULL)::INT + (payment_method IS NOT NULL)::INT + (product_id IS NOT NULL)::INT AS DOUBLE) / 4 AS enrichment_confidence,
    concat_ws('; ', CASE WHEN amount > 200 THEN 'amount above 200' WHEN amount > 100 THEN 'amount above 100' END,
      CASE WHEN payment_method = 'crypto' THEN 'paid with crypto' WHEN payment_method IS NULL THEN 'no payment method' END,
      CASE WHEN geo_risk_flag THEN 'unusual country and currency' END) AS enrichment_reasoning
  FROM (SELECT *, CASE WHEN amount > 200 THEN 2 WHEN amount > 100 THEN 1 ELSE 0 END
      + CASE WHEN payment_method = 'crypto' THEN 2 WHEN payment_method IS NULL THEN 1 ELSE 0 END + geo_risk_flag::INT AS pts FROM points)
)"""
ENRICHED_COLUMNS = "event_id, fraud_risk, customer_intent, product_category, geo_risk_flag, enrichment_confidence, enrichment_reasoning"
ENRICH_SQL = f"WITH {TXN}, {ENRICHED} SELECT {ENRICHED_COLUMNS} FROM enriched"

CENTROIDS = """dims AS (
  SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS d, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings
), centers AS (
  SELECT label, list(m ORDER BY d) AS c FROM (SELECT label, d, avg(x) AS m FROM dims GROUP BY label, d) GROUP BY label
)"""


def vector_top(score: str, shown: str) -> str:
    return f"""WITH {CENTROIDS}, pairs AS (
          SELECT centers.label AS question_id, vec_id AS document_id, {score} AS score FROM centers, embeddings
        ), r AS (
          SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY round(score, 9) DESC, document_id) AS rank FROM pairs)
        SELECT question_id, document_id, CAST(rank AS INT) AS rank, {shown} FROM r WHERE rank <= 5"""


def tfidf(documents: str, questions: str) -> str:
    """The five best documents (doc_id, text) per question (item_id, text) as relation `r`."""
    split = r"unnest(string_split_regex(lower(text), '[^\p{L}]+'))"
    return f"""docs AS ({documents}), dt AS (
          SELECT doc_id, t AS term, count(*) AS tf FROM (SELECT doc_id, {split} AS t FROM docs) WHERE t <> '' GROUP BY doc_id, t
        ), qt AS (
          SELECT item_id, t AS term, count(*) AS tf FROM (SELECT item_id, {split} AS t FROM ({questions})) WHERE t <> '' GROUP BY item_id, t
        ), idf AS (
          SELECT term, ln((SELECT count(*) FROM docs) / CAST(count(*) AS DOUBLE)) AS idf FROM dt GROUP BY term
        ), dw AS (SELECT doc_id, term, tf * idf AS w FROM dt JOIN idf USING (term)
        ), qw AS (SELECT item_id, term, tf * idf AS w FROM qt JOIN idf USING (term)
        ), dn AS (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM dw GROUP BY doc_id
        ), qn AS (SELECT item_id, sqrt(sum(w * w)) AS norm FROM qw GROUP BY item_id
        ), dots AS (
          SELECT item_id, doc_id, sum(dw.w * qw.w) AS dot FROM dw JOIN qw USING (term) WHERE dw.w > 0 AND qw.w > 0 GROUP BY item_id, doc_id
        ), scored AS (
          SELECT item_id, doc_id, dot / (dn.norm * qn.norm) AS score FROM dots JOIN dn USING (doc_id) JOIN qn USING (item_id)
        ), r AS (
          SELECT item_id, doc_id, score, CAST(rank AS INT) AS rank FROM (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored) WHERE rank <= 5)"""


QUESTIONS = [
    (1, "Which table holds the price of an order?"),
    (2, "customer name, nation key and account balance"),
    (3, "Where are the embedding vectors and their label?"),
    (4, "tables with text of documents, pages or conversations"),
]

PAYLOADS = """payloads AS (
  SELECT *, CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 4) AS BIGINT) + 1 AS version,
    CASE user_id % 5 WHEN 0 THEN 'US' WHEN 1 THEN 'UK' WHEN 2 THEN 'DE' WHEN 3 THEN 'FR' ELSE 'CA' END AS country FROM events
), texts AS (
  SELECT version, ts, '{"event_id":"' || event_id || '"'
    || CASE WHEN version < 7 THEN ',"user_id":' || user_id ELSE '' END
    || ',"amount":' || CASE WHEN version < 5 THEN CAST(value AS VARCHAR) ELSE '"' || value || '"' END
    || ',"currency":' || CASE WHEN version >= 6 AND event_type = 'view' THEN 'null' ELSE '"EUR"' END
    || ',"quantity":' || json_extract_string(props, '$.k') || CASE WHEN version < 4 THEN '' ELSE '.5' END
    || CASE WHEN version >= 3 THEN ',"channel":"' || event_type || '"' ELSE '' END
    || CASE WHEN version < 8 THEN ',"country":"' ELSE ',"region":"' END || country || '"}' AS value
  FROM payloads
), cells AS (
  SELECT version, j.key AS name, CASE j.type WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double'
    WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN NULL ELSE lower(j.type) END AS kind
  FROM texts, json_each(CAST(texts.value AS JSON)) AS j
), totals AS (
  SELECT version, count(*) AS record_count, max(CAST(ts AS TIMESTAMP)) AS committed_at FROM texts GROUP BY version
), cols AS (
  SELECT version, name AS column_name, record_count, committed_at,
    CASE WHEN count(kind) = 0 THEN 'void' WHEN count(DISTINCT kind) = 1 THEN min(kind)
      WHEN count(*) FILTER (WHERE kind NOT IN ('bigint', 'double')) = 0 THEN 'double' ELSE 'string' END AS type,
    count(kind) < record_count AS nullable
  FROM cells JOIN totals USING (version) GROUP BY version, name, record_count, committed_at
), ordinals AS (
  SELECT version, row_number() OVER (ORDER BY version) AS o, lag(version) OVER (ORDER BY version) AS before FROM totals
), changed AS (
  SELECT o.before AS from_version, o.version AS to_version, coalesce(c.column_name, p.column_name) AS column_name,
    p.type AS p_type, c.type AS c_type, p.nullable AS p_null, c.nullable AS c_null
  FROM ordinals o
  JOIN (SELECT DISTINCT column_name FROM cols) n ON o.before IS NOT NULL
  LEFT JOIN cols c ON c.version = o.version AND c.column_name = n.column_name
  LEFT JOIN cols p ON p.version = o.before AND p.column_name = n.column_name
  WHERE c.column_name IS NOT NULL OR p.column_name IS NOT NULL
), changes AS (
  SELECT from_version, to_version, 'added' AS change, column_name, CAST(NULL AS VARCHAR) AS from_type, CAST(NULL AS VARCHAR) AS to_type FROM changed WHERE p_type IS NULL
  UNION ALL SELECT from_version, to_version, 'removed', column_name, NULL, NULL FROM changed WHERE c_type IS NULL
  UNION ALL SELECT from_version, to_version, 'type', column_name, p_type, c_type FROM changed WHERE p_type <> c_type
  UNION ALL SELECT from_version, to_version, 'nullability', column_name, NULL, NULL FROM changed WHERE p_null <> c_null
)"""

SNAPSHOT = """SELECT CAST({v} AS INT) AS version, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM orders {where} GROUP BY o_orderstatus"""
OLD_ORDERS = "WHERE o_orderdate < TIMESTAMP '2000-01-01'"

ORACLES: dict[str, str] = {
    "decode_events": f"""WITH {TXN}
        SELECT event_id, user_id, product_id, amount, currency, event_type, event_ts, country, payment_method, date_part,
          {AS_OF} AS ingest_ts, malformed, CAST(CASE defect WHEN 'undecodable' THEN 6 + length('EVT-' || n)
            WHEN 'two_objects' THEN 2 * json_chars + 1 WHEN 'amount_as_text' THEN CASE WHEN malformed THEN json_chars + 6 END END AS INT) AS raw_chars
        FROM flagged JOIN (SELECT n, length(CAST(to_json({{'event_id': event_id, 'user_id': user_id, 'product_id': product_id, 'amount': amount,
            'currency': currency, 'event_type': event_type, 'timestamp': coalesce(strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'), 'at noon'),
            'country': country, 'payment_method': payment_method}}) AS VARCHAR)) AS json_chars FROM txn) USING (n)""",
    "payload_key_drift": f"""WITH {TXN}
        SELECT event_id, 'unexpected_field' AS unexpected, 'payment_method' AS missing FROM flagged WHERE drifted""",
    "quality_flags": f"WITH {TXN} SELECT event_id, {FLAG_LIST}, is_anomaly, anomaly_score FROM flagged",
    "clean_events": f"WITH {TXN} SELECT event_id, user_id, amount, currency, date_part FROM flagged WHERE NOT is_anomaly",
    "anomaly_events": f"WITH {TXN} SELECT event_id, user_id, amount, currency, date_part, anomaly_score FROM flagged WHERE is_anomaly",
    "rules_on_customer": """WITH f AS (
          SELECT c_custkey, c_acctbal < 0 AS flag_negative_balance, c_acctbal > 9000 AS flag_high_balance,
            coalesce(c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY'), true) AS flag_unknown_segment
          FROM customer)
        SELECT *, flag_negative_balance OR flag_high_balance OR flag_unknown_segment AS is_anomaly,
          CAST(flag_negative_balance AS INT) + 0.5::DOUBLE * CAST(flag_high_balance AS INT) + CAST(flag_unknown_segment AS INT) AS anomaly_score
        FROM f""",
    "rules_on_orders": """WITH f AS (
          SELECT o_totalprice > 400000 AS a, o_orderdate > TIMESTAMP '2001-01-01' AS b, coalesce(c_acctbal < 0, false) AS c
          FROM orders LEFT JOIN customer ON o_custkey = c_custkey)
        SELECT 'large_order' AS rule, count(*) FILTER (WHERE a) AS n FROM f
        UNION ALL SELECT 'late_order', count(*) FILTER (WHERE b) FROM f
        UNION ALL SELECT 'customer_in_debt', count(*) FILTER (WHERE c) FROM f
        UNION ALL SELECT 'any_rule', count(*) FILTER (WHERE a OR b OR c) FROM f""",
    "remediated_events": f"""WITH {TXN}, a AS (
          SELECT *, CASE WHEN flag_null_user THEN 'reject'
              WHEN flag_negative_amount AND event_type IS DISTINCT FROM 'refund' THEN 'reject'
              WHEN flag_extreme_amount OR flag_invalid_currency THEN 'filter'
              WHEN flag_negative_amount OR flag_future_ts THEN 'impute'
              WHEN flag_schema_drift THEN 'alert_upstream' ELSE 'keep' END AS action
          FROM flagged)
        SELECT event_id, action,
          CASE WHEN action = 'impute' AND flag_negative_amount THEN abs(amount) ELSE amount END AS fixed_amount,
          CASE WHEN action = 'impute' AND flag_future_ts THEN {AS_OF} ELSE event_ts END AS fixed_event_ts
        FROM a""",
    "anomaly_summary_day": f"""WITH {TXN}, {TYPED}
        SELECT date_part, anomaly_type, count(*) AS anomaly_count,
          (SELECT count(*) FROM flagged WHERE is_anomaly AND date_part = DATE '2024-01-15') AS total_anomalies
        FROM typed WHERE date_part = DATE '2024-01-15' GROUP BY date_part, anomaly_type""",
    "anomaly_summary_by_type": f"""WITH {TXN}, {TYPED}
        SELECT date_part, anomaly_type, count(*) AS anomaly_count FROM typed GROUP BY date_part, anomaly_type""",
    "top_anomalies": f"""WITH {TXN}
        SELECT event_id, anomaly_score, date_part FROM flagged WHERE is_anomaly ORDER BY anomaly_score DESC, event_id NULLS FIRST LIMIT 200""",
    "unanalyzed_anomalies": f"""WITH {TXN}
        SELECT event_id, date_part, anomaly_score FROM flagged WHERE is_anomaly AND (date_part > DATE '2024-01-15' OR date_part IS NULL)""",
    "anomaly_batches": f"""WITH {TXN}, {RANKED}
        SELECT date_part, CAST(floor((rank - 1) / 20) AS INT) AS batch, count(*) AS n,
          list(event_id ORDER BY rank)[1] AS first_event_id, list(event_id ORDER BY rank)[-1] AS last_event_id
        FROM ranked GROUP BY date_part, floor((rank - 1) / 20)""",
    "anomaly_groups": f"""WITH {TXN}, {TYPED}, total AS (SELECT count(*) AS events FROM flagged), g AS (
          SELECT anomaly_type, count(*) AS n, array_to_string(list_sort(list(event_id) FILTER (WHERE event_id IS NOT NULL))[1:2], ',') AS example_event_ids FROM typed GROUP BY anomaly_type)
        SELECT anomaly_type, n AS anomaly_count, round(100 * CAST(n AS DOUBLE) / events, 2) AS share_pct,
          {case('anomaly_type', ROOT_CAUSES)} AS root_cause, {impact('n', 'events')} AS business_impact,
          {case('anomaly_type', REMEDIES)} AS remediation, example_event_ids
        FROM g, total""",
    "anomaly_patterns": f"""WITH {TXN}, {TYPED}, c AS (
          SELECT anomaly_type, 'country' AS dimension, country AS value, count(*) AS n FROM typed GROUP BY ALL
          UNION ALL SELECT anomaly_type, 'hour', strftime(event_ts, '%H'), count(*) FROM typed GROUP BY ALL
        ), r AS (
          SELECT *, row_number() OVER (PARTITION BY anomaly_type, dimension ORDER BY n DESC, value) = 1 AS is_dominant,
            CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY anomaly_type, dimension) AS ratio FROM c)
        SELECT anomaly_type, dimension, value, n, round(ratio * 100, 2) AS share_pct, is_dominant,
          CASE WHEN is_dominant AND ratio >= 0.5 THEN 'mostly ' || dimension || ' ' || value END AS pattern_insight FROM r""",
    "anomaly_report_daily": f"""WITH {TXN}, {TYPED}, days AS (
          SELECT date_part, count(*) AS events, count(*) FILTER (WHERE is_anomaly) AS anomalies,
            max(event_ts) FILTER (WHERE NOT flag_future_ts) AS last_ts FROM flagged GROUP BY date_part
        ), countries AS (
          SELECT date_part, anomaly_type, country, count(*) AS k,
            row_number() OVER (PARTITION BY date_part, anomaly_type ORDER BY count(*) DESC, country) AS r
          FROM typed GROUP BY date_part, anomaly_type, country
        ), g AS (
          SELECT date_part, anomaly_type, count(*) AS n, list_sort(list(event_id) FILTER (WHERE event_id IS NOT NULL))[1:2] AS ids FROM typed GROUP BY ALL
        ), groups AS (
          SELECT g.date_part, g.anomaly_type, g.n, events, {{'anomaly_type': g.anomaly_type, 'count': n,
            'root_cause': {case('g.anomaly_type', ROOT_CAUSES)}, 'business_impact': {impact('n', 'events')},
            'remediation': {case('g.anomaly_type', REMEDIES)}, 'example_event_ids': ids,
            'pattern_insight': CASE WHEN 2 * k >= n THEN 'mostly country ' || country END}} AS grp,
            {case('g.anomaly_type', REMEDIES)} AS remedy
          FROM g JOIN days ON days.date_part IS NOT DISTINCT FROM g.date_part JOIN countries c ON c.date_part IS NOT DISTINCT FROM g.date_part AND c.anomaly_type = g.anomaly_type AND r = 1
        ), rep AS (
          SELECT date_part, list(grp ORDER BY anomaly_type) AS anomaly_groups, first(anomaly_type ORDER BY n DESC, anomaly_type) AS top_type,
            list_sort(list(DISTINCT remedy)) AS recommended_actions FROM groups GROUP BY date_part
        ), final AS (
          SELECT rep.date_part, anomalies, anomaly_groups,
            CASE WHEN anomalies > 50 AND coalesce(date_sub('minute', last_ts, CAST(rep.date_part + 1 AS TIMESTAMP)) >= 30, true) THEN 'critical'
              WHEN anomalies > 50 OR coalesce(date_sub('minute', last_ts, CAST(rep.date_part + 1 AS TIMESTAMP)) >= 30, true) THEN 'degraded'
              ELSE 'healthy' END AS overall_pipeline_health,
            CAST(anomalies AS VARCHAR) || ' of ' || CAST(events AS VARCHAR) || ' events are anomalous; most frequent: ' || top_type || '.' AS executive_summary,
            recommended_actions
          FROM rep JOIN days ON days.date_part IS NOT DISTINCT FROM rep.date_part)
        SELECT date_part AS run_date, '2024-01-31T00:00:00.000000+00:00' AS analyzed_at, anomalies AS anomaly_count,
          overall_pipeline_health AS pipeline_health, executive_summary,
          CAST(to_json({{'anomaly_groups': anomaly_groups, 'overall_pipeline_health': overall_pipeline_health,
            'executive_summary': executive_summary, 'recommended_actions': recommended_actions}}) AS VARCHAR) AS full_report
        FROM final""",
    "freshness": f"WITH {TXN} " + " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, last_updated, date_sub('minute', last_updated, {AS_OF}) AS age_minutes,
        CASE WHEN date_sub('minute', last_updated, {AS_OF}) >= 30 THEN 'stale' ELSE 'fresh' END AS freshness_status
        FROM (SELECT max(CAST({c} AS TIMESTAMP)) FILTER (WHERE CAST({c} AS TIMESTAMP) <= {AS_OF}) AS last_updated FROM {relation})"""
        for t, c, relation in [("events", "ts", "events"), ("orders", "o_orderdate", "orders"), ("lineitem", "l_shipdate", "lineitem"), ("transactions", "event_ts", "txn")]
    ),
    "freshness_by_commit": """SELECT 'orders' AS table_name, TIMESTAMP '2024-01-01' AS last_updated, CAST(20 AS BIGINT) AS age_minutes, 'fresh' AS freshness_status
        FROM orders LIMIT 1""",
    "health_daily": f"WITH {TXN}, {HEALTH} SELECT * FROM health",
    "incidents": f"""WITH {TXN}, {HEALTH}
        SELECT 'INC-20240131000000-' || coalesce(strftime(date_part, '%Y%m%d'), 'undated') || '-transactions' AS incident_id, '2024-01-31T00:00:00.000000+00:00' AS created_at,
          'medium' AS severity,
          'no event for ' || coalesce(CAST(age_minutes AS VARCHAR) || ' minutes', 'an unknown time') || ' on ' || coalesce(CAST(date_part AS VARCHAR), 'an unknown date') AS summary,
          'data-engineering-team' AS assigned_to, 'open' AS status, 'transactions' AS pipeline
        FROM health WHERE is_stale""",
    "dq_actions": f"""WITH {TXN}, {HEALTH}
        SELECT date_part, anomaly_count, age_minutes, pipeline_health,
          'check_freshness,summarize_anomalies' || CASE WHEN is_over THEN ',collect_table_stats,prepare_remediation' ELSE '' END
            || CASE WHEN is_stale THEN ',open_incident' ELSE '' END || ',report_' || pipeline_health AS actions
        FROM health""",
    "alert_routing": f"""WITH {TXN}, {HEALTH}
        SELECT date_part, pipeline_health,
          CASE pipeline_health WHEN 'critical' THEN 'send_critical_alert' WHEN 'degraded' THEN 'send_degraded_alert' ELSE 'pipeline_healthy' END AS route,
          CASE WHEN pipeline_health <> 'healthy' THEN '[' || upper(pipeline_health) || '] ' || coalesce(CAST(date_part AS VARCHAR), 'undated') || ': '
            || CAST(anomaly_count AS VARCHAR) || ' anomalies' END AS alert_text
        FROM health""",
    "stream_split": f"""WITH {TXN}
        SELECT CASE WHEN is_anomaly THEN 'anomalies' ELSE 'clean' END AS side, date_part, count(*) AS n FROM flagged GROUP BY ALL""",
    "enrich_transactions": ENRICH_SQL,
    "enrich_partitioned": ENRICH_SQL,
    "enrich_merge": f"""WITH {TXN}, {ENRICHED}
        SELECT event_id, amount, event_type,
          CASE WHEN known THEN fraud_risk ELSE 'unknown' END AS fraud_risk,
          CASE WHEN known THEN customer_intent ELSE 'unknown' END AS customer_intent,
          CASE WHEN known THEN product_category ELSE 'unknown' END AS product_category,
          known AND geo_risk_flag AS geo_risk_flag,
          CASE WHEN known THEN enrichment_confidence ELSE 0.0::DOUBLE END AS enrichment_confidence,
          CASE WHEN again THEN 'second round' WHEN known THEN enrichment_reasoning ELSE '' END AS enrichment_reasoning
        FROM (SELECT *, coalesce(payment_method = 'crypto', false) AS again, event_type = 'purchase' OR coalesce(payment_method = 'crypto', false) AS known FROM enriched)""",
    "null_rates": f"WITH {TXN} " + union([
        null_rates("txn", "transactions", ["event_id", "user_id", "product_id", "amount", "currency", "event_type", "event_ts", "country", "payment_method"]),
        null_rates("documents", "documents", [c for c, _ in FIELDS["documents"]]),
        null_rates("orders", "orders", [c for c, _ in FIELDS["orders"]]),
    ]),
    "numeric_profile": union(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 4) AS avg FROM {t}"""
        for t in ("orders", "lineitem", "events", "part") for c, kind in FIELDS[t] if kind in ("int", "bigint", "double")
    ),
    "sample_values": union(
        f"""SELECT '{t}' AS table_name, '{c}' AS column_name, string_agg(CAST({c} AS VARCHAR), ',' ORDER BY {key}) AS samples
        FROM (SELECT * FROM {t} ORDER BY {key} LIMIT 3)"""
        for t, key in [("part", "p_partkey"), ("nation", "n_nationkey")] for c, _ in FIELDS[t]
    ),
    "catalog_tables": union(
        f"SELECT '{t}' AS table_name, 'warehouse/{t}' AS table_path, count(*) AS row_count, CAST({len(FIELDS[t])} AS INT) AS column_count FROM {t}" for t in FIELDS
    ),
    "catalog_columns": union(
        f"""SELECT '{t}' AS table_name, count(*) AS row_count, CAST({i} AS INT) AS position, '{c}' AS column_name, '{kind}' AS data_type, true AS nullable, count({c}) AS non_null FROM {t}"""
        for t in FIELDS for i, (c, kind) in enumerate(FIELDS[t])
    ),
    "catalog_documents": f"SELECT table_name, document FROM ({union(document(t) for t in FIELDS)})",
    "catalog_describe": f"""SELECT table_name, table_path, row_count, '{",".join(c for c, _ in FIELDS["orders"])}' AS column_names,
        document AS description FROM ({document("orders")})""",
    "catalog_upsert": union(described(t, 1 if t in ("nation", "region") else 2) for t in FIELDS),
    "vector_topk_cosine": vector_top("list_cosine_similarity(CAST(embedding AS DOUBLE[]), c)", "round(score, 4) AS relevance"),
    "vector_topk_l2": vector_top("-list_distance(CAST(embedding AS DOUBLE[]), c)", "round(-score, 4) AS distance"),
    "text_topk_tfidf": f"""WITH {tfidf("SELECT doc_id, text FROM documents", "SELECT item_id, text FROM benchmark")}
        SELECT item_id AS question_id, doc_id AS document_id, rank, round(score, 4) AS relevance FROM r""",
    "catalog_search": f"""WITH catalog AS ({union(document(t) for t in FIELDS)}),
        asked(item_id, text) AS (VALUES {", ".join(f"(CAST({i} AS INT), '{q}')" for i, q in QUESTIONS)}),
        {tfidf("SELECT table_name AS doc_id, document AS text FROM catalog", "SELECT item_id, text FROM asked")}
        SELECT item_id AS question_id, rank, table_name, table_path, row_count, round(score, 3) AS relevance_score FROM r JOIN catalog ON table_name = doc_id""",
    "schema_history": f"""WITH {PAYLOADS}
        SELECT version, committed_at, record_count, column_name, type, nullable FROM cols WHERE version > (SELECT max(version) FROM totals) - 7""",
    "schema_drift_pair": f"WITH {PAYLOADS} SELECT * FROM changes WHERE to_version = (SELECT max(version) FROM totals)",
    "schema_drift_history": f"WITH {PAYLOADS} SELECT * FROM changes",
    "schema_drift_severity": f"""WITH {PAYLOADS}, v AS (
          SELECT from_version, to_version,
            string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE change = 'added') AS added,
            string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE change = 'removed') AS removed,
            string_agg(column_name, ', ' ORDER BY column_name) FILTER (WHERE change = 'type' AND NOT (from_type = 'bigint' AND to_type = 'double')) AS narrowed,
            count(*) FILTER (WHERE change = 'type') AS retyped,
            count(*) FILTER (WHERE change IN ('removed', 'type') AND column_name IN ('event_id', 'user_id')) AS on_key
          FROM changes GROUP BY from_version, to_version HAVING count(*) FILTER (WHERE change <> 'nullability') > 0)
        SELECT from_version, to_version, removed IS NOT NULL OR narrowed IS NOT NULL AS is_breaking_change,
          CASE WHEN (removed IS NOT NULL OR narrowed IS NOT NULL) AND on_key > 0 THEN 'critical' WHEN removed IS NOT NULL OR narrowed IS NOT NULL THEN 'high'
            WHEN retyped > 0 THEN 'medium' ELSE 'low' END AS severity,
          CASE WHEN removed IS NOT NULL THEN 'a producer stopped sending columns' WHEN retyped > 0 THEN 'a producer changed the type of values'
            ELSE 'a producer started sending new columns' END AS root_cause_hypothesis,
          concat_ws('; ', 'restore or replace: ' || removed, 'check readers of: ' || narrowed, 'document: ' || added) AS recommended_actions,
          CASE WHEN removed IS NOT NULL OR narrowed IS NOT NULL THEN 'SELECT * FROM payloads VERSION AS OF ' || from_version END AS rollback_sql
        FROM v""",
    "schema_merge": f"""WITH {TXN}
        SELECT event_id, amount, CAST(event_ts AS DATE) AS date_part, CASE WHEN CAST(event_ts AS DATE) < DATE '2024-01-15' THEN NULL ELSE payment_method END AS payment_method FROM txn""",
    "snapshot_as_of": union([SNAPSHOT.format(v=1, where=OLD_ORDERS), SNAPSHOT.format(v=2, where="")]),
    "snapshot_rollback": SNAPSHOT.format(v=3, where=OLD_ORDERS),
    "prompt_batches": f"""WITH {TXN}, {RANKED}, rec AS (
          SELECT date_part, CAST(floor((rank - 1) / 20) AS INT) AS batch, rank, CAST(to_json({{'event_id': event_id, 'user_id': user_id, 'product_id': product_id,
            'amount': amount, 'currency': currency, 'event_type': event_type, 'timestamp': strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'),
            'country': country, 'payment_method': payment_method, 'anomaly_type': concat_ws(',', {", ".join(f"CASE WHEN flag_{t} THEN '{t}' END" for t in TYPES)})}}) AS VARCHAR) AS record
          FROM ranked
        ), p AS (
          SELECT date_part, batch, count(*) AS n, count(*) FILTER (WHERE record LIKE '%"event_id":"EVT-%') AS known, '{ANOMALY_TASK}' || chr(10) || chr(10) || CAST(count(*) AS VARCHAR) || ' records:' || chr(10) || chr(10)
            || string_agg(record, chr(10) ORDER BY rank) AS prompt FROM rec GROUP BY date_part, batch)
        SELECT date_part, batch, n, length(prompt) AS prompt_chars, md5(prompt) AS prompt_md5, known + 1 AS parts FROM p""",
    "explained_reports": f"""WITH {TXN}, {RANKED}, named AS (
          SELECT date_part, floor((rank - 1) / 20) AS batch, concat_ws(',', {", ".join(f"CASE WHEN flag_{t} THEN '{t}' END" for t in TYPES)}) AS types FROM ranked
        ), b AS (
          SELECT *, count(*) OVER (PARTITION BY date_part, batch) = 3 AS unread FROM named
        )
        SELECT date_part AS run_date, count(*) AS anomaly_count, count(DISTINCT batch) FILTER (WHERE unread) AS unread_batches,
          CASE WHEN bool_and(unread) THEN 'unknown' WHEN bool_or(types LIKE '%,%') FILTER (WHERE NOT unread) THEN 'critical' ELSE 'degraded' END AS pipeline_health,
          CAST(count(DISTINCT types) FILTER (WHERE NOT unread) AS INT) AS group_count
        FROM b GROUP BY date_part""",
    "parse_responses": f"""WITH {TXN}, {ENRICHED}
        SELECT event_id AS answer_id, ok AS parse_ok, CASE WHEN ok THEN event_id END AS event_id, CASE WHEN ok THEN fraud_risk END AS fraud_risk,
          CASE WHEN ok THEN geo_risk_flag END AS geo_risk_flag, CASE WHEN ok THEN enrichment_confidence END AS enrichment_confidence,
          CASE WHEN ok THEN 'fits {{usual}} values' END AS reasoning
        FROM (SELECT *, currency IS DISTINCT FROM 'XYZ' AND payment_method IS NOT NULL AS ok FROM enriched)""",
    "anomaly_summary_by_label": f"""WITH {TXN}
        SELECT CASE {" ".join(f"WHEN flag_{t} THEN '{t}'" for t in TYPES)} END AS anomaly_type, count(*) AS anomaly_count
        FROM flagged WHERE is_anomaly AND date_part = DATE '2024-01-15' GROUP BY ALL""",
    "distinct_events": f"""WITH {TXN} SELECT event_id, event_type, amount FROM decoded
        UNION ALL SELECT event_id, event_type, amount FROM decoded WHERE defect = 'undecodable' AND sent_type = 'refund'""",
    "table_history": f"""SELECT * FROM (VALUES (CAST(1 AS BIGINT), TIMESTAMP '2024-01-01', 'write'), (2, TIMESTAMP '2024-01-02', 'write'),
          (3, TIMESTAMP '2024-01-03', 'rollback to 1')) v(version, committed_at, operation),
        LATERAL (SELECT count(*) FILTER (WHERE v.version = 2 OR o_orderdate < TIMESTAMP '2000-01-01') AS row_count, CAST(4 AS INT) AS column_count FROM orders) c""",
}
ORACLES["stream_two_tables"] = ORACLES["stream_split"]
ORACLES["stream_compacted"] = ORACLES["stream_split"]
ORACLES["stream_distinct"] = ORACLES["distinct_events"]
ORACLES["vector_topk_indexed"] = ORACLES["vector_topk_cosine"]

ORACLES["anomaly_bursts"] = f"""WITH {TXN}, {TYPED}, e AS (
    SELECT anomaly_type, event_ts, lag(event_ts) OVER (PARTITION BY anomaly_type ORDER BY event_ts) AS before FROM typed WHERE event_ts IS NOT NULL
  ), numbered AS (
    SELECT *, sum(CASE WHEN before IS NULL OR event_ts - before > INTERVAL 2 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY anomaly_type ORDER BY event_ts) AS run FROM e
  ), runs AS (
    SELECT anomaly_type, min(event_ts) AS burst_start, max(event_ts) AS burst_end, count(*) AS n FROM numbered GROUP BY anomaly_type, run
  ), spans AS (
    SELECT *, CAST(sum(n) OVER w AS BIGINT) AS total, epoch_us(max(burst_end) OVER w) - epoch_us(min(burst_start) OVER w) + 7200000000 AS span
    FROM runs WINDOW w AS (PARTITION BY anomaly_type)
  ), due AS (
    SELECT *, CAST(total * (epoch_us(burst_end) - epoch_us(burst_start) + 7200000000) AS DOUBLE) / span AS expected FROM spans WHERE n >= 3
  )
  SELECT anomaly_type, burst_start, burst_end, n, CASE WHEN n > expected THEN round(n * ln(n / expected)
    + CASE WHEN total > n THEN (total - n) * ln((total - n) / (total - expected)) ELSE 0.0 END, 6) ELSE 0.0 END AS score FROM due"""

ITEM_FIELDS = ["country", "payment_method", "hour"]
_SETS = [[f for k, f in enumerate([*ITEM_FIELDS, "types"]) if mask >> k & 1] for mask in range(16)]
ORACLES["anomaly_itemsets"] = f"""WITH {TXN}, rec AS (
    SELECT country, payment_method, strftime(event_ts, '%H') AS hour,
      list_filter([{', '.join(f"CASE WHEN flag_{t} THEN '{t}' END" for t in TYPES)}], lambda x: x IS NOT NULL) AS list FROM flagged WHERE is_anomaly
  ), whole AS (SELECT count(*) AS total FROM rec), typed_rec AS (SELECT * EXCLUDE (list), unnest(list) AS types FROM rec),
  single AS (
    {' UNION ALL '.join(f"SELECT '{f}' AS field, {f} AS value, count(*) AS n FROM {'typed_rec' if f == 'types' else 'rec'} GROUP BY {f}" for f in [*ITEM_FIELDS, 'types'])}
  ), frequent AS (SELECT field, value, n FROM single, whole WHERE value IS NOT NULL AND n >= ceil(total * 0.02)),
  sets AS (
    {' UNION ALL '.join(
        f"SELECT {len(s)} AS size, " + ", ".join(f"{f if f in s else 'NULL'} AS {f}" for f in [*ITEM_FIELDS, 'types'])
        + f", count(*) AS n FROM {'typed_rec' if 'types' in s else 'rec'} WHERE " + " AND ".join(f"{f} IS NOT NULL" for f in s)
        + f" GROUP BY {', '.join(s)}" for s in _SETS if len(s) > 1)}
  )
  SELECT CAST(size AS INT) AS size,
    concat_ws(', ', 'country=' || sets.country, 'hour=' || sets.hour, 'payment_method=' || sets.payment_method, 'types=' || sets.types) AS items, sets.n AS n,
    round(sets.n / total * 100, 2) AS support_pct,
    round(sets.n / total / coalesce(c.n / total, 1.0) / coalesce(p.n / total, 1.0) / coalesce(h.n / total, 1.0) / coalesce(t.n / total, 1.0), 4) AS lift
  FROM sets CROSS JOIN whole
    LEFT JOIN frequent c ON c.field = 'country' AND c.value = sets.country
    LEFT JOIN frequent p ON p.field = 'payment_method' AND p.value = sets.payment_method
    LEFT JOIN frequent h ON h.field = 'hour' AND h.value = sets.hour
    LEFT JOIN frequent t ON t.field = 'types' AND t.value = sets.types
  WHERE sets.n >= ceil(total * 0.02)"""

# What the payloads of each version hold, as their description says.
PATHS = """records AS (
    SELECT datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 4 + 1 AS version, max(CAST(ts AS TIMESTAMP)) AS committed_at, count(*) AS record_count,
      bool_or(event_type = 'view') AS some_views, bool_or(event_type <> 'view') AS some_others FROM events GROUP BY ALL
  ), named(path, type, since, until) AS (VALUES
    ('event_id', 'bigint', 1, 99), ('user', 'struct', 1, 99), ('user.id', 'bigint', 1, 5), ('user.id', 'string', 6, 99), ('user.country', 'string', 1, 6),
    ('user.tier', 'string', 3, 99), ('items', 'array', 1, 99), ('items[]', 'struct', 1, 99), ('items[].q', 'bigint', 1, 3), ('items[].q', 'double', 4, 99),
    ('items[].note', 'string', 5, 99), ('tags', 'array', 1, 7), ('tags[]', 'string', 1, 7), ('meta', 'struct', 8, 99), ('meta.tags', 'array', 8, 99),
    ('meta.tags[]', 'string', 8, 99)
  ), paths AS (
    SELECT CAST(version AS BIGINT) AS version, committed_at, record_count, path,
      CASE WHEN path = 'items[].note' AND NOT some_others THEN 'void' ELSE type END AS type, path = 'items[].note' AND some_views AS nullable
    FROM records JOIN named ON version BETWEEN since AND until
  ), steps AS (
    SELECT version AS to_version, lag(version) OVER (ORDER BY version) AS from_version FROM (SELECT DISTINCT version FROM paths)
  ), both_sides AS (
    SELECT from_version, to_version, path, type, nullable, 'a' AS side FROM paths JOIN steps ON version = from_version
    UNION ALL SELECT from_version, to_version, path, type, nullable, 'b' FROM paths JOIN steps ON version = to_version WHERE from_version IS NOT NULL
  ), met AS (
    SELECT from_version, to_version, path, max(type) FILTER (WHERE side = 'a') AS t0, max(type) FILTER (WHERE side = 'b') AS t1,
      bool_or(nullable) FILTER (WHERE side = 'a') AS n0, bool_or(nullable) FILTER (WHERE side = 'b') AS n1 FROM both_sides GROUP BY ALL
  ), path_changes AS (
    SELECT from_version, to_version, CASE WHEN t0 IS NULL THEN 'added' WHEN t1 IS NULL THEN 'removed' WHEN t0 <> t1 THEN 'type' ELSE 'nullability' END AS change,
      path, CASE WHEN t0 <> t1 THEN t0 END AS from_type, CASE WHEN t0 <> t1 THEN t1 END AS to_type
    FROM met WHERE t0 IS DISTINCT FROM t1 OR n0 IS DISTINCT FROM n1
  )"""
ORACLES["schema_paths"] = f"WITH {PATHS} SELECT * FROM paths WHERE version > (SELECT max(version) FROM paths) - 7"
ORACLES["schema_path_changes"] = f"WITH {PATHS} SELECT * FROM path_changes"
ORACLES["schema_path_verdicts"] = f"""WITH {PATHS}, counted AS (
    SELECT from_version, to_version, count(*) FILTER (WHERE change = 'added') AS n_added, count(*) FILTER (WHERE change = 'removed') AS n_removed,
      count(*) FILTER (WHERE change = 'type' AND from_type = 'bigint' AND to_type = 'double') AS n_widened,
      count(*) FILTER (WHERE change = 'type' AND NOT (from_type = 'bigint' AND to_type = 'double')) AS n_narrowed,
      count(*) FILTER (WHERE change IN ('removed', 'type') AND NOT (from_type IS NOT DISTINCT FROM 'bigint' AND to_type IS NOT DISTINCT FROM 'double')
                       AND path IN ('event_id', 'user.id')) AS n_keys
    FROM path_changes WHERE change <> 'nullability' GROUP BY ALL
  )
  SELECT * EXCLUDE (n_keys), n_removed + n_narrowed > 0 AS is_breaking_change,
    CASE WHEN n_keys > 0 THEN 'critical' WHEN n_removed + n_narrowed > 0 THEN 'high' WHEN n_widened > 0 THEN 'medium' ELSE 'low' END AS severity FROM counted"""

_NUMERIC = ("event_id", "user_id", "value")
ORACLES["catalog_profiles"] = " UNION ALL ".join(
    f"""SELECT 'events' AS table_name, '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
      round((count(*) - count({c})) / count(*) * 100, 2) AS null_pct, {f'CAST(min({c}) AS DOUBLE)' if c in _NUMERIC else 'CAST(NULL AS DOUBLE)'} AS min,
      {f'CAST(max({c}) AS DOUBLE)' if c in _NUMERIC else 'CAST(NULL AS DOUBLE)'} AS max, {f'round(avg({c}), 4)' if c in _NUMERIC else 'CAST(NULL AS DOUBLE)'} AS avg,
      (SELECT string_agg(CAST({c} AS VARCHAR), ',' ORDER BY event_id) FROM (SELECT * FROM events ORDER BY event_id LIMIT 3)) AS samples FROM events"""
    for c in ("event_id", "ts", "user_id", "event_type", "value", "props")
)
