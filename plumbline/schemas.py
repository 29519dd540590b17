"""Record layouts and fixed values."""

from __future__ import annotations

# Fields of an event record, in order. All are nullable.
EVENT_FIELDS = [
    ("event_id", "string"),
    ("user_id", "string"),
    ("product_id", "string"),
    ("amount", "double"),
    ("currency", "string"),
    ("event_type", "string"),
    ("timestamp", "string"),
    ("country", "string"),
    ("payment_method", "string"),
    ("_anomaly_type", "string"),
]

# Accepted currencies, amount limit, and the label a producer puts on drifted records.
VALID_CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CAD", "AUD"]
MAX_AMOUNT = 10000.0
DRIFT_LABEL = "schema_drift"

# Batch sizes, caps and thresholds.
ANALYSIS_BATCH = 20
TOP_ANOMALIES = 200
ENRICHMENT_BATCH = 25
ANOMALY_LIMIT = 50
STALE_MINUTES = 30
HISTORY_VERSIONS = 7
TOP_K = 5
TRIGGER = "15 seconds"

# Incident fields.
INCIDENT_SEVERITY = "medium"
INCIDENT_ASSIGNEE = "data-engineering-team"
INCIDENT_STATUS = "open"

EVENT_DDL = ", ".join(f"`{name}` {kind}" for name, kind in EVENT_FIELDS)

# The label is optional in a payload; every other key is expected.
REQUIRED_KEYS = [name for name, _ in EVENT_FIELDS if name != "_anomaly_type"]
ALLOWED_KEYS = [name for name, _ in EVENT_FIELDS]

GROUP_DDL = (
    "anomaly_type STRING, count BIGINT, root_cause STRING, business_impact STRING, "
    "remediation STRING, example_event_ids ARRAY<STRING>, pattern_insight STRING"
)

REPORT_DDL = (
    "run_date DATE, analyzed_at STRING, anomaly_count BIGINT, pipeline_health STRING, "
    "executive_summary STRING, full_report STRING"
)

# Enrichment columns with the value a record gets when nothing is known about it.
ENRICHMENT_DEFAULTS = [
    ("fraud_risk", "string", "unknown"),
    ("customer_intent", "string", "unknown"),
    ("product_category", "string", "unknown"),
    ("geo_risk_flag", "boolean", False),
    ("enrichment_confidence", "double", 0.0),
    ("enrichment_reasoning", "string", ""),
]

ENRICHMENT_DDL = ", ".join(f"{name} {kind}" for name, kind, _ in ENRICHMENT_DEFAULTS)
