"""Field lists, allowed values, names and messages.

These values must equal the pipeline's published contract for the results to
match, so they are stated here plainly, in their natural order.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES (contract of the event schemas and jobs)
# ---------------------------------------------------------------------------

# Kafka topics.
CARD_TOPIC = "banking.transaction.card-authorizations.v1"
LOGIN_TOPIC = "banking.digital-activity.login-events.v1"
RISK_TOPIC = "banking.fraud-risk.risk-events.v1"

# Storage prefixes.
BRONZE_CARD_PREFIX = "transaction/card-authorizations"
BRONZE_LOGIN_PREFIX = "digital-activity/login-events"
BRONZE_RISK_PREFIX = "fraud-risk/risk-events"
QUARANTINE_CARD_PREFIX = "silver-card-authorizations"
QUARANTINE_LOGIN_PREFIX = "silver-login-events"

# Buckets.
BRONZE_BUCKET = "banking-bronze"
GOLD_BUCKET = "banking-gold"

# Job names.
JOB_SILVER_CARD = "silver_card_authorizations"
JOB_SILVER_LOGIN = "silver_login_events"

# Card authorization event: required fields (merchant_city is optional).
CARD_REQUIRED_FIELDS = [
    "event_id", "transaction_id", "authorization_id", "customer_id", "account_id",
    "card_id", "event_time", "amount", "currency", "merchant_id", "merchant_name",
    "merchant_category_code", "merchant_country", "authorization_status", "channel",
    "card_present", "entry_mode", "source_system", "schema_version",
]
CARD_ALLOWED_CURRENCY = "USD"
CARD_ALLOWED_STATUSES = ["approved", "declined"]

# Login event: required fields (failure_reason and user_agent are optional).
LOGIN_REQUIRED_FIELDS = [
    "event_id", "login_event_id", "customer_id", "event_time", "event_type",
    "login_status", "device_id", "device_type", "ip_address", "country", "city",
    "channel", "source_system", "schema_version",
]
LOGIN_ALLOWED_EVENT_TYPES = ["login_success", "login_failed", "password_reset", "new_device_registered"]
LOGIN_ALLOWED_STATUSES = ["success", "failed"]

# Lineage columns added by the Silver jobs.
SILVER_LINEAGE_FIELDS = ["bronze_kafka_topic", "bronze_kafka_partition", "bronze_kafka_offset", "bronze_ingest_time"]

# Bronze envelope validation.
BRONZE_DOCUMENT_FIELDS = ["bronze_ingest_time", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_key", "raw_value",
                          "parsed_value"]
BRONZE_REQUIRED_EVENT_FIELDS = ["event_time", "customer_id", "source_system", "schema_version"]
BRONZE_EVENT_ID_FIELDS = ["event_id", "risk_event_id"]

# Gold validation field lists.
GOLD_TX_REQUIRED_FIELDS = [
    "authorization_status", "channel", "merchant_country", "merchant_category_code",
    "transaction_count", "total_amount", "average_amount", "approved_count",
    "declined_count", "gold_processed_time",
]
GOLD_FRAUD_REQUIRED_FIELDS = [
    "risk_event_id", "customer_id", "account_id", "card_id", "source_transaction_id",
    "risk_score", "risk_level", "recommended_action", "rule_flags", "explanation",
    "login_event_count", "failed_login_count", "new_device_count", "password_reset_count",
    "source_events", "gold_processed_time",
]
GOLD_FRAUD_RISK_LEVELS = ["low", "medium", "medium_high", "high"]
GOLD_FRAUD_COUNT_FIELDS = ["login_event_count", "failed_login_count", "new_device_count", "password_reset_count"]
GOLD_HEALTH_REQUIRED_FIELDS = [
    "run_id", "job_name", "status", "process_date", "records_read", "records_written",
    "records_rejected", "started_at", "finished_at", "duration_seconds", "input_prefix",
    "output_prefix", "gold_processed_time",
]
GOLD_HEALTH_STATUSES = ["success", "failed"]
GOLD_HEALTH_COUNT_FIELDS = ["records_read", "records_written", "records_rejected"]

# Monitoring rules: (rule_id, severity) and thresholds.
DECLINE_RATE_THRESHOLD = "20.0"
HIGH_RISK_SCORE_THRESHOLD = 90
HIGH_RISK_LEVELS = ["medium_high", "high"]
DEFAULT_ALERT_CHANNEL = "local_file"
UNMATCHED_LABEL = "Not matched"
DASHBOARD_TOP_N = 10
DASHBOARD_ALERT_LINES = 8

# Core banking reference tables: allowed values of the CHECK constraints.
CUSTOMER_STATUSES = ["active", "inactive", "closed", "restricted"]
ACCOUNT_TYPES = ["checking", "savings", "money_market"]
ACCOUNT_STATUSES = ["open", "closed", "frozen", "restricted"]
BALANCE_CURRENCY = "USD"
KYC_STATUSES = ["pending", "verified", "failed", "expired"]
KYC_RISK_RATINGS = ["low", "medium", "high"]
SANCTIONS_STATUSES = ["clear", "potential_match", "confirmed_match"]

