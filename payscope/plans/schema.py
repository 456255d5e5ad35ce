"""Columns, thresholds and lookup tables of the records."""

from __future__ import annotations

#: The columns of records, of metrics and of raw records, in the order of their files.
RECORD = ("id guid request request_body timestamp response latency_ms volume psp bank country status error event_type source_file source_format validation_flags is_valid confidence severity").split()
METRIC = (
    "psp bank country total_ops success_ops failed_ops decline_ops error_count success_rate_% decline_rate_% error_rate_% conversion_rate_% "
    "total_withdrawals_checked job_starts job_finishes job_completion_rate_% avg_latency_ms p50_latency_ms p95_latency_ms max_latency_ms transaction_total_volume").split()  # fmt: skip
#: Raw fields that normalisation reads: text, null where a value is absent, empty, zero or false.
RAW = (
    "id tx_id transaction_id guid correlation_id request request_body timestamp time @timestamp response response_body latency_ms latency duration_ms "
    "amount volume transaction_amount psp bank country status error event_type source_file source_format").split()  # fmt: skip
NUMBERS = ("latency_ms", "latency", "duration_ms", "amount", "volume", "transaction_amount")

#: Other names of fields.
ALIASES = {
    "psp_name": "psp", "provider": "psp", "processor": "psp",
    "bank_name": "bank", "institution": "bank", "issuer": "bank",
    "country_code": "country", "region": "country", "iso_country": "country",
    "latency": "latency_ms", "duration_ms": "latency_ms", "response_time": "latency_ms", "elapsed": "latency_ms",
    "transaction_amount": "amount", "value": "amount",
    "error_code": "error", "failure_reason": "error", "decline_reason": "error",
    "tx_id": "id", "transaction_id": "id", "ref_id": "id",
    "correlation_id": "guid", "trace_id": "guid",
    "event": "event_type", "type": "event_type",
}
#: Raw states of each status.
STATUSES = {
    "SUCCESS": ("SUCCESS", "TRUE", "OK", "200", "COMPLETED"),
    "FAILED": ("FAILED", "FALSE", "ERROR", "FAIL", "KO", "500", "4XX"),
    "DECLINED": ("DECLINED", "DECLINE"),
    "UNKNOWN": ("UNKNOWN",),
}
#: Severities, quality of source formats, ranges.
ERROR_SEVERITY = {"NETWORK_ERROR": "CRITICAL", "TIMEOUT": "HIGH", "DECLINED": "MEDIUM", "INSUFFICIENT_FUNDS": "LOW"}
STATUS_SEVERITY = {"SUCCESS": "INFO", "FAILED": "HIGH", "DECLINED": "MEDIUM", "UNKNOWN": "HIGH"}
SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO")
FORMAT_QUALITY = {"azure_withdrawal_csv": 1.0, "freetext_numbered": 1.0, "json_lines": 0.95, "json_array": 0.95, "csv_generic": 0.85, "adaptive_unknown": 0.65}
OTHER_QUALITY = 0.70
LATENCY_BELOW, VOLUME_BELOW = 300_000, 1_000_000
NO_VALUE = ("", "N/A", "null", "UNKNOWN")
DEFAULT_REQUEST = "POST /withdrawals/process"
TECHNICAL_ERRORS = ("NETWORK_ERROR", "TIMEOUT", "INSUFFICIENT_FUNDS")
BANDS = (("HIGH", 0.85), ("MEDIUM", 0.70), ("LOW", 0.50), ("CRITICAL", None))
#: Thresholds of the anomaly rules and of the run.
FAILURE_SPIKE, HIGH_ERROR, HIGH_DECLINE, LATENCY_WARN, MIN_OPS, CONFIDENCE_WARN = 40.0, 25.0, 30.0, 900.0, 5, 0.70
REJECTION_ALERT, MAX_ATTEMPTS, GATE = 0.20, 3, 0.70
#: What marks a withdrawal.
WITHDRAWAL_PATHS = ("/withdrawals/", "/withdraw", "/payout", "/disbursement")
WITHDRAWAL_EVENTS = ("withdrawal_request", "withdrawal_response", "payout_initiated")
WITHDRAWAL_WORDS = ("withdrawal", "withdraw", "payout", "disbursement", "remittance")
SUFFIXES = ("txt", "csv", "json", "jsonl", "log", "xlsx")
