"""Schemas, closed vocabularies and the fixed lookup values of the engine."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Vocabularies (fixed values)
# --------------------------------------------------------------------------
FORMATS = ["syslog", "json", "cef", "unknown"]
ACTIONS = ["allow", "deny", "alert", "drop", "unknown"]
SEVERITIES = ["low", "medium", "high", "critical", "unknown"]
PROTOCOLS = ["TCP", "UDP", "ICMP", "UNKNOWN"]
CONFIDENCES = ["high", "low"]

# The columns of events that take only these words.
VOCABULARIES = {
    "source_format": FORMATS, "action": ACTIONS, "severity": SEVERITIES, "protocol": PROTOCOLS,
    "parser_confidence": CONFIDENCES,
}

STATUS_NORMALIZED = "normalized"
STATUS_PARSE_ERROR = "parse_error"

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------
LINES_SCHEMA = T.StructType([
    T.StructField("source_name", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("raw_text", T.StringType()),
])

# The five contract columns, then the physical columns the engine adds: a typed
# ingestion time, the arrival position used by template mining, and a hash of the line's
# content and place, which is the same whenever the line is ingested again.
RAW_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("raw_text", T.StringType(), False),
    T.StructField("source_name", T.StringType()),
    T.StructField("source_format_hint", T.StringType()),
    T.StructField("ingested_at", T.StringType(), False),
    T.StructField("ingested_ts", T.TimestampType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("content_id", T.StringType()),
])
RAW_EVENT_COLUMNS = [
    "event_id", "raw_text", "source_name", "source_format_hint", "ingested_at",
]

NORMALIZED_EVENT_SCHEMA = T.StructType([
    T.StructField("normalized_id", T.StringType(), False),
    T.StructField("raw_event_id", T.StringType(), False),
    T.StructField("timestamp", T.StringType(), False),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("src_port", T.LongType()),
    T.StructField("dst_port", T.LongType()),
    T.StructField("action", T.StringType(), False),
    T.StructField("protocol", T.StringType(), False),
    T.StructField("device_vendor", T.StringType()),
    T.StructField("severity", T.StringType(), False),
    T.StructField("source_format", T.StringType(), False),
    T.StructField("parser_confidence", T.StringType(), False),
    T.StructField("normalized_at", T.StringType(), False),
])
NORMALIZED_EVENT_COLUMNS = NORMALIZED_EVENT_SCHEMA.fieldNames()

# What a parser yields for one line. ``error_reason`` is null on success.
PARSED_STRUCT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("src_ip", T.StringType()),
    T.StructField("dst_ip", T.StringType()),
    T.StructField("src_port", T.LongType()),
    T.StructField("dst_port", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("protocol", T.StringType()),
    T.StructField("device_vendor", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("error_reason", T.StringType()),
])
PARSED_FIELDS = PARSED_STRUCT.fieldNames()

QUARANTINE_COLUMNS = [
    "raw_event_id", "source_name", "detected_format", "status", "error_reason",
]

# The order in which the event table is shown.
DISPLAY_COLUMNS = [
    "timestamp", "src_ip", "src_country", "src_flagged_bad", "dst_ip",
    "src_port", "dst_port", "action", "protocol", "severity",
    "device_vendor", "source_format", "parser_confidence",
    "normalized_id", "raw_event_id", "normalized_at",
]

# --------------------------------------------------------------------------
# JSON dialects: key aliases in priority order, and word maps (fixed values)
# --------------------------------------------------------------------------
JSON_KEYS = {
    "timestamp": ["ts", "timestamp", "time", "event_time", "@timestamp"],
    "src_ip": ["src_ip", "source_ip", "srcip", "src", "client_ip"],
    "dst_ip": ["dst_ip", "dest_ip", "destination_ip", "dstip", "dst", "server_ip"],
    "src_port": ["src_port", "source_port", "srcport", "sport"],
    "dst_port": ["dst_port", "dest_port", "destination_port", "dstport", "dport"],
    "action": ["action", "verdict", "decision", "disposition"],
    "protocol": ["protocol", "proto"],
    "device_vendor": ["device", "vendor", "product", "device_vendor", "appliance"],
    "severity": ["severity", "sev", "priority", "level"],
}
JSON_ACTION_WORDS = {
    "allow": ["allow", "allowed", "permit", "permitted"],
    "deny": ["deny", "denied", "block", "blocked"],
    "alert": ["alert", "alerted", "flagged"],
    "drop": ["drop", "dropped"],
}
JSON_SEVERITY_WORDS = {
    "low": ["low", "info", "informational"],
    "medium": ["medium", "med", "moderate", "warning"],
    "high": ["high"],
    "critical": ["critical", "crit", "severe"],
}

# --------------------------------------------------------------------------
# CEF: extension key aliases and word maps (fixed values)
# --------------------------------------------------------------------------
CEF_KEYS = {
    "timestamp": ["rt", "start", "end"],
    "src_ip": ["src", "sourceaddress"],
    "dst_ip": ["dst", "destinationaddress"],
    "src_port": ["spt", "sourceport"],
    "dst_port": ["dpt", "destinationport"],
    "action": ["act", "deviceaction"],
    "protocol": ["proto", "transportprotocol"],
}
CEF_ACTION_WORDS = {
    "allow": ["allow", "allowed", "permit", "permitted", "accept"],
    "deny": ["deny", "denied", "block", "blocked"],
    "alert": ["alert", "alerted", "flagged"],
    "drop": ["drop", "dropped"],
}
CEF_SEVERITY_WORDS = {
    "low": ["low"],
    "medium": ["medium", "med"],
    "high": ["high"],
    "critical": ["very-high", "veryhigh", "critical"],
}

# --------------------------------------------------------------------------
# Unrecognised formats: action words and token separators (fixed values)
# --------------------------------------------------------------------------
UNKNOWN_ACTION_WORDS = {
    "deny": ["block", "blocked", "deny", "denied"],
    "allow": ["allow", "allowed"],
    "alert": ["alert", "alerted"],
    "drop": ["drop", "dropped"],
}
EXTRA_DELIMITERS = "|="
WILDCARD = "<*>"

PROTOCOL_WORDS = {"TCP": ["tcp"], "UDP": ["udp"], "ICMP": ["icmp"]}

# --------------------------------------------------------------------------
# Bundled enrichment tables (fixed values; the order of the ranges matters)
# --------------------------------------------------------------------------
KNOWN_BAD_IPS = [
    "203.0.113.55",
    "10.10.10.5",
    "192.0.2.50",
    "192.0.2.77",
    "192.0.2.200",
    "198.51.100.23",
    "203.0.113.99",
]

GEO_RANGES = [
    ("10.0.0.0/8", "United States"),
    ("172.16.0.0/16", "Germany"),
    ("192.168.0.0/16", "India"),
    ("203.0.113.0/24", "United Kingdom"),
    ("198.51.100.0/24", "Japan"),
    ("100.64.0.0/10", "Canada"),
    ("192.0.2.0/24", "France"),
    ("198.18.0.0/15", "Australia"),
    ("172.20.0.0/14", "Brazil"),
    ("172.24.0.0/14", "China"),
    ("10.10.0.0/16", "Singapore"),
    ("10.20.0.0/16", "South Korea"),
    ("10.30.0.0/16", "Netherlands"),
    ("10.40.0.0/16", "Switzerland"),
    ("10.50.0.0/16", "Sweden"),
    ("10.60.0.0/16", "Norway"),
    ("10.70.0.0/16", "Spain"),
    ("10.80.0.0/16", "Italy"),
    ("10.90.0.0/16", "Canada"),
    ("10.100.0.0/16", "Australia"),
    ("172.18.0.0/16", "United States"),
    ("172.19.0.0/16", "United Kingdom"),
    ("172.21.0.0/16", "India"),
    ("172.22.0.0/16", "Germany"),
    ("172.23.0.0/16", "Japan"),
    ("192.168.1.0/24", "India"),
    ("192.168.2.0/24", "United States"),
    ("192.168.3.0/24", "Germany"),
    ("192.168.4.0/24", "France"),
    ("192.168.5.0/24", "United Kingdom"),
    ("192.168.6.0/24", "Japan"),
    ("192.168.7.0/24", "Australia"),
    ("192.168.8.0/24", "Singapore"),
    ("192.168.9.0/24", "Brazil"),
    ("192.168.10.0/24", "South Korea"),
]
