"""A format of one's own, in one call."""

from __future__ import annotations

from pyspark.sql import functions as F

from loglathe.operators import formats
from loglathe.operators.detect import detect_format
from loglathe.operators.fields import found_struct
from loglathe.operators.normalize import outcomes
from loglathe.plans.batch import EventStore
from loglathe.sources import tables
from tests.conftest import CLOCK, OPTIONS
from tests.test_formats import CEF, DENY
from tests.test_ingest import JSON

GATE = "gate;2026-05-01T10:00:00Z;10.9.8.7;shut;7"
BROKEN = "gate;2026-05-01T10:00:00Z"


def gate_stages(only, assumed_year):
    when = F.lit(True) if only else F.col("detected_format") == "gate"
    part = [F.get("_gate_parts", F.lit(i)) for i in range(5)]
    return [
        {"_gate_parts": F.when(when, F.split("_text", ";"))},
        {"_gate": F.when(when, found_struct(
            time=part[1], src_ip=part[2], action=part[3], severity=part[4],
            error_reason=F.when(F.size("_gate_parts") < 5, "fields")))},
    ]


def test_one_call_adds_a_format(spark, raw_of, folder):
    lines = [GATE, DENY, BROKEN, JSON, CEF, "something else"]
    raw = raw_of(lines)
    before = [r["detected_format"] for r in outcomes(raw, OPTIONS).orderBy("seq").collect()]
    assert before == ["unknown", "syslog", "unknown", "json", "cef", "unknown"]
    formats.register(formats.LogFormat(
        "gate", lambda text: text.startswith("gate;"), gate_stages,
        action=lambda key: F.when(key == "shut", "deny").otherwise("unknown"),
        severity=lambda key, level: F.when(level > 5, "high").otherwise("low")))
    try:
        rows = outcomes(raw, OPTIONS).orderBy("seq").collect()
        assert [r["detected_format"] for r in rows] == ["gate", "syslog", "gate", "json", "cef", "unknown"]
        first = rows[0]
        assert (first["timestamp"], first["src_ip"], first["action"], first["severity"], first["status"],
                first["parser_confidence"]) == (
            "2026-05-01T10:00:00Z", "10.9.8.7", "deny", "high", "normalized", "high")
        assert (rows[2]["status"], rows[2]["error_reason"]) == ("parse_error", "fields")
        assert spark.range(1).select(detect_format(F.lit(GATE))).first()[0] == "gate"
        # The vocabulary of stored formats knows it too.
        store = EventStore(spark, folder)
        tables.write_outcomes(outcomes(raw, OPTIONS), store.outcome_path, "one")
        assert store.events().filter("source_format = 'gate'").count() == 1
    finally:
        formats.unregister("gate")
    after = [r["detected_format"] for r in outcomes(raw, OPTIONS).orderBy("seq").collect()]
    assert after == before
