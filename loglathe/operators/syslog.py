"""Syslog lines with firewall and VPN message bodies."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from loglathe.functions.clock import bsd_as_iso
from loglathe.functions.text import capture
from loglathe.operators.fields import found_struct
from loglathe.operators.stages import Stages

# Message shapes (fixed values). ``(?d)``: only a line feed ends a line.
_HEADER = r"(?d)^([A-Z][a-z]{2})\s+(\d{1,2})\s+(\d{2}:\d{2}:\d{2})\s+(\S+)\s+(.+)$"
_TAG = r"(?d)^%([A-Z0-9]+)-(\d+)-(\d+):\s*(.+)$"
_DENY = (
    r"(?si)^.*?Deny\s+(\w+)\s+src\s+\S+:(\d+\.\d+\.\d+\.\d+)/(\d+)\s+"
    r"dst\s+\S+:(\d+\.\d+\.\d+\.\d+)/(\d+).*$"
)
_BUILT = (
    r"(?si)^.*?Built\s+\w+\s+(\w+)\s+connection.*?outside:(\d+\.\d+\.\d+\.\d+)/(\d+).*?"
    r"inside:(\d+\.\d+\.\d+\.\d+)/(\d+).*$"
)
_VPN = (
    r"(?si)^.*?Group\s+<([^>]+)>\s+User\s+<([^>]+)>\s+IP\s+<(\d+\.\d+\.\d+\.\d+)>\s+(.+)$"
)


@cache
def syslog_stages(only: bool, assumed_year: int | None) -> Stages:
    """``_syslog``, the texts found in ``_text``; null for lines of other formats.

    ``only`` says that all lines are syslog. Without ``assumed_year`` the year of
    ingestion completes a date.
    """
    when = F.lit(True) if only else F.col("detected_format") == "syslog"
    year = (F.substring("ingested_at", 1, 4) if assumed_year is None
            else F.lit(f"{assumed_year:04d}"))
    head = [F.get("_sys_head", F.lit(i)) for i in range(5)]
    tag = [F.get("_sys_tag", F.lit(i)) for i in range(4)]
    part = [F.get("_sys_body", F.lit(i)) for i in range(6)]
    body = F.col("_sys_text")
    flow = part[0] != "vpn"
    action = (
        F.when(part[0] == "deny", "deny").when(part[0] == "built", "allow")
        .when(F.contains(F.lower(part[4]), F.lit("established")), "allow")
    )
    error = (
        F.when(F.col("_sys_head").isNull(), "header")
        .when(F.col("_sys_time").isNull(), "timestamp")
        .when(F.col("_sys_body").isNull(), "body")
    )
    return [
        {"_sys_head": F.when(when, capture(F.col("_text"), _HEADER, 5))},
        {"_sys_message": head[4],
         "_sys_tag": capture(head[4], _TAG, 4),
         "_sys_time": bsd_as_iso(head[0], head[1], head[2], year)},
        {"_sys_text": F.coalesce(tag[3], F.col("_sys_message"))},
        # The message types in order of precedence; an array of its fields behind its name.
        {"_sys_body": F.coalesce(
            F.concat(F.array(F.lit("deny")), capture(body, _DENY, 5)),
            F.concat(F.array(F.lit("built")), capture(body, _BUILT, 5)),
            F.concat(F.array(F.lit("vpn")), capture(body, _VPN, 4)))},
        {"_syslog": F.when(when, found_struct(
            time=F.col("_sys_time"),
            src_ip=F.when(flow, part[2]).otherwise(part[3]),
            dst_ip=F.when(flow, part[4]),
            src_port=F.when(flow, part[3]),
            dst_port=F.when(flow, part[5]),
            action=action,
            protocol=F.when(flow, part[1]),
            device_vendor=F.when(F.startswith("_sys_message", F.lit("%ASA-")), "Cisco"),
            severity=tag[1],
            error_reason=error))},
    ]
