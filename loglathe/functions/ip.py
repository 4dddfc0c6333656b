"""IPv4 arithmetic as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:0|[1-9]\d{0,2})"
_IPV4 = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def ipv4_number(address: Column) -> Column:
    """Dotted text to its BIGINT value; null unless strictly valid (no leading zeros)."""
    octets = [F.split_part(address, F.lit("."), F.lit(i)).try_cast("int") for i in (1, 2, 3, 4)]
    in_range = (octets[0] < 256) & (octets[1] < 256) & (octets[2] < 256) & (octets[3] < 256)
    value = (octets[0].cast("bigint") * 16777216 + octets[1] * 65536
             + octets[2] * 256 + octets[3])
    return F.when(address.rlike(_IPV4) & in_range, value)


def network_number(value: Column, prefix_len: Column | int) -> Column:
    """The leading ``prefix_len`` bits of an address."""
    if isinstance(prefix_len, int):
        return F.shiftright(value, 32 - prefix_len)
    # The shift distance of ``shiftright`` is a literal in the Python API.
    return F.call_function("shiftright", value, F.lit(32) - prefix_len)
