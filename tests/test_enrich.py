"""Country, known-bad flag, display time, and joins on skewed keys."""

from __future__ import annotations

import ipaddress
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loglathe.contracts import GEO_RANGES
from loglathe.functions.clock import ist_display
from loglathe.operators import enrich
from loglathe.operators.skew import attach_by_key
from loglathe.sources import dimensions


def frame(spark, ips):
    return spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "i int, src_ip string")


@pytest.mark.parametrize("small", [True, False])
def test_first_matching_range_wins(spark, small):
    cases = {
        "192.168.5.6": "India", "10.20.30.40": "United States", "172.21.1.1": "Brazil",
        "172.18.0.9": "United States", "8.8.8.8": None, "010.1.1.1": None, "::1": None,
        " 10.1.1.1 ": "United States", "": None, None: None, "300.1.1.1": None, "10.1.1": None,
        "not an address": None, "203.0.113.255": "United Kingdom",
    }
    df = enrich.with_country(frame(spark, cases), dimensions.geo_ranges(spark), small=small)
    got = {r["src_ip"]: r["src_country"] for r in df.collect()}
    assert got == cases


def test_ranges_against_brute_force(spark):
    rnd = random.Random(4)
    ips = [f"{rnd.choice([10, 172, 192, 100, 198])}.{rnd.choice([18, 20, 64, 168, 127])}."
           f"{rnd.randint(0, 11)}.{rnd.randint(0, 255)}" for _ in range(500)]
    networks = [(ipaddress.ip_network(cidr), country) for cidr, country in GEO_RANGES]

    def look_up(ip, longest):
        hits = [(n, c) for n, c in networks if ipaddress.ip_address(ip) in n]
        if longest:
            hits.sort(key=lambda hit: -hit[0].prefixlen)
        return hits[0][1] if hits else None

    ranges = dimensions.geo_ranges(spark)
    for policy in (enrich.FIRST_MATCH, enrich.LONGEST_PREFIX):
        rows = enrich.with_country(frame(spark, ips), ranges, policy=policy).orderBy("i").collect()
        assert [r["src_country"] for r in rows] == [
            look_up(ip, policy == enrich.LONGEST_PREFIX) for ip in ips]


def write(folder, name, text):
    with open(f"{folder}/{name}", "w", encoding="utf-8") as f:
        f.write(text)
    return f"{folder}/{name}"


def test_ranges_from_a_file(spark, folder):
    path = write(folder, "r.csv", "cidr,country\n 10.9.9.9/8 , Here \n10.0.0.0/16,There\n"
                 "8.8.8.8,Single\n2001:db8::/32,Six\n")
    ranges = dimensions.geo_ranges(spark, path)
    assert [(r["ord"], r["cidr"], r["country"]) for r in ranges.orderBy("ord").collect()] == [
        (1, "10.9.9.9/8", "Here"), (2, "10.0.0.0/16", "There"), (3, "8.8.8.8", "Single"),
        (4, "2001:db8::/32", "Six")]
    df = enrich.with_country(frame(spark, ["10.0.0.1", "8.8.8.8", "8.8.8.9"]), ranges)
    assert {r["src_ip"]: r["src_country"] for r in df.collect()} == {
        "10.0.0.1": "Here", "8.8.8.8": "Single", "8.8.8.9": None}


@pytest.mark.parametrize("cidr", ["10.0.0.0/33", "10.0.0/8", "nonsense", "10.0.0.0/x"])
def test_malformed_range_fails(spark, folder, cidr):
    path = write(folder, "r.csv", f"cidr,country\n10.0.0.0/8,A\n{cidr},B\n")
    with pytest.raises(PySparkException, match="not an address range"):
        dimensions.geo_ranges(spark, path).collect()


def test_missing_range_file_fails(spark, folder):
    with pytest.raises(PySparkException):
        dimensions.geo_ranges(spark, f"{folder}/none.csv").collect()


@pytest.mark.parametrize("small", [True, False])
def test_known_bad(spark, small):
    cases = {"203.0.113.55": True, "10.10.10.5": True, " 192.0.2.50 ": True, "192.168.5.6": False,
             "8.8.8.8": False, "": False, None: False}
    df = enrich.with_known_bad(frame(spark, cases), dimensions.known_bad_ips(spark), small=small)
    assert {r["src_ip"]: r["src_flagged_bad"] for r in df.collect()} == cases


def test_indian_time(spark):
    cases = {
        "2026-08-25T14:32:07Z": "25 Aug 2026, 08:02:07 PM IST",
        "2026-08-25T20:15:00Z": "26 Aug 2026, 01:45:00 AM IST",
        "2026-01-01T00:00:00Z": "01 Jan 2026, 05:30:00 AM IST",
        "not a real timestamp": "not a real timestamp",
        "2026-08-25T14:32:07": "2026-08-25T14:32:07",
        "2026-99-25T14:32:07Z": "2026-99-25T14:32:07Z",
        None: None,
    }
    df = spark.createDataFrame([(t,) for t in cases], "t string")
    assert [r["x"] for r in df.select(ist_display(F.col("t")).alias("x")).collect()] == list(
        cases.values())


def test_hot_keys_are_split_off(spark):
    """A third of the rows share one key, others are absent from the table or null."""
    rows = [(i, "hot" if i % 3 == 0 else "gone" if i % 7 == 0 else None if i % 5 == 0
             else f"k{i % 40}") for i in range(3000)]
    big = spark.createDataFrame(rows, "i int, k string")
    dim = spark.createDataFrame([("hot", 1)] + [(f"k{j}", j) for j in range(40)], "k string, v int")
    expected = {i: 1 if k == "hot" else None if k in (None, "gone") else int(k[1:])
                for i, k in rows}
    for hot_keys in (1, 2, 64):
        got = attach_by_key(big, dim, "k", small=False, hot_keys=hot_keys).collect()
        assert len(got) == 3000
        assert {r["i"]: r["v"] for r in got} == expected
