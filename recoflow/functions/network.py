"""Address predicates for target checks, refusing what they cannot read. Addresses are columns; names are never resolved here.

An address is read into hex digits: 8 for IPv4, 32 for IPv6. An IPv6 address that maps an IPv4 one counts as that one. Digits of
one length compare like the numbers, so a block is a range of texts.
"""

from __future__ import annotations

import ipaddress
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

# The metadata address and the blocks that are not public.
METADATA_ADDRESS = "169.254.169.254"
NON_PUBLIC_BLOCKS = ["0.0.0.0/32", "127.0.0.0/8", "169.254.0.0/16", "10.0.0.0/8", "172.16.0.0/12",
                     "192.168.0.0/16", "224.0.0.0/4"]
# Of IPv6 only global unicast is public, without the blocks that carry an IPv4 address out of sight.
PUBLIC_IPV6, TEREDO, SIX_TO_FOUR = "2000::/3", "2001::/32", "2002::/16"
MAPPED = "0" * 20 + "ffff"
_OCTET = r"(25[0-5]|2[0-4]\d|1?\d?\d)"
_DOTTED = rf"{_OCTET}(\.{_OCTET}){{3}}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once; a column used in several places would be copied into each."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _dotted_hex(address: Column) -> Column:
    """Dotted address as 8 hex digits; null for anything else, parts above 255 included."""
    parts = F.split(F.when(address.rlike(rf"^{_DOTTED}$"), address), r"\.")
    return F.array_join(F.transform(parts, lambda p: F.lpad(F.lower(F.hex(p.cast("int"))), 2, "0")), "")


def _groups(side: Column) -> Column:
    return F.when(side == "", F.array().cast("array<string>")).otherwise(F.split(side, ":"))


def _ipv6_hex(address: Column) -> Column:
    """IPv6 text (one ``::`` at most, also with a dotted end) as 32 hex digits; null for anything else, zones included."""
    def without_dots(text: Column) -> Column:
        head, tail = F.regexp_extract(text, r"^(.*:)[0-9.]+$", 1), _dotted_hex(F.regexp_extract(text, rf":({_DOTTED})$", 1))
        joined = _let(tail, lambda t: F.concat(head, F.substring(t, 1, 4), F.lit(":"), F.substring(t, 5, 4)))
        return F.when(text.contains("."), joined).otherwise(text)

    return _let(F.split(without_dots(F.lower(address)), "::", -1), _joined_groups)


def _joined_groups(sides: Column) -> Column:
    short = F.size(sides) == 2
    left, right = _groups(sides[0]), F.when(short, _groups(F.get(sides, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    given = F.size(left) + F.size(right)
    good = (F.size(sides) <= 2) & F.when(short, given <= 7).otherwise(given == 8) & F.forall(
        F.concat(left, right), lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    filled = F.concat(left, F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - given, F.lit(0))), right)
    return F.when(good, F.array_join(F.transform(filled, lambda g: F.lpad(g, 4, "0")), ""))


def address_hex(address: Column) -> Column:
    """Hex digits of an address, 8 or 32 of them; null for what is neither IPv4 nor IPv6."""
    six = _let(_ipv6_hex(address), lambda d: F.when(F.startswith(d, F.lit(MAPPED)), F.substring(d, 25, 8)).otherwise(d))
    return F.when(address.contains(":"), six).otherwise(_dotted_hex(address))


def ipv4_number(address: Column) -> Column:
    """Dotted address as a number; null for anything else, parts above 255 included."""
    return F.conv(_dotted_hex(address), 16, 10).cast("bigint")


def _range(cidr: str) -> tuple[str, str]:
    network = ipaddress.ip_network(cidr, strict=False)
    digits = network.max_prefixlen // 4
    low, high = (f"{int(a):0{digits}x}" for a in (network.network_address, network.broadcast_address))
    if digits == 32 and network.prefixlen >= 96 and low.startswith(MAPPED):
        return low[24:], high[24:]
    return low, high


def _within(digits: Column, cidr: str) -> Column:
    low, high = _range(cidr)
    return F.coalesce((F.length(digits) == len(low)) & digits.between(low, high), F.lit(False))


def in_block(address: Column, cidr: str) -> Column:
    """Membership in an IPv4 or IPv6 CIDR block as a range test on the address's digits; an address of the other kind is outside."""
    return _let(address_hex(address), lambda digits: _within(digits, cidr))


def is_public_hex(digits: Column) -> Column:
    """``is_public`` on digits that ``address_hex`` has read, so that a row is read once for many tests."""
    def public_ipv4(carried: Column) -> Column:
        four = carried.isNotNull()
        for block in NON_PUBLIC_BLOCKS:
            four = four & ~_within(carried, block)
        return four

    four = _let(F.when(_within(digits, SIX_TO_FOUR), F.substring(digits, 5, 8)).when(F.length(digits) == 8, digits), public_ipv4)
    six = _within(digits, PUBLIC_IPV6) & ~_within(digits, TEREDO) & ~_within(digits, SIX_TO_FOUR)
    return F.coalesce(four | six, F.lit(False))


def is_public(address: Column) -> Column:
    """True only for addresses that can be read and lie in no block that is not public; null is not public.

    IPv6 is public in 2000::/3 only; mapped and 6to4 addresses are judged by the IPv4 address they carry, Teredo is refused.
    """
    return _let(address_hex(address), is_public_hex)


def is_public_ipv6(address: Column) -> Column:
    """Public, and written as IPv6."""
    return F.coalesce(address.contains(":") & is_public(address), F.lit(False))


def block_parts(cidr: Column) -> tuple[Column, Column]:
    """Digits of a block's address and its prefix length in bits; both null for a text that is no block."""
    parts = F.split(cidr, "/")
    digits = address_hex(parts[0])
    length = F.get(parts, F.lit(1))
    bits = F.when(length.rlike(r"^\d{1,3}$"), length.cast("int"))
    # A mapped block is a block of IPv4.
    bits = F.when((F.length(digits) == 8) & parts[0].contains(":"), bits - 96).otherwise(bits)
    good = (F.size(parts) == 2) & bits.between(0, F.length(digits) * 4)
    return F.when(good, digits), F.when(good, bits)


def prefix_of(digits: Column, bits: Column) -> Column:
    """The first ``bits`` bits of an address's digits, the rest of the last digit cleared."""
    whole, rest = F.floor(bits / 4).cast("int"), (bits % 4).cast("int")
    last = F.conv(F.substring(digits, whole + 1, F.lit(1)), 16, 10).cast("int")
    step = F.pow(F.lit(2), 4 - rest).cast("int")
    return F.concat(F.substring(digits, F.lit(1), whole), F.when(rest > 0, F.lower(F.hex(last - last % step))).otherwise(F.lit("")))


def longest_match(rows: DataFrame, address: str, blocks: DataFrame, cidr: str = "cidr") -> DataFrame:
    """``rows`` with the row of ``blocks`` (as struct ``block``) that holds the address with the longest prefix; null for none.

    Block lists may be tables of any size. Each distinct address is looked up once, by its prefix at every length that
    occurs among the blocks: at most 33 lengths of IPv4 and 129 of IPv6, so the list of lengths is broadcast and the lookup is a
    hash join on (kind, length, prefix). Of equal blocks the first by its other columns counts; unreadable blocks hold nothing.
    """
    digits, bits = block_parts(F.col(cidr))
    read = blocks.select(F.struct(*blocks.columns).alias("block"), digits.alias("_digits"), bits.alias("_bits")).filter("_bits IS NOT NULL")
    keyed = read.select("block", F.length("_digits").alias("_kind"), "_bits", prefix_of(F.col("_digits"), F.col("_bits")).alias("_prefix"))
    once = keyed.groupBy("_kind", "_bits", "_prefix").agg(F.min("block").alias("block"))
    lengths = F.broadcast(once.select("_kind", "_bits").distinct())
    asked = rows.select(F.col(address).alias("_address")).filter(F.col("_address").isNotNull()).distinct()
    asked = asked.withColumn("_digits", address_hex(F.col("_address"))).withColumn("_kind", F.length("_digits"))
    probes = asked.join(lengths, "_kind").withColumn("_prefix", prefix_of(F.col("_digits"), F.col("_bits")))
    found = probes.join(once, ["_kind", "_bits", "_prefix"]).groupBy("_address").agg(F.max_by("block", "_bits").alias("block"))
    return rows.join(found, rows[address] == found["_address"], "left").drop("_address")
