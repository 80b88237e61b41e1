"""Column helpers for addresses, names and flow classification. All are native expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def ipv4_to_int(ip: Column) -> Column:
    """A dotted quad as BIGINT; null for IPv6 and null."""
    octet = lambda k: F.try_element_at(F.split(ip, r"\."), F.lit(k)).try_cast("bigint")
    value = F.shiftleft(octet(1), 24) + F.shiftleft(octet(2), 16) + F.shiftleft(octet(3), 8) + octet(4)
    return F.when(~ip.contains(":"), value)


_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_QUAD = rf"{_OCTET}(?:\.{_OCTET}){{3}}"


def normalized_ip(ip: Column) -> Column:
    """The normal form of an IPv4 or IPv6 address (RFC 5952, mapped IPv4 dotted, the zone kept), null for other texts."""
    return F.when(ip.rlike(rf"\A{_QUAD}\z"), ip).when(F.contains(ip, F.lit(":")), _normalized_ipv6(ip))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once, however often f uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _normalized_ipv6(ip: Column) -> Column:
    def plain(body: Column) -> Column:
        """A dotted tail as two groups."""
        pair = lambda octets, k: F.lower(F.hex(F.get(octets, F.lit(k)).try_cast("bigint") * 256 + F.get(octets, F.lit(k + 1)).try_cast("bigint")))
        grouped = lambda octets: F.concat(F.regexp_replace(body, r"[^:]*\z", ""), pair(octets, 0), F.lit(":"), pair(octets, 2))
        return F.when(body.rlike(rf":{_QUAD}\z"), _let(F.split(F.regexp_extract(body, r"([^:]*)\z", 1), r"\."), grouped)).otherwise(body)

    def groups(text: Column) -> Column:
        """Eight groups, those that :: stands for as zeros; null for other texts."""
        some = r"(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4})*)?"
        cut = lambda x: F.filter(F.split(x, ":"), lambda y: y != "")
        sides = F.struct(cut(F.substring_index(text, "::", 1)).alias("a"), cut(F.regexp_extract(text, r"::(.*)\z", 1)).alias("b"))
        filled = lambda x: F.when(F.size(x["a"]) + F.size(x["b"]) <= 7, F.concat(x["a"], F.array_repeat(F.lit("0"), F.greatest(8 - F.size(x["a"]) - F.size(x["b"]), F.lit(0))), x["b"]))
        return F.when(text.rlike(r"\A(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}\z"), cut(text)).when(text.rlike(rf"\A{some}::{some}\z"), _let(sides, filled))

    def shortened(joined: Column) -> Column:
        """The longest run of zero groups, the first of equals, becomes ::; mapped IPv4 is dotted."""
        out = joined
        for k in range(2, 9):
            run = rf"\A(?:(.*?):)??0(?::0){{{k - 1}}}(?::(.*))?\z"
            out = F.when(joined.rlike(run), F.regexp_replace(joined, run, "$1::$2")).otherwise(out)
        number = lambda k: F.conv(F.get(F.split(joined, ":"), F.lit(k)), 16, 10).cast("bigint")
        octets = [F.shiftright(number(6), 8), number(6).bitwiseAND(F.lit(255)), F.shiftright(number(7), 8), number(7).bitwiseAND(F.lit(255))]
        return F.when(joined.startswith("0:0:0:0:0:ffff:"), F.concat(F.lit("::ffff:"), F.concat_ws(".", *[x.cast("string") for x in octets]))).otherwise(out)

    zone = F.regexp_extract(ip, r"(?s)\A[^%]*(%[^%]+)\z", 1)
    text = _let(F.lower(F.substring_index(ip, "%", 1)), plain)
    joined = _let(text, lambda x: F.array_join(F.transform(groups(x), lambda g: F.regexp_replace(g, r"\A0+(?=.)", "")), ":"))
    return F.when(~F.contains(ip, F.lit("%")) | (zone != ""), F.concat(_let(joined, shortened), zone))


def is_private_ipv6(ip: Column) -> Column:
    """Unique local (fc00::/7) or link-local (fe80::/10)."""
    return ip.contains(":") & F.lower(ip).rlike("^(f[cd]|fe[89ab])")


def parent_domain(name: Column) -> Column:
    """The last two labels; a name of one label stays."""
    return F.substring_index(name, ".", -2)


def protocol_name(name: Column, protocol: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("IP-"), protocol.cast("string")))


def app_protocol(protocols: Column) -> Column:
    return F.coalesce(F.get(protocols, F.lit(0)), F.lit("none"))


def responder_name(tls_names: Column, http_hosts: Column, dns_names: Column) -> Column:
    """TLS name, else HTTP host without its port (brackets of IPv6 stay), else DNS name."""
    host = F.regexp_replace(F.get(http_hosts, F.lit(0)), r"^(\[[^\]]*\]|[^:]*):[0-9]+$", "$1")
    return F.coalesce(F.get(tls_names, F.lit(0)), host, F.get(dns_names, F.lit(0)))


def direction(initiator_is_internal: Column, responder_is_internal: Column) -> Column:
    return (
        F.when(initiator_is_internal & responder_is_internal, "internal").when(initiator_is_internal, "outbound").when(responder_is_internal, "inbound").otherwise("external")
    )


def record_id(sensor_id: Column, capture_id: Column, flow_id: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("\u001f", sensor_id, capture_id, flow_id.cast("string")), 256), 1, 32)


def utc_text(ts: Column) -> Column:
    """A timestamp as text with its offset; the session's time zone is UTC."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("+00"))


def severity_rank(severity: Column) -> Column:
    return F.when(severity == "critical", 0).when(severity == "high", 1).when(severity == "medium", 2).when(severity == "low", 3).otherwise(4)
