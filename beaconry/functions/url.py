"""URL pieces of inbound requests and outbound origins."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from beaconry.functions.text import let

# Schemes with a default port, which is left blank.
DEFAULT_PORTS = {"http": 80, "https": 443, "ws": 80, "wss": 443, "ftp": 21}

def inbound_path(url: Column) -> Column:
    """Text before ``?``; an empty URL is ``/`` but ``?x`` stays empty."""
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("/")).otherwise(F.substring_index(url, "?", 1))


def outbound_path(path: Column) -> Column:
    return inbound_path(path)


def _split_authority(authority: Column) -> Column:
    """Struct of host and port text of an authority, credentials left out."""

    def parts(hp: Column) -> Column:
        bracket = hp.startswith("[")
        return F.struct(
            F.when(bracket, F.concat(F.substring_index(hp, "]", 1), F.lit("]")))
            .otherwise(F.substring_index(hp, ":", 1)).alias("host"),
            F.when(bracket, F.when(F.contains(hp, F.lit("]:")), F.substring_index(hp, "]:", -1)).otherwise(F.lit("")))
            .when(F.contains(hp, F.lit(":")), F.substring_index(hp, ":", -1))
            .otherwise(F.lit("")).alias("port"),
        )

    return let(F.substring_index(authority, "@", -1), parts)


def parse_origin(origin: Column) -> Column:
    """Struct of host and port of an origin URL.

    Web schemes: lower-case host, the default port blank. Other schemes: the authority as written.
    Text that is no URL: scheme stripped, cut at ``/`` and split at ``:``.
    """
    ports = F.create_map(*[F.lit(x) for kv in DEFAULT_PORTS.items() for x in kv])
    pair = lambda h, p: F.struct(h.alias("host"), p.alias("port"))

    def by_hand(o: Column) -> Column:
        return let(
            F.substring_index(F.regexp_replace(o, r"(?i)^[a-z]+://", ""), "/", 1),
            lambda hp: pair(F.substring_index(hp, ":", 1), F.coalesce(F.get(F.split(hp, ":"), F.lit(1)), F.lit(""))),
        )

    def web(o: Column, default: Column) -> Column:
        rest = F.regexp_extract(o, r"^[a-zA-Z]+:[/\\]*([^/\\?#]*)", 1)

        def read(a: Column) -> Column:
            host, port = a["host"], a["port"]
            number = F.when(port.rlike(r"^[0-9]{1,5}\z"), port.cast("int"))
            valid = host.rlike(r"^(?:\[[0-9a-fA-F:.]+\]|[^\s<>^|%:@\[\]]+)\z") & ((port == "") | (number <= 65535))
            shown = F.when((port == "") | (number == default), F.lit("")).otherwise(number.cast("string"))
            return F.when(valid, pair(F.lower(host), shown)).otherwise(by_hand(o))

        return let(_split_authority(rest), read)

    def other(o: Column) -> Column:
        return F.when(
            o.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*://"), _split_authority(F.regexp_extract(o, r"^[^:]*://([^/?#]*)", 1))
        ).otherwise(pair(F.lit(""), F.lit("")))

    def any_origin(o: Column) -> Column:
        return let(
            F.try_element_at(ports, F.lower(F.substring_index(o, ":", 1))),
            lambda default: F.when(default.isNotNull() & F.contains(o, F.lit(":")), web(o, default))
            .when(o.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), other(o))
            .otherwise(by_hand(o)),
        )

    return let(F.coalesce(origin, F.lit("")), any_origin)


def request_target(url: Column) -> Column:
    """What follows scheme and authority of an absolute URL."""
    return F.regexp_replace(url, r"(?i)^[a-z][a-z0-9+.\-]*://[^/?#]*", "")


def request_host(headers: Column, hostname: Column) -> Column:
    """Single ``host`` header, else the framework's host name, else ``unknown``."""
    host = F.try_element_at(headers, F.lit("host"))
    return F.when(F.size(host) == 1, F.get(host, F.lit(0))).otherwise(
        F.coalesce(F.nullif(hostname, F.lit("")), F.lit("unknown"))
    )
