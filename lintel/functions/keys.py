"""Keys: SHA-1 of listings and evidence, name-based UUIDs of buildings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Name space of urls (RFC 4122).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def _bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def joined(*cols: Column) -> Column:
    """Parts with | between them, null as empty."""
    return F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cols])


def sha1_key(*cols: Column) -> Column:
    return F.sha1(_bytes(joined(*cols)))


def legacy_key(name: Column, address: Column) -> Column:
    return F.substring(sha1_key(name, address), 1, 32)


def evidence_key(given: Column, url: Column, raw: Column) -> Column:
    """The evidence id of a row, else its url and a hash of its raw text."""
    return F.coalesce(F.nullif(F.trim(F.coalesce(given, F.lit(""))), F.lit("")), F.concat(url, F.lit("#r="), F.substring(sha1_key(raw), 1, 16)))


def uuid5(name: Column) -> Column:
    """Name-based UUID (version 5) in the url name space."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), _bytes(name)))
    variant = F.substring(F.lit("89ab"), F.pmod(F.conv(F.substring(h, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1, F.lit(1))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12))


def building_key(norm_name: Column, norm_address: Column) -> Column:
    return uuid5(joined(norm_name, norm_address))
