"""Content hashes and the point ids derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the DNS namespace of RFC 4122.
DNS_NAMESPACE = "6ba7b8109dad11d180b400c04fd430c8"


def content_hash(text: Column | str) -> Column:
    return F.sha2(text, 256)


def point_id(name: Column | str) -> Column:
    """Version-5 UUID of `name` in the DNS namespace."""
    name = F.col(name) if isinstance(name, str) else name
    g = F.sha1(F.concat(F.unhex(F.lit(DNS_NAMESPACE)), F.encode(name, "UTF-8")))
    # Byte 8 carries the variant: its two top bits are forced to 10.
    byte8 = F.conv(F.substring(g, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)
    return F.concat_ws(
        "-",
        F.substring(g, 1, 8),
        F.substring(g, 9, 4),
        F.concat(F.lit("5"), F.substring(g, 14, 3)),
        F.concat(F.lower(F.lpad(F.hex(byte8), 2, "0")), F.substring(g, 19, 2)),
        F.substring(g, 21, 12),
    )
