"""Hash keys, hashdiffs and deterministic ids as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SEPARATOR = "||"  # fixed value: separator between hashed fields


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dv_hash(*cols) -> Column:
    """Data Vault hash key: md5 over the '||'-joined string forms.

    NULL becomes the empty string, so field positions are kept
    (``dv_hash('a', NULL)`` hashes ``a||``).
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws(HASH_SEPARATOR, *parts))


def dv_hashdiff(*cols) -> Column:
    """Hashdiff of a satellite payload; same construction as the hash key."""
    return dv_hash(*cols)


def stable_uuid(namespace: str, name) -> Column:
    """RFC 4122 version-5 UUID of ``name`` in ``namespace`` (SHA-1 based).

    Pure built-ins: sha1(namespace bytes || utf-8 name), first 16 bytes, then
    the version nibble set to 5 and the variant bits to 10xx.
    """
    ns_hex = namespace.replace("-", "").lower()
    digest = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(_col(name).cast("string"), "UTF-8")))
    h = F.substring(digest, 1, 32)
    variant = F.lower(F.hex(
        (F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3)).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
