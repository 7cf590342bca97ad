"""Hash-derived values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastegrid.functions.binding import let

EMBEDDING_DIM = 384
_DIGEST_BYTES = 16


def cache_key(**fields: Column) -> Column:
    """SHA-256 of the sorted-key JSON of the request fields."""
    ordered = [fields[k].alias(k) for k in sorted(fields)]
    return F.sha2(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}), 256)


def _hex_int(h: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(h, start, digits), 16, 10).cast("long")


def ab_bucket(experiment: Column, user: Column) -> Column:
    """(md5 as a 128-bit integer mod 1000) / 1000, folded over four 32-bit pieces."""
    digest = F.md5(F.concat(experiment, F.lit(":"), user.cast("string")))
    shift = (1 << 32) % 1000
    folded = F.lit(0).cast("long")
    for piece in range(4):
        folded = (folded * shift + _hex_int(digest, 8 * piece + 1, 8)) % 1000
    return folded / F.lit(1000.0)


def hash_bucket(c: Column, seed: int, buckets: int = 10_000) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), c.cast("string")))
    return _hex_int(digest, 1, 8) % buckets


def digest_vector(c: Column, dim: int = EMBEDDING_DIM) -> Column:
    """Fallback embedding: the 16 md5 bytes of the lower-cased text, tiled to ``dim``, mapped to [-1, 1]."""
    one = let(
        F.md5(F.lower(c)),
        lambda digest: F.transform(
            F.sequence(F.lit(0), F.lit(min(dim, _DIGEST_BYTES) - 1)),
            lambda i: F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 127.5 - 1.0,
        ),
    )
    if dim <= _DIGEST_BYTES:
        return one
    tiled = F.flatten(F.array_repeat(one, -(-dim // _DIGEST_BYTES)))
    return tiled if dim % _DIGEST_BYTES == 0 else F.slice(tiled, 1, dim)
