"""Small rules of operation as expressions: masks, back-off, ladders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that tell a lock conflict.
LOCK_CONFLICTS = ("already locked", "lock acquisition failed", "dataset locked", "failed to acquire lock")


def masked(secret: Column) -> Column:
    """Empty stays empty, up to 8 characters become ***, longer ones show four at each end."""
    long = F.concat(F.left(secret, F.lit(4)), F.lit("***"), F.right(secret, F.lit(4)))
    return F.when(secret == "", secret).when(F.length(secret) <= 8, F.lit("***")).otherwise(long)


def requeue_delay(attempts: Column) -> Column:
    """Seconds before a failed job runs again: 30 doubled with each attempt, 1800 at most."""
    return F.least(F.lit(30) * F.power(F.lit(2), F.least(attempts, F.lit(20))), F.lit(1800)).cast("long")


def upload_delay(attempts: Column) -> Column:
    return (attempts * attempts * 10).cast("long")


def startup_delay(attempts: Column) -> Column:
    return F.least(F.lit(2) * F.power(F.lit(2), F.least(attempts, F.lit(20))), F.lit(30)).cast("long")


def severity(failures: Column) -> Column:
    return F.when(failures >= 10, "CRITICAL").when(failures >= 5, "HIGH").otherwise("MEDIUM")


# How severe an alert of a kind is; an update of the registry goes by failures in a row.
SEVERITIES = {"registry start": "CRITICAL", "processing": "HIGH", "upload given up": "CRITICAL", "upload retry": "MEDIUM"}


def alert_severity(kind: Column, failures: Column) -> Column:
    """The severity of an alert by its kind; other kinds climb the ladder of failures."""
    known = F.create_map(*[F.lit(x) for pair in SEVERITIES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, kind), severity(failures))


def health(dead: Column) -> Column:
    return F.when(dead > 500, "unhealthy").when(dead > 100, "warning").otherwise("healthy")


def is_lock_conflict(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("|".join(LOCK_CONFLICTS)), F.lit(False))


def merged_tags(*maps: Column) -> Column:
    """Tag maps as one; of equal keys the value of the last map holds."""
    entries = F.concat(*[F.coalesce(F.map_entries(m), F.expr("cast(array() as array<struct<key: string, value: string>>)")) for m in maps])
    last = F.filter(entries, lambda x, i: ~F.exists(F.slice(entries, i + 2, F.greatest(F.size(entries), F.lit(1))), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(last)


def setting(config: Column, path: str, kind: str = "string", default=None) -> Column:
    """A nested setting of a VARIANT, or the default."""
    value = F.try_variant_get(config, path, kind)
    return value if default is None else F.coalesce(value, F.lit(default))
