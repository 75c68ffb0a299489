"""Column-level helpers (all built-in expressions, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "c", "tolerant_double", "oss_key", "umts_sort_key", "sector_layer",
    "site_from_cell", "hour_text", "day_stamp", "quarter_hour",
    "pk_date_of", "pk_hr_of", "run_uuid", "run_id", "daily_run_id",
    "export_key", "ts_text", "round_half_away", "UNASSIGNED",
]

# Fixed values that must match the reference's output.
UNASSIGNED = "unassigned"          # default for lookup attributes without a match
DAILY_HOUR_TOKEN = "24"            # run-id / file-name hour token for daily output
SECTOR_LAYER_U = "AWS"             # UMTS cells whose name starts with 'U'
SECTOR_LAYER_OTHER = "PCS"         # every other UMTS cell
SITE_PREFIX = "U"                  # site = 'U' + characters 2..9 of the cell name
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
HOUR_TEXT_FORMAT = "yyyy-MM-dd HH:00:00"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tolerant_double(x) -> Column:
    """Text counter -> double; unparseable text becomes NULL (never raises)."""
    return c(x).try_cast("double")


def oss_key(x) -> Column:
    """Case-insensitive OSS join key."""
    return F.upper(c(x))


def umts_sort_key(cell) -> Column:
    """First, last and last-but-one character of the cell name."""
    cell = c(cell)
    return F.concat(F.substring(cell, 1, 1), F.substring(cell, -1, 1), F.substring(cell, -2, 1))


def sector_layer(cell) -> Column:
    return F.when(F.substring(c(cell), 1, 1) == SITE_PREFIX, F.lit(SECTOR_LAYER_U)).otherwise(F.lit(SECTOR_LAYER_OTHER))


def site_from_cell(cell) -> Column:
    return F.concat(F.lit(SITE_PREFIX), F.substring(c(cell), 2, 8))


def hour_text(ts) -> Column:
    return F.date_format(c(ts), HOUR_TEXT_FORMAT)


def ts_text(ts) -> Column:
    return F.date_format(c(ts), TS_TEXT_FORMAT)


def day_stamp(ts) -> Column:
    return F.date_trunc("day", c(ts))


def quarter_hour(ts) -> Column:
    """Start of the 15-minute reporting period containing ``ts``."""
    ts = c(ts)
    return F.date_trunc("hour", ts) + F.make_dt_interval(
        mins=(F.floor(F.minute(ts) / 15) * 15).cast("int"))


def pk_date_of(ts) -> Column:
    return F.date_format(c(ts), "yyyy-MM-dd")


def pk_hr_of(ts) -> Column:
    return F.date_format(c(ts), "HH")


def run_uuid(run_token, market) -> Column:
    """Deterministic uuid-shaped id, one per (run, market).

    Replaces a random uuid per market so reruns of a failed task produce the
    same value.
    """
    h = F.md5(F.concat_ws("|", F.lit(run_token) if isinstance(run_token, str) else run_token, c(market)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def run_id(hour, uuid_col) -> Column:
    """'<HH>-<uuid>' for an hourly report row."""
    return F.concat(F.lpad(c(hour).cast("string"), 2, "0"), F.lit("-"), c(uuid_col))


def daily_run_id(uuid_col) -> Column:
    return F.concat(F.lit(DAILY_HOUR_TOKEN + "-"), c(uuid_col))


def export_key(prefix, date, suffix, market, hour=None, family=None) -> Column:
    """Output file key: <prefix>_<date>_<suffix>_<MARKET-WITH-DASHES>[_<HH>][_<family-with-dashes>].

    suffix is lower-cased, market upper-cased with spaces turned into dashes,
    hour zero-padded, family underscores turned into dashes.
    """
    parts = [F.lit(prefix) if isinstance(prefix, str) else prefix,
             c(date).cast("string"),
             F.lower(c(suffix)),
             F.upper(F.regexp_replace(c(market), " ", "-"))]
    if hour is not None:
        parts.append(F.lpad(c(hour).cast("string"), 2, "0"))
    if family is not None:
        parts.append(F.regexp_replace(c(family), "_", "-"))
    return F.concat_ws("_", *parts)


def round_half_away(x, digits: int = 4) -> Column:
    """Round a double to ``digits`` decimals, halves away from zero, with plain
    arithmetic (scale, floor(|y| + 0.5), unscale) — the way SQL engines round
    doubles. ``round()`` on a double goes through a decimal per value, about
    twice as slow on wide reports. NaN and values beyond exact double
    integers pass through unchanged."""
    if isinstance(x, str):                   # a column's name: as text, one call (wide reports round hundreds)
        n, scale = f"`{x}`", f"{10 ** digits}D"
        return F.expr(f"CASE WHEN isnan({n}) OR abs({n}) * {scale} >= 4.0E15D THEN {n} "
                      f"ELSE signum({n}) * CAST(floor(abs({n}) * {scale} + 0.5D) AS DOUBLE) / {scale} END")
    x = c(x)
    scale = float(10 ** digits)
    y = F.abs(x) * scale
    return F.when(F.isnan(x) | (y >= 4.0e15), x).otherwise(
        F.signum(x) * F.floor(y + 0.5).cast("double") / scale)
