"""Scalar Column expressions (F1-F16). All JVM-side, no UDFs.

ANSI mode stays on: every division is ``try_divide`` (NULL instead of a
DIVIDE_BY_ZERO error) and every text-to-number conversion is ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barforge.schema import PCT_DECIMAL, PRICE_DECIMAL, VOLUME_DECIMAL

# Freshness limits in seconds and their labels, the signed-percent
# pattern, the axis pad fraction and the unsigned decimal-number syntax.
FRESH_LIVE_S = 180
FRESH_LAGGING_S = 360
FRESH_LABELS = ("Live", "Lagging", "Stale")
SIGNED_2DP = "+0.00;-0.00"
AXIS_PAD_FRACTION = 0.08
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pct_change(open_col, close_col) -> Column:
    """F1: percent move open -> close; 0.0 when open is NULL or 0 (0.42 means +0.42 %)."""
    o, c = _c(open_col), _c(close_col)
    return F.when(o.isNull() | (o == 0), F.lit(0.0)).otherwise(F.try_divide(c - o, o) * 100.0)


def exceeds(pct, threshold: float) -> Column:
    """alert predicate, strictly above the threshold (NaN counts as above)."""
    return F.abs(_c(pct)) > F.lit(float(threshold))


def signed_pct_text(pct) -> Column:
    """'+0.42' / '-0.50': two decimals, half-even on the exact binary value."""
    return F.call_function("format_number", _c(pct), F.lit(SIGNED_2DP))


def hhmm(ts) -> Column:
    return F.date_format(_c(ts), "HH:mm")


def alert_message(symbol, pct, window_start, window_end) -> Column:
    """'<symbol> moved +0.42% in the 14:32-14:33 window'."""
    return F.concat(
        _c(symbol),
        F.lit(" moved "),
        signed_pct_text(pct),
        F.lit("% in the "),
        hhmm(window_start),
        F.lit("-"),
        hhmm(window_end),
        F.lit(" window"),
    )


def parse_ts(text) -> Column:
    """RFC 3339 text -> TIMESTAMP; unparseable text is NULL (never an error)."""
    return F.try_to_timestamp(_c(text))


def direction(x) -> Column:
    """'up' when x >= 0, 'down' below, NULL stays NULL."""
    x = _c(x)
    return F.when(x >= 0, F.lit("up")).when(x < 0, F.lit("down"))


def age_seconds(as_of, ts) -> Column:
    """Fractional seconds from ts to as_of (microsecond precision)."""
    return (F.unix_micros(_c(as_of)) - F.unix_micros(_c(ts))) / 1_000_000.0


def freshness_state(age_s) -> Column:
    """Live up to 180 s, Lagging up to 360 s, else Stale."""
    a = _c(age_s)
    live, lagging, stale = FRESH_LABELS
    return (
        F.when(a <= FRESH_LIVE_S, F.lit(live))
        .when(a <= FRESH_LAGGING_S, F.lit(lagging))
        .when(a.isNotNull(), F.lit(stale))
    )


def age_text(age_s) -> Column:
    """'{m}m {s}s', or '{s}s' under a minute; whole seconds, floor divmod."""
    whole = _c(age_s).cast("long")
    mins = F.floor(whole / 60).cast("long")
    secs = whole - mins * 60
    return F.when(
        mins != 0,
        F.concat(mins.cast("string"), F.lit("m "), secs.cast("string"), F.lit("s")),
    ).otherwise(F.concat(secs.cast("string"), F.lit("s")))


def preferred_price(live_price, last_close) -> Column:
    """F8: live tick price when there is one, else the last candle close."""
    return F.coalesce(_c(live_price), _c(last_close))


def kpi_change(price, first_open, n_candles) -> Column:
    """change vs the slice's first open; NULL with <2 candles or a zero open."""
    p, o, n = _c(price), _c(first_open), _c(n_candles)
    return F.when((n >= 2) & (o != 0), F.try_divide(p - o, o) * 100.0)


def range_move(first_open, last_close) -> Column:
    """move over the visible range; 0.0 when the first open is 0 or NULL."""
    o, c = _c(first_open), _c(last_close)
    return F.coalesce(F.try_divide(c - o, F.when(o != 0, o)) * 100.0, F.lit(0.0))


def typical_price(high, low, close) -> Column:
    """(H + L + C) / 3."""
    return (_c(high) + _c(low) + _c(close)) / 3.0


def axis_pad(lo, hi) -> Column:
    """8 % of the range, or 1.0 when the range is exactly 0."""
    pad = (_c(hi) - _c(lo)) * AXIS_PAD_FRACTION
    return F.when(pad == 0, F.lit(1.0)).otherwise(pad)


def clean_number(x) -> Column:
    """NULL / NaN / unparseable -> 0.0."""
    d = _c(x).try_cast("double")
    return F.coalesce(F.nanvl(d, F.lit(0.0)), F.lit(0.0))


def money_text(x) -> Column:
    """'$1,234.50'."""
    return F.concat(F.lit("$"), F.format_number(_c(x), 2))


def to_stored_price(x) -> Column:
    """double -> DECIMAL(20,8), half-up; overflow gives NULL, not an error."""
    return _c(x).try_cast(PRICE_DECIMAL)


def to_stored_volume(x) -> Column:
    return _c(x).try_cast(VOLUME_DECIMAL)


def to_stored_pct(x) -> Column:
    return _c(x).try_cast(PCT_DECIMAL)


RFC3339_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def trade_json(*cols: str) -> Column:
    """F16: serialise trade fields to one JSON object text (ts as RFC 3339, micros)."""
    names = cols or ("symbol", "price", "size", "side", "trade_id", "ts")
    return F.to_json(F.struct(*[F.col(c) for c in names]), {"timestampFormat": RFC3339_MICROS})


def strict_double(text) -> Column:
    """Plain decimal-number text -> double; anything else (nan, inf, '1f', '') -> NULL."""
    t = _c(text)
    return F.when(t.rlike(DECIMAL_TEXT), F.trim(t).try_cast("double"))


def round_to(x, places: int = 8) -> Column:
    """Round a floating result to the stored scale (8 places, as DECIMAL(20,8))."""
    return F.round(_c(x), places)
