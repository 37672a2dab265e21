"""Scalar functions as Column expressions; no Python runs per row.

Casts never throw: what cannot be read is NULL, or the stated default.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .teams import GAME_TYPES, INGESTED, INJURY_MARKERS, POSTSEASON


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- ids, numbers ---------------------------------------------------------------------


def as_id(x: Column | str) -> Column:
    """A provider's id as text: trimmed, '' is NULL."""
    text = F.trim(_c(x).cast("string"))
    return F.when(text != "", text)


def as_id_number(x: Column | str) -> Column:
    """A floating id as text: 147.0 is '147', NaN is NULL, other fractions as they print."""
    x = _c(x).cast("double")
    return F.when(F.isnan(x), None).when(x == F.floor(x), x.cast("bigint").cast("string")).otherwise(x.cast("string"))


def to_int(x: Column | str, default: int | None = None) -> Column:
    """A number in text, cut to an integer; what is not a number is ``default``."""
    number = _c(x).cast("string").try_cast("double")
    got = F.when(~F.isnan(number), number.try_cast("int"))
    return got if default is None else F.coalesce(got, F.lit(default))


def strict_int(x: Column | str) -> Column:
    """An integer in text; '4.7' is NULL."""
    return F.trim(_c(x).cast("string")).try_cast("int")


def strict_float(x: Column | str) -> Column:
    return F.trim(_c(x).cast("string")).try_cast("double")


def nan_to_null(x: Column | str) -> Column:
    x = _c(x)
    return F.when(~F.isnan(x), x)


def rate(n: Column | str, d: Column | str) -> Column:
    """n / d to six places, halves to even; NULL if either is NULL or d is 0."""
    return F.bround(F.try_divide(_c(n).cast("double"), _c(d).cast("double")), 6)


def or_else(x: Column | str, other: Column | str) -> Column:
    """``other`` where x is NULL or 0."""
    x = _c(x)
    return F.coalesce(F.when(x != 0, x), _c(other))


# -- baseball notation ----------------------------------------------------------------


def innings_to_outs(x: Column | str) -> Column:
    """'7.1' is 22 outs: whole innings, then 0, 1 or 2 outs; anything else is NULL."""
    text = F.trim(_c(x).cast("string"))
    whole = F.regexp_extract(text, r"^([0-9]+)(?:\.[0-9]*)?$", 1).try_cast("int")
    part = F.regexp_extract(text, r"^[0-9]+\.([0-9])", 1)
    return F.when(part == "", whole * 3).when(part.isin("0", "1", "2"), whole * 3 + part.try_cast("int"))


def lineup_slot(order: Column | str) -> Column:
    """'101' bats in slot 1."""
    return F.floor(to_int(order) / 100).cast("int")


def substitution_index(order: Column | str) -> Column:
    """'101' is the first substitute of its slot; '100' started."""
    return to_int(order) % 100


def obp(hits: Column, walks: Column, hit_by_pitch: Column, at_bats: Column, sac_flies: Column) -> Column:
    return rate(hits + walks + hit_by_pitch, at_bats + walks + hit_by_pitch + sac_flies)


def whip(walks: Column, hits: Column, outs: Column) -> Column:
    """Walks and hits over innings, where innings are rounded to six places first."""
    return rate(walks + hits, rate(outs, F.lit(3)))


# -- dates and times ------------------------------------------------------------------

EASTERN = "America/New_York"


def parse_utc(text: Column | str) -> Column:
    """An ISO-8601 instant that names its offset, cut to the minute; others are NULL."""
    text = _c(text)
    return F.when(text.rlike(r"T.*(Z|[+-][0-9]{2}:?[0-9]{2})$"), F.date_trunc("minute", F.try_to_timestamp(text)))


def eastern_date(instant: Column | str) -> Column:
    """The calendar date in New York of a UTC instant."""
    return F.to_date(F.from_utc_timestamp(_c(instant), EASTERN))


def season_of(date: Column | str) -> Column:
    return F.year(_c(date))


def season_start(season: Column | str) -> Column:
    return F.make_date(_c(season), F.lit(2), F.lit(1))


def season_end(season: Column | str) -> Column:
    return F.make_date(_c(season), F.lit(12), F.lit(15))


def seasons_between(first: int, last: int) -> list[int]:
    if last < first:
        raise ValueError(f"season {last} is before {first}")
    return list(range(first, last + 1))


def minutes_to_start(tick: Column | str, start: Column | str) -> Column:
    """Negative before the start."""
    return F.timestamp_diff("MINUTE", _c(start), _c(tick)).cast("int")


# -- names and text -------------------------------------------------------------------


def slug(name: Column | str) -> Column:
    """Lower case; runs of anything but letters and digits become one '_', none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(F.trim(_c(name))), r"[^\p{L}\p{N}]+", "_"), F.lit("_"))


def display_name(slugged: Column | str) -> Column:
    return F.initcap(F.replace(_c(slugged), F.lit("_"), F.lit(" ")))


def full_name(first: Column | str, last: Column | str) -> Column:
    name = F.trim(F.concat_ws(" ", F.trim(_c(first)), F.trim(_c(last))))
    return F.when(name != "", name)


def team_name(full: Column | str, short: Column | str) -> Column:
    return F.coalesce(as_id(full), as_id(short))


def game_type_name(code: Column | str) -> Column:
    known = F.create_map(*(F.lit(x) for pair in GAME_TYPES.items() for x in pair))
    return F.coalesce(known[_c(code)], F.lit("Unknown"))


def is_postseason(code: Column | str) -> Column:
    return F.coalesce(_c(code).isin(*POSTSEASON), F.lit(False))


def is_ingested(code: Column | str) -> Column:
    return F.coalesce(_c(code).isin(*INGESTED), F.lit(False))


def is_injury(description: Column | str, kind: Column | str) -> Column:
    text = F.lower(F.concat_ws(" ", _c(description), _c(kind)))
    found = F.lit(False)
    for marker in INJURY_MARKERS:
        found = found | F.contains(text, F.lit(marker))
    return found


def backdated_days(known: Column | str, effective: Column | str) -> Column:
    return F.datediff(_c(known), _c(effective))


def is_backdated(known: Column | str, effective: Column | str) -> Column:
    return F.coalesce(backdated_days(known, effective) > 0, F.lit(False))


def before(name: str) -> str:
    """The name of a feature that only knows what came before."""
    return f"{name}_BEFORE"


# -- quotes ---------------------------------------------------------------------------


def encode_line(line: Column | str) -> Column:
    """Twice the line as SMALLINT; a line that is no multiple of a half stops the job."""
    twice = _c(line).cast("double") * 2
    return F.when(
        F.abs(twice - F.rint(twice)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(twice)), F.rint(twice).cast("smallint")
    ).when(twice.isNotNull(), F.raise_error(F.concat(F.lit("line is not a multiple of a half: "), _c(line).cast("string"))).cast("smallint"))


def decode_line(code: Column | str) -> Column:
    return _c(code) / F.lit(2.0)


def encode_price(price: Column | str) -> Column:
    """An American price as SMALLINT; NULL between -100 and 100, beyond the type, or a placeholder."""
    whole = to_int(price)
    return F.when((F.abs(whole) >= 100) & (F.abs(whole) < 100000), whole.try_cast("smallint"))


def american_probability(price: Column | str) -> Column:
    p = _c(price).cast("double")
    return F.when(p > 0, 100 / (p + 100)).when(p < 0, -p / (-p + 100))


def devig(left: Column | str, right: Column | str) -> Column:
    """struct(fair_left, fair_right, overround) of a two-way price; all NULL if either is."""
    a, b = american_probability(left), american_probability(right)
    total = a + b
    return F.struct(F.try_divide(a, total).alias("fair_left"), F.try_divide(b, total).alias("fair_right"), (total - 1).alias("overround"))


def within(x: Column | str, low: float, high: float) -> Column:
    """Whether x lies between the bounds; NULL passes."""
    return F.coalesce(_c(x).between(low, high), F.lit(True))
