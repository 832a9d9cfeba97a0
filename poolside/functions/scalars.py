"""Column functions: clocks, dates, ages, names and keys.

Every function takes and returns Columns, so Catalyst sees plain expressions.
Unparsable input gives null, never an error.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME = "decimal(10,2)"
#: Results without a time, each with the meaning of its time of zero.
NO_TIME_STATUSES = ("DNS", "DNF", "DSQ", "WDR", "SICK", "RJC", "OTL")
STROKES = ("FREE", "BACK", "BREAST", "FLY", "MEDLEY")


def _blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


# FN1-FN5: numbers, clocks and dates


def clock_strict(text: Column) -> Column:
    """h:m:s or m:s as decimal seconds."""
    parts = F.split(F.trim(text), ":")
    n = [F.try_element_at(parts, F.lit(i)).try_cast("decimal(12,4)") for i in (1, 2, 3)]
    return (
        F.when(F.size(parts) == 2, n[0] * 60 + n[1]).when(F.size(parts) == 3, n[0] * 3600 + n[1] * 60 + n[2]).cast(TIME)
    )


def clock_lenient(text: Column) -> Column:
    """As clock_strict, and bare seconds too."""
    return F.coalesce(clock_strict(text), F.when(~F.contains(text, F.lit(":")), F.trim(text).try_cast(TIME)))


def centiseconds(text: Column) -> Column:
    """Positive whole centiseconds; null for anything else."""
    parts = F.transform(F.split(F.trim(text), ":"), lambda p: p.try_cast("decimal(14,6)"))
    total = F.aggregate(parts, F.lit(0).cast("decimal(30,6)"), lambda a, p: (a * 60 + p).cast("decimal(30,6)")) * 100
    return F.when((F.size(parts) <= 3) & (total > 0) & (total == F.floor(total)) & (total < 2_000_000_000), total.cast("int"))


def serial_date(serial: Column, epoch_1904: bool = False) -> Column:
    """A spreadsheet's day number as a date, if whole and from 1 to 150000."""
    n = serial.try_cast("double")
    day = F.when((n == F.floor(n)) & (n >= 1) & (n <= 150_000), n.cast("int"))
    return F.date_add(F.lit("1904-01-01" if epoch_1904 else "1899-12-30").cast("date"), day)


def safe_int(text: Column) -> Column:
    return F.trim(text.cast("string")).try_cast("int")


def safe_decimal(text: Column, kind: str = TIME) -> Column:
    return F.trim(text.cast("string")).try_cast(kind)


def safe_date(text: Column, pattern: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.try_to_timestamp(F.trim(text), F.lit(pattern)))


# FN6-FN9: text and codes


def clean_text(text: Column) -> Column:
    """White space collapsed; empty is null."""
    return _blank_to_null(F.regexp_replace(text, r"\s+", " "))


def gender(text: Column, fallback: str = "U") -> Column:
    """M, F, X or U; an explicit U stays, anything else is the fallback."""
    code = F.upper(F.trim(text))
    return F.when(code.isin("M", "F", "X", "U"), code).otherwise(F.lit(fallback))


def pool_length(course: Column) -> Column:
    return F.when(F.contains(F.upper(course), F.lit("SCM")), 25).otherwise(50)


def course_code(pool: Column) -> Column:
    return F.when(pool == 25, "SCM").when(pool == 50, "LCM")


# FN10-FN15: seasons and ages


def season_end_year(day: Column) -> Column:
    """Seasons begin in September."""
    return F.year(day) + F.when(F.month(day) >= 9, 1).otherwise(0)


def season_age(day: Column, birth_year: Column) -> Column:
    return season_end_year(day) - birth_year


def calendar_age(day: Column, birth_year: Column) -> Column:
    return F.year(day) - birth_year


def age_on(reference: Column, mode: Column, birth: Column) -> Column:
    """Years by calendar year, or exact to the birthday unless mode is YEAR."""
    years = F.year(reference) - F.year(birth)
    before = (F.month(reference) * 100 + F.dayofmonth(reference)) < (F.month(birth) * 100 + F.dayofmonth(birth))
    return years - F.when((F.upper(mode) != "YEAR") & before, 1).otherwise(0)


def clamped_age(age: Column, least: int = 8, most: int = 19) -> Column:
    return F.least(F.lit(most), F.greatest(F.lit(least), age))


def age_band(least: Column, most: Column) -> Column:
    """a-b, >=a or <=b; -1 and null mean no bound."""
    low, high = F.when(least >= 0, least), F.when(most >= 0, most)
    both = low.isNotNull() & high.isNotNull()
    return F.when(both, F.concat_ws("-", low, high)).when(low.isNotNull(), F.concat(F.lit(">="), low)).when(high.isNotNull(), F.concat(F.lit("<="), high))


def record_age_key(least: Column, most: Column) -> Column:
    """12, 11u, 60-64 or open; without an upper bound always open. Bounds are taken as they are written, -1 too."""
    return _record_age(least, most, "", "u", "open")


def record_age_label(least: Column, most: Column) -> Column:
    """12 years, 11 years and younger, 60-64 years or Open."""
    return _record_age(least, most, " years", " years and younger", "Open")


def _record_age(least: Column, most: Column, years: str, younger: str, without: str) -> Column:
    return (
        F.when(least == most, F.concat(least, F.lit(years)))
        .when(most.isNotNull() & (F.coalesce(least, F.lit(0)) <= 0), F.concat(most, F.lit(younger)))
        .when(least.isNotNull() & most.isNotNull(), F.concat(F.concat_ws("-", least, most), F.lit(years)))
        .otherwise(without)
    )


# FN16-FN22: names and keys


def canonical_swimmer_id(nation: Column, sex: Column, birth_year: Column, first: Column, last: Column) -> Column:
    """A hash of the identity in this order; nulls are spelled out, for concat_ws would skip them."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (nation, sex, birth_year, first, last)]
    return F.concat(F.lit("CANON::"), F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 32))


def meet_key(name: Column, day: Column) -> Column:
    return F.substring(F.replace(F.concat(name, F.lit("_"), day.cast("string")), F.lit(" "), F.lit("_")), 1, 100)


def folded_name(text: Column) -> Column:
    """Case and white space set aside."""
    return clean_text(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")))


_GERMAN = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"))


@F.pandas_udf(T.StringType())
def _without_marks(texts: pd.Series) -> pd.Series:
    def strip(t: str | None) -> str | None:
        return None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c))

    return texts.map(strip)


@F.pandas_udf(T.StringType())
def _ascii(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode())


def name_key(text: Column) -> Column:
    """Umlauts written out, marks dropped, letters and digits only."""
    out = F.lower(text)
    for old, new in _GERMAN:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.regexp_replace(F.lower(_without_marks(out)), r"[^\p{L}\p{N}]", "")


def file_slug(text: Column) -> Column:
    """ASCII letters, digits, dots and dashes; runs of others become one underscore."""
    return F.regexp_replace(F.regexp_replace(_ascii(text), r"[^A-Za-z0-9.-]+", "_"), r"^_+|_+$", "")


def fingerprint(*columns: Column | str) -> Column:
    """md5 over the same."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def plain_fingerprint(*columns: Column) -> Column:
    """md5 over values joined by bars, null as a tilde; other engines can repeat it."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("~")) for c in columns)))


# FN23-FN28: descriptors and dictionaries


def event_descriptor(text: Column) -> Column:
    """struct(kind lap|relay|individual, legs, distance, stroke) of texts like '4x100m Freestyle' or '50m Fly Lap'."""
    pattern = r"(?i)^\s*(?:(\d+)\s*x\s*)?(\d+)\s*m?\s+(.+?)(\s+lap)?\s*$"
    legs, distance, stroke, lap = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3, 4))
    # a lap of a relay is ambiguous, and a stroke nobody knows is no event
    kind = F.when((distance == "") | ((lap != "") & (legs != "")) | stroke_code(stroke).isNull(), None).when(lap != "", "lap").when(legs != "", "relay").otherwise("individual")
    return F.struct(kind.alias("kind"), F.coalesce(legs.try_cast("int"), F.lit(1)).alias("legs"), distance.try_cast("int").alias("distance"), stroke_code(stroke).alias("stroke"))


def composite_key(*columns: Column) -> Column:
    return F.concat_ws(":", *columns)


def population_key(distance: Column, stroke: Column, course: Column, sex: Column, age_group: Column) -> Column:
    """FN24: distance:stroke:course:gender, and the age group unless it is everybody's (X_X)."""
    return F.concat_ws(":", distance, stroke, course, sex, F.nullif(age_group, F.lit("X_X")))


def category_title(sex: Column, age_group: Column) -> Column:
    """FN24: 'Women, Open', 'Men, 11 years and younger', 'Women, 12 years'."""
    ages = F.when(age_group == "X_X", "Open").when(age_group == "X_11", "11 years and younger").otherwise(F.concat(F.split(age_group, "_")[0], F.lit(" years")))
    return F.concat(F.when(sex == "F", "Women").otherwise("Men"), F.lit(", "), ages)


#: Stroke names in several languages.
STROKE_NAMES = {
    "FREE": "free freestyle freistil libre crawl fr freestyle_relay",
    "BACK": "back backstroke rücken dos espalda bk",
    "BREAST": "breast breaststroke brust brasse braza br",
    "FLY": "fly butterfly schmetterling delfin papillon mariposa fl bu",
    "MEDLEY": "medley im lagen 4n estilos individual_medley me medley_relay",
}


#: Gender names of event titles.
GENDER_NAMES = {"M": "men herren knaben messieurs", "F": "women damen mädchen dames", "X": "mixed"}


def gender_code(text: Column) -> Column:
    pairs = [F.lit(v) for code, names in GENDER_NAMES.items() for name in names.split() for v in (name, code)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(text)))


def stroke_code(text: Column) -> Column:
    pairs = [F.lit(v) for code, names in STROKE_NAMES.items() for name in names.split() for v in (name.replace("_", " "), code)]
    return F.try_element_at(F.create_map(*pairs), F.lower(F.trim(text)))


def date_range(text: Column) -> Column:
    """struct(start, end) of '5 Mar 2026', '5 - 7 Mar 2026', '30 Mar - 2 Apr 2026' and '30 Dec 2025 - 2 Jan 2026'."""
    t = clean_text(F.regexp_replace(text, "[–—]", "-"))
    m = r"^(\d{1,2})(?: ([A-Za-z]{3})[a-z]*)?(?: (\d{4}))?(?: ?- ?(\d{1,2}) ([A-Za-z]{3})[a-z]* (\d{4}))?$"
    g = [_blank_to_null(F.regexp_extract(t, m, i)) for i in range(1, 7)]
    day = lambda d, mon, y: F.to_date(F.try_to_timestamp(F.concat_ws(" ", d, F.initcap(mon), y), F.lit("d MMM yyyy")))
    end = F.when(g[3].isNotNull(), day(g[3], g[4], g[5])).otherwise(day(g[0], g[1], g[2]))
    start = day(g[0], F.coalesce(g[1], g[4]), F.coalesce(g[2], g[5]))
    return F.struct(start.alias("start"), end.alias("end"))


def city_country(text: Column) -> Column:
    """struct(city, country) of 'City (SUI)'."""
    pattern = r"^\s*(.*?)\s*\(([A-Z]{3})\)\s*$"
    city = F.regexp_extract(text, pattern, 1)
    country = _blank_to_null(F.regexp_extract(text, pattern, 2))
    return F.struct(F.when(country.isNotNull(), city).otherwise(clean_text(text)).alias("city"), country.alias("country"))


# FN29-FN36: states and checks


#: Words in a list's name that keep it out of comparisons.
HISTORICAL = ("until ", "archiv", "former ")
RESTRICTED = ("championship", "olympic", "games", "world cup", "regio", "provincial", "para record")


def record_scope(kind: Column, nation: Column, least: Column, most: Column, name: Column, *restrictions: Column) -> Column:
    """struct(scope, reason) of a record list's header; restrictions are its region, handicap and club.

    A list is national only if its type is its nation's own (the Faroese one is FAR), or an
    age type of that nation with bounds; types that merely begin with a nation are for review.
    """
    text, code, home = (f(F.coalesce(c, F.lit(""))) for f, c in ((F.lower, name), (F.upper, kind), (F.upper, nation)))
    restricted = F.concat(*(F.coalesce(c, F.lit("")) for c in (*restrictions, F.lit("")))) != ""
    has = lambda words: F.greatest(*(F.contains(text, F.lit(w)) for w in words))
    bounded = (F.coalesce(least, F.lit(0)) > 0) | (F.coalesce(most, F.lit(0)) > 0)
    own = (home != "") & ((code == home) | ((home == "FRO") & (code == "FAR")))
    of_age = (home != "") & code.isin(F.concat(home, F.lit(".JR")), F.concat(home, F.lit(".MS"))) & bounded
    reason = F.when(restricted, "restricted").when(has(HISTORICAL), "historical").when(has(RESTRICTED), "competition or regional")
    scope = (
        F.when(reason.isNotNull(), "excluded").when(code.isin("WR", "ER") & ~bounded, F.when(code == "WR", "world").otherwise("europe"))
        .when(own | of_age, F.when(bounded, "age").otherwise("national")).otherwise("unmapped")
    )
    return F.struct(scope.alias("scope"), F.coalesce(reason, F.when(scope == "unmapped", "for review")).alias("reason"))


#: Continental record codes and their scopes.
CONTINENTS = {"AM": "americas", "AF": "africa", "AS": "asia", "OC": "oceania"}


def approval_scope(status: Column, approved: Column) -> Column:
    """The approved scope for status 2 alone; anything else is pending."""
    return F.when(status.cast("string").try_cast("int") == 2, approved).otherwise("pending")


def continent(code: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(v) for pair in CONTINENTS.items() for v in pair)), code)


def kept_score(score: Column, old_time: Column, new_time: Column, old_status: Column, new_status: Column) -> Column:
    """null if time or status changed; blank and null statuses are one."""
    same = old_time.eqNullSafe(new_time) & blank_status(old_status).eqNullSafe(blank_status(new_status))
    return F.when(same, score)


def blank_status(status: Column) -> Column:
    return _blank_to_null(status)


def utc_time(text: Column) -> Column:
    """An ISO time with a zone as a timestamp; without a zone null."""
    return F.when(text.rlike(r"(Z|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(text))


def url_with(base: Column, **parameters: Column) -> Column:
    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(v.cast("string"))) for k, v in sorted(parameters.items())]
    return F.concat(base, F.lit("?"), F.concat_ws("&", *pairs))


def has_parameter(url: Column, name: str, value: Column) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name)).eqNullSafe(value.cast("string"))


def first_non_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.nullif(a, F.lit(0)), F.nullif(b, F.lit(0)))


def schedule_state(today: Column, start: Column, end: Column) -> Column:
    return F.when(today < start, "upcoming").when(today <= end, "ongoing").otherwise("ended_unverified")


def relay_legs(name: Column, distance: Column, is_relay: Column) -> Column:
    """struct(legs, distance, consistent) of a discipline's name like '4x100' and its distance a leg."""
    legs, each = (F.regexp_extract(F.coalesce(name, F.lit("")), r"^(\d+)x(\d+)$", i).try_cast("int") for i in (1, 2))
    ok = (legs.isNotNull() == F.coalesce(is_relay, F.lit(False))) & (legs.isNull() | F.coalesce(each == distance, F.lit(False)))
    return F.struct(F.coalesce(legs, F.lit(1)).alias("legs"), distance.alias("distance"), ok.alias("consistent"))
