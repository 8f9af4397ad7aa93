"""SQL fragments shared by the expected results."""

from __future__ import annotations

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def stamp(x: str) -> str:
    """Timestamp of a date text, ISO or day first."""
    days = ["%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y"]
    formats = [f"'{d}{t}'" for d in days for t in (" %H:%M:%S", " %H:%M", "")]
    fraction = "'%Y-%m-%d %H:%M:%S.%f'"
    return f"try_strptime(trim({x}), [{fraction}, {', '.join(formats)}])"


def day(x: str) -> str:
    return f"CAST({stamp(x)} AS DATE)"


def iso(x: str) -> str:
    """A date as text, the form both engines print alike."""
    return f"strftime({x}, '%Y-%m-%d')"


def parts(y: str, m: str, d: str) -> str:
    return f"try_cast({y} || '-' || lpad({m}, 2, '0') || '-' || lpad({d}, 2, '0') AS DATE)"


def number(x: str) -> str:
    return f"CASE WHEN regexp_matches({x}, {quoted(NUMBER)}) THEN try_cast({x} AS DOUBLE) END"


def comma(x: str) -> str:
    return number(f"replace({x}, ',', '.')")


def fold(x: str) -> str:
    return f"strip_accents(lower(trim(coalesce({x}, ''))))"


def half_even(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS INT)"


def cell_hour(x: str, part: int) -> str:
    """Hour (1) or minute (2) of a data cell."""
    c = f"trim({x})"
    v = comma(c)
    form = r"'^\s*(\d{1,2})\s*[:hH]?\s*(\d{1,2})?\s*$'"
    free = r"'(?:^|[^\d:])(\d{1,2}):(\d{2})(?:[^\d]|$)'"
    dots = f"replace({c}, '.', ':')"
    got = f"regexp_extract({dots}, {form}, {part})"
    fraction = (
        f"CAST(floor({v}) AS INT)" if part == 1 else half_even(f"({v} - floor({v})) * 60")
    )
    ts = stamp(c)
    stamped = f"hour({ts})" if part == 1 else f"minute({ts})"
    found = f"CAST(regexp_extract({c}, {free}, {part}) AS INT)"
    if part == 1:
        pm = f"regexp_matches({c}, '\\d\\s*[pP]\\.?[mM]')"
        found = f"CASE WHEN {pm} AND {found} < 12 THEN {found} + 12 ELSE {found} END"
    return f"""CASE
        WHEN {v} >= 0 AND {v} < 24 AND abs({v} - round({v})) > 1e-9 THEN {fraction}
        WHEN regexp_matches({dots}, {form})
          THEN CASE WHEN {got} = '' THEN 0 ELSE CAST({got} AS INT) END
        WHEN {ts} IS NOT NULL THEN CAST({stamped} AS INT)
        WHEN regexp_matches({c}, {free}) THEN {found} END"""


def midpoint(x: str) -> str:
    """Minute of the day of a time or range text."""
    span = r"'^\s*(\d{1,2}):(\d{2})\s*-\s*(\d{1,2}):(\d{2})\s*$'"
    hhmm = r"'^\s*(\d{1,2})[:hH](\d{1,2})\s*$'"

    def group(form: str, i: int) -> str:
        return f"CAST(regexp_extract({x}, {form}, {i}) AS INT)"

    v = comma(x)
    total = " + ".join([f"{group(span, 1)} * 60", group(span, 2), f"{group(span, 3)} * 60",
                        group(span, 4)])
    minutes = f"""CASE
        WHEN regexp_matches({x}, {span}) THEN ({total}) // 2
        WHEN regexp_matches({x}, {hhmm})
          THEN CASE WHEN {group(hhmm, 2)} < 60 THEN {group(hhmm, 1)} * 60 + {group(hhmm, 2)} END
        WHEN {v} >= 0 AND {v} < 24
          THEN CAST(floor({v}) AS INT) * 60 + {half_even(f'({v} - floor({v})) * 60')} END"""
    return f"CAST(CASE WHEN {minutes} < 1440 THEN {minutes} END AS INT)"


def split_stamp(date: str, hour: str) -> str:
    """Day of a date text plus the midpoint of an hour text (none counts as 00:00)."""
    minute = f"coalesce({midpoint(hour)}, 0)"
    return f"(CAST({day(date)} AS TIMESTAMP) + to_minutes(CAST({minute} AS INT)))"


def window(x: str, target: str, months: int) -> str:
    return (f"{x} BETWEEN CAST(DATE '{target}' - INTERVAL {months} MONTH AS DATE) "
            f"AND DATE '{target}'")


def haversine(lat: str, lon: str) -> str:
    p1, p2 = "radians(40.4168e0)", f"radians({lat})"
    a = (f"(pow(sin(({p2} - {p1}) / 2), 2) + cos({p1}) * cos({p2}) * "
         f"pow(sin((radians({lon}) - radians(-3.7038e0)) / 2), 2))")
    return f"(6371e0 * 2 * atan2(sqrt({a}), sqrt(1 - {a})))"
