"""Dates as text for the parser functions: formats by tokens, texts read as instants in UTC."""

from __future__ import annotations

import calendar
import re
from collections.abc import Callable
from datetime import UTC, date, datetime, timedelta, tzinfo
from functools import lru_cache

MONTHS, DAYS = list(calendar.month_name)[1:], list(calendar.day_name)

#: The format tokens and what they give.
TOKENS: dict[str, Callable[[datetime], object]] = {
    "d": lambda t: f"{t.day:02}", "j": lambda t: t.day, "D": lambda t: DAYS[t.weekday()][:3], "l": lambda t: DAYS[t.weekday()], "N": lambda t: t.isoweekday(), "w": lambda t: t.isoweekday() % 7,
    "z": lambda t: t.timetuple().tm_yday - 1, "W": lambda t: f"{t.isocalendar()[1]:02}", "m": lambda t: f"{t.month:02}", "n": lambda t: t.month, "F": lambda t: MONTHS[t.month - 1], "xg": lambda t: MONTHS[t.month - 1], "M": lambda t: MONTHS[t.month - 1][:3],
    "t": lambda t: calendar.monthrange(t.year, t.month)[1], "L": lambda t: int(calendar.isleap(t.year)), "o": lambda t: t.isocalendar()[0], "Y": lambda t: t.year, "y": lambda t: f"{t.year % 100:02}",
    "a": lambda t: "am" if t.hour < 12 else "pm", "A": lambda t: "AM" if t.hour < 12 else "PM", "g": lambda t: (t.hour + 11) % 12 + 1, "G": lambda t: t.hour, "h": lambda t: f"{(t.hour + 11) % 12 + 1:02}", "H": lambda t: f"{t.hour:02}",
    "i": lambda t: f"{t.minute:02}", "s": lambda t: f"{t.second:02}", "U": lambda t: int(t.timestamp()), "c": lambda t: t.strftime("%Y-%m-%dT%H:%M:%S+00:00"), "r": lambda t: f"{DAYS[t.weekday()][:3]}, {t.day:02} {MONTHS[t.month - 1][:3]} {t.year} {t:%H:%M:%S} +0000",
    "e": lambda t: "UTC", "T": lambda t: "UTC", "O": lambda t: "+0000", "P": lambda t: "+00:00", "Z": lambda t: 0, "I": lambda t: 0,
}

_PIECE = re.compile(r'\\(.)|"([^"]*)"|(xg|[A-Za-z])|(.)', re.S)


@lru_cache(maxsize=512)
def _pieces(pattern: str) -> list[str | Callable[[datetime], object]]:
    return [TOKENS.get(token) or escaped or quoted or token or other for escaped, quoted, token, other in _PIECE.findall(pattern)]


def formatted(at: datetime, pattern: str) -> str:
    """Text by the tokens; ``\\`` escapes, quoted text and other characters stay."""
    return "".join([p if isinstance(p, str) else str(p(at)) for p in _pieces(pattern)])


def _month(name: str) -> int:
    return next((i for i, m in enumerate(MONTHS, 1) if name.lower() in (m.lower(), m[:3].lower())), 0)


def _year(text: str) -> int:
    n = int(text)
    return n if len(text) > 2 else n + (2000 if n < 70 else 1900)


#: Ways to write a day: a pattern and (year, month, day) of its groups.
_DAYS: list[tuple[re.Pattern, Callable]] = [
    (re.compile(r"([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})"), lambda y, m, d: (int(y), int(m), int(d))),
    (re.compile(r"([0-9]{4})-([0-9]{1,2})"), lambda y, m: (int(y), int(m), 1)),
    (re.compile(r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{4})"), lambda d, m, y: (int(y), int(m), int(d))),
    (re.compile(r"([0-9]{1,2})[- ]([A-Za-z]+),?[- ]([0-9]{4})"), lambda d, m, y: (int(y), _month(m), int(d))),
    (re.compile(r"([A-Za-z]+) ([0-9]{1,2}),? ([0-9]{4})"), lambda m, d, y: (int(y), _month(m), int(d))),
    (re.compile(r"([A-Za-z]+) ([0-9]{4})"), lambda m, y: (int(y), _month(m), 1)),
    (re.compile(r"([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})"), lambda y, m, d: (int(y), int(m), int(d))),
    (re.compile(r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{2}|[0-9]{4})"), lambda m, d, y: (_year(y), int(m), int(d))),
    (re.compile(r"([0-9]{1,2})\.([0-9]{1,2})\.([0-9]{4})"), lambda d, m, y: (int(y), int(m), int(d))),
]
_CLOCK = re.compile(r"(.*?)(?:[T ]|^)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?\s*(Z|UTC|[+-][0-9]{2}:?[0-9]{2})?$")
_STEP = re.compile(r"([+-]?\s*[0-9]+) (second|minute|hour|day|week|month|year)s?( ago)?")
#: Words for a midnight and its days from today.
_WORDS = {"today": 0, "midnight": 0, "yesterday": -1, "tomorrow": 1}
_EDGE = re.compile(r"(first|last) day of (this|last|next) month")


def shifted(at: datetime, months: int) -> datetime:
    """So many months on; the day is the last of its month at most."""
    index = at.year * 12 + at.month - 1 + months
    year, month = index // 12, index % 12 + 1
    return at.replace(year=year, month=month, day=min(at.day, calendar.monthrange(year, month)[1]))


def _relative(text: str, now: datetime) -> datetime | None:
    midnight = now.replace(hour=0, minute=0, second=0, microsecond=0)
    if text in ("", "now"):
        return now
    if text in _WORDS:
        return midnight + timedelta(_WORDS[text])
    if m := _EDGE.fullmatch(text):
        base = shifted(midnight, {"this": 0, "last": -1, "next": 1}[m[2]])
        return base.replace(day=1 if m[1] == "first" else calendar.monthrange(base.year, base.month)[1])
    if m := _STEP.fullmatch(text):
        n = int(m[1].replace(" ", "")) * (-1 if m[3] else 1)
        if m[2] in ("month", "year"):
            return shifted(now, n * (12 if m[2] == "year" else 1))
        return now + timedelta(**{f"{m[2]}s": n})
    return None


def read(text: str, now: datetime) -> datetime | None:
    """The instant a text names, relative words counted from now; null if unreadable."""
    # equal instants of two zones are one key, so the zone is part of it
    return _read(text, now, now.tzinfo) if len(text) <= 64 else _read.__wrapped__(text, now, now.tzinfo)


@lru_cache(maxsize=1024)
def _read(text: str, now: datetime, zone: tzinfo | None) -> datetime | None:
    text = text.strip()
    try:
        if (found := _relative(text.lower(), now)) is not None:
            return found
        if re.fullmatch("[0-9]{14}", text):
            return datetime.strptime(text, "%Y%m%d%H%M%S").replace(tzinfo=UTC)
        if re.fullmatch("@-?[0-9]+", text):
            return datetime.fromtimestamp(int(text[1:]), UTC)
        hour = minute = second = 0
        offset = timedelta()
        day = now.date()
        if m := _CLOCK.fullmatch(text):
            text, hour, minute, second = m[1].strip(), int(m[2]), int(m[3]), int(m[4] or 0)
            if m[5] and m[5][0] in "+-":
                digits = m[5][1:].replace(":", "")
                offset = (1 if m[5][0] == "+" else -1) * timedelta(hours=int(digits[:2]), minutes=int(digits[2:]))
        if text:
            day = next((date(*fields(*m.groups())) for pattern, fields in _DAYS if (m := pattern.fullmatch(text))), None)
        return None if day is None else datetime(day.year, day.month, day.day, hour, minute, second, tzinfo=UTC) - offset
    except (ValueError, OverflowError):
        return None


#: What date preferences stand for.
PREFERENCES = {"dmy": "j F Y", "mdy": "F j, Y", "ymd": "Y F j", "iso 8601": "Y-m-d"}


def preferred(text: str, preference: str, now: datetime) -> str:
    """A date in a span with its ISO form, written as preferred; unreadable text is only trimmed."""
    at = read(text, now)
    if at is None or not text.strip():
        return text.strip()
    return f'<span class="mw-formatted-date" title="{formatted(at, "Y-m-d")}">{formatted(at, PREFERENCES.get(preference.lower(), "Y-m-d"))}</span>'
