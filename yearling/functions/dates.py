"""Date expressions. Monday is 0."""

from __future__ import annotations


def is_weekend(day: str) -> str:
    return f"weekday({day}) >= 5"


def nth_weekday(year: str, month: int, weekday: int, nth: int) -> str:
    """The nth given weekday of a month; nth = -1 is the last one."""
    first = f"make_date({year}, {month}, 1)"
    if nth > 0:
        shift = f"({weekday} - weekday({first}) + 7) % 7 + {7 * (nth - 1)}"
        return f"date_add({first}, {shift})"
    last = f"last_day({first})"
    return f"date_sub({last}, (weekday({last}) - {weekday} + 7) % 7)"


def observed_shift(day: str) -> str:
    """The weekday a weekend holiday closes instead; NULL for other days."""
    return f"case weekday({day}) when 5 then date_sub({day}, 1) when 6 then date_add({day}, 1) end"


def monday_after(day: str, two_days: bool = True) -> str:
    """The weekday given for a holiday on a weekend; NULL for other days.

    Two days later, so that Christmas and the day after it get different ones; or the
    Monday after.
    """
    sunday = f"date_add({day}, {2 if two_days else 1})"
    return f"case weekday({day}) when 5 then date_add({day}, 2) when 6 then {sunday} end"


def easter_steps(year: str, name: str) -> list[list[str]]:
    """Columns to add, step after step, that end in the date of Easter Sunday as `name`.

    The Gregorian reckoning: the golden number and the century's corrections give the
    paschal full moon, the Sunday after it is Easter.
    """
    return [
        [f"{year} % 19 as _gold", f"{year} div 100 as _century"],
        # Leap days left out since the Julian calendar, and the moon's own correction.
        [
            "_century - _century div 4 as _solar",
            "(8 * _century + 13) div 25 as _lunar",
        ],
        ["(19 * _gold + _solar - _lunar + 15) % 30 as _age"],
        # The full moon's days after 21 March, one less for the two latest cases.
        ["_age - if(_age = 29 or (_age = 28 and _gold > 10), 1, 0) as _moon"],
        [f"date_add(make_date({year}, 3, 21), int(_moon)) as _full"],
        [f"date_add(_full, 7 - (weekday(_full) + 1) % 7) as {name}"],
    ]
