"""Numbers that a text states: Arabic ones, fractions, and Chinese numerals with a decimal tail.

A text is cut into number tokens once. Each token gives its readings, a value and how far the truth may lie from it; two
tokens that only a fraction mark parts give their ratio."""

from __future__ import annotations

import re
from collections.abc import Iterator
from fractions import Fraction

# Fixed values. What a character stands for.
DIGITS = {"零": 0, "〇": 0, "一": 1, "壹": 1, "二": 2, "两": 2, "贰": 2, "三": 3, "叁": 3, "四": 4, "肆": 4, "五": 5, "伍": 5, "六": 6, "陆": 6, "七": 7, "柒": 7, "八": 8, "捌": 8, "九": 9, "玖": 9}
UNITS = {"十": 10, "拾": 10, "百": 100, "佰": 100, "千": 1000, "仟": 1000}
GROUPS = {"万": 10**4, "亿": 10**8}

_D, _U, _G = ("".join(x) for x in (DIGITS, UNITS, GROUPS))
_TOKEN = re.compile(rf"(?P<arabic>-?\d[\d,]*(?:\.\d+)?)|(?P<numeral>[{_D}{_U}{_G}]+(?:点[{_D}{_U}{_G}]+)?)")
_SECTIONS = re.compile(rf"([^{_G}]*)([{_G}]?)")
_PLACES = re.compile(rf"[{_D}]*([{_D}])([{_U}])|([{_U}])|[{_D}]*([{_D}])$")


def section(s: str) -> int:
    """Digits and units below ten thousand; a unit without a digit, or after a zero, counts once, and of digits side by side
    the last counts."""
    return sum((DIGITS[d] or 1) * UNITS[u] if u else UNITS[bare] if bare else DIGITS[last] for d, u, bare, last in _PLACES.findall(s))


def whole(s: str) -> int:
    """Sections by their marks of ten thousands and hundred millions; a mark without a value before it counts once."""
    return sum((section(part) or 1) * GROUPS[mark] if mark else section(part) for part, mark in _SECTIONS.findall(s))


def numeral(s: str) -> tuple[Fraction, int]:
    """The value of a Chinese numeral and its decimal places: digits after 点 are read one by one, up to the first unit."""
    head, _, tail = s.partition("点")
    places = re.match(f"[{_D}]*", tail).group()
    return whole(head) + sum((Fraction(DIGITS[c], 10**k) for k, c in enumerate(places, 1)), Fraction(0)), len(places)


def _within(value: Fraction, places: int) -> tuple[Fraction, Fraction]:
    return value, Fraction(1, 2 * 10**places)


def readings(s: str) -> Iterator[tuple[Fraction, Fraction]]:
    """(value, tolerance) of every number that a text can be read as stating: half a unit of the last place written, none
    for a fraction. A numeral may run into the words after it, so each of its beginnings is a reading."""
    before, taken = None, False  # the token before, and whether a fraction has used it
    for m in _TOKEN.finditer(s):
        arabic, own = m["arabic"], m[0]
        if arabic:
            plain = arabic.replace(",", "")
            yield _within(Fraction(plain), len(plain.partition(".")[2]))
        else:
            for k in range(1, len(own) + 1):
                yield _within(*numeral(own[:k]))
        ratio = None
        if before is not None and not taken and bool(before["arabic"]) == bool(arabic):
            mark = s[before.end() : m.start()].strip()
            if arabic and mark == "/" and (top := re.search(r"\d+$", before[0])) and own[0] != "-":
                ratio = (int(top.group()), int(re.match(r"\d+", own).group()))
            elif not arabic and mark == "分之":
                ratio = (whole(own.partition("点")[0]), whole(before[0].rpartition("点")[2]))
        if ratio and ratio[1]:
            yield Fraction(*ratio), Fraction(0)
        before, taken = m, ratio is not None


def agrees(reference: str, s: str) -> bool:
    """Whether the text states the reference at the precision it writes it in."""
    truth = Fraction(reference)
    return any(abs(x - truth) <= off for x, off in readings(s))
