"""Digits in spoken text into words: each run of digits is classified by its neighbours, then read out by its class."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.functions.text import ONES, TENS

# Ordinals that aren't formed by rule, and names of currencies.
ORDINALS = {"one": "first", "two": "second", "three": "third", "five": "fifth", "eight": "eighth", "nine": "ninth", "twelve": "twelfth"}
CURRENCIES = {"€": "euros", "$": "dollars", "£": "pounds"}
#: Below this, numbers are read as a whole; from here on digit by digit.
WHOLE_BELOW = 1_000_000
#: Four digits in this range, standing alone, are a year.
YEARS = range(1950, 2040)


def _hundreds(n: int) -> list[str]:
    """Words of a number below a thousand; none for 0."""
    big, small = divmod(n, 100)
    out = [ONES[big], "hundred"] if big else []
    if 0 < small < 20:
        out.append(ONES[small])
    elif small:
        ten, one = divmod(small, 10)
        out.append(TENS[ten - 2] if not one else f"{TENS[ten - 2]}-{ONES[one]}")
    return out


def cardinal(n: int) -> str:
    """A number below a million in words; larger ones digit by digit."""
    if n >= WHOLE_BELOW:
        return digits(str(n))
    high, low = divmod(n, 1000)
    words = [*_hundreds(high), *(["thousand"] if high else []), *_hundreds(low)]
    return " ".join(words or [ONES[0]])


def digits(s: str) -> str:
    """The digits of a text, one by one."""
    return " ".join(ONES[ord(c) - 48] for c in s if "0" <= c <= "9")


def ordinal(n: int) -> str:
    """The ordinal: only the last number word changes."""
    said = cardinal(n)
    last = re.split(r"[ -]", said)[-1]
    if last not in ORDINALS:
        return said[:-1] + "ieth" if last.endswith("y") else said + "th"
    return said[: len(said) - len(last)] + ORDINALS[last]


def year(n: int) -> str:
    """A year as two pairs; hundreds and the first ten years of a thousand in their own way."""
    pair, rest = divmod(n, 100)
    if rest >= 10:
        return f"{cardinal(pair)} {cardinal(rest)}"
    if pair == 20:
        return "two thousand" + (f" {ONES[rest]}" if rest else "")
    return f"{cardinal(pair)} oh {ONES[rest]}" if rest else f"{cardinal(pair)} hundred"


_SIGN = re.compile(rf"([{''.join(CURRENCIES)}])\s?$")


class Spot(NamedTuple):
    """A run of digits with what stands before and after it, the run after that, and what follows then."""

    before: str
    run: str
    after: str
    run2: str | None
    after2: str

    def starts(self) -> bool:
        """Nothing is attached before the run."""
        return not self.before or not _inside(self.before[-1])

    def ends(self) -> bool:
        return not self.after or not _inside(self.after[0])

    def ends2(self) -> bool:
        return not self.after2 or not _inside(self.after2[0])


class Reading(NamedTuple):
    """What is said, how much of the text before and after the digits it takes up, and how many digits of the second run."""

    said: str
    back: int = 0
    skip: int = 0
    second: int = 0
    percent: bool = False


def _inside(c: str) -> bool:
    return c.isalnum() or c == "_"


def _grouped(s: Spot) -> Reading | None:
    return Reading(cardinal(int(s.run.replace(",", ""))), percent=True) if "," in s.run else None


def _clock(s: Spot) -> Reading | None:
    if s.after != ":" or s.run2 is None or len(s.run2) < 2 or len(s.run) > 2 or not s.starts():
        return None
    half = re.match(r"\s*(?:([ap])\.?m\.?)?", s.after2, re.I) if len(s.run2) == 2 else None
    hour, minute = cardinal(int(s.run)), int(s.run2[:2])
    said = [hour, "o'clock"] if not minute else [hour, "oh", ONES[minute]] if minute < 10 else [hour, cardinal(minute)]
    if half and half[1]:
        said += [half[1].lower(), "m"]
    return Reading(" ".join(said), skip=half.end() if half else 0, second=2)


def _money(s: Spot) -> Reading | None:
    sign = _SIGN.search(s.before)
    if not sign:
        return None
    said = f"{cardinal(int(s.run))} {CURRENCIES[sign[1]]}"
    cents = s.run2[:2] if s.after in (".", ",") and s.run2 is not None and len(s.run2) > 1 else None
    if cents and cents != "00":
        said += f" {cardinal(int(cents))}"
    return Reading(said, back=len(sign[0]), second=2 if cents else 0)


def _ordinal(s: Spot) -> Reading | None:
    ending = re.match(r"(?:st|nd|rd|th)\b", s.after, re.I)
    if not ending or not s.starts() or (len(s.after) == 2 and s.run2 is not None):
        return None
    return Reading(ordinal(int(s.run)), skip=2)


def _code(s: Spot) -> Reading | None:
    airline = re.search(r"(?<!\w)[A-Z]{2}(\s?)$", s.before)
    if not airline or not 2 <= len(s.run) <= 4 or not s.ends():
        return None
    return Reading(f" {digits(s.run)}", back=len(airline[1]))


def _decimal(s: Spot) -> Reading | None:
    if s.after != "." or s.run2 is None or not s.starts() or not s.ends2():
        return None
    return Reading(f"{cardinal(int(s.run))} point {digits(s.run2)}", second=len(s.run2), percent=True)


def _year(s: Spot) -> Reading | None:
    alone = s.starts() and s.ends() and len(s.run) == 4 and int(s.run) in YEARS
    return Reading(year(int(s.run)), percent=True) if alone else None


def _plain(s: Spot) -> Reading:
    attached = s.before[-1:].isascii() and s.before[-1:].isalpha()
    return Reading(" " * attached + cardinal(int(s.run)), percent=True)


#: Classes of numbers; a run belongs to the first that takes it.
READERS: list[Callable[[Spot], Reading | None]] = [_grouped, _clock, _money, _ordinal, _code, _decimal, _year, _plain]
_SIGNS = "".join(CURRENCIES)
#: A number with commas between groups of three digits, unless it is money, or a run of digits.
_RUN = re.compile(rf"((?<![\w{_SIGNS}])(?<![{_SIGNS}]\s)(?<![0-9][.,:])[0-9]{{1,3}}(?:,[0-9]{{3}})+(?!\w)|[0-9]+)")
_PERCENT = re.compile(r"\s?%")
_SEAT = re.compile(r"(?<=[a-z])(?=[A-Z]\b)")


def spoken(text: str | None) -> str | None:
    """All digits of a text in words; null stays null.

    A run of digits is a time of day, an amount of money, an ordinal, a flight code, a decimal number, a year,
    a number attached to a word, or a plain number, by what stands beside it. Commas between groups of three
    digits belong to the number; a percent sign after a number is said.
    """
    if text is None:
        return None
    parts = _RUN.split(text)
    gaps, runs = parts[0::2], parts[1::2]
    out, i = "", 0
    while i < len(runs):
        out += gaps[i]
        spot = Spot(out, runs[i], gaps[i + 1], runs[i + 1] if i + 1 < len(runs) else None, gaps[i + 2] if i + 1 < len(runs) else "")
        r = next(x for x in (read(spot) for read in READERS) if x is not None)
        out = out[: len(out) - r.back] + r.said
        rest = None
        if r.second:  # the second run is used up, or what is left of it is a run of its own
            i += 1
            rest = runs[i][r.second :]
        if rest:
            gaps[i], runs[i] = "", rest
            continue
        i += 1
        gaps[i] = gaps[i][r.skip :]
        if r.percent:
            gaps[i] = _PERCENT.sub(" percent", gaps[i], count=1) if _PERCENT.match(gaps[i]) else gaps[i]
    return _SEAT.sub(" ", out + gaps[-1])


@F.pandas_udf(T.StringType())
def _spoken(texts: pd.Series) -> pd.Series:
    return texts.map(spoken, na_action="ignore")


def spoken_numbers(text: Column) -> Column:
    """``spoken`` over a column, in Arrow batches."""
    return _spoken(text)
