"""Text helpers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_skip_null(*parts: Column | str) -> Column:
    """Concatenate as PostgreSQL's ``concat``: NULL counts as the empty string."""
    return F.concat_ws("", *[_col(p).cast("string") for p in parts])


def strip_chars(c: Column | str, chars: str) -> Column:
    """Remove every one of ``chars`` from the text."""
    return F.translate(_col(c), chars, "")


def url_host(c: Column | str) -> Column:
    """Host of a URL: what stands between the first run of slashes and the next."""
    host = F.regexp_extract(_col(c), "/([^/]+)", 1)
    return F.when(host != "", host)


def trim_fraction(c: Column | str, digits: int = 3) -> Column:
    """Cut the fraction of a timestamp text to ``digits`` digits; other text is kept."""
    text = _col(c)
    short = F.regexp_extract(text, r"^(.+\.[0-9]{1,%d})" % digits, 1)
    return F.when(short == "", text).otherwise(short)


def split_pair(c: Column | str, sep: str = "/") -> tuple[Column, Column]:
    """``'BTC/CAD'`` to its two symbols."""
    halves = F.split(_col(c), sep)
    return halves.getItem(0), halves.getItem(1)


def code_map(c: Column | str, mapping: Mapping[str, object], default: object = None) -> Column:
    """Translate short fixed codes through a map literal."""
    flat = [F.lit(x) for pair in mapping.items() for x in pair]
    found = F.try_element_at(F.create_map(*flat), _col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def any_like(c: Column | str, patterns: Sequence[str]) -> Column:
    """True when the text matches one of several LIKE patterns."""
    return reduce(lambda a, b: a | b, [_col(c).like(p) for p in patterns])


def display_amount(c: Column | str) -> Column:
    """Whole number with thousands separators."""
    return F.format_number(_col(c).cast("double"), 0)


def display_percent(c: Column | str) -> Column:
    """A percentage given in hundredths, shown as ``'12%'``."""
    return F.concat(F.format_string("%.0f", F.rint(_col(c).cast("double"))), F.lit("%"))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once for each row and hand it to ``use``, which may name it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
