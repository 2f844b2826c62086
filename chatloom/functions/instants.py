"""One UTC instant for timestamps of mixed notation, precision and zone (p7).

Each value is turned into a shape mask (digit -> 9, letter -> a, other characters as they are).
Within an Arrow batch every distinct mask is looked up once; the parser found for it then converts
all values of that mask in numpy, column by column. Clock times without a zone are mapped through a
transition table of the zone by binary search. The tables are built once a worker from the installed
tz database. A conversion is pinned to the release that the driver has: a worker with another one
refuses to convert, so one result never mixes the rules of two releases.
"""

from __future__ import annotations

import re
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTHS = (64, 256, 1024)  #: values are laid out in blocks of these many bytes; longer ones one by one

# Abbreviations of zones with one usual meaning, as hours from UTC. An abbreviation
# that the row's own zone uses at that time takes that zone's offset instead.
ABBREVIATIONS = {
    "UTC": 0, "GMT": 0, "Z": 0, "UT": 0, "WET": 0, "WEST": 1, "BST": 1, "CET": 1, "CEST": 2, "MET": 1, "MEST": 2,
    "EET": 2, "EEST": 3, "MSK": 3, "IST": 5.5, "PKT": 5, "HKT": 8, "SGT": 8, "JST": 9, "KST": 9,
    "AWST": 8, "ACST": 9.5, "ACDT": 10.5, "AEST": 10, "AEDT": 11, "NZST": 12, "NZDT": 13,
    "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
    "AKST": -9, "AKDT": -8, "HST": -10, "BRT": -3, "BRST": -2, "ART": -3,
}
# English month and weekday names.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
LONG_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DAYS = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")

DAY_US = 86_400_000_000
_LUT = np.full(256, ord("?"), np.uint8)
_LUT[1:128] = np.arange(1, 128)
_LUT[0] = 0
_LUT[ord("0") : ord("9") + 1] = ord("9")
_LUT[ord("A") : ord("Z") + 1] = ord("a")
_LUT[ord("a") : ord("z") + 1] = ord("a")

_CLOCK = r"(?P<h>9{1,2}):(?P<mi>99)(?::(?P<s>99)(?:[.,](?P<f>9{1,9}))?)?"
_ZONE = r"(?: ?(?P<o>[+-]99(?::?99)?)(?: ?[\[(](?P<z>[a/_+9?-]+)[\])]| ?\([^()]*\))?| ?[\[(](?P<zo>[a/_+9-]+)[\])]| ?(?P<ab>a{1,5}))?"
# The notations, as patterns of masks. Groups: y mo d date, mn month name, h mi s f clock, ap am/pm,
# o offset, z region after an offset, zo region alone, ab abbreviation, e epoch, ef its fraction.
NOTATIONS = tuple(
    re.compile(p + "$")
    for p in (
        rf"(?:(?P<wd>aaa),? )?(?P<mn>a{{3,9}}) (?P<d>9{{1,2}}) (?P<y>9999) {_CLOCK} (?P<g>aaa)(?P<o>[+-]99:?99)(?: ?\([^()]*\))?",
        rf"(?P<y>9999)-(?P<mo>99)-(?P<d>99)(?:(?P<t>a)| +){_CLOCK}{_ZONE}",
        rf"(?P<y>9999)/(?P<mo>99)/(?P<d>99)(?:(?P<t>a)| +){_CLOCK}{_ZONE}",
        rf"(?P<d>9{{1,2}})\.(?P<mo>9{{1,2}})\.(?P<y>9999),? +{_CLOCK}{_ZONE}",
        rf"(?P<y>9999)(?P<mo>99)(?P<d>99)(?P<t>a)(?P<h>99)(?P<mi>99)(?P<s>99)?(?:[.,](?P<f>9{{1,9}}))?{_ZONE}",
        rf"(?:(?P<wd>aaa), )?(?P<d>9{{1,2}}) (?P<mn>a{{3,9}}) (?P<y>9999) {_CLOCK}{_ZONE}",
        rf"(?:(?P<wd>aaa),? )?(?P<mn>a{{3,9}}) (?P<d>9{{1,2}}),? (?P<y>9999),? {_CLOCK}(?: ?(?P<ap>aa))?(?: (?P<ab>a{{3,5}}))?",
        r"(?P<e>-?9{9,10})(?:\.(?P<ef>9{1,9}))?",
        r"(?P<e3>-?9{12,13})(?:\.9+)?",
        r"(?P<e6>-?9{15,16})",
        r"(?P<e9>-?9{18,19})",
    )
)


def _notation(mask: str) -> dict[str, tuple[int, int]] | None:
    """The parser of a mask: where its fields lie; None if it names no date and time."""
    for pattern in NOTATIONS:
        if m := pattern.match(mask):
            return {k: m.span(k) for k, v in m.groupdict().items() if v is not None}
    return None


_known = lru_cache(maxsize=4096)(_notation)


def notation(mask: str) -> dict[str, tuple[int, int]] | None:
    """`_notation`, remembered for masks of usual length."""
    return _known(mask) if len(mask) <= WIDTHS[-1] else _notation(mask)


@lru_cache(maxsize=1)
def tz_release() -> str:
    """Release of the tz database that zoneinfo reads: the system's if it has one, else that of the tzdata package."""
    import zoneinfo

    for folder in map(Path, zoneinfo.TZPATH):
        for name in ("tzdata.zi", "+VERSION"):
            if (folder / name).is_file():
                with (folder / name).open(encoding="utf-8") as f:
                    return f.readline().replace("# version", "").strip()
        if (folder / "Europe").is_dir():  # a system that doesn't name its release is known by its content
            import hashlib

            told = hashlib.sha256()
            for file in sorted(p for p in folder.rglob("*") if p.is_file() and p.suffix == ""):
                told.update(file.read_bytes())
            return told.hexdigest()[:16]
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "none"


@lru_cache(maxsize=1024)
def transitions(zone: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, tuple[str, ...]] | None:
    """Of a zone: clock times (us) from which the next offset holds, UTC instants of the changes,
    offsets (us), names; None for no known zone.

    A clock time that occurs twice lies before its boundary and so takes the earlier offset (the
    first occurrence); one that a jump skips takes the offset before the jump.
    """
    from datetime import datetime, timedelta, timezone
    from zoneinfo import ZoneInfo

    try:
        info = ZoneInfo(zone)
    except Exception:  # noqa: BLE001 - any unknown or malformed key
        return None
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def state(second: int) -> tuple[int, str]:
        at = (epoch + timedelta(seconds=second)).astimezone(info)
        return int(at.utcoffset().total_seconds()), at.tzname() or ""

    low, high, step = -2_208_988_800, 4_102_444_800, 2 * 86_400  # 1900 to 2100
    walls, instants, offsets, names = [], [], [], []
    at, now = low, state(low)
    offsets.append(now[0])
    names.append(now[1])
    while at < high:
        after = min(at + step, high)
        if (then := state(after)) != now:
            a, b = at, after
            while b - a > 1:
                mid = (a + b) // 2
                a, b = (mid, b) if state(mid) == now else (a, mid)
            then = state(b)
            instants.append(b)
            walls.append(b + max(now[0], then[0]))
            offsets.append(then[0])
            names.append(then[1])
            at, now = b, then
        else:
            at = after
    us = lambda x: np.asarray(x, np.int64) * 1_000_000
    return us(walls), us(instants), us(offsets), tuple(names)


def _number(block: np.ndarray, span: tuple[int, int] | None, rows: int) -> np.ndarray:
    if span is None:
        return np.zeros(rows, np.int64)
    out = np.zeros(rows, np.int64)
    for k in range(*span):
        out = out * 10 + (block[:, k].astype(np.int64) - 48)
    return out


def _words(block: np.ndarray, span: tuple[int, int]) -> np.ndarray:
    part = np.ascontiguousarray(block[:, span[0] : span[1]])
    return part.view(f"S{span[1] - span[0]}").ravel()


def _mapped(words: np.ndarray, table: dict[str, int], default: int = -1) -> np.ndarray:
    kinds, inverse = np.unique(words, return_inverse=True)
    return np.array([table.get(w.decode("latin-1").lower(), default) for w in kinds], np.int64)[inverse]


def _convert(block: np.ndarray, zones: np.ndarray, parser: dict[str, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(microseconds, usable) of the values of one mask."""
    n = len(block)
    good = np.ones(n, bool)
    for key, scale in (("e", 1_000_000), ("e3", 1_000), ("e6", 1), ("e9", 0)):
        if key in parser:
            lo, hi = parser[key]
            minus = block[:, lo] == ord("-")
            lo += int(bool(n and minus[0]))
            value = _number(block, (lo, hi), n)
            sign = np.where(minus, -1, 1)
            if key == "e9":
                return sign * (value // 1000), good
            us = value * scale
            if "ef" in parser:
                a, b = parser["ef"]
                digits = min(b - a, 6)
                us = us + _number(block, (a, a + digits), n) * 10 ** (6 - digits)
            return sign * us, good
    year = _number(block, parser["y"], n)
    day = _number(block, parser["d"], n)
    if "mn" in parser:
        names = {m: i + 1 for i, m in enumerate(MONTHS)} | {m: i + 1 for i, m in enumerate(LONG_MONTHS)} | {"sept": 9}
        month = _mapped(_words(block, parser["mn"]), names)
    else:
        month = _number(block, parser["mo"], n)
    hour, minute, second = (_number(block, parser.get(k), n) for k in ("h", "mi", "s"))
    if "t" in parser:
        good &= np.isin(block[:, parser["t"][0]], (ord("T"), ord("t")))
    if "wd" in parser:
        good &= _mapped(_words(block, parser["wd"]), {d: 1 for d in DAYS}) > 0
    if "ap" in parser:
        half = _mapped(_words(block, parser["ap"]), {"am": 0, "pm": 12})
        good &= (half >= 0) & (hour >= 1) & (hour <= 12)
        hour = hour % 12 + half
    good &= (year >= 1) & (month >= 1) & (month <= 12) & (hour <= 23) & (minute <= 59) & (second <= 59) & (day >= 1)
    months = np.where(good, (year - 1970) * 12 + month - 1, 0).astype("datetime64[M]")
    first = months.astype("datetime64[D]")
    length = ((months + 1).astype("datetime64[D]") - first).astype(np.int64)
    good &= day <= length
    us = (first.astype(np.int64) + day - 1) * DAY_US + ((hour * 60 + minute) * 60 + second) * 1_000_000
    if "f" in parser:
        a, b = parser["f"]
        digits = min(b - a, 6)
        us = us + _number(block, (a, a + digits), n) * 10 ** (6 - digits)
    if "g" in parser:  # "GMT+0100"
        good &= _mapped(_words(block, parser["g"]), {"gmt": 1, "utc": 1}) > 0
    if "o" in parser:
        a, b = parser["o"]
        hours = _number(block, (a + 1, a + 3), n)
        minutes = _number(block, (b - 2, b), n) if b - a > 3 else np.zeros(n, np.int64)
        good &= (hours <= 18) & (minutes <= 59)
        sign = np.where(block[:, a] == ord("-"), -1, 1)
        return us - sign * (hours * 60 + minutes) * 60_000_000, good
    if "zo" in parser:
        zones = np.array([w.decode("latin-1") for w in _words(block, parser["zo"])], object)
    short = np.array([w.decode("latin-1").upper() for w in _words(block, parser["ab"])], object) if "ab" in parser else None
    out = us.copy()
    for zone in dict.fromkeys(zones.tolist()):
        rows = zones == zone if zone is not None else np.array([z is None for z in zones])
        known = transitions(zone) if zone else None
        if short is None:
            if known is None:
                good[rows] = False
            else:
                at = us[rows]
                out[rows] = at - known[2][np.searchsorted(known[0], at, side="right")]
            continue
        for abbreviation in dict.fromkeys(short[rows].tolist()):
            here = rows & (short == abbreviation)
            own = np.full(int(here.sum()), np.iinfo(np.int64).min)
            if known is not None:  # the zone's own use of the abbreviation at that time
                for offset in {int(o) for o, name in zip(known[2], known[3]) if name == abbreviation}:
                    instant = us[here] - offset
                    at = np.searchsorted(known[1], instant, side="right")
                    fits = np.array([known[3][k] == abbreviation and known[2][k] == offset for k in at], bool)
                    own = np.where(fits, instant, own)
            usual = ABBREVIATIONS.get(abbreviation)
            missing = own == np.iinfo(np.int64).min
            if usual is None:
                good[here] &= ~missing
                out[here] = np.where(missing, 0, own)
            else:
                out[here] = np.where(missing, us[here] - int(usual * 3_600_000_000), own)
    return out, good


def parse_batch(values: pa.Array, zones: pa.Array) -> pa.Array:
    """Microseconds since 1970-01-01 UTC of each value, null where it names no date and time."""
    import pyarrow.compute as pc

    n = len(values)
    if n == 0:
        return pa.array([], pa.int64())
    text = pc.fill_null(pc.utf8_trim_whitespace(values.cast(pa.string())), "")
    text = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
    sizes = pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + n].astype(np.int64)
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
    zone_names = np.array(zones.to_pylist(), object)
    out, good = np.zeros(n, np.int64), np.zeros(n, bool)
    below = -1
    for width in WIDTHS:
        rows = np.flatnonzero((sizes > below) & (sizes <= width))
        below = width
        if len(rows):
            out[rows], good[rows] = _parse(data, starts[rows], sizes[rows], zone_names[rows], width)
    for row in np.flatnonzero(sizes > below):
        some = slice(row, row + 1)
        out[some], good[some] = _parse(data, starts[some], sizes[some], zone_names[some], int(sizes[row]))
    return pa.array(out, pa.int64(), mask=~good)


def _parse(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, zones: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(microseconds, usable) of values of at most `width` bytes."""
    n = len(starts)
    block = np.zeros((n, width), np.uint8)
    columns = np.arange(width)
    inside = columns[None, :] < sizes[:, None]
    block[inside] = data[(starts[:, None] + columns[None, :])[inside]]
    masks = np.ascontiguousarray(_LUT[block]).view(f"S{width}").ravel()
    kinds, inverse = np.unique(masks, return_inverse=True)
    out, good = np.zeros(n, np.int64), np.zeros(n, bool)
    order = np.argsort(inverse, kind="stable")
    bounds = np.searchsorted(inverse[order], np.arange(len(kinds) + 1))
    for k, kind in enumerate(kinds):
        parser = notation(kind.decode("latin-1"))
        if parser is None:
            continue
        rows = order[bounds[k] : bounds[k + 1]]
        out[rows], good[rows] = _convert(block[rows], zones[rows], parser)
    return out, good


def to_utc_us(value: Column | str, zone: Column | str, release: str | None = None) -> Column:
    """Column of UTC microseconds for timestamps as delivered.

    `zone` is the IANA zone that values without a zone of their own are clock times of. Null, empty,
    unknown or impossible values and zone-less values whose zone is null or unknown give NULL, however
    long they are. Parts that aren't written are zero; digits beyond microseconds are cut. Workers must have the
    given release of the tz database, else the driver's.
    """
    from pyspark.sql.functions import arrow_udf

    release = release or tz_release()

    @arrow_udf("bigint")
    def convert(v: pa.Array, z: pa.Array) -> pa.Array:
        if (own := tz_release()) != release:
            raise RuntimeError(f"this worker has release {own} of the tz database, the driver {release}")
        return parse_batch(v, z)

    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return convert(as_column(value).cast("string"), as_column(zone).cast("string"))


def display_time(value: Column | str, offset_hours: float = 0.0) -> Column:
    """the instant of a display time, "YYYY-MM-DD HH:MM" on a clock `offset_hours` east of UTC; NULL for
    any other notation (ISO too) and for days or hours that don't exist."""
    text = F.col(value) if isinstance(value, str) else value
    read = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm"))
    shown = text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$")
    return F.when(shown, F.timestamp_micros(F.unix_micros(read) - F.lit(round(offset_hours * 3_600_000_000))))
