"""JSON texts read element by element, for texts too large to be held as one value.

A VARIANT holds 16 MiB, a whole export is often larger. `Reading` walks down the objects of a text
and decodes the elements of arrays one at a time, so that beside the text itself only one element is
in memory. A text that isn't one valid JSON value gives no element at all, whatever its size.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from decimal import Decimal
from typing import Any

#: Texts of more bytes are split into elements before they become VARIANT: a VARIANT can be three times as large as its text.
LARGE = 4 << 20

_BLANK = re.compile(r"[ \t\n\r]*")


def _refuse(name: str):
    raise ValueError(f"{name} is no JSON")


def _fraction(digits: str) -> str:
    """A number with a fraction or exponent, as VARIANT writes it: exact and without closing zeros."""
    value = Decimal(digits).normalize()
    return f"{value:f}" if -38 < value.adjusted() < 38 else repr(float(digits))


class Number(str):
    """The text of a number that isn't whole."""


_DECODER = json.JSONDecoder(parse_constant=_refuse, parse_float=lambda s: Number(_fraction(s)))


def parsed(text: str) -> Any:
    """The value of a whole text; ValueError if it isn't one JSON value."""
    value, end = _DECODER.raw_decode(text, _BLANK.match(text).end())
    if _BLANK.match(text, end).end() != len(text):
        raise ValueError("more than one value")
    return value


class Reading:
    """One pass over a text. `head` is, after the pass, the value without the elements of its arrays."""

    def __init__(self, text: str, arrays: set[tuple[str, ...]] | None = None):
        """`arrays`: paths of the arrays to take apart, all others stay in the head; None takes apart all
        that stand below objects alone."""
        self.text, self.arrays, self.head = text, arrays, None
        self.above = None if arrays is None else {path[:k] for path in arrays for k in range(len(path))}

    def elements(self) -> Iterator[tuple[tuple[str, ...], int, Any, int, int]]:
        """(path of the array, position, value, where its text begins, where it ends) of each element."""
        self.head, end = yield from self._value(self._skip(0), ())
        if self._skip(end) != len(self.text):
            raise ValueError("more than one value")

    def members(self) -> Iterator[tuple[str | None, Any, int, int]]:
        """(key, value, where its text begins, where it ends) of each member of an object, or of each element of an
        array (no key); none of a scalar. A key that is repeated makes the text no value, as for a VARIANT."""
        at = self._skip(0)
        if self.text[at : at + 1] != "{":
            for _, _, value, begin, end in Reading(self.text, {()}).elements():
                yield None, value, begin, end
            return
        at, seen = self._skip(at + 1), set()
        mark = self.text[at : at + 1]
        while mark != "}":
            key, at = self._one(at)
            at = self._skip(at)
            if not isinstance(key, str) or isinstance(key, Number) or key in seen or self.text[at : at + 1] != ":":
                raise ValueError("no key")
            seen.add(key)
            begin = self._skip(at + 1)
            value, end = self._one(begin)
            yield key, value, begin, end
            at = self._skip(end)
            mark = self.text[at : at + 1]
            if mark == ",":
                at = self._skip(at + 1)
            elif mark != "}":
                raise ValueError("no comma")
        if self._skip(at + 1) != len(self.text):
            raise ValueError("more than one value")

    def _skip(self, at: int) -> int:
        return _BLANK.match(self.text, at).end()

    def _one(self, at: int) -> tuple[Any, int]:
        try:
            return _DECODER.raw_decode(self.text, at)
        except (IndexError, RecursionError) as e:
            raise ValueError(str(e)) from None

    def _value(self, at: int, path: tuple[str, ...]):
        first = self.text[at : at + 1]
        if first == "{" and (self.above is None or path in self.above):
            return (yield from self._object(at + 1, path))
        if first == "[" and (self.arrays is None or path in self.arrays):
            return (yield from self._array(at + 1, path))
        return self._one(at)

    def _object(self, at: int, path: tuple[str, ...]):
        out: dict[str, Any] = {}
        at = self._skip(at)
        if self.text[at : at + 1] == "}":
            return out, at + 1
        while True:
            key, at = self._one(at)
            at = self._skip(at)
            if not isinstance(key, str) or isinstance(key, Number) or self.text[at : at + 1] != ":":
                raise ValueError("no key")
            out[key], at = yield from self._value(self._skip(at + 1), (*path, key))
            at = self._skip(at)
            mark = self.text[at : at + 1]
            if mark == "}":
                return out, at + 1
            if mark != ",":
                raise ValueError("no comma")
            at = self._skip(at + 1)

    def _array(self, at: int, path: tuple[str, ...]):
        at, position = self._skip(at), 0
        if self.text[at : at + 1] == "]":
            return [], at + 1
        while True:
            value, end = self._one(at)
            yield path, position, value, at, end
            position, at = position + 1, self._skip(end)
            mark = self.text[at : at + 1]
            if mark == "]":
                return [], at + 1
            if mark != ",":
                raise ValueError("no comma")
            at = self._skip(at + 1)


def head_of(text: str | None, arrays: set[tuple[str, ...]] | None = None) -> Any:
    """What a text holds beside the elements of its arrays; ValueError unless all of it is one JSON value."""
    if text is None:
        raise ValueError("no text")
    reading = Reading(text, arrays)
    for _ in reading.elements():
        pass
    return reading.head


def scalar_text(value: Any) -> str | None:
    """A scalar as text, as VARIANT writes it; None for null, objects and arrays."""
    if value is None or isinstance(value, (dict, list)):
        return None
    return ("true" if value else "false") if isinstance(value, bool) else str(value)
