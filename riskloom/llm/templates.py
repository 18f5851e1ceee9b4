"""Texts as templates: typed placeholders for numbers, names and units.

Tokens are words (letters), numbers with sign and separators, single stops and unit signs:
``[^\\W\\d_]+``, ``[+-]?\\d+([.,]\\d+)*``, ``[.!?:\\n]``, ``[%$€£°]``. Many texts are scanned at
once with array operations; a token is known by the hash of its lower-cased characters.
"""

from __future__ import annotations

import numpy as np
import xxhash

WORD, CAPITAL, NUMBER, UNIT, STOP = range(5)
NUMBER_WORDS = """two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen
sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred
thousand million billion""".split()
UNITS = """% $ € £ ° mm cm m km inch inches foot feet yard yards mile miles g kg mg ton tons pound pounds
ounce ounces l ml liter liters litre litres gallon gallons second seconds minute minutes hour hours day
days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees meter
meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms mph kmh""".split()
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
PLACEHOLDERS = {
    CAPITAL: np.uint64(xxhash.xxh64_intdigest(b"<name>")),
    NUMBER: np.uint64(xxhash.xxh64_intdigest(b"<number>")),
    UNIT: np.uint64(xxhash.xxh64_intdigest(b"<unit>")),
}

# Classes of characters: parts of words, decimal digits, stops, unit signs, signs of numbers.
LETTER, DIGIT, POINT, SYMBOL, SIGN = range(1, 6)
PLANE = 1 << 16  # characters that the tables cover; rarer ones are looked at one by one
POWERS = np.multiply.accumulate(np.full(4096, 0xD6E8FEB86659FD93, np.uint64))


def _class_of(c: str) -> int:
    if c.isalnum():
        return DIGIT if c.isdecimal() else LETTER
    return POINT if c in ".!?:\n" else SYMBOL if c in "%$€£°" else SIGN if c in "+-" else 0


def _lower(c: str) -> int:
    return ord(c.lower()) if len(c.lower()) == 1 else ord(c)


_CHARACTERS = [chr(i) for i in range(PLANE)]
CLASSES = np.array([_class_of(c) for c in _CHARACTERS], np.uint8)
LOWERED = np.array([_lower(c) for c in _CHARACTERS], np.uint64)
UPPER = np.array([c.isupper() for c in _CHARACTERS])
LOWER = np.array([c.islower() for c in _CHARACTERS])


def _look_up(points: np.ndarray) -> list[np.ndarray]:
    """Class, lower case, and whether upper or lower case, of every character."""
    inside = np.minimum(points, PLANE - 1)
    found = [CLASSES[inside], LOWERED[inside], UPPER[inside], LOWER[inside]]
    if points.max(initial=0) >= PLANE:
        for point in np.unique(points[points >= PLANE]).tolist():
            c, at = chr(point), points == point
            for column, value in zip(found, (_class_of(c), _lower(c), c.isupper(), c.islower())):
                column[at] = value
    return found


def _before(x: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, x.dtype), x[:-1]])


def _scan(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, hashes, kinds) of all tokens, numbers and units in words not yet told."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes, lowered, upper, lower = _look_up(points)
    digit = classes == DIGIT
    digit_next = np.concatenate([digit[1:], [False]])
    separator = ((points == ord(".")) | (points == ord(","))) & _before(digit) & digit_next
    signed = (classes == SIGN) & digit_next
    part = np.where(separator | signed, DIGIT, classes)
    part[(classes == SIGN) & ~signed] = 0
    starts = np.flatnonzero((part != 0) & ((part != _before(part)) | (part >= POINT) | signed))
    if not len(starts):
        return starts, np.empty(0, np.uint64), np.empty(0, np.int8)
    place = np.arange(len(points))
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(points))))
    values = (lowered + np.uint64(1)) * POWERS[place % len(POWERS)]
    values[part == 0] = 0
    hashes = np.add.reduceat(values, starts)
    hashes = (hashes ^ (hashes >> np.uint64(31))) * MULTIPLIER
    hashes ^= hashes >> np.uint64(29)
    own, word = part[starts], part == LETTER
    capitals = np.add.reduceat((upper & word).astype(np.int32), starts)
    smalls = np.add.reduceat((lower & word).astype(np.int32), starts)
    kinds = np.full(len(starts), WORD, np.int8)
    kinds[(own == LETTER) & upper[starts] & (capitals == 1) & (smalls > 0)] = CAPITAL
    kinds[own == DIGIT] = NUMBER
    kinds[own == POINT] = STOP
    return starts, hashes, kinds


KNOWN = {int(_scan(w)[1][0]): kind for words, kind in ((NUMBER_WORDS, NUMBER), (UNITS, UNIT)) for w in words}
KNOWN_TOP = np.zeros(1 << 16, bool)
KNOWN_TOP[[value >> 48 for value in KNOWN]] = True


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash with the kind in its last 3 bits, of all tokens; tokens up to the end of each text).

    The texts are scanned as one, with a line end behind each.
    """
    starts, hashes, kinds = _scan("".join(f"{text}\n" for text in texts))
    for i in np.flatnonzero(KNOWN_TOP[hashes >> np.uint64(48)]):
        kinds[i] = KNOWN.get(int(hashes[i]), kinds[i])
    ends = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts]))
    return (hashes & ~np.uint64(7)) | kinds.astype(np.uint64), ends


def template(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(template token hashes, slot values) of the tokens of one text.

    A value is 0 where a token is no placeholder. A name is a capitalised word inside a
    sentence, a run of names is one; a unit counts behind a number only.
    """
    coded, kinds = _without_stops(coded)
    # Neighbouring names across a stop cannot be: the second one starts a sentence.
    starts = np.flatnonzero((kinds != CAPITAL) | (np.concatenate([[WORD], kinds[:-1]]) != CAPITAL))
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    place = np.arange(len(coded)) - np.repeat(starts, np.diff(np.append(starts, len(coded))))
    values = np.add.reduceat((coded >> np.uint64(3)) * (2 * place + 1).astype(np.uint64), starts)
    return _placed(coded[starts], kinds[starts], values)


def caseless_template(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template token hashes, slot values, whether it is a name by its case) with names as
    plain words, so that case changes neither hashes nor values."""
    coded, kinds = _without_stops(coded)
    name = kinds == CAPITAL
    return *_placed(coded, np.where(name, WORD, kinds), coded >> np.uint64(3)), name


def _without_stops(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kinds = (coded & np.uint64(7)).astype(np.int8)
    before = np.concatenate([[STOP], kinds[:-1]]) if len(kinds) else kinds
    kinds = np.where((kinds == CAPITAL) & (before == STOP), WORD, kinds)
    kinds = np.where((kinds == UNIT) & (before != NUMBER), WORD, kinds)
    return coded[kinds != STOP], kinds[kinds != STOP]


def _placed(coded: np.ndarray, kinds: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = coded >> np.uint64(3)
    for kind, code in PLACEHOLDERS.items():
        hashes[kinds == kind] = code
    return hashes, np.where(kinds == WORD, np.uint64(0), values)


def window_hashes(hashes: np.ndarray, window: int) -> np.ndarray:
    """Hash of every ``window`` tokens in a row; a shorter text is one window."""
    if not len(hashes):
        return hashes
    window = min(window, len(hashes))
    n = len(hashes) - window + 1
    out = np.zeros(n, np.uint64)
    for j in range(window):
        out = out * MULTIPLIER + hashes[j : j + n]
    return (out ^ (out >> np.uint64(29))) * MULTIPLIER + np.uint64(window)
