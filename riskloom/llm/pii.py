"""Personal data: base patterns, and further spans chosen by boosted trees.

The base spans are e-mail addresses, IPv4 addresses, card and phone numbers as fixed
patterns define them: leftmost and non-overlapping per kind, checked afterwards, never
tried again. That loses numbers which run into each other (a phone followed by an
address, two cards in a row) or are written differently. High-recall generators
therefore propose overlapping spans; trees score them from the format of the span and the
characters around it; spans above a calibrated threshold per kind are added where they do
not overlap a base span, the most probable first.

The trees learn without annotations. Base spans are positive, proposals that fail the format
checks and touch no base span are negative, and proposals that are well formed but not base
spans are left out; they are what the model is asked about. As plain texts hold few of the
cases that are hard, more are constructed in them: base spans written with other gaps and run
into each other are positive, with every other way to cut them negative; dates, times, scores,
book numbers, versions, broken card numbers and words around an @ are negative. A kind is never
added unless enough constructed or found cases of both classes were kept for calibration.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.boosting import Trees, calibrate, fit_trees
from riskloom.llm.shared import map_rows, slices

KINDS = ("email", "ip", "card", "phone")  # fixed values, in the order of equal starts
# The base patterns. An address is looked for from its @, and an IPv4 number
# from the start of its first digits, which finds the same matches in linear time.
LOCAL_REVERSED = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LUHN_DOUBLE = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)

# What the generators propose. Quantifiers are bounded, so every start costs a bounded time.
DIGITS = re.compile(r"[0-9]+")
QUAD = re.compile(r"(?<![0-9])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])")
SPELLED = re.compile(
    r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\(at\)|\[at\]|@) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,8}"
)
JOINT = re.compile(r"[\x20().-]{1,3}")
CUES = re.compile(r"(?i)\b(?:tel|phone|fax|call|mobile|mail|card|visa|ip|host|addr)|(token|key|secret|hash|id)\b")
CANDIDATE = r"[0-9@]|\(at\)|\[at\]"
ANY_CANDIDATE = re.compile(CANDIDATE)

# Endings of domains that are common everywhere.
ENDINGS = frozenset("com org net edu gov info biz io co eu de fr es it uk us ca au ch nl at be se no pl pt ru jp cn br in".split())
SEPARATOR = re.compile(r"\(at\)|\[at\]|@")
DOT = re.compile(r"\.|\(dot\)|\[dot\]")
WORDS = re.compile(r"[A-Za-z]{2,12}")

SAMPLE_DOCS = 4000  # documents the trees learn from, at most
PIECE = 1600  # characters of each
DOCS_PER_SAMPLE = 24  # so many documents are looked at per document wanted
CONSTRUCTED_TEXTS = 1200  # of them that cases are constructed in, at most
PRECISION = 0.99
LEAST_OF_CLASS = 50  # cases of a kind, of both classes, without which it is not added
SCORED_AT_ONCE = 4096  # proposals; long rows of short numbers give many
MASK = {kind: f"[{kind.upper()}]" for kind in KINDS}
SPAN_TYPE = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("base", T.BooleanType())
    .add("score", T.DoubleType())
)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(LUHN_DOUBLE[int(c)] for c in digits[-2::-2])
    return total % 10 == 0


def octets(text: str) -> bool:
    parts = [part.lstrip("0") or "0" for part in text.split(".")]
    return all(len(part) <= 3 and int(part) <= 255 for part in parts)


def valid(kind: str, text: str) -> bool:
    """The check after the match."""
    if kind == "ip":
        return octets(text)
    if kind == "card":
        digits = _digits(text)
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15
    return True


def base_emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of local part, @ and domain, found from each @."""
    floor, at = 0, text.find("@")
    while at >= 0:
        local = LOCAL_REVERSED.match(text[floor:at][::-1])
        domain = DOMAIN.match(text, at + 1) if local else None
        if domain:
            yield at - local.end(), domain.end()
            floor = domain.end()
            at = text.find("@", floor)
        else:
            floor, at = at + 1, text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in base_emails(text)]
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        found += [(kind, *m.span()) for m in pattern.finditer(text) if valid(kind, m[0])]
    return sorted(found, key=_span_order)


def _span_order(span) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def proposals(text: str) -> list[tuple[str, int, int]]:
    """Overlapping candidate spans of every kind."""
    found = [("email", *m.span()) for m in SPELLED.finditer(text)] if "@" in text or "(at)" in text or "[at]" in text else []
    found += [("ip", *m.span()) for m in QUAD.finditer(text)]
    groups = [m.span() for m in DIGITS.finditer(text)]
    for i, (start, _) in enumerate(groups):
        total = 0
        opens = start - 1 if start and text[start - 1] == "(" else start
        plus = opens - 1 if opens and text[opens - 1] == "+" else None
        in_card = True
        for j in range(i, len(groups)):  # 19 digits at most, so 19 groups
            a, b = groups[j]
            if j > i and not (a - groups[j - 1][1] <= 3 and JOINT.fullmatch(text, groups[j - 1][1], a)):
                break
            total += b - a
            if total > 19:
                break
            in_card = in_card and (j == i or text[groups[j - 1][1] : a] in " -")
            if total >= 12 and in_card:
                found.append(("card", start, b))
            if 9 <= total <= 15 and (plus is not None or j > i):
                found.append(("phone", start if plus is None else plus, b))
    return list(dict.fromkeys(found))


FEATURES = 34


def _address_format(span: str) -> list[float]:
    """How the parts of a spelled address look."""
    at = SEPARATOR.search(span)
    if at is None:
        return [0.0] * 7
    local, domain = span[: at.start()].strip(), span[at.end() :].strip()
    last = DOT.split(domain)[-1].strip()
    return [
        float(last.lower() in ENDINGS),
        len(last),
        float(last.isalpha()),
        float(not local.isalpha()),
        float(at[0] != "@"),
        float(span[at.start() - 1 : at.start()] == " ") + float(span[at.end() : at.end() + 1] == " "),
        float(re.search(r"\. ", domain) is not None),
    ]


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format of the span, then what stands around it."""
    span = text[start:end]
    before, after = text[start - 1 : start], text[end : end + 1]
    near = text[max(0, start - 24) : start]
    cue = None
    for cue in CUES.finditer(near):
        pass
    digits = _digits(span)
    groups = [len(m[0]) for m in DIGITS.finditer(span)]
    return [
        *[float(kind == k) for k in KINDS],
        len(span),
        len(digits),
        len(groups),
        min(groups, default=0),
        max(groups, default=0),
        float(span.startswith("+")),
        span.count("("),
        float(span.count("(") == span.count(")")),
        span.count(" "),
        span.count("-"),
        span.count("."),
        span.count("@"),
        float(len(digits) >= 2 and luhn(digits)),
        float(kind != "ip" or octets(span)),
        len(set(digits)) / max(len(digits), 1),
        float(before.isalpha()),
        float(before.isdigit()),
        float(before in (".", "-", "_", "+")),
        float(after.isalpha()),
        float(after.isdigit()),
        float(after in ("-", "_", "@") or (after == "." and text[end + 1 : end + 2].isdigit())),
        float(cue is not None and cue[1] is None),
        float(cue is not None and cue[1] is not None),
        *_address_format(span if kind == "email" else ""),
    ]


@dataclass
class SpanModel:
    """Trees, and per kind the probability from which a proposal is taken (2: never)."""

    trees: Trees | None = None
    threshold: dict[str, float] = field(default_factory=lambda: dict.fromkeys(KINDS, 2.0))
    measured: dict[str, tuple[int, int, float, float]] = field(default_factory=dict)


def _well_formed(text: str, kind: str, start: int, end: int) -> bool:
    """Whether a proposal alone would be a base span."""
    span = text[start:end]
    if kind == "email":
        return list(base_emails(span)) == [(0, len(span))]
    pattern = {"ip": IP, "card": CARD, "phone": PHONE}[kind]
    return pattern.fullmatch(span) is not None and valid(kind, span)


def _overlaps(span, spans) -> bool:
    return any(span[1] < other[2] and other[1] < span[2] for other in spans)


def training_rows(text: str) -> Iterator[tuple[list[float], int]]:
    base = base_spans(text)
    for span in base:
        yield features(text, *span), 1
    known = set(base)
    for span in proposals(text):
        if span in known:
            continue
        if not _well_formed(text, *span) and not _overlaps(span, base):
            yield features(text, *span), 0
        elif text[span[1] - 1 : span[1]].isalnum() or text[span[2] : span[2] + 1].isalnum():
            yield features(text, *span), 0  # a piece of a longer token


def _respaced(kind: str, span: str, words: list[str], rng: random.Random) -> str:
    """A base span as others write it; for addresses also with other names."""
    if kind == "email":
        local, domain = span.split("@")
        name = rng.choice([local, rng.choice(words), f"{rng.choice(words)}.{rng.choice(words)}", f"{rng.choice(words)}{rng.randrange(99)}"])
        local, domain = rng.choice([(local, domain), (name, domain), (name, f"{rng.choice(words)}.{rng.choice(sorted(ENDINGS))}")])
        return rng.choice([f"{local} @ {domain}", f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local} @{domain}"])
    if kind == "card":
        digits, size, gap = _digits(span), rng.choice((2, 4, 4, 19)), rng.choice(" -")
        return gap.join(digits[i : i + size] for i in range(0, len(digits), size))
    if kind == "phone":
        digits, size, gap = _digits(span), rng.choice((2, 3)), rng.choice(" .-")
        own = gap.join(digits[i : i + size] for i in range(2, len(digits), size))
        return f"+{digits[:2]}{rng.choice([' (0)', ' ', ' '])}{own}"
    return span


def _no_personal_data(words: list[str], rng: random.Random) -> str:
    """Something that only looks like personal data."""
    n = lambda low, high: str(rng.randrange(low, high))
    two = lambda high: f"{rng.randrange(1, high):02d}"
    digits = lambda count: "".join(rng.choices("0123456789", k=count))
    word = lambda: rng.choice(words)
    year, gap = n(1900, 2040), rng.choice(" -")
    card = digits(16)
    card = card[:-1] + str((int(card[-1]) + (1 if luhn(card) else 0)) % 10)
    cases = [
        f"{word()} @ {word()}.{word()}",
        f"{word()} @ {word()}. {word().title()}",
        f"{word()} @{word()}.{word()}",
        f"{n(1, 99)} @ {n(1, 99)}.{two(99)}",
        f"{year}-{two(12)}-{two(28)} {two(23)}.{two(59)}.{two(59)}",
        f"{two(28)}-{two(12)} {two(23)}.{two(59)}.{two(59)}",
        f"{two(28)}.{two(12)}.{year} {two(23)}-{two(23)}",
        f"{year}-{n(1900, 2040)} {n(1900, 2040)}-{n(1900, 2040)}",
        " ".join(f"{n(0, 99)}-{n(0, 99)}" for _ in range(rng.randrange(2, 6))) + f" {n(0, 99)}",
        " ".join(f"{n(0, 99)}.{n(0, 9)}" for _ in range(rng.randrange(3, 7))),
        f"97{rng.choice('89')}-{digits(1)}-{digits(2)}-{digits(6)}-{digits(1)}",
        f"{n(1, 999)} {digits(3)} {digits(3)} {digits(3)}",
        f"{n(256, 999)}.{n(0, 999)}.{n(0, 999)}.{n(0, 999)}",
        f"{n(0, 30)}.{n(0, 30)}.{n(256, 999)}.{n(0, 30)}",
        gap.join(card[i : i + 4] for i in range(0, 16, 4)),
        card,
    ]
    return rng.choice(cases)


def constructed_rows(text: str) -> Iterator[tuple[list[float], int]]:
    """Cases put between the words of a text, the same whenever the text is met."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "replace")))
    words = WORDS.findall(text) or ["word"]
    base = base_spans(text)
    own = [(kind, text[a:b]) for kind, a, b in base if b - a <= 80]
    gaps = [i for i, c in enumerate(text) if c == " "] or [len(text)]

    def rows(parts: list[tuple[str, str]], at: int) -> Iterator[tuple[list[float], int]]:
        left, right = text[max(0, at - 60) : at] + " ", " " + text[at + 1 : at + 30]
        inserted = " ".join(part for _, part in parts)
        whole = left + inserted + right
        true, start = set(), len(left)
        for kind, part in parts:
            true.add((kind, start, start + len(part)))
            start += len(part) + 1
        for span in proposals(whole):
            if span[2] > len(left) and span[1] < len(left) + len(inserted):
                yield features(whole, *span), int(span in true)

    for kind in dict.fromkeys(kind for kind, _ in own):
        span = rng.choice([part for k, part in own if k == kind])
        at = next(a for k, a, _ in base if k == kind)
        yield from rows([(kind, _respaced(kind, span, words, rng))], at)
        other = rng.choice(own)
        yield from rows([(kind, _respaced(kind, span, words, rng)), (other[0], _respaced(*other, words, rng))], at)
    for _ in range(4):
        case = _no_personal_data(words, rng)
        if not base_spans(case):  # what the base patterns take is not asked of the model
            yield from rows([("none", case)], rng.choice(gaps))


def fit_span_model(texts: list[str]) -> SpanModel:
    """Trees on three quarters of the texts, calibration and thresholds on the rest."""
    parts: tuple[list, list] = ([], [])
    for i, text in enumerate(texts):
        parts[i % 4 == 0].extend(training_rows(text))
        if i < CONSTRUCTED_TEXTS:
            parts[i % 4 == 0].extend(constructed_rows(text))
    model = SpanModel()
    rows = [np.array([r for r, _ in part], float).reshape(-1, FEATURES) for part in parts]
    labels = [np.array([y for _, y in part], float) for part in parts]
    if any(len(set(y.tolist())) < 2 for y in labels):
        return model
    model.trees = fit_trees(rows[0], labels[0])
    calibrate(model.trees, rows[1], labels[1])
    chance = model.trees.probability(rows[1])
    for i, kind in enumerate(KINDS):
        own = rows[1][:, i] == 1
        model.threshold[kind] = _threshold(chance[own], labels[1][own])
        model.measured[kind] = _measured(chance[own], labels[1][own], model.threshold[kind])
    return model


def _threshold(chance: np.ndarray, labels: np.ndarray) -> float:
    """The lowest probability of at least one half from which the precision holds, half-way
    down to the next case below; never, without enough cases of both classes."""
    if min((labels == 1).sum(), (labels == 0).sum()) < LEAST_OF_CLASS:
        return 2.0
    below = chance[chance < 0.5].max(initial=0.0)
    for cut in np.unique(chance[chance >= 0.5]):
        if labels[chance >= cut].mean() >= PRECISION:
            return float((below + cut) / 2)
        below = cut
    return 2.0


def _measured(chance: np.ndarray, labels: np.ndarray, threshold: float) -> tuple[int, int, float, float]:
    """(positives, negatives, precision, recall) of the cases kept for calibration."""
    taken = chance >= threshold
    hits = float((taken & (labels == 1)).sum())
    positives = int((labels == 1).sum())
    return positives, int((labels == 0).sum()), hits / max(taken.sum(), 1), hits / max(positives, 1)


def find_spans(text: str | None, model: SpanModel) -> list[tuple[str, int, int, bool, float]]:
    """All spans (kind, start, end, base, score) by start; base spans have score 1."""
    if not text or not ANY_CANDIDATE.search(text):
        return []
    base = base_spans(text)
    found = [(*span, True, 1.0) for span in base]
    if model.trees is not None:
        starts, reach = [span[1] for span in base], list(accumulate((span[2] for span in base), max))
        fresh = [span for span in proposals(text) if not _touches(span, starts, reach)]
        if fresh:
            blocks = [fresh[i : i + SCORED_AT_ONCE] for i in range(0, len(fresh), SCORED_AT_ONCE)]
            chance = np.concatenate([model.trees.probability(np.array([features(text, *span) for span in b])) for b in blocks])
            chosen = [(score, span) for score, span in zip(chance, fresh) if score >= model.threshold[span[0]]]
            ranked = sorted(_whole(text, chosen), key=lambda x: (-round(x[0], 6), x[1][1] - x[1][2], *_span_order(x[1])))
            taken: dict[int, tuple[int, int]] = {}
            for score, span in ranked:
                if _free(span, taken):
                    taken.update(dict.fromkeys(range(span[1], span[2])))
                    found.append((*span, False, float(score)))
    return sorted(found, key=_span_order)


def _whole(text: str, chosen: list[tuple[float, tuple[str, int, int]]]) -> list[tuple[float, tuple[str, int, int]]]:
    """Without pieces of a well-formed span of the same kind that was chosen too: like the
    base patterns, a number goes as far as it can."""
    kept, reach = [], dict.fromkeys(KINDS, 0)
    for score, span in sorted(chosen, key=lambda x: (x[1][1], -x[1][2])):
        if span[2] <= reach[span[0]]:
            continue
        kept.append((score, span))
        if _well_formed(text, *span):
            reach[span[0]] = span[2]
    return kept


def _touches(span, starts: list[int], reach: list[int]) -> bool:
    """Whether one of the sorted spans that start before the end reaches beyond the start."""
    at = bisect_left(starts, span[2])
    return at > 0 and reach[at - 1] > span[1]


def _free(span, taken) -> bool:
    return not any(i in taken for i in range(span[1], span[2]))


def learn_span_model(docs: DataFrame, text: str = "text", sample: int = SAMPLE_DOCS) -> SpanModel:
    """Learn from at most ``sample`` documents that have candidates, chosen by hash; of each
    the text around the first candidate. Large tables are thinned by that hash first, to a
    number of documents that does not grow with the table."""
    share = min(1.0, DOCS_PER_SAMPLE * sample / max(docs.count(), 1))
    first = F.regexp_instr("_text", F.lit(CANDIDATE))
    piece = F.substring(F.col("_text"), F.greatest(first - 80, F.lit(1)), F.lit(PIECE))
    own = docs.select(F.col(text).alias("_text"), F.xxhash64(text).alias("_order"))
    own = own.where(F.pmod("_order", F.lit(1 << 30)) < int(share * (1 << 30))).where(F.col("_text").rlike(CANDIDATE))
    rows = own.select("_order", piece.alias("text")).distinct().orderBy("_order", "text").limit(sample).collect()
    return fit_span_model([row.text for row in rows])


def personal_data(docs: DataFrame, keys: list[str], model: SpanModel, text: str = "text") -> DataFrame:
    """(``keys``, spans): per row all spans with kind, start, end (code points), base, score.

    A NULL or empty text has no spans. Repeated rows all stay; no rows give no rows.
    """
    schema = docs.select(*keys).schema.add("spans", SPAN_TYPE)
    span_type = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("kind", "start", "end", "base", "score")
        for batch in slices(batches, "_text"):
            found = [
                [dict(zip(names, span)) for span in find_spans(value, model)]
                for value in batch.column(batch.num_columns - 1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, span_type)], names=[*keys, "spans"])

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)


def span_text(spans: str, base_only: bool = False) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    chosen = F.filter(spans, lambda s: s["base"]) if base_only else F.col(spans)
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: str, spans) -> str:
    """Each stretch of touching or overlapping spans becomes the mask of its first kind."""
    out, end = [], 0
    for kind, start, stop, *_ in spans:
        if start >= end:
            out += [text[end:start], MASK[kind]]
        end = max(end, stop)
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, model: SpanModel, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced by masks, and ``length`` (if there) set anew
    where the text changed. Rows, and columns of any names and types, stay as they are."""
    at = docs.columns.index(text)
    size_at = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"_{at}"):
            columns = list(batch.columns)
            values = columns[at].to_pylist()
            found = {i: spans for i, value in enumerate(values) if (spans := find_spans(value, model))}
            if found:
                for i, spans in found.items():
                    values[i] = masked(values[i], spans)
                columns[at] = pa.array(values, columns[at].type)
                if size_at is not None:
                    sizes = columns[size_at].to_pylist()
                    for i in found:
                        sizes[i] = len(values[i])
                    columns[size_at] = pa.array(sizes, columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_rows(docs, run)
