"""Benchmark decontamination by template windows.

Texts become templates: numbers, names (capitalised words inside a sentence; a run of them
is one name) and units (after a number) turn into typed placeholders, other words are
lower-cased. Equal windows of template tokens join documents with benchmark items, so a
question that was re-parameterised still meets its original. An aligned occurrence (same
document, item and offset) must use its slots consistently: one value of the item stands
for one value of the document, the one that most of its mentions have (the item's own on a
tie). A window counts if its slots are the item's, or if all stand for what they should. If
a value has no such partner, being replaced in several ways equally often, the other
windows with slots do not count, and runs are of windows without slots.

Case decides what a name is, so every text is hashed in a second, caseless template too, with
names as plain words. It judges the occurrences whose case differs from the item's, and items
that are shorter than a window in the first template; all others are left to that one.

Windows of placeholders alone are alike in all number tables and lists of names, so they do not
join by template: they join where their values are the same, and where another window of the
item has met, by their place next to it. Items shorter than a window in both templates are
passages too: their few tokens join as they are, in any case.

Document windows are hashed where the document is read and first tested against a bitmap of
the benchmark's window hashes, some 16 bits each up to a bound; what passes it is joined by
equality of the whole hash, so the bitmap never decides alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.shared import fresh, row_identity, slices
from riskloom.llm.templates import caseless_template, template, tokens, window_hashes
from riskloom.operators.durable import BROADCAST_BYTES, durable

WINDOW = 5
COVERAGE = 0.8
RUN_TOKENS = 13  # so many consistent template tokens in a row are contamination as well
BITMAP_BITS = range(23, 27)  # of bits, as powers of two: the least and one beyond the most

# Constants that tell windows of one kind from those of another.
CASELESS = np.uint64(0x5BD1E9955BD1E995)  # of the second template
VALUED = np.uint64(0xC2B2AE3D27D4EB4F)  # of values, not of placeholders
SHORT = -1  # the case of items that have no whole window in the first template
ANY_CASE = 1  # the case of document windows that meet short items


def _slot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _bare(values: np.ndarray, window: int) -> np.ndarray:
    """Whether each window has placeholders alone."""
    return ~np.lib.stride_tricks.sliding_window_view(values == 0, min(window, len(values))).any(axis=1)


def template_windows(
    df: DataFrame,
    keys: list[str],
    text: str,
    window: int,
    bitmap: bytes | None = None,
    lengths: tuple[int, ...] = (),
    bare_only: bool = False,
) -> DataFrame:
    """(``keys``, hash, pos, n_windows, case, bare, slots) of the windows of both templates, with a
    bitmap only of those in it. ``case`` is 0 in the first template, else tells names by case.
    ``bare`` is the hash by template of windows of placeholders alone, whose ``hash`` is that of
    their values; ``bare_only`` asks for these alone. ``lengths`` asks for the windows of so few
    tokens as well, as short items have them.
    """
    fields = [df.schema[k] for k in keys]
    schema = T.StructType(fields).add("hash", T.LongType()).add("pos", T.IntegerType()).add("n_windows", T.IntegerType())
    schema = schema.add("case", T.LongType()).add("bare", T.LongType()).add("slots", T.ArrayType(T.LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = None if bitmap is None else np.unpackbits(np.frombuffer(bitmap, np.uint8), bitorder="little")
        bits = 0 if wanted is None else len(wanted).bit_length() - 1
        for batch in slices(batches, "_text", 1 << 20):
            rows, found, places, sizes, cases, slots, templates, bares = [], [], [], [], [], [], [], []

            def add(i: int, hashes: np.ndarray, values: np.ndarray, case: np.ndarray, kind: np.uint64, size: int = window) -> None:
                by_template = window_hashes(hashes, size) ^ kind
                if not len(by_template):
                    return
                bare = _bare(values, size)
                windows = np.where(bare, window_hashes(hashes + values, size) ^ kind ^ VALUED, by_template)
                keep = bare if bare_only else np.ones(len(windows), bool) if wanted is None else wanted[_slot(windows, bits)] > 0
                at = np.flatnonzero(keep)
                if not len(at):
                    return
                rows.append(np.full(len(at), i))
                found.append(windows[at])
                places.append(at)
                sizes.append(np.full(len(at), len(windows)))
                cases.append(case[at])
                templates.append(by_template[at])
                bares.append(bare[at])
                slots.extend(values[p : p + size].view(np.int64).tolist() for p in at)

            coded, ends = tokens([text or "" for text in batch.column(batch.num_columns - 1).to_pylist()])
            for i, end in enumerate(ends):
                own = coded[ends[i - 1] if i else 0 : end]
                hashes, values = template(own)
                add(i, hashes, values, np.zeros(len(hashes), np.int64), np.uint64(0))
                words, values, name = caseless_template(own)
                is_item = wanted is None and not bare_only
                if len(words) >= window:
                    case = window_hashes(name.astype(np.uint64) + np.uint64(1), window).view(np.int64)
                    if is_item and len(hashes) < window:
                        case = np.full(len(case), SHORT)
                    add(i, words, values, case, CASELESS)
                elif is_item and len(words):
                    add(i, words + values, values, np.full(1, SHORT), CASELESS ^ VALUED, len(words))
                for size in lengths:
                    if len(words) >= size:
                        add(i, words + values, values, np.full(len(words), ANY_CASE), CASELESS ^ VALUED, size)
            if not rows:
                continue
            picked = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    *[column.take(picked) for column in batch.columns[:-1]],
                    pa.array(np.concatenate(found).view(np.int64)),
                    pa.array(np.concatenate(places).astype(np.int32)),
                    pa.array(np.concatenate(sizes).astype(np.int32)),
                    pa.array(np.concatenate(cases)),
                    pa.array(np.concatenate(templates).view(np.int64), mask=~np.concatenate(bares)),
                    pa.array(slots, pa.list_(pa.int64())),
                ],
                names=schema.names,
            )

    return df.select(*keys, F.col(text).alias("_text")).mapInArrow(run, schema)


def _consistent(windows: list[dict]) -> tuple[list[int], list[int], int]:
    """(places that count, places that count in runs, changed slots) of an occurrence."""
    found = []
    for w in windows:
        pairs = [(w["item_pos"] + i, a, b) for i, (a, b) in enumerate(zip(w["item_slots"], w["slots"])) if a != 0]
        found.append((w["item_pos"], pairs))
    # Each mention once, however many windows hold it.
    mentions = {pair for _, pairs in found for pair in pairs}
    counts: dict[int, Counter] = {}
    for _, a, b in mentions:
        counts.setdefault(a, Counter())[b] += 1
    stands: dict[int, int | None] = {}
    for a, own in counts.items():
        most = max(own.values())
        first = [b for b, n in own.items() if n == most]
        stands[a] = first[0] if len(first) == 1 else a if own[a] else None
    decided = None not in stands.values()
    places, in_runs = set(), set()
    for place, pairs in found:
        same = all(a == b for _, a, b in pairs)
        if same or (decided and all(stands[a] == b for _, a, b in pairs)):
            places.add(place)
            if decided or not pairs:
                in_runs.add(place)
    changed = sum(a != b for a, b in stands.items()) if decided else 0
    return sorted(places), sorted(in_runs), changed


def _counted_places(met: DataFrame, own: list[str]) -> DataFrame:
    """(``own``, _places, _in_runs, _changed) of every occurrence in rows that met by hash."""
    schema = T.StructType([met.schema[k] for k in own])
    places = T.ArrayType(T.IntegerType())
    schema = schema.add("_places", places).add("_in_runs", places).add("_changed", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int32())
        for batch in batches:
            found = [_consistent(windows) for windows in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((kind, kind, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=schema.names)

    met = met.withColumn("_offset", F.col("pos") - F.col("item_pos")).groupBy(*own, "_offset")
    grouped = met.agg(
        F.collect_set(F.struct("item_pos", "item_slots", "slots")).alias("_windows"),
        F.bool_or((F.col("item_case") == 0) | (F.col("item_case") != F.col("case"))).alias("_own_case"),
    ).where("_own_case")
    return grouped.select(*own, "_windows").mapInArrow(run, schema)


def _bitmap(windows: DataFrame, n: int) -> bytes:
    """Bits of the window hashes, as many as the benchmark needs; at most a 32nd of them, in
    rows, reaches the driver."""
    bits = next((b for b in BITMAP_BITS if 16 * n <= 1 << b), BITMAP_BITS[-1])
    slot = F.shiftrightunsigned("hash", 64 - bits)
    bit = F.expr(f"shiftleft(1L, cast(pmod(shiftrightunsigned(hash, {64 - bits}), 32) as int))")
    rows = windows.groupBy(F.shiftright(slot, 5).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros((1 << bits) // 32, np.uint32)
    for row in rows:
        out[row.word] = row.bits
    return out.tobytes()


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    return reduce(Column.__and__, [left[c].eqNullSafe(right[f"_{c}"]) for c in columns])


def _beside(met: DataFrame, items: DataFrame, source: DataFrame, keys: list[str], window: int) -> DataFrame:
    """Rows like ``met`` for the items' windows of placeholders alone, at their places beside
    windows that have met. Documents without an occurrence of such an item are not read again."""
    name = ["item_id", "_version", "_caseless"]
    bare = items.where(F.col("bare").isNotNull()).drop("hash").withColumnsRenamed({c: f"_{c}" for c in name})
    occurrences = met.select(*keys, *name, (F.col("pos") - F.col("item_pos")).alias("_at")).distinct()
    wanted = occurrences.join(bare, _same(occurrences, bare, name)).withColumn("_pos", F.col("_at") + F.col("item_pos"))
    wanted = wanted.drop("_at", *[f"_{c}" for c in name]).withColumnsRenamed({k: f"_{k}" for k in keys})
    hit = wanted.select(*[f"_{k}" for k in keys]).distinct()
    texts = source.join(hit, _same(source, hit, keys), "left_semi")
    own = template_windows(texts, keys, "_doc", window, bare_only=True).select(*keys, "pos", "case", "slots", F.col("bare").alias("_bare"))
    place = _same(own, wanted, keys) & (own["pos"] == wanted["_pos"]) & (own["_bare"] == wanted["bare"])
    return own.join(wanted, place).select(*met.columns)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    keys: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: float = COVERAGE,
    run_tokens: int = RUN_TOKENS,
) -> DataFrame:
    """(``keys``, item_id, matched, item_windows, coverage, run_tokens, changed_slots).

    One row per document row (told apart by ``keys``) and benchmark item it contains: at
    least ``coverage`` of the item's template windows, or ``run_tokens`` template tokens in
    a row. ``changed_slots`` counts slot values that differ from the item's. NULL and
    wordless texts on either side match nothing; items shorter than a window are one
    window, met wherever their tokens occur, in any case. A NULL item id is an item.
    Repeated items and rows with equal keys are one each. No items or documents give no rows.
    """
    item = benchmark.select(F.col(item_id).alias("item_id"), F.xxhash64(item_text).alias("_version"), F.col(item_text).alias("_item"))
    item = item.dropDuplicates(["item_id", "_version"])
    items = durable(template_windows(item, ["item_id", "_version"], "_item", window), "item-windows")
    items = items.select(
        "item_id",
        "_version",
        "hash",
        F.col("pos").alias("item_pos"),
        "n_windows",
        F.col("slots").alias("item_slots"),
        F.col("case").alias("item_case"),
        (F.col("case") != 0).alias("_caseless"),
        "bare",
    )
    seen = items.agg(
        F.count("*").alias("n"),
        F.count("bare").alias("bare"),
        F.collect_set(F.when((F.col("item_case") == SHORT) & (F.size("item_slots") < window), F.size("item_slots"))).alias("lengths"),
    ).first()
    keyed = {k: f"_key{i}" for i, k in enumerate(keys)}
    source = docs.select(*[F.col(f"`{k}`").alias(v) for k, v in keyed.items()], F.col(text).alias("_doc"))
    lengths = tuple(sorted(seen.lengths))
    found = template_windows(source, list(keyed.values()), "_doc", window, _bitmap(items, seen.n), lengths)
    row_bytes = 80 + 8 * window
    small = seen.n * row_bytes <= BROADCAST_BYTES
    by_hash = items.drop("bare")
    met = found.drop("n_windows", "bare").join(F.broadcast(by_hash) if small else by_hash, "hash").drop("hash")
    if seen.bare:
        met = durable(met, "met")
        met = met.unionByName(_beside(met, items, source, list(keyed.values()), window))

    own = [*keyed.values(), "item_id", "_version", "_caseless"]
    places = _counted_places(met, [*own, "n_windows"])
    merged = places.groupBy(*own, "n_windows").agg(
        F.array_distinct(F.flatten(F.collect_list("_places"))).alias("_places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_in_runs")))).alias("_in_runs"),
        F.max("_changed").alias("changed_slots"),
    )
    # Longest run of neighbouring windows: positions minus their rank are equal inside a run.
    runs = F.transform("_in_runs", lambda p, i: p - i)
    longest = F.coalesce(F.array_max(F.transform(F.array_distinct(runs), lambda r: F.size(F.filter(runs, lambda x: x == r)))), F.lit(0))
    matched = F.size("_places")
    scored = merged.select(
        *own,
        matched.alias("matched"),
        F.col("n_windows").alias("item_windows"),
        (matched / F.col("n_windows")).alias("coverage"),
        F.when(longest > 0, longest + (window - 1)).otherwise(0).alias("run_tokens"),
        "changed_slots",
    ).where((F.col("coverage") >= coverage) | (F.col("run_tokens") >= run_tokens))
    # Several texts under one item id, or both templates: the best covered counts.
    best = F.max_by(
        F.struct("matched", "item_windows", "coverage", "run_tokens", "changed_slots"), F.struct("coverage", "matched", "_version", ~F.col("_caseless"))
    )
    out = scored.groupBy(*keyed.values(), "item_id").agg(best.alias("_best"))
    return out.select(*[F.col(v).alias(k) for k, v in keyed.items()], "item_id", "_best.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **rules) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item; columns, of any names and types,
    as they came. NULL and empty texts and repeated rows stay; rows equal in all columns are
    judged alike (``row_identity``)."""
    row = fresh("_row", docs)
    keyed = docs.withColumn(row, row_identity(docs))
    hits = durable(contaminated(keyed, benchmark, [row], text, **rules).select(row).distinct(), "contaminated")
    return keyed.join(hits, row, "left_anti").drop(row)
