"""Repeated passages removed by a prefix-free parse of the corpus and its sorted dictionary.

Parse. A rolling hash over ``TRIGGER`` bytes marks, for every window of ``length`` bytes, its
least place: the trigger. Windows in a row with one trigger are a phrase: the text from the
first window's start to the last one's end, so that phrases overlap like those of a
prefix-free parse and every window lies in one phrase whole. Triggers depend on the
window's bytes alone, so equal windows have equal triggers wherever they stand.

Dictionary and parse. Phrases are named by fingerprints and counted over the corpus. A
trigger that occurs once has no repeated window. A phrase that occurs twice has only
repeated windows. That settles nearly all of the text, copies included, at a row per
phrase. What is left are phrases at the edges of repeats: distinct phrases with a common
trigger. Each is taken once, their suffixes are sorted, by fingerprints of ``length`` bytes,
and suffixes that agree with a neighbour in that order in all ``length`` bytes are repeats.
Triggers with many distinct phrases are settled by counting the suffixes' fingerprints
instead, so that no task needs them together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.llm.tables import clear_name, kept, quoted
from shardloom.llm.text import PIECE_BYTES, Fingerprints, encoded, groups, ranges
from shardloom.session import attach

LENGTH = 200
TRIGGER = 64
# Distinct phrases of one trigger that a task sorts; those of other triggers are counted.
SORTED_TOGETHER = 2_048
# Phrases whose suffixes are sorted at once, if they fit.
LOT = 2_048

_PARSE = (
    "struct<triggers:array<bigint>,names:array<bigint>,lows:array<bigint>,spans:array<int>>"
)
# A window's place in the least-hash search takes the low bits of a 64-bit number.
_PLACE_BITS = 22


def parse(text: bytes, length: int = LENGTH, width: int = TRIGGER):
    """Phrases of a text: trigger fingerprints, names, first window starts, further windows."""
    parts = []
    for at in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
        piece = text[at : at + PIECE_BYTES + length - 1]
        found = _parse_joined([piece], length, width)
        parts.append([found[1], found[2], found[3] + at, found[4]])
    return [np.concatenate(columns) for columns in zip(*parts, strict=True)]


def _parse_joined(texts: Sequence[bytes], length: int, width: int):
    """Phrases of several texts: the text's number, trigger, name, start in the text, further windows."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return [empty, empty.view(np.uint64), empty.view(np.uint64), empty, empty]
    prints = Fingerprints(data)
    hashes = prints.all(width)
    # The least hash of a window, the rightmost of equals, in the high bits of one number.
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    span, reach = length - width + 1, 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if span > reach:
        least = np.minimum(least[: len(least) - (span - reach)], least[span - reach :])
    begins = np.cumsum(sizes) - sizes
    windows = np.maximum(sizes - length + 1, 0)
    starts = ranges(begins, windows)  # of the windows that lie in one text
    place = (low - (least[starts] & low)).astype(np.int64)
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    head = np.flatnonzero(fresh)
    first = starts[head]
    further = np.diff(head, append=len(starts)) - 1
    owner = np.searchsorted(begins, first, side="right") - 1
    owner = owner if not len(owner) else _nonempty(owner, begins, sizes)
    place = place[head]
    names = prints.of(first, first + further + length)
    names += (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return [owner, hashes[place], names, first - begins[owner], further]


def _nonempty(owner: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``owner`` is the last text that begins at or before; empty ones begin there too."""
    filled = np.flatnonzero(sizes > 0)
    return filled[np.searchsorted(begins[filled], begins[owner], side="right") - 1]


def _parses(length: int):
    @F.arrow_udf(_PARSE)
    def parses(column: pa.Array) -> pa.Array:
        texts = encoded(column)
        per_text, parts = np.zeros(len(texts), np.int64), []
        for lo, hi in groups([len(t) for t in texts]):
            if hi - lo == 1:
                columns = parse(texts[lo], length)
                per_text[lo] = len(columns[0])
            else:
                owner, *columns = _parse_joined(texts[lo:hi], length, TRIGGER)
                per_text[lo:hi] = np.bincount(owner, minlength=hi - lo)
            parts.append(columns)
        offsets = pa.array(np.concatenate([[0], np.cumsum(per_text)]), pa.int32())
        kinds = (np.int64, np.int64, np.int64, np.int32)
        lists = []
        for k, kind in enumerate(kinds):
            flat = np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind)
            flat = flat.view(kind) if flat.dtype == np.uint64 else flat.astype(kind)
            lists.append(pa.ListArray.from_arrays(offsets, pa.array(flat)))
        return pa.StructArray.from_arrays(lists, ["triggers", "names", "lows", "spans"])

    return parses


def repeated_spans(docs: DataFrame, text_col: str, length: int = LENGTH) -> DataFrame:
    """``(row, spans)``: rows of ``docs`` by :func:`row_key`, starts and ends of repeated windows' runs.

    ``spans`` is an array of structs ``(start, end)``, ``end`` being after the last byte; they
    may touch and overlap. Rows without a repeated window are not there.
    """
    spark = attach(docs.sparkSession)
    key = row_key(docs)
    parsed = docs.select(key.alias("row"), _parses(length)(quoted(text_col)).alias("p"))
    # Copies of one row share a key; each counts, so the number given here tells them apart.
    numbered = parsed.select(F.monotonically_increasing_id().alias("id"), "row", "p.*")
    parses = kept(numbered, "parse")
    phrases = parses.select(
        "id", F.inline(F.arrays_zip("triggers", "names", "lows", "spans"))
    ).toDF("id", "trigger", "name", "low", "further")
    met = phrases.groupBy("trigger").agg(
        F.count(F.lit(1)).alias("n"), F.min("name").alias("one"), F.max("name").alias("other")
    )
    met = kept(
        met.filter("n > 1").select("trigger", (F.col("one") != F.col("other")).alias("mixed")), "triggers"
    )
    shared = kept(phrases.join(met, "trigger"), "shared")
    mixed = shared.filter("mixed")
    names = mixed.groupBy("trigger", "name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "low")).alias("sample")
    )
    names = kept(names, "names")
    # Triggers with a phrase that occurs once, the only ones with anything left to find.
    unsettled = names.groupBy("trigger").agg(
        (F.count(F.lit(1)) > SORTED_TOGETHER).alias("many"), F.min("n").alias("fewest")
    )
    unsettled = unsettled.filter("fewest = 1").select("trigger", "many")
    # One phrase for each name goes into the dictionary; it weighs as the name's occurrences.
    dictionary = names.join(unsettled, "trigger").select(
        F.col("sample.id").alias("id"), F.col("sample.low").alias("low"), "n", "many"
    )
    judged = kept(
        mixed.join(dictionary.withColumnRenamed("n", "weight"), ["id", "low"])
        .select("id", "low", "further", "trigger", "weight", "many"),
        "dictionary",
    )
    edges = judged.groupBy("id").agg(
        F.collect_list(F.struct("low", "further", "trigger", "weight", "many")).alias("wanted")
    )
    places = edges.join(parses.select("id", "row"), "id")
    texts = docs.select(key.alias("row"), quoted(text_col).alias("text"))
    cut = places.join(texts, "row").select(
        "id", F.explode(_cutter(length)("text", "wanted")).alias("e")
    )
    # Copies of a row all found the same places.
    strings = kept(cut.select("id", "e.*").dropDuplicates(["id", "low"]), "strings")
    lone = _settled(strings, length)
    whole_names = names.filter("n > 1").select("trigger", "name")
    whole = shared.filter("not mixed").select("id", "low", "further").union(
        mixed.join(whole_names, ["trigger", "name"]).select("id", "low", "further")
    )
    spans = whole.select(
        "id", F.col("low").alias("start"), (F.col("low") + F.col("further") + length).alias("end")
    ).union(lone)
    by_id = spans.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    found = by_id.join(parses.select("id", "row"), "id").select("row", _joined_spans(F.col("spans")).alias("spans"))
    return kept(found.dropDuplicates(["row"]), "spans")


def row_key(docs: DataFrame) -> Column:
    """A 128-bit key of a row's values: rows with equal keys are copies of one another."""
    columns = [quoted(c) for c in docs.columns]
    return F.struct(
        F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b")
    )


def _cutter(length: int):
    @F.arrow_udf(
        "array<struct<low:bigint,further:int,trigger:bigint,weight:bigint,many:boolean,body:binary>>"
    )
    def cut(texts: pa.Array, wanted: pa.Array) -> pa.Array:
        rows = []
        for text, phrases in zip(encoded(texts), wanted.to_pylist(), strict=True):
            rows.append([
                p | {"body": text[p["low"] : p["low"] + p["further"] + length]} for p in phrases
            ])
        return pa.array(rows, pa.list_(pa.struct([
            ("low", pa.int64()), ("further", pa.int32()), ("trigger", pa.int64()),
            ("weight", pa.int64()), ("many", pa.bool_()), ("body", pa.binary()),
        ])))

    return cut


def _settled(strings: DataFrame, length: int) -> DataFrame:
    """``(id, start, end)`` of repeated windows in phrases that occur once."""
    few = strings.filter("not many").repartition("trigger").sortWithinPartitions("trigger")
    sorted_ = few.select("id", "low", "further", "trigger", "weight", "body").mapInArrow(
        _sorter(length), "id bigint, start bigint, end bigint"
    )
    suffixes = strings.filter("many").select(
        "id", "weight", F.explode(_suffixes(length)("low", "body")).alias("s")
    ).select("id", "weight", "s.*")
    seen = suffixes.groupBy("f1", "f2").agg(F.sum("weight").alias("seen")).filter("seen > 1")
    counted = suffixes.filter("weight = 1").join(seen, ["f1", "f2"])
    return sorted_.union(counted.select("id", "start", (F.col("start") + length).alias("end")))


def _suffixes(length: int):
    """The first ``length`` bytes of each suffix of a phrase, as two fingerprints."""

    @F.arrow_udf("array<struct<start:bigint,f1:bigint,f2:bigint>>")
    def suffixes(lows: pa.Array, bodies: pa.Array) -> pa.Array:
        rows = []
        for low, body in zip(lows.to_pylist(), encoded(bodies), strict=True):
            items = []
            for k in range(len(body) - length + 1):
                digest = hashlib.blake2b(body[k : k + length], digest_size=16).digest()
                items.append({
                    "start": low + k, "f1": int.from_bytes(digest[:8], "big", signed=True),
                    "f2": int.from_bytes(digest[8:], "big", signed=True),
                })
            rows.append(items)
        kind = pa.struct([("start", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64())])
        return pa.array(rows, pa.list_(kind))

    return suffixes


def _sorter(length: int):
    def settle(table: pa.Table) -> pa.RecordBatch:
        bodies = encoded(table.column("body"))
        ids, lows = table.column("id").to_numpy(), table.column("low").to_numpy()
        weights = table.column("weight").to_numpy()
        sizes = np.fromiter(map(len, bodies), np.int64, len(bodies))
        data = np.frombuffer(b"".join(bodies), np.uint8)
        begins = np.cumsum(sizes) - sizes
        windows = sizes - length + 1
        at = ranges(begins, windows)
        owner = np.repeat(np.arange(len(bodies)), windows)
        names = Fingerprints(data).of(at, at + length)
        order = np.argsort(names, kind="stable")
        equal = np.flatnonzero(names[order[1:]] == names[order[:-1]])
        view = np.lib.stride_tricks.sliding_window_view(data, length)
        same = np.zeros(len(order), bool)  # as the suffix before, in all bytes
        for lo in range(0, len(equal), 1 << 14):
            rows = equal[lo : lo + (1 << 14)]
            agree = (view[at[order[rows]]] == view[at[order[rows + 1]]]).all(axis=1)
            same[rows[agree] + 1] = True
        repeated = np.zeros(len(order), bool)
        repeated[order] = same | np.append(same[1:], False)
        hit = np.flatnonzero(repeated & (weights[owner] == 1))
        # Windows in a row become one span.
        row, start = owner[hit], at[hit]
        fresh = np.ones(len(hit), bool)
        fresh[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)
        head = np.flatnonzero(fresh)
        tail = np.append(head[1:], len(hit)) - 1
        offset = lows[row] - begins[row]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(ids[row[head]]),
                pa.array((start + offset)[head]),
                pa.array((start + offset)[tail] + length),
            ],
            ["id", "start", "end"],
        )

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, LOT):
                part = batch.slice(lo, LOT)
                held.append(part)
                size += part.num_rows
                if size < 2 * LOT:
                    continue
                # All but the last trigger are complete.
                table = pa.Table.from_batches(held).combine_chunks()
                triggers = table.column("trigger").to_numpy()
                cut = int(np.searchsorted(triggers, triggers[-1]))
                if cut:
                    yield settle(table.slice(0, cut).combine_chunks())
                    held = table.slice(cut).to_batches()
                    size -= cut
        if size:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    return settled


def _joined_spans(spans_of: Column) -> Column:
    """Sorted spans, those that touch or overlap made one."""

    @F.arrow_udf("array<struct<start:bigint,end:bigint>>")
    def apply(column: pa.Array) -> pa.Array:
        rows = []
        for spans in column.to_pylist():
            out: list[dict] = []
            for span in spans:
                if out and span["start"] <= out[-1]["end"]:
                    out[-1]["end"] = max(out[-1]["end"], span["end"])
                else:
                    out.append(span)
            rows.append(out)
        return pa.array(rows, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return apply(spans_of)


def remaining(text: Column, cuts_of: Column) -> Column:
    """A text's bytes outside of sorted spans that do not touch."""

    @F.arrow_udf("binary")
    def apply(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for text, cuts in zip(encoded(texts), spans.to_pylist(), strict=True):
            at, parts = 0, []
            for cut in cuts or ():
                parts.append(text[at : cut["start"]])
                at = cut["end"]
            rows.append(b"".join([*parts, text[at:]]) if parts else text)
        return pa.array(rows, pa.binary())

    return apply(text, cuts_of)


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """All columns of ``docs`` and ``spans, kept_bytes``: each byte of a repeat is removed.

    A byte goes if some string of ``length`` bytes over it starts anywhere else too, in the
    same or another document, judged on the input. ``spans`` are the removed runs, apart
    from each other, an empty array if there is none; ``kept_bytes`` is the rest, which may
    end inside a character. A null text is empty; texts shorter than ``length`` are left
    alone; copies of a row remove each other. Columns named like a new one are replaced.
    """
    made = {"spans", "kept_bytes"}
    own = docs.select(*[quoted(c) for c in docs.columns if c.lower() not in made])
    # Only the id and text that tell rows apart take part in the search.
    spans = repeated_spans(own, text_col, length)
    row = clear_name(own, "_row")
    joined = own.withColumn(row, row_key(own)).join(
        spans.select(F.col("row").alias(row), "spans"), row, "left"
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    all_spans = joined.withColumn("spans", F.coalesce("spans", none))
    return all_spans.select(
        *map(quoted, own.columns), "spans", remaining(quoted(text_col), F.col("spans")).alias("kept_bytes")
    )
