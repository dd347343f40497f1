"""Removal of long repeated byte strings by longest-previous-factor arrays over partitioned suffixes.

A suffix is dealt out by the minimizer of its first ``length`` bytes: the
smallest hash among its ``GRAM``-byte strings. Suffixes that agree in ``length``
bytes have the same minimizer at the same place, so they meet in one group.
Neighbouring suffixes share their minimizer, so a run of them travels as one row
of bytes, and only runs whose minimizer occurs elsewhere travel at all.

In a task, rows are aligned at their minimizer. Their suffix order there comes
from sorting the bytes that follow; the order of the suffixes that start one byte
further left follows from it by a stable sort on that byte. In suffix order,
suffixes with a common prefix of ``length`` bytes form runs. The longest previous
factor of a suffix reaches ``length`` exactly if the previous or the next smaller
text position in suffix order lies in the same run, that is if it is not the
run's smallest position; the longest next factor mirrors it. Matches are compared
byte by byte before they count.

A minimizer with more than ``HOT`` rows is not gathered in a task. Its runs are
compared in pieces by 128-bit hashes: of all bytes of a piece, and of the core
that its suffixes have in common. Of pieces with the same bytes only the first
and the last occurrence (combined within each text, then before the shuffle) can
have anything else to find; the others match from end to end. These two go on in
narrower pieces while another piece has their core, down to single suffixes, so
an occurrence makes a few rows at each width and not one for each suffix, and a
text that repeats one pattern sends two rows for each content of its runs. Equal texts form one class
that is read once; further copies of a text repeat all of it.

Positions are ordered by (id, place in the text). Null text counts as empty, and
texts shorter than ``length`` never change. Null ids come last. Repeated rows are
copies of each other. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import map_rows, require, slices, table
from tripmill.session import settle

LENGTH = 400
GRAM = 32
HOT = 4096
SEGMENT = 900_000
ROWS_BYTES = 12 << 20
#: Distances to the minimizer in one piece of a hot run; each width divides the one before, the first pieces are whole runs.
WIDTHS = (64, 8, 1)
_INDEX = np.uint64((1 << 20) - 1)
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def runs(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of suffixes with one minimizer: (text number, first start, number of starts, minimizer place, hash)."""
    units = [(number, at) for number, text in enumerate(texts) for at in range(0, max(1, len(text) - length + 1), SEGMENT) if len(text) >= length]
    parts = [[], [], [], [], []]
    group, weight = [], 0
    for number, at in [*units, (-1, 0)]:
        piece = texts[number][at : at + SEGMENT + length - 1] if number >= 0 else b""
        if group and (number < 0 or weight + len(piece) > SEGMENT + length):
            for part, found in zip(parts, _runs_of(group, length)):
                part.append(found)
            group, weight = [], 0
        if number >= 0:
            group.append((number, at, piece))
            weight += len(piece)
    return tuple(np.concatenate(part) if part else np.zeros(0, np.int64) for part in parts)


def _runs_of(group: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(piece for _, _, piece in group), np.uint8)
    begin = np.cumsum([0, *(len(piece) for _, _, piece in group)])
    rolled, step, power = data.astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while step < GRAM:
        rolled = rolled[:-step] * np.uint64(power) + rolled[step:]
        step, power = 2 * step, power * power % (1 << 64)
    hashes = _mix(rolled)
    packed = (hashes & ~_INDEX) | np.arange(len(hashes), dtype=np.uint64)
    window, span = length - GRAM + 1, 1
    while 2 * span <= window:
        packed = np.minimum(packed[:-span], packed[span:])
        span *= 2
    packed = np.minimum(packed[: len(packed) - (window - span)], packed[window - span :])
    valid = np.zeros(len(packed), bool)
    for low, high in zip(begin[:-1], begin[1:]):
        valid[low : high - length + 1] = True
    starts = np.flatnonzero(valid)
    places = (packed[starts] & _INDEX).astype(np.int64)
    first = np.flatnonzero(np.append(True, (starts[1:] != starts[:-1] + 1) | (places[1:] != places[:-1])))
    counts = np.diff(np.append(first, len(starts)))
    owner = np.searchsorted(begin, starts[first], side="right") - 1
    shift = np.array([at for _, at, _ in group])[owner] - begin[owner]
    number = np.array([n for n, _, _ in group])[owner]
    return number, starts[first] + shift, counts, places[first] + shift, hashes[places[first]].view(np.int64)


def factor_ranges(rows: list[bytes], before: np.ndarray, fewest: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Suffixes with an earlier and with a later match, as ranges of their distance to the minimizer.

    ``rows[i]`` has its minimizer at ``before[i]``; its suffixes start ``fewest[i]``
    to ``before[i]`` bytes before it. ``order`` ranks rows by text position. Returns
    columns (largest, smallest) for earlier and (largest, smallest) for later
    matches, -1 where there are none.
    """
    count = len(rows)
    found = np.full((count, 4), -1, np.int64)
    deepest = int(before.max())
    width = max(len(r) - b for r, b in zip(rows, before))
    aligned = np.zeros((count, deepest + width), np.uint8)
    for i, (row, b) in enumerate(zip(rows, before)):
        aligned[i, deepest - b : deepest - b + len(row)] = np.frombuffer(row, np.uint8)
    # suffix order at the minimizer; then one more byte to the left at a time
    by_suffix = np.array(sorted(range(count), key=lambda i: rows[i][before[i] :]), np.int64)
    sums, steps = [], []
    for base in _BASES:  # rolling hashes of the window that starts `distance` before the minimizer
        total = np.zeros(count, np.uint64)
        for place in range(length):  # byte by byte, so that no matrix of words is held
            byte = aligned[:, deepest + place] if place < width else np.zeros(count, np.uint8)
            total = total * np.uint64(base) + (byte.astype(np.uint64) + np.uint64(1))
        sums.append(total)
        steps.append((np.uint64(base), np.uint64(pow(base, -1, 1 << 64)), np.uint64(pow(base, length - 1, 1 << 64))))
    one = np.uint64(1)
    for distance in range(deepest + 1):
        if distance:
            left = aligned[:, deepest - distance]
            by_suffix = by_suffix[np.argsort(left[by_suffix], kind="stable")]
            leaving = deepest + length - distance
            gone = aligned[:, leaving] if leaving < aligned.shape[1] else np.zeros(count, np.uint8)
            for n, (base, inverse, top) in enumerate(steps):
                sums[n] = (sums[n] - (gone.astype(np.uint64) + one)) * inverse + (left.astype(np.uint64) + one) * top
        here = by_suffix[(fewest[by_suffix] <= distance) & (distance <= before[by_suffix])]
        if len(here) < 2:
            continue
        a, b = sums[0][here], sums[1][here]
        edge = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        if len(edge) == len(here):
            continue
        sizes = np.diff(np.append(edge, len(here)))
        run = np.repeat(np.arange(len(edge)), sizes)
        place = order[here]
        smallest, largest = np.minimum.reduceat(place, edge), np.maximum.reduceat(place, edge)
        # the same bytes, not only the same hash, as the first row of the run
        pair = sizes[run] > 1
        lead = here[edge][run[pair]]
        window = slice(deepest - distance, deepest - distance + length)
        same = (aligned[here[pair], window] == aligned[lead, window]).all(axis=1)
        for column, chosen in ((0, place[pair] > smallest[run[pair]]), (2, place[pair] < largest[run[pair]])):
            hit = here[pair][chosen & same]
            found[hit, column] = distance
            found[hit, column + 1] = np.where(found[hit, column + 1] < 0, distance, found[hit, column + 1])
    return found


def _anchors(length: int):
    def anchors(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (h, k1, k2, start, starts, place) of the distinct texts of a task."""
        seen: set[tuple[int, int]] = set()
        for batch in source:
            for piece in slices([batch], "text", 4 << 20):
                keys, texts = [], []
                for k1, k2, text in zip(piece.column("k1").to_pylist(), piece.column("k2").to_pylist(), piece.column("text").to_pylist()):
                    if (k1, k2) not in seen:
                        seen.add((k1, k2))
                        keys.append((k1, k2))
                        texts.append(text.encode())
                number, start, starts, place, hashes = runs(texts, length)
                keys = np.array(keys, np.int64).reshape(-1, 2)
                yield pa.record_batch(
                    [pa.array(hashes), pa.array(keys[number, 0]), pa.array(keys[number, 1]), pa.array(start), pa.array(starts.astype(np.int32)), pa.array(place)],
                    ["h", "k1", "k2", "start", "starts", "place"],
                )

    return anchors


def _squeeze(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    packer, seen = zstandard.ZstdCompressor(3), set()
    for batch in source:
        for piece in slices([batch]):
            rows = []
            for k1, k2, text in zip(piece.column("k1").to_pylist(), piece.column("k2").to_pylist(), piece.column("text").to_pylist()):
                if (k1, k2) not in seen:
                    seen.add((k1, k2))
                    rows.append((k1, k2, packer.compress(text.encode())))
            yield pa.record_batch(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                ["k1", "k2", "z"],
            )


def _cut_rows(length: int, hot_rows: int):
    def cut(source: Iterator[dict]) -> Iterator[dict]:
        """The bytes of each run (kind 0, hot ones kind 1), the text itself (kind 2), and what hot runs cover for certain (kind 3, start to place)."""
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for row in source:
            text = unpack.decompress(row["z"])
            key = {"k1": row["k1"], "k2": row["k2"], "least": row["least"]}
            yield key | {"kind": 2, "data": row["z"]}
            hot, inner = _ends(text, [run for run in row["runs"] if run["n"] > hot_rows], length)
            for kind, found in ((0, [run for run in row["runs"] if run["n"] <= hot_rows]), (1, hot)):
                for run in found:
                    data = text[run["start"] : run["start"] + run["starts"] + length - 1]
                    yield key | {"kind": kind, "h": run["h"], "start": run["start"], "starts": run["starts"], "place": run["place"], "data": data}
            for low, high in inner:
                yield key | {"kind": 3, "start": low, "place": high}

    return cut


def _ends(text: bytes, hot: list[dict], length: int) -> tuple[list[dict], list[tuple[int, int]]]:
    """Of equal runs within a text the first and the last, and the spans of those between, which match from end to end on both sides."""
    first, last, spans = {}, {}, []
    for run in sorted(hot, key=lambda r: r["place"]):
        at = run["place"] - run["start"]
        content = _digest(b"%d %d " % (at, run["starts"]) + text[run["start"] : run["start"] + run["starts"] + length - 1])
        if content not in first:
            first[content] = run
        else:
            between = last.get(content)
            if between is not None:
                spans.append((between["start"], between["start"] + between["starts"] + length - 1))
            last[content] = run
    return [*first.values(), *last.values()], merged_spans(spans)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _pieces(width: int, length: int):
    def pieces(source: Iterator[dict]) -> Iterator[dict]:
        """Pieces of at most ``width`` distances of the given ranges of a run, with hashes of their core and of all their bytes."""
        for row in source:
            data, at = row["data"], row["place"] - row["start"]
            key = {c: row[c] for c in ("k1", "k2", "least", "start", "place")}
            for span in row["ranges"]:
                low = span["low"]
                while low <= span["high"]:
                    block = low - low % width
                    end = min(block + width - 1, length - GRAM)
                    high = min(end, span["high"])
                    core, whole = data[at - block : at - end + length], data[at - high : at - low + length]
                    yield key | {"low": low, "high": high, "block": block, "core": _digest(core), "whole": _digest(b"%d %d " % (low, high) + whole)}
                    low = high + 1

    return pieces


def _hot_spans(runs_of: DataFrame, length: int) -> DataFrame | None:
    """Spans (k1, k2, later, low, high) of the runs of hot minimizers; None where there are no such runs."""
    key = ["k1", "k2", "start", "place"]
    id_type = runs_of.schema["least"].dataType.simpleString()
    shape = f"k1 bigint, k2 bigint, least {id_type}, start bigint, place bigint, low bigint, high bigint, block bigint, core binary, whole binary"
    whole_run = F.struct((F.col("place") - F.col("start") - F.col("starts") + 1).alias("low"), (F.col("place") - F.col("start")).alias("high"))
    todo, spans = runs_of.withColumn("ranges", F.array(whole_run)), None
    for width in (length, *WIDTHS):
        if todo.isEmpty():
            break
        position = F.struct(F.col("least").isNull().alias("none"), "least", "k1", "k2", "place")
        pieces = settle(map_rows(todo, _pieces(width, length), shape, lambda r: 160).withColumn("position", position), "hot-pieces")
        contents = pieces.groupBy("block", "core", "whole").agg(F.min("position").alias("_first"), F.max("position").alias("_last"))
        shared = contents.groupBy("block", "core").agg(F.count(F.lit(1)).alias("_contents")).where("_contents > 1")
        ends = contents.join(shared, ["block", "core"], "left").where("_first <> _last or _contents > 1")
        is_first, is_last = F.col("position") == F.col("_first"), F.col("position") == F.col("_last")
        told = settle(
            pieces.join(ends, ["block", "core", "whole"]).select(
                *key, "low", "high", (~is_first).alias("earlier"), (~is_last).alias("later"), ((is_first | is_last) & F.col("_contents").isNotNull()).alias("open")
            ),
            "hot-matches",
        )
        sides = F.explode(F.array(F.struct(F.col("earlier").alias("hit"), F.lit(False).alias("later")), F.struct(F.col("later").alias("hit"), F.lit(True).alias("later"))))
        found = told.select("k1", "k2", "place", "low", "high", sides.alias("_s")).where("_s.hit")
        found = found.select("k1", "k2", "_s.later", (F.col("place") - F.col("high")).alias("low"), (F.col("place") - F.col("low") + length).alias("high"))
        spans = found if spans is None else spans.unionByName(found)
        ranges = told.where("open").groupBy(*key).agg(F.collect_list(F.struct("low", "high")).alias("ranges"))
        todo = runs_of.join(ranges, key)
    return spans


def _match(length: int):
    def match(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Spans (k1, k2, later, low, high) from rows sorted by h: low to high has matches; later tells where they lie."""
        held: list[pa.RecordBatch] = []
        weight = 0
        for batch in source:
            held.append(batch)
            weight += batch.nbytes
            if weight < ROWS_BYTES:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            h = whole.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1]))
            if cut:
                yield from work(whole.slice(0, cut))
                held = whole.slice(cut).to_batches()
                weight = (len(whole) - cut) * 2 * length
            else:
                weight = 0  # one group goes on; it has at most HOT rows
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        h = rows.column("h").to_numpy()
        sizes = np.diff(np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h)))
        rows = rows.filter(pa.array(np.repeat(sizes, sizes) > 1))
        if not rows.num_rows:
            return
        k1, k2, start, starts, place = (rows.column(c).to_numpy() for c in ("k1", "k2", "start", "starts", "place"))
        least = pd.Series(rows.column("least").to_pylist())
        ids = pd.factorize(least, sort=True)[0]
        ids = np.where(ids < 0, len(ids), ids)
        order = np.empty(rows.num_rows, np.int64)
        order[np.lexsort((place, k2, k1, ids))] = np.arange(rows.num_rows)
        before = place - start
        found = factor_ranges(rows.column("data").to_pylist(), before, before - starts + 1, order, length)
        for column, later in ((0, False), (2, True)):
            hit = np.flatnonzero(found[:, column] >= 0)
            yield pa.record_batch(
                [pa.array(k1[hit]), pa.array(k2[hit]), pa.array(np.full(len(hit), later)), pa.array(place[hit] - found[hit, column]), pa.array(place[hit] - found[hit, column + 1] + length)],
                ["k1", "k2", "later", "low", "high"],
            )

    return match


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Per distinct text (k1, k2): its class (least, copies), its spans with matches, and, where it has any, its packed text."""
    require(docs, id_col, text_col)
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} at least")
    rows = _keyed(docs, id_col, text_col)
    classes = settle(
        rows.groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n_bytes").alias("n_bytes"), F.first("sha").alias("sha")), "texts"
    )
    long_enough = rows.where(F.col("n_bytes") >= length).select("k1", "k2", "text")
    anchors = settle(
        long_enough.mapInArrow(_anchors(length), "h bigint, k1 bigint, k2 bigint, start bigint, starts int, place bigint").dropDuplicates(), "anchors"
    )
    repeated = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    per_text = anchors.join(repeated, "h").groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "start", "starts", "place", "n")).alias("runs"))
    texts = long_enough.mapInArrow(_squeeze, "k1 bigint, k2 bigint, z binary").dropDuplicates(["k1", "k2"])
    wanted = texts.join(per_text, ["k1", "k2"]).join(classes.select("k1", "k2", "least"), ["k1", "k2"])
    id_type = classes.schema["least"].dataType.simpleString()
    shape = f"k1 bigint, k2 bigint, least {id_type}, kind int, h bigint, start bigint, starts int, place bigint, data binary"
    cut = settle(map_rows(wanted, _cut_rows(length, HOT), shape, lambda r: 100 + len(r.get("data") or b"")), "suffix-rows")
    span = "k1 bigint, k2 bigint, later boolean, low bigint, high bigint"
    close = (
        cut.where("kind = 0")
        .select("h", "k1", "k2", "least", "start", "starts", "place", "data")
        .repartition("h")
        .sortWithinPartitions("h")
        .mapInArrow(_match(length), span)
    )
    hot = _hot_spans(cut.where("kind = 1").select("k1", "k2", "least", "start", "starts", "place", "data"), length)
    if hot is not None:
        inner = cut.where("kind = 3").select("k1", "k2", F.col("start").alias("low"), F.col("place").alias("high"))
        close = close.unionByName(hot).unionByName(inner.select("k1", "k2", F.lit(False).alias("later"), "low", "high"))
        close = close.unionByName(inner.select("k1", "k2", F.lit(True).alias("later"), "low", "high"))
    spans = settle(close, "spans")
    return classes, spans, cut.where("kind = 2").select("k1", "k2", F.col("data").alias("z"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.xxhash64(text).alias("k1"),
        F.xxhash64(F.lit(1), text).alias("k2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("sha"),
    )


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def without(text: bytes, spans: list[tuple[int, int]], whole_characters: bool = False) -> bytes:
    """The bytes outside of the spans; ``whole_characters`` shrinks spans to character borders."""
    kept, at = [], 0
    for low, high in spans:
        if whole_characters:
            while low < high and text[low] & 0xC0 == 0x80:
                low += 1
            while high > low and high < len(text) and text[high] & 0xC0 == 0x80:
                high -= 1
        kept.append(text[at:low])
        at = high
    return b"".join([*kept, text[at:]])


def _texts_without(spans: DataFrame, texts: DataFrame, keep_first: bool, payload: bool) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept_sha256, kept) of texts with spans."""
    chosen = spans.where(~F.col("later")) if keep_first else spans
    per_text = chosen.groupBy("k1", "k2").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def remove(source: Iterator[dict]) -> Iterator[dict]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for row in source:
            text = unpack.decompress(row["z"])
            found = merged_spans([(s["low"], s["high"]) for s in row["spans"]])
            kept = without(text, found, payload)
            yield {
                "k1": row["k1"],
                "k2": row["k2"],
                "n_removed": len(text) - len(kept),
                "n_spans": len(found),
                "kept_sha256": hashlib.sha256(kept).hexdigest(),
                "kept": kept.decode() if payload else None,
            }

    return map_rows(texts.join(per_text, ["k1", "k2"]), remove, "k1 bigint, k2 bigint, n_removed bigint, n_spans int, kept_sha256 string, kept string", lambda r: 200 + len(r["kept"] or ""))


_NOTHING = hashlib.sha256(b"").hexdigest()


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document, with every copy of a repeated string removed: id, n_bytes, n_removed, n_spans, kept_sha256."""
    classes, spans, texts = repeated_spans(docs, id_col, text_col, length)
    changed = _texts_without(spans, texts, False, False).drop("kept")
    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    results = settle(
        classes.join(changed, ["k1", "k2"], "left").select(
            "k1",
            "k2",
            "n_bytes",
            F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copied, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(copied, _NOTHING).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        ),
        "removals",
    )
    members = _keyed(docs, id_col, text_col).select(F.col("id").alias(id_col), "k1", "k2")
    return members.join(results, ["k1", "k2"]).select(id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with later copies of repeated strings cut out of the text; rows of which nothing is left go.

    Cuts respect character borders. Of equal texts the row with the smallest id is the first.
    """
    classes, spans, texts = repeated_spans(docs, id_col, text_col, length)
    changed = settle(_texts_without(spans, texts, True, True).select("k1", "k2", "kept"), "changed")
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.withColumns({"_k1": F.xxhash64(text), "_k2": F.xxhash64(F.lit(1), text)})
    copied = classes.where((F.col("copies") > 1) & (F.col("n_bytes") >= length)).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("least").alias("_least"))
    firsts = keyed.join(copied, ["_k1", "_k2"], "left").where(F.col("_least").isNull() | F.col(id_col).eqNullSafe(F.col("_least"))).drop("_least")
    cut = firsts.join(changed.toDF("_k1", "_k2", "_kept"), ["_k1", "_k2"], "left").where(F.col("_kept").isNull() | (F.col("_kept") != ""))
    return cut.withColumn(text_col, F.coalesce("_kept", text_col)).select(*docs.columns)


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removal_report(table(spark, sf_dir, "documents"))


QUERIES = {"op7_suffix_array_dedup": op7_suffix_array_dedup}
SQL: dict[str, str] = {}
