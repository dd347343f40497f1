"""Near-duplicate classes by Jaccard similarity of word shingles, with adaptive multi-match prefixes.

A document is the set of its distinct five-word shingles, as 64-bit hashes. In
one global order of shingles, two sets of similarity 0.8 share at least ``l`` of
the first ``n - ceil(0.8 n) + l`` shingles of each, for any ``l``. So:

1. Sets are hashed per document. Documents with equal sets form one class, and
   only classes are compared. Frequent shingles are counted, those of low hashes
   in a sample of the sets wherever they lie; a bounded number of them goes last
   in the global order, rarer ones first. Any order gives the same result.
2. Each class takes a prefix whose length follows its estimated candidate cost:
   the more frequent its prefix shingles, the longer the prefix and the more
   shared shingles a partner must show.
3. Prefix rows meet by shingle. Short lists give all their pairs, long lists only
   the pairs with their first member. Pairs with enough shared shingles whose
   bitmaps of set bits differ in no more places than similar sets can are
   verified on the complete sets of both texts.
4. In a long list that holds several components, the members outside its largest
   one meet members of it, the nearest by bitmaps of those that their lists name,
   round by round while most of these pairs are links.
5. What a long list left out, and unverified pairs, are taken up where the two
   sides are not yet in one component: exactly these pairs could still change a
   component. A pair is met in the first lists it shares, not in each, and its
   shared shingles are counted from both sides' lists. So a group of thousands of
   near copies costs a row per member and shingle and one for each pair across its
   components that bitmaps allow, and no link between components is lost.

Words are lower-cased (A-Z) runs without white space bytes. A text of fewer than
five words is one shingle; a text without words, or null, is empty and linked
with nothing. Repeated rows fall into one class. A null id never names a class.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import fresh, require, slices, table
from tripmill.llm.components import connected
from tripmill.session import settle

WORDS = 5
#: Similarity 0.8 as a ratio of integers.
SHARE, OF = 4, 5
#: Shingles in so many sets go last in the order, by count; at most so many of them.
FREQUENT, FREQUENT_KEPT = 16, 1_000_000
#: Shingles of hashes up to here, which most prefixes consist of, are counted in one of so many sets; wherever the sets lie.
COUNTED, SAMPLED = np.uint64(int(0.4 * 2**64)), 4
#: Other shingles repeated less often within one map task are not reported as frequent.
LOCAL_REPEATS = 4
#: Shingles that a map task holds before it reports the frequent ones among them.
HELD_SHINGLES = 4_000_000
#: Longest list that gives all its pairs.
SHORT_LIST = 16
MOST_EXTRA = 4
#: Long lists of a member that show where a pair was met before.
FIRST_LISTS = 8
#: Rounds of nearest members before all pairs that are still apart are taken up.
ROUNDS = 4
#: Longs in the bitmap of a set.
MARKS = 16
CHUNK = 1 << 20

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and where it starts."""
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    first = ~space
    first[1:] &= space[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), starts
    inside = np.zeros(len(data), np.int64)
    inside[starts[0] :] = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    longest = int(inside.max()) + 1
    powers = np.cumprod(np.full(longest, np.uint64(0x100000001B3), np.uint64))
    values = (_FOLD[data].astype(np.uint64) + np.uint64(1)) * powers[inside]
    values[space] = 0
    return _mix(np.add.reduceat(values, starts)), starts


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, starts = word_hashes(b" ".join([*texts, b""]))
    places = np.cumsum([0, *(len(t) + 1 for t in texts)])
    bounds = np.searchsorted(starts, places)
    rolled = np.zeros(max(0, len(words) - WORDS + 1), np.uint64)
    for i in range(WORDS):
        rolled = rolled * _ODD + words[i : i + len(rolled)]
    rolled = _mix(rolled)
    sets = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        if high - low >= WORDS:
            sets.append(np.unique(rolled[low : high - WORDS + 1]))
        elif high > low:
            one = np.uint64(high - low)
            for w in words[low:high]:
                one = _mix(np.array([one], np.uint64) * _ODD + w)[0]
            sets.append(np.array([one], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def prefix_length(n: int) -> int:
    return n - (SHARE * n + OF - 1) // OF + 1


def needed(size, extra, other_size, other_extra, least, greatest):
    """Shared prefix shingles that a similar pair has at least.

    One more than the smaller extra; and of the 4/9 of both sizes that similar sets
    share, what cannot lie beyond the prefix that ends first.
    """
    whole = (lambda x, y: x // y) if isinstance(size, np.ndarray) else (lambda x, y: F.floor(x / y))
    beyond, other_beyond = (whole(n * SHARE + OF - 1, OF) - 1 - e for n, e in ((size, extra), (other_size, other_extra)))
    shared = whole((size + other_size) * SHARE + SHARE + OF - 1, SHARE + OF)
    return greatest(least(extra, other_extra) + 1, shared - greatest(beyond, other_beyond))


def similar(left: np.ndarray, right: np.ndarray) -> bool:
    shared = len(np.intersect1d(left, right, assume_unique=True))
    return OF * shared >= SHARE * (len(left) + len(right) - shared) and shared > 0


def marks_of(shingles: np.ndarray) -> np.ndarray:
    """Bitmap of a set: the bit of each shingle is set."""
    bits = np.zeros(64 * MARKS, bool)
    bits[(shingles % np.uint64(64 * MARKS)).astype(np.int64)] = True
    return np.packbits(bits).view(np.int64)


def _apart(left: str, right: str) -> Column:
    """Bits that differ between two bitmaps."""
    return sum((F.bit_count(F.col(f"{left}{i}").bitwiseXOR(F.col(f"{right}{i}"))) for i in range(1, MARKS)), F.bit_count(F.col(f"{left}0").bitwiseXOR(F.col(f"{right}0"))))


def _may_be_similar(left: str, right: str) -> Column:
    """Whether bitmaps allow similarity; columns of the two sides start with ``left`` and ``right``.

    Each bit that differs is a shingle of one side only, and similar sets have at most 1/9
    of their sizes in such shingles.
    """
    return _apart(left, right) * (OF + SHARE) <= (F.col(f"{left}size") + F.col(f"{right}size")) * (OF - SHARE)


def _marks(texts: DataFrame, cid: str, prefix: str) -> DataFrame:
    return texts.select(F.col("cid").alias(cid), F.col("size").alias(f"{prefix}size"), *[F.col(f"m{i}").alias(f"{prefix}{i}") for i in range(MARKS)])


def _class_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple[list, list[np.ndarray], list[bytes]]]:
    for piece in slices([batch], "text", CHUNK):
        texts = [(t or "").encode() for t in piece.column("text").to_pylist()]
        yield piece, shingle_sets(texts), texts


def _describe(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, n_shingles, cid) of each document, and (token, n) of shingles: of the sets sampled, and those repeated in the task."""
    held, weight, seen = [], 0, set()

    def frequent() -> pa.RecordBatch:
        tokens, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        counts = np.where(tokens <= COUNTED, counts * SAMPLED, counts)
        counted = (tokens <= COUNTED) | (counts >= LOCAL_REPEATS)
        tokens, counts = tokens[counted], counts[counted]
        none = pa.nulls(len(tokens), pa.int64())
        return pa.record_batch(
            [pa.nulls(len(tokens), kind), none, none, pa.array(tokens.view(np.int64)), pa.array(counts.astype(np.int64))], names
        )

    names, kind = ["id", "n_shingles", "cid", "token", "n"], pa.int64()
    for batch in source:
        kind = batch.column("id").type
        for piece, sets, _ in _sets_of(batch):
            cids = [_class_id(s) if len(s) else None for s in sets]
            for cid, shingles in zip(cids, sets):
                if cid is not None and cid not in seen:
                    seen.add(cid)
                    held.append(shingles if cid % SAMPLED == 0 else shingles[np.searchsorted(shingles, COUNTED, side="right") :])
                    weight += len(held[-1])
            empty = pa.nulls(len(sets), pa.int64())
            yield pa.record_batch([piece.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(cids, pa.int64()), empty, empty], names)
            if weight > HELD_SHINGLES:
                yield frequent()
                held, weight, seen = [], 0, set()
    yield frequent()


def _emit_prefixes(tokens: np.ndarray, counts: np.ndarray):
    """Prefix rows (token, cid, meta) of the distinct sets of a task; meta is size * 8 + extra matches."""

    def emit(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in source:
            for _, sets, _ in _sets_of(batch):
                rows, cids, metas = [], [], []
                for shingles in sets:
                    if not len(shingles) or (cid := _class_id(shingles)) in seen:
                        continue
                    seen.add(cid)
                    size, base = len(shingles), prefix_length(len(shingles))
                    at = np.minimum(np.searchsorted(tokens, shingles), max(0, len(tokens) - 1))
                    known = counts[at] * (tokens[at] == shingles) if len(tokens) else np.zeros(size, np.int64)
                    by_count = np.argsort(known, kind="stable")  # the global order: count, then hash
                    ordered, cost = shingles[by_count], known[by_count][:base]
                    extra = min(MOST_EXTRA, size - base, int(np.log2(1 + cost.sum() / base)))
                    rows.append(ordered[: base + extra])
                    cids.append(np.full(base + extra, cid, np.int64))
                    metas.append(np.full(base + extra, size * 8 + extra, np.int64))
                if rows:
                    yield pa.record_batch(
                        [pa.array(np.concatenate(rows).view(np.int64)), pa.array(np.concatenate(cids)), pa.array(np.concatenate(metas))], ["token", "cid", "meta"]
                    )

    return emit


def _meet(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates from rows sorted by (token, cid): pairs (a, b, n, need, first) and, of long lists, rows (token, cid)."""

    def numbers(batches: list[pa.RecordBatch]) -> list[np.ndarray]:
        return [np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("token", "cid", "meta")]

    def work(token: np.ndarray, cid: np.ndarray, meta: np.ndarray, inherited: bool) -> Iterator[pa.RecordBatch]:
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (cid[1:] != cid[:-1])
        token, cid, meta = token[fresh], cid[fresh], meta[fresh]
        begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        sizes = np.diff(np.append(begin, len(token)))
        group = np.repeat(np.arange(len(begin)), sizes)
        long_list = sizes > SHORT_LIST
        if inherited:
            long_list[0] = True
        size, extra = meta >> 3, meta & 7
        lefts, rights, leads = [], [], []
        short = ~long_list[group]
        for step in range(1, SHORT_LIST):
            left = np.flatnonzero((token[:-step] == token[step:]) & short[:-step]) if len(token) > step else np.zeros(0, int)
            if not len(left):
                break
            lefts.append(left)
            rights.append(left + step)
            leads.append(left == begin[group[left]])
        members = np.flatnonzero(long_list[group] & (np.arange(len(token)) != begin[group]))
        lefts.append(begin[group[members]])
        rights.append(members)
        leads.append(np.ones(len(members), bool))
        left, right, lead = np.concatenate(lefts), np.concatenate(rights), np.concatenate(leads)
        small, large = np.minimum(size[left], size[right]), np.maximum(size[left], size[right])
        fit = OF * small >= SHARE * large
        left, right, lead = left[fit], right[fit], lead[fit]
        if len(left):
            a, b, need = cid[left], cid[right], needed(size[left], extra[left], size[right], extra[right], np.minimum, np.maximum)
            order = np.lexsort((b, a))
            a, b, need, lead = a[order], b[order], need[order], lead[order]
            at = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
            n = np.diff(np.append(at, len(a)))
            nothing = pa.nulls(len(at), pa.int64())
            yield pa.record_batch(
                [pa.array(a[at]), pa.array(b[at]), pa.array(n), pa.array(need[at]), pa.array(np.logical_or.reduceat(lead, at)), nothing, nothing, nothing], names
            )
        rows = np.flatnonzero(long_list[group])
        if len(rows):
            nothing = pa.nulls(len(rows), pa.int64())
            yield pa.record_batch(
                [nothing, nothing, nothing, nothing, nothing.cast(pa.bool_()), pa.array(token[rows]), pa.array(cid[rows]), pa.array(meta[rows])], names
            )

    names = ["a", "b", "n", "need", "first", "token", "cid", "meta"]
    held: list[pa.RecordBatch] = []
    lead_row, count = None, 0  # first row of a long list that goes on
    for batch in source:
        held.append(batch)
        count += batch.num_rows
        if count < 200_000:
            continue
        token, cid, meta = numbers(held)
        cut = int(np.searchsorted(token, token[-1]))
        open_rows = len(token) - cut
        if cut:
            yield from work(*_with(lead_row, token[:cut], cid[:cut], meta[:cut]))
            lead_row = None
        token, cid, meta = token[cut:], cid[cut:], meta[cut:]
        if open_rows > SHORT_LIST:
            goes_on = (token[:1], cid[:1], meta[:1]) if lead_row is None else lead_row
            yield from work(*_with(lead_row, token, cid, meta)[:3], True)
            lead_row, held = goes_on, []
        else:
            held = [pa.record_batch([pa.array(token), pa.array(cid), pa.array(meta)], ["token", "cid", "meta"])]
        count = sum(b.num_rows for b in held)
    if held:
        yield from work(*_with(lead_row, *numbers(held)))


def _with(lead, token: np.ndarray, cid: np.ndarray, meta: np.ndarray):
    """Rows with the first row of a list that began earlier before them, if it is the same list."""
    if lead is None or not len(token) or token[0] != lead[0][0]:
        return token, cid, meta, False
    return np.concatenate([lead[0], token]), np.concatenate([lead[1], cid]), np.concatenate([lead[2], meta]), True


def _compressed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cid, z, size, marks) of each distinct set of a task: the text compressed, the size and bitmap of its set."""
    import zstandard

    squeeze, seen = zstandard.ZstdCompressor(3), set()
    for batch in source:
        for _, sets, texts in _sets_of(batch):
            cids, packed, sizes, marks = [], [], [], []
            for shingles, text in zip(sets, texts):
                if len(shingles) and (cid := _class_id(shingles)) not in seen:
                    seen.add(cid)
                    cids.append(cid)
                    packed.append(squeeze.compress(text))
                    sizes.append(len(shingles))
                    marks.append(marks_of(shingles))
            columns = [pa.array(c) for c in np.array(marks, np.int64).reshape(-1, MARKS).T]
            yield pa.record_batch(
                [pa.array(cids, pa.int64()), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64()), *columns], ["cid", "z", "size", *(f"m{i}" for i in range(MARKS))]
            )


def _verify(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) from rows (a, b, z) sorted by a, b's text in each; the row with b null holds a's own text and comes first."""
    import zstandard

    expand = zstandard.ZstdDecompressor()
    own, owner = None, None
    for batch in source:
        lefts, rights = [], []
        for row in range(batch.num_rows):
            a, b = batch.column("a")[row].as_py(), batch.column("b")[row].as_py()
            shingles = shingle_sets([expand.decompress(batch.column("z")[row].as_py())])[0]
            if b is None:
                own, owner = shingles, a
            elif owner == a and similar(own, shingles):
                lefts.append(a)
                rights.append(b)
        yield pa.record_batch([pa.array(lefts, pa.int64()), pa.array(rights, pa.int64())], ["a", "b"])


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar; texts of pairs that may be similar travel, once for each pair and once for each left side."""
    marked = pairs.join(_marks(texts, "a", "_l"), "a").join(_marks(texts, "b", "_r"), "b")
    pairs = settle(marked.where(_may_be_similar("_l", "_r")).select("a", "b"), "close-pairs")
    texts = texts.select("cid", "z")
    right = pairs.join(texts, pairs.b == texts.cid).select("a", "b", "z")
    left = pairs.select("a").distinct().join(texts, F.col("a") == texts.cid).select("a", F.lit(None).cast("long").alias("b"), "z")
    # a left side with many partners is split; each part gets the left text
    salted = right.withColumn("_part", F.pmod(F.xxhash64("b"), F.lit(64)))
    parts = salted.select("a", "_part").distinct()
    rows = salted.unionByName(left.join(parts, "a").select("a", "b", "z", "_part"))
    return rows.repartition("a", "_part").sortWithinPartitions("a", "_part", F.asc_nulls_first("b")).select("a", "b", "z").mapInArrow(fresh(_verify), "a bigint, b bigint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = plain.schema["id"].dataType.simpleString()
    described = settle(plain.mapInArrow(fresh(_describe), f"id {id_type}, n_shingles bigint, cid bigint, token bigint, n bigint"), "sets")
    documents = described.where("token IS NULL").select("id", "n_shingles", "cid")
    frequent = (
        described.where("token IS NOT NULL").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT).orderBy(F.desc("n"), "token").limit(FREQUENT_KEPT)
    ).toPandas()  # at most FREQUENT_KEPT rows
    tokens = frequent["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    emit = _emit_prefixes(tokens[order], frequent["n"].to_numpy(np.int64)[order])
    prefixes = plain.select("text").mapInArrow(fresh(emit), "token bigint, cid bigint, meta bigint")
    met = settle(
        prefixes.repartition("token")
        .sortWithinPartitions("token", "cid")
        .mapInArrow(fresh(_meet), "a bigint, b bigint, n bigint, need bigint, first boolean, token bigint, cid bigint, meta bigint"),
        "candidates",
    )
    pairs = settle(
        met.where("token IS NULL").groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("need").alias("need"), F.max("first").alias("first")), "pairs"
    )
    long_lists = settle(met.where("token IS NOT NULL").groupBy("cid").agg(F.first("meta").alias("meta"), F.collect_set("token").alias("tokens")), "long-lists")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).union(long_lists.select("cid")).distinct()
    squeezed = plain.select("text").mapInArrow(fresh(_compressed), "cid bigint, z binary, size bigint, " + ", ".join(f"m{i} bigint" for i in range(MARKS)))
    texts = settle(squeezed.join(wanted, "cid", "left_semi").dropDuplicates(["cid"]), "texts")

    # pairs with the first member of a list: most components come together here
    chosen = pairs.where(F.col("first") & (F.col("n") >= F.col("need")))
    links = settle(verified(chosen.select("a", "b"), texts), "links")
    classes = _components(wanted, links)

    # members outside the main component of a list meet one member of it a round, while most of these pairs are links
    for number in range(ROUNDS):
        nearest = settle(_nearest(_members(long_lists, classes), texts, number), "nearest")
        tried = nearest.count()
        if not tried:
            break
        found = settle(verified(nearest, texts), "links")
        joined = found.count()
        if joined:
            links = links.union(found)
            classes = _components(wanted, links)
        if 2 * joined < tried:
            break

    # what could still join two components
    side = classes.select(F.col("cid"), F.col("component"))
    left, right = side.toDF("a", "_of_a"), side.toDF("b", "_of_b")
    apart = pairs.join(left, "a").join(right, "b").where("_of_a <> _of_b").select("a", "b", "n", "need", (F.col("first") & (F.col("n") >= F.col("need"))).alias("done"))
    crossing = _crossing(_members(long_lists, classes), long_lists, texts)
    open_pairs = (
        apart.unionByName(crossing)
        .groupBy("a", "b")
        .agg(F.sum("n").alias("n"), F.max("need").alias("need"), F.max("done").alias("done"))
        .where((F.col("n") >= F.col("need")) & ~F.col("done"))
    )
    more = settle(verified(open_pairs.select("a", "b"), texts), "links")
    final = settle(_components(wanted, links.union(more)), "components")
    least = documents.where("cid IS NOT NULL").groupBy("cid").agg(F.min("id").alias("_least"))
    named = least.join(final, "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("_least").alias("component_id"))
    names = settle(named.join(smallest, "component").select("cid", "component_id"), "classes")
    return documents.join(names, "cid", "left").select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def _components(wanted: DataFrame, links: DataFrame) -> DataFrame:
    """(cid, component) of all wanted classes."""
    found = connected(links)
    return settle(
        wanted.join(found, F.col("cid") == F.col("node"), "left").select("cid", F.coalesce("component", "cid").alias("component")), "components"
    )


def _members(long_lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (token, cid, meta, component, _main) of the long lists that hold several components; _main has the most members there."""
    rows = long_lists.join(classes, "cid").select("cid", "meta", "component", F.explode("tokens").alias("token"))
    counted = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("_members"))
    main = counted.groupBy("token").agg(F.max(F.struct("_members", "component")).alias("_main"), F.count(F.lit(1)).alias("_parts"))
    return settle(rows.join(main.where("_parts > 1").select("token", F.col("_main.component").alias("_main")), "token"), "mixed-lists")


def _nearest(mixed: DataFrame, texts: DataFrame, number: int) -> DataFrame:
    """Pairs (a, b) of a member outside the main component and the nearest, by bitmaps, of the members inside that its lists name in this round."""
    named = mixed.where("component = _main").groupBy("token").agg(F.min_by("cid", F.xxhash64("cid", "token", F.lit(number))).alias("_leader"))
    met = mixed.where("component <> _main").join(named, "token").select("cid", "_main", "_leader").distinct()
    marked = met.join(_marks(texts, "cid", "_l"), "cid").join(_marks(texts, "_leader", "_r"), "_leader").where(_may_be_similar("_l", "_r"))
    best = marked.groupBy("cid", "_main").agg(F.min_by("_leader", F.struct(_apart("_l", "_r"), "_leader")).alias("_leader"))
    return best.select(F.least("cid", "_leader").alias("a"), F.greatest("cid", "_leader").alias("b")).distinct()


def _crossing(mixed: DataFrame, long_lists: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs across components in long lists that may be similar, with at least the number of shingles that long lists show them to share."""
    pairs = _met_across(mixed, long_lists, texts).distinct()
    held = long_lists.select("cid", "tokens")
    both = pairs.join(held.toDF("a", "_tokens_a"), "a").join(held.toDF("b", "_tokens_b"), "b")
    return both.select("a", "b", F.size(F.array_intersect("_tokens_a", "_tokens_b")).cast("long").alias("n"), "need", F.lit(False).alias("done"))


def _met_across(mixed: DataFrame, long_lists: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows (a, b, need): members outside a list's main component, against the others of that list, if they may be similar.

    A pair shares many lists. It is left out of a list when the first few tokens of both sides
    show an earlier list that it shares, as it is met there; so it comes about once.
    """
    first = long_lists.select("cid", F.slice(F.array_sort("tokens"), 1, FIRST_LISTS).alias("_lists"))
    mixed = mixed.join(_marks(texts, "cid", "_l").join(first, "cid"), "cid")
    few = mixed.where("component <> _main").select(
        "token",
        F.col("cid").alias("_c"),
        F.col("component").alias("_k"),
        F.col("meta").alias("_m"),
        F.col("_lists").alias("_other_lists"),
        *[F.col(f"_l{c}").alias(f"_r{c}") for c in ("size", *range(MARKS))],
    )
    met = mixed.join(few, "token").where((F.col("component") == F.col("_main")) | (F.col("component") < F.col("_k"))).where("component <> _k")
    size, other = F.shiftright("meta", 3), F.shiftright("_m", 3)
    earlier = F.array_min(F.array_intersect("_lists", "_other_lists"))
    near = (F.least(size, other) * OF >= F.greatest(size, other) * SHARE) & _may_be_similar("_l", "_r")
    return met.where(near & (earlier.isNull() | (F.col("token") <= earlier))).select(
        F.least("cid", "_c").alias("a"),
        F.greatest("cid", "_c").alias("b"),
        needed(size, F.col("meta").bitwiseAND(7), other, F.col("_m").bitwiseAND(7), F.least, F.greatest).alias("need"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay: of each component the one with the smallest id.

    Rows are told apart by id and text, so rows that share an id are decided one by
    one; null ids come last, and of equal ids the text of the smaller hash stays.
    Rows of equal id and text are copies: one stays, unless the text has no words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = {"_none": F.col(id_col).isNull(), "_id": F.col(id_col), "_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(1), text)}
    key = F.struct(*[column.alias(name) for name, column in parts.items()])
    groups = near_groups(docs.select(key.alias("_key"), F.col(text_col).alias("_text")), "_key", "_text")
    groups = settle(groups.where("n_shingles > 0").select("_key", "component_id"), "decided")
    same = reduce(Column.__and__, [F.col(f"_gone{name}").eqNullSafe(column) for name, column in parts.items()])
    gone = groups.where(~F.col("_key").eqNullSafe(F.col("component_id"))).select("_key.*").toDF(*[f"_gone{name}" for name in parts]).distinct()
    kept = docs.join(gone, same, "left_anti")
    again = groups.where(F.col("_key").eqNullSafe(F.col("component_id"))).groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    again = again.select("_key.*").toDF(*[f"_gone{name}" for name in parts])
    if again.isEmpty():
        return kept
    repeated = kept.withColumns(parts).join(again, same, "left_semi").dropDuplicates(list(parts)).select(*docs.columns)
    return kept.join(again, same, "left_anti").unionByName(repeated)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op8_ngram_jaccard_join": op8_ngram_jaccard_join}
SQL: dict[str, str] = {}
