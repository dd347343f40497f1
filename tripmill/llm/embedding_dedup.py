"""Near-duplicate vectors by cross-polytope hashing with multiprobe buckets and verified pairs.

A hash rotates the unit vector pseudo-randomly (three rounds of random signs and
a fast Hadamard transform) and takes the nearest signed axis. ``TABLES`` tables
use ``HASHES`` hashes each; a vector lies in the bucket of its own codes and also
looks into ``PROBES`` more, in which its least certain codes are replaced by the
next nearest axis. All pairs that meet are verified by cosine in double
precision, so no link below the threshold is returned.

Equal vectors of one label form one class first, so a vector that a third of all
rows share is hashed and compared once. A bucket of more than ``BLOCK`` rows is
cut into blocks and each pair of blocks becomes a task of its own; nothing is
capped. A pair that meets several times counts in its first table only, so tasks
return link counts and a spanning forest instead of pairs.

Vectors that are null, empty, zero, or hold null or non-finite components, and
rows with a null label, link with nothing. Vectors of unequal length are not
compared. Repeated rows link with each other. A null id never names a component.
An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require, table
from tripmill.llm.components import connected
from tripmill.session import settle

THRESHOLD = 0.98
TABLES = 6
HASHES = 2
PROBES = 4
BLOCK = 4096
SEED = 20_240


def _signs(width: int) -> np.ndarray:
    """Random signs by table, hash and round; the same in every task."""
    return np.random.default_rng(SEED + width).choice(np.array([-1.0, 1.0]), (TABLES, HASHES, 3, width))


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    count, width = rows.shape
    step = 1
    while step < width:
        pairs = rows.reshape(count, width // (2 * step), 2, step)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(count, width)
        step *= 2
    return rows / np.sqrt(width)


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Own bucket (rows x tables) and probed buckets (rows x tables x probes) of unit vectors."""
    count, length = units.shape
    width = max(2, 1 << (length - 1).bit_length())
    padded = np.zeros((count, width))
    padded[:, :length] = units
    signs = _signs(width)
    own = np.zeros((count, TABLES), np.int64)
    probes = np.zeros((count, TABLES, PROBES), np.int64)
    row = np.arange(count)
    for t in range(TABLES):
        best, gaps, others = [], [], []
        for h in range(HASHES):
            turned = padded
            for r in range(3):
                turned = hadamard(turned * signs[t, h, r])
            size = np.abs(turned)
            order = np.argpartition(-size, min(2, width - 1), axis=1)[:, :3]
            order = np.take_along_axis(order, np.argsort(-np.take_along_axis(size, order, 1), axis=1, kind="stable"), 1)
            code = 2 * order + (np.take_along_axis(turned, order, 1) < 0)
            best.append(code[:, 0])
            for rank in range(1, code.shape[1]):
                gaps.append(size[row, order[:, 0]] - size[row, order[:, rank]])
                others.append((h, code[:, rank]))
        own[:, t] = sum(b * (2 * width) ** h for h, b in enumerate(best))
        ranked = np.argsort(np.stack(gaps, 1), axis=1, kind="stable")
        moved = np.stack([own[:, t] + (code - best[h]) * (2 * width) ** h for h, code in others], 1)
        picked = np.take_along_axis(moved, ranked, 1)[:, :PROBES]
        probes[:, t, : picked.shape[1]] = picked
        probes[:, t, picked.shape[1] :] = own[:, t, None]
    return own, probes


def _hash_classes(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in source:
        vectors = batch.column("vector")
        lengths = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        own, probes = np.zeros((batch.num_rows, TABLES), np.int64), np.zeros((batch.num_rows, TABLES, PROBES), np.int64)
        packed: list[bytes] = [b""] * batch.num_rows
        for length in np.unique(lengths):
            rows = np.flatnonzero(lengths == length)
            part = flat[starts[rows][:, None] + np.arange(length)]
            part = part / np.abs(part).max(axis=1, keepdims=True)  # keeps squares finite
            units = part / np.sqrt((part * part).sum(axis=1, keepdims=True))
            own[rows], probes[rows] = codes(units)
            for i, r in enumerate(rows):
                packed[r] = units[i].tobytes()
        yield pa.record_batch(
            [batch.column("cid"), batch.column("label"), batch.column("size"), pa.array(packed, pa.binary()), pa.array(list(own), pa.list_(pa.int64())), pa.array(list(probes.reshape(len(own), -1)), pa.list_(pa.int64()))],
            ["cid", "label", "size", "unit", "own", "probes"],
        )


def _compare(threshold: float):
    def compare(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per cell (rows sorted by key, i, j): link counts (cid, links) and forest edges (cid, other)."""
        held: list[pa.RecordBatch] = []
        for batch in source:
            held.append(batch)
            if sum(b.num_rows for b in held) < 2 * BLOCK:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            keys = _cells(whole)
            last = int(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1))[-1]) + 1 if (keys[0] != keys[-1]).any() else 0
            if last:
                yield from work(whole.slice(0, last))
            held = whole.slice(last).to_batches() if last < whole.num_rows else []
        if held:
            yield from work(pa.Table.from_batches(held).combine_chunks())

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = _cells(rows)
        begin = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        ends = np.append(begin[1:], len(keys))
        many = np.flatnonzero(ends - begin > 1)
        columns = {n: rows.column(n).to_numpy() for n in ("cid", "size", "t", "probe", "block", "i", "j")}
        units, own, probes = rows.column("unit").combine_chunks(), rows.column("own").combine_chunks(), rows.column("probes").combine_chunks()
        out = [[], [], []]
        for first, end in zip(begin[many], ends[many]):
            cell(first, end, columns, units, own, probes, out)
        if out[0]:
            cid, links, other = (np.concatenate(x) for x in out)
            yield pa.record_batch([pa.array(cid), pa.array(links), pa.array(other, pa.int64(), mask=links > 0)], ["cid", "links", "other"])

    def cell(first, end, columns, units, own, probes, out) -> None:
        part = {n: v[first:end] for n, v in columns.items()}
        matrix = np.frombuffer(b"".join(units.slice(first, end - first).to_pylist()), np.float64).reshape(end - first, -1)
        mine = np.array(own.slice(first, end - first).to_pylist())
        theirs = np.array(probes.slice(first, end - first).to_pylist()).reshape(end - first, TABLES, PROBES)
        t, across = part["t"][0], part["i"][0] != part["j"][0]
        for low in range(0, end - first, BLOCK // 4):
            chunk = slice(low, min(low + BLOCK // 4, end - first))
            a, b = np.nonzero(matrix[chunk] @ matrix.T >= threshold)
            a = a + low
            keep = part["cid"][a] < part["cid"][b]
            keep &= ~(part["probe"][a] & part["probe"][b])  # two probes alone do not meet
            if across:
                keep &= part["block"][a] != part["block"][b]
            a, b = a[keep], b[keep]
            # a vector can be in the bucket by its own code or by a probe, not both: a pair is here once; count it in its first table
            earlier = np.zeros(len(a), bool)
            for u in range(t):
                same = mine[a, u] == mine[b, u]
                earlier |= same | (theirs[b, u] == mine[a, u][:, None]).any(axis=1) | (theirs[a, u] == mine[b, u][:, None]).any(axis=1)
            # of the meetings in this table only one counts: at the own bucket of the smaller id, if it is one
            at_a, at_b = ~part["probe"][a], ~part["probe"][b]
            twice = (theirs[b, t] == mine[a, t][:, None]).any(axis=1) & (theirs[a, t] == mine[b, t][:, None]).any(axis=1) & (mine[a, t] != mine[b, t])
            keep = ~earlier & ~(twice & at_b & ~at_a)
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            size = part["size"]
            out[0] += [part["cid"][a], part["cid"][b]]
            out[1] += [size[b], size[a]]
            out[2] += [np.zeros(2 * len(a), np.int64)]
            _forest(part["cid"], a, b, out)

    return compare


def _cells(rows: pa.Table) -> np.ndarray:
    return np.stack([rows.column(n).to_numpy() for n in ("key", "i", "j")], axis=1)


def _forest(cids: np.ndarray, a: np.ndarray, b: np.ndarray, out: list) -> None:
    """Edges of a spanning forest of the pairs."""
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    left, right = [], []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            left.append(x)
            right.append(y)
    if left:
        out[0].append(cids[left])
        out[1].append(np.zeros(len(left), np.int64))
        out[2].append(cids[right])


def vector_groups(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept."""
    require(vectors, id_col, vector_col, label_col)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("cid", F.when(usable, F.xxhash64("label", F.transform("vector", lambda x: x + F.lit(0.0)))))
    classes = rows.where("cid IS NOT NULL").groupBy("cid").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count(F.lit(1)).alias("size"), F.min("id").alias("least")
    )
    classes = settle(classes, "vector-classes")
    label = classes.schema["label"].dataType.simpleString()
    coded = settle(
        classes.select("cid", "label", "size", "vector").mapInArrow(
            _hash_classes, f"cid bigint, label {label}, size bigint, unit binary, own array<bigint>, probes array<bigint>"
        ),
        "vector-codes",
    )
    own = F.transform("own", lambda code, t: F.struct(t.alias("t"), code.alias("code"), F.lit(False).alias("probe")))
    probed = F.transform("probes", lambda code, n: F.struct(F.floor(n / PROBES).cast("int").alias("t"), code.alias("code"), F.lit(True).alias("probe")))
    # the key holds table, label, length and code, so a bucket never mixes them but by a hash collision
    entries = coded.withColumn("_e", F.explode(F.concat(own, probed))).select("*", "_e.*").drop("_e")
    entries = entries.where(~F.col("probe") | (F.col("code") != F.element_at("own", F.col("t") + 1)))
    entries = entries.withColumn("key", F.xxhash64("t", "label", F.octet_length("unit"), "code")).drop("label", "code")
    large = settle(
        entries.groupBy("key").count().where(F.col("count") > BLOCK).select("key", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large-buckets"
    )
    blocks = F.coalesce("blocks", F.lit(1))
    cut = entries.join(large, "key", "left").withColumn("block", F.pmod(F.xxhash64("cid"), blocks).cast("int"))
    cells = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "key", "cid", "size", "t", "probe", "block", "unit", "own", "probes", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j")
    )
    found = settle(
        cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_compare(threshold), "cid bigint, links bigint, other bigint"),
        "vector-links",
    )
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    labels = connected(found.where("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b")))
    named = classes.select("cid", "size", "least").join(labels, F.col("cid") == F.col("node"), "left").withColumn("component", F.coalesce("component", "cid"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    results = settle(
        named.join(smallest, "component")
        .join(counts, "cid", "left")
        .select("cid", "component_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")),
        "vector-groups",
    )
    joined = rows.select("id", "cid").join(results, "cid", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return joined.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_groups(table(spark, sf_dir, "embeddings"))


QUERIES = {"op6_embedding_dedup": op6_embedding_dedup}
SQL: dict[str, str] = {}
