"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after each run of white space bytes
(space, tab to carriage return) is replaced by one space. Each map task first
merges its own copies, so a text that a third of all rows share sends one row
per task; then records are dealt by hash and merged per bucket. Merging reads
records into an open-addressing table that compares complete contents. When the
table reaches its memory budget, records that are not in it go to spill files
partitioned by further bits of the hash, and each file is treated the same way,
until every bucket fits.

Null text counts as empty. The row with the smallest id stays; null ids come
last. Rows that repeat id and text are one record several times: the first
stays. An empty table gives an empty table. Columns of any name and type are
kept.
"""

from __future__ import annotations

import pickle
import re
import tempfile
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import map_rows, require, table

#: Bytes of content that one table holds before it spills.
TABLE_BYTES = 48 << 20
FAN_OUT = 16
SPACE = re.compile(rb"[\x20\x09-\x0D]+")
SPACE_SQL = r"[\x20\x09-\x0D]+"


def normalised(text: str | None) -> bytes:
    return SPACE.sub(b" ", (text or "").encode())


class ContentTable:
    """Open addressing with linear probing; equal means equal content, the hash only finds the slot."""

    def __init__(self):
        self.slots, self.mask = [-1] * 1024, 1023
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.values: list[dict] = []
        self.bytes = 0

    def find(self, hashed: int, content: bytes) -> tuple[int, int]:
        """Slot and entry of a content; the entry is -1 if it is absent."""
        slot = (hashed ^ (hashed >> 29)) & self.mask
        while (entry := self.slots[slot]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return slot, entry
            slot = (slot + 1) & self.mask
        return slot, -1

    def insert(self, slot: int, hashed: int, content: bytes, value: dict) -> None:
        self.slots[slot] = len(self.hashes)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.values.append(value)
        self.bytes += 2 * len(content) + 200
        if 2 * len(self.hashes) > self.mask:
            self.mask = 2 * self.mask + 1
            self.slots = [-1] * (self.mask + 1)
            for entry, known in enumerate(self.hashes):
                slot = (known ^ (known >> 29)) & self.mask
                while self.slots[slot] >= 0:
                    slot = (slot + 1) & self.mask
                self.slots[slot] = entry


def _order(row: dict) -> tuple:
    return (row["_id"] is None, row["_id"])


def merge_rows(kept: dict, row: dict) -> dict:
    """The row with the smaller id, with both counts and copies of its id."""
    first, other = (row, kept) if _order(row) < _order(kept) else (kept, row)
    return first | {"_rows": kept["_rows"] + row["_rows"]}


def grace(rows: Iterable[dict], budget: int = TABLE_BYTES, depth: int = 0) -> Iterator[dict]:
    """One row per content; rows have _hash, _text, _id and _rows beside any payload."""
    contents = ContentTable()
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files: dict[int, object] = {}
        for row in rows:
            content, hashed = normalised(row["_text"]), row["_hash"] & (1 << 64) - 1
            slot, entry = contents.find(hashed, content)
            if entry >= 0:
                contents.values[entry] = merge_rows(contents.values[entry], row)
            elif contents.bytes < budget or 4 * depth >= 60:
                contents.insert(slot, hashed, content, row)
            else:
                part = hashed >> 4 * depth & FAN_OUT - 1
                if part not in files:
                    files[part] = open(f"{folder}/{part}", "wb")
                pickle.dump(row, files[part], protocol=5)
        yield from contents.values
        del contents
        for part, file in files.items():
            file.close()
            yield from grace(_read(f"{folder}/{part}"), budget, depth + 1)


def _read(path: str) -> Iterator[dict]:
    with open(path, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return


def distinct_contents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", payload: bool = True) -> DataFrame:
    """One row per distinct text: _digest, keep_id, group_size and, as ``_row``, the row that stays."""
    require(docs, id_col, text_col)
    content = F.regexp_replace(F.coalesce(text_col, F.lit("")), SPACE_SQL, " ")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if payload else F.lit(0)
    rows = docs.select(
        F.xxhash64(content).alias("_hash"),
        F.sha2(content, 256).alias("_digest"),
        F.col(text_col).alias("_text"),
        F.col(id_col).alias("_id"),
        F.lit(1).cast("long").alias("_rows"),
        *([row.alias("_row")] if payload else []),
    )
    schema = rows.schema
    sized = lambda r: len(r["_text"] or "") + 100
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    merged = map_rows(map_rows(rows, grace, ddl, sized).repartition("_hash"), grace, ddl, sized)
    return merged.select(
        "_digest", F.col("_id").alias("keep_id"), F.col("_rows").alias("group_size"), *(["_row"] if payload else [])
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    groups = distinct_contents(docs, id_col, text_col, payload=False)
    content = F.regexp_replace(F.coalesce(text_col, F.lit("")), SPACE_SQL, " ")
    # repeated (id, text) rows travel as one row with a count, and come apart at the end
    members = docs.select(F.col(id_col), F.sha2(content, 256).alias("_digest")).groupBy(id_col, "_digest").agg(F.count(F.lit(1)).alias("_times"))
    joined = members.join(groups, "_digest")
    return joined.select(
        id_col, "keep_id", "group_size", "_digest", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_copy")
    ).select(
        id_col,
        "keep_id",
        "group_size",
        (F.col(id_col).eqNullSafe(F.col("keep_id")) & (F.col("_copy") == 1)).alias("kept"),
        F.col("_digest").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    return distinct_contents(docs, id_col, text_col).select("_row.*")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


QUERIES = {"op4_exact_dedup": op4_exact_dedup}
SQL = {
    "op4_exact_dedup": r"""
        WITH texts AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), numbered AS (
            SELECT doc_id, text_sha256,
                   first_value(doc_id) OVER ordered AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   row_number() OVER ordered AS place
            FROM texts
            WINDOW ordered AS (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM numbered
    """
}
