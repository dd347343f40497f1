"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

1. Every document is encoded once and cut into pieces of at most ``capacity``
   tokens; only piece lengths and checksums are stored, not ids.
2. Best fit in falling length is computed over *counts*: the driver sees one row
   per length (at most ``capacity`` rows, whatever the number of documents) and
   works on classes of equally filled sequences.
3. Each piece gets its rank among pieces of its length and takes the slot that
   the plan holds for that rank. Ranks come from counts per (length, bucket), so
   a length that a third of all pieces share is spread over many tasks.

Null text counts as empty: one token, the closing id. Rows may repeat and ids may
be null or equal: pieces are then ranked in any order and each is placed once. An
empty table gives no pieces. Other columns are dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmill.llm.common import kept, require, table
from tripmill.llm.token_counts import _byte_of_symbol
from tripmill.session import settle

CAPACITY = 2048
VOCABULARY = "word_bpe_49k.json"
CLOSING_ID = 0
#: Entries kept per Python worker; a full store is emptied and fills again.
KEPT_CHUNKS = 400_000
#: Pieces that one (length, bucket) ranks on average at most.
BUCKET_ROWS = 20_000
#: Characters at which str.split cuts and the tokenizer's own white space does not (fixed values).
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Chunks of these characters need no Unicode normalisation; of the letters, lower case has one form (fixed values).
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Split of a lower-case plain chunk before merging (fixed value of this vocabulary).
WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class ChunkEncoder:
    """Ids of a text from the ids of its chunks between white space, which this vocabulary encodes one by one.

    Chunks of plain characters are split into words here, and the tokenizer's
    merging model encodes each distinct word; anything else goes to the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.symbols = {byte: symbol for symbol, byte in _byte_of_symbol().items()}
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, word: str) -> bytes:
        """Ids of one word, by the tokenizer's merging model."""
        found = self.words.get(word)
        if found is None:
            symbols = word if word.isascii() else "".join(map(self.symbols.__getitem__, word.encode()))
            found = np.array([t.id for t in self.model.tokenize(symbols)], "<u4").tobytes()
            if len(self.words) > KEPT_CHUNKS:
                self.words.clear()
            self.words[word] = found
        return found

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text."""
        known = self.known
        for text in texts:
            if ODD_SPACE.search(text) or "<|" in text:
                yield self.whole([text])[0]
                continue
            chunks = text.split()
            try:
                yield b"".join(map(known.__getitem__, chunks))
            except KeyError:
                self.learn({c for c in chunks if c not in known}, chunks)
                yield b"".join(map(known.__getitem__, chunks))

    def learn(self, new: set[str], chunks: list[str]) -> None:
        if len(self.known) + len(new) > KEPT_CHUNKS:
            self.known.clear()
            new = set(chunks)
        odd = []
        for chunk in new:
            if len(chunk) <= 200 and PLAIN.fullmatch(chunk):
                self.known[chunk] = b"".join(map(self.word, WORDS.findall(chunk.lower())))
            else:
                odd.append(chunk)
        if odd:
            self.known.update(zip(odd, self.whole(odd)))


def encoder(path: str) -> ChunkEncoder:
    return kept(("chunks", path), lambda: ChunkEncoder(path))


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32."""
    import zlib

    require(docs, id_col, text_col)
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    closing = np.array([CLOSING_ID], "<u4").tobytes()

    @F.arrow_udf("array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>")
    def pieces(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(path)
        kind = pa.list_(pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
        for column in columns:
            rows = []
            for first in range(0, len(column), 256):
                texts = [v.as_py() or "" for v in column.slice(first, 256)]
                for ids in own.encode(texts):
                    ids += closing
                    rows.append(
                        [
                            {"piece": i, "start": start // 4, "length": len(part) // 4, "ids_crc32": zlib.crc32(part)}
                            for i, start in enumerate(range(0, len(ids), 4 * capacity))
                            for part in [ids[start : start + 4 * capacity]]
                        ]
                    )
            yield pa.array(rows, kind)

    return docs.select(F.col(id_col), F.explode(pieces(F.col(text_col))).alias("_piece")).select(id_col, "_piece.*")


def plan_slots(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit in falling length over counts.

    Rows (length, first_rank, end_rank, sequence, per_sequence, offset): pieces of
    that length with ranks from first_rank below end_rank fill sequences from
    ``sequence`` on, ``per_sequence`` in each, starting at ``offset``. Sequences
    filled alike form one class, so the plan has a few rows per length.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> classes (first sequence, how many)
    slots, used = [], 0

    def leave(room: int, first: int, number: int) -> None:
        if room and number:
            free.setdefault(room, []).append((first, number))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"length {length} does not fit {capacity}")
        left, rank = histogram[length], 0

        def fill(room: int, first: int, number: int) -> None:
            """Place what is left into sequences with this room, several each where they fit."""
            nonlocal left, rank
            each = room // length
            full = min(number, left // each)
            if full:
                slots.append((length, rank, rank + full * each, first, each, capacity - room))
                leave(room - each * length, first, full)
                rank, left, first, number = rank + full * each, left - full * each, first + full, number - full
            if left and number:
                slots.append((length, rank, rank + left, first, left, capacity - room))
                leave(room - left * length, first, 1)
                rank, left, first, number = rank + left, 0, first + 1, number - 1
            leave(room, first, number)

        for room in sorted(r for r in free if r >= length):
            classes = free.pop(room)
            while classes and left:
                fill(room, *classes.pop())
            if classes:
                free.setdefault(room, []).extend(classes)
            if not left:
                break
        if left:
            number = -(-left // (capacity // length))
            first, used = used, used + number
            fill(capacity, first, number)
    return slots


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to stored pieces; ``keys`` only deal pieces of one length to buckets."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # a row per length
    slots = plan_slots(counts, capacity)
    plan = spark.createDataFrame(
        slots, "_length bigint, _first bigint, _end bigint, _sequence bigint, _each bigint, _offset bigint"
    )
    buckets = max(64, -(-sum(counts.values()) // BUCKET_ROWS))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy("length", "_bucket").count().select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    ranked = (
        dealt.withColumn("_within", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy(*keys)))
        .join(starts, ["length", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.col("_within") - 1)
    )
    # one row per class of equally filled sequences and length: bounded by the capacity, not by the documents
    small = F.broadcast(plan) if len(slots) <= 64 * capacity else plan
    slot = F.col("_rank") - F.col("_first")
    return ranked.join(
        small, (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    ).select(
        *pieces.columns,
        (F.col("_sequence") + F.floor(slot / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (slot % F.col("_each")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their places."""
    pieces = settle(cut_pieces(docs, id_col, text_col, capacity), "pieces")
    return pack(pieces, [id_col, "piece"], capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op9_best_fit_packing": op9_best_fit_packing}
SQL: dict[str, str] = {}
