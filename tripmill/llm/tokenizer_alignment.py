"""Alignment of two tokenizers over a corpus, with an identity map as the fast path.

Both tokenizers encode the same bytes (A reads a space and the text, B adds that
space itself), so the byte offsets where tokens of both end cut a document into
groups, and every A-B pair of token occurrences whose bytes overlap is a link.
A link covers exactly one stretch between neighbouring ends of either side, so
the links of a document are read from the union of both sets of ends.

*Identity map.* An array holds for each A id the B id of the same bytes. Links
that follow the map - those of all one-to-one groups, but for bytes with two B
ids - are counted in vectors as long as A's vocabulary, one for each task. Only
pairs off the map enter the shuffle of pairs.

*Words.* Where single spaces and line ends part a text, neither tokenizer has a
token across a word's begin, so each distinct word is encoded and aligned once
per worker and generation of its store; other texts are aligned as a whole.

*Passes.* 1. Encode and align; store each row's distinct links with their number.
2. Count rows by pair from the stored links: a vector for map pairs, a shuffle of
pre-aggregated rows for the others. 3. Look counts up: map pairs and the most
frequent other pairs (``FREQUENT``, a fixed bound) from arrays, the rest by a join.

Null and empty text, and text whose joined token bytes differ from space and text
on either side, has no tokens: zeros, and an empty digest. Rows are told apart by
a number of their own, so repeated rows, null or equal ids count as documents of
their own. Ties for the highest count all count as best. An empty table gives an
empty table. Other columns are kept, and existing columns named like a result are
replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require, table
from tripmill.llm.token_counts import _byte_of_symbol
from tripmill.session import settle

VOCABULARY_A, MODEL_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of words and results that each of a worker's two generations holds, about.
KEPT_BYTES = 80 << 20
#: Characters of new words that are encoded in one call, about.
CALL_CHARS = 1 << 14
#: Codes that a task holds before it emits their counts.
HELD_CODES = 1 << 20
#: Most frequent pairs off the map that tasks hold as arrays; rarer ones are joined.
FREQUENT = 1 << 16
#: White space other than space and line end, the mark, and a character that words are parted with (fixed values).
ODD = re.compile(f"[\x00\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200a\u2028\u2029\u202f\u205f\u3000{MARK}]")
BESIDE = ("  ", " \n", "\n ", "\n\n")
#: Split of a text into words before merging (fixed value of A's vocabulary).
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters whose classes are the same in all versions of Unicode that the two encoders of A know.
SETTLED = re.compile("[ \n!-~¡-ɏ]*")

COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULTS = (*COUNTS, "n_best", "count_sum", "groups_sha256")


class Alignment:
    """Two encodings of one byte string: ends of tokens and groups, and links as codes (A id times B's size plus B id)."""

    def __init__(self, own: Aligner, ids_a: np.ndarray, ids_b: np.ndarray):
        self.own, self.ids_a, self.ids_b = own, ids_a, ids_b
        self.ends_a, self.ends_b = np.cumsum(own.size_a[ids_a]), np.cumsum(own.size_b[ids_b])
        stretches = np.concatenate((self.ends_a, self.ends_b))
        stretches.sort()
        new = np.empty(len(stretches), bool)
        new[:1], new[1:] = True, stretches[1:] != stretches[:-1]
        self.marks, self.groups = stretches[new], stretches[~new]
        at_a, at_b = np.searchsorted(self.ends_a, self.marks), np.searchsorted(self.ends_b, self.marks)
        self.codes = (ids_a[at_a] * own.width + ids_b[at_b]).astype(own.kind)

    def text(self, words: np.ndarray | None = None) -> str:
        """The groups as text: A's ids, a bar, B's ids, a semicolon; a line end instead where a word ends."""
        ids_a, ids_b, groups = self.ids_a, self.ids_b, self.groups
        of_a, of_b = np.searchsorted(groups, self.ends_a), np.searchsorted(groups, self.ends_b)
        last = (groups[of_b] == self.ends_b).astype(np.int64)
        if words is not None:
            last[np.searchsorted(self.ends_b, words)] = 2
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[np.arange(len(ids_a)) + np.searchsorted(of_b, of_a, "left")] = ids_a * 2 + (groups[of_a] == self.ends_a)
        order[np.arange(len(ids_b)) + np.searchsorted(of_a, of_b, "right")] = len(self.own.names_a) * 2 + ids_b * 3 + last
        return "".join(map(self.own.written.__getitem__, order.tolist()))[:-1]


class Aligner:
    """Two tokenizers, their vocabularies as bytes, the identity map and a store of aligned words."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path_a)
        self.tokenizer.encode_special_tokens = True
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        symbols, vocabulary = _byte_of_symbol(), spec["model"]["vocab"]
        added = {t["id"]: t["content"] for t in spec["added_tokens"]}
        names_a = [b""] * (max([*vocabulary.values(), *added], default=-1) + 1)
        for token, i in vocabulary.items():
            if i not in added:
                names_a[i] = bytes(symbols[c] for c in token)
        # the same vocabulary for an encoder that is three times faster; its ids are the ranks of merges
        self.quick = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={n: i for i, n in enumerate(names_a) if n}, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)) for i in range(len(pieces))]
        is_byte = [self.model.is_byte(i) for i in range(len(pieces))]
        names_b = [
            (bytes([int(p[3:5], 16)]) if byte else p.replace(MARK, " ").encode()) if ok else b"" for p, ok, byte in zip(pieces, plain, is_byte)
        ]
        #: No piece goes on behind a word mark or a line end, so words can be encoded one by one.
        self.by_words = not any("\n" in p or MARK in p.lstrip(MARK) for p in pieces)
        self.names_a, self.names_b, self.width = names_a, names_b, len(names_b)
        self.kind = "<u4" if len(names_a) * len(names_b) < 1 << 32 else "<u8"
        self.size_a, self.size_b = (np.array([len(n) for n in names], np.int64) for names in (names_a, names_b))
        self.identity = identity_map(names_a, names_b, is_byte)
        self.written = [f"{i}{end}" for i in range(len(names_a)) for end in ",|"] + [f"{i}{end}" for i in range(len(names_b)) for end in ",;\n"]
        self.young: dict[str, tuple[int, str, bytes]] = {}
        self.old: dict[str, tuple[int, str, bytes]] = {}
        self.weight = 0

    def encode(self, text: str) -> Alignment | None:
        """The alignment of space and text; None if either side's bytes differ from it."""
        if not text:
            return None
        marked = f" {text}"
        raw = marked.encode()
        ids_a = self.quick.encode_ordinary(marked) if SETTLED.fullmatch(text) else self.tokenizer.encode_batch_fast([marked], add_special_tokens=False)[0].ids
        ids_b = self.model.encode(text)
        if b"".join(map(self.names_a.__getitem__, ids_a)) != raw or b"".join(map(self.names_b.__getitem__, ids_b)) != raw:
            return None
        return Alignment(self, np.array(ids_a, np.int64), np.array(ids_b, np.int64))

    def learn(self, words: list[str]) -> bool:
        """Keeps the aligned parts of new words, which are encoded together behind a letter; False if one has none."""
        found = self.encode("a" + "".join(words))
        ends = np.cumsum([2, *map(len, words)] if (whole := "".join(words)).isascii() else [2, *(len(w.encode()) for w in words)])
        if found is None or not np.isin(ends, found.groups).all():
            return False
        n_a = np.diff(np.searchsorted(found.ends_a, ends, "right")).tolist()
        links = (np.searchsorted(found.marks, ends, "right") * found.codes.itemsize).tolist()
        codes, young = found.codes.tobytes(), self.young
        groups = found.text(ends).split("\n")
        for word, n, text, start, end in zip(words, n_a, groups[1:], links, links[1:]):
            young[word] = n, text, codes[start:end]
        self.weight += 350 * len(words) + 2 * len(whole) + len(codes) + sum(map(len, groups))
        return True

    def known(self, text: str) -> list[tuple[int, str, bytes]] | None:
        """The aligned words of a text; None if it must be aligned as a whole."""
        if not self.by_words or text[0] in " \n" or text[-1] in " \n" or any(b in text for b in BESIDE) or ODD.search(text):
            return None
        words = f"\x00 {text}".replace("\n", "\x00\n").replace(" ", "\x00 ").split("\x00")[2:]
        if self.weight > KEPT_BYTES:
            self.young, self.old, self.weight = {}, self.young, 0
        young = self.young
        rows = list(map(young.get, words))
        if None in rows:
            old, new, weight = self.old, [], 0
            for word in {w for w, row in zip(words, rows) if row is None}:
                row = old.get(word)
                if row is not None:
                    young[word] = row
                    self.weight += 350 + 2 * len(word) + len(row[1]) + len(row[2])
                    continue
                new.append(word)
                weight += len(word)
                if weight > CALL_CHARS:
                    if not self.learn(new):
                        return None
                    new, weight = [], 0
            if new and not self.learn(new):
                return None
            rows = list(map(young.__getitem__, words))
        return rows

    def align(self, text: str | None) -> tuple[int, int, int, str, np.ndarray]:
        """(n_a, n_b, n_groups, groups as text, codes of links) of a text."""
        rows = self.known(text) if text else None
        if rows is not None:
            n_a, groups, codes = zip(*rows)
            count, whole, links = sum(n_a), ";".join(groups), np.frombuffer(b"".join(codes), self.kind)
            n_groups = whole.count(";") + 1
            return count, len(links) + n_groups - count, n_groups, whole, links
        found = self.encode(text) if text else None
        if found is None:
            return 0, 0, 0, "", np.array([], self.kind)
        return len(found.ends_a), len(found.ends_b), len(found.groups), found.text(), found.codes


def identity_map(names_a: list[bytes], names_b: list[bytes], is_byte: list[bool]) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 if there is none; a whole piece comes before a byte piece."""
    of_bytes: dict[bytes, int] = {}
    for i in sorted(range(len(names_b)), key=lambda i: (is_byte[i], i)):
        if names_b[i]:
            of_bytes.setdefault(names_b[i], i)
    return np.array([of_bytes.get(name, -1) if name else -1 for name in names_a], np.int64)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def store_links(docs: DataFrame, text_col: str, paths: tuple[str, str]) -> DataFrame:
    """Each row with a number of its own (_at), its counts and digest, and its distinct codes with their number of links."""
    schema = "n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string,codes:binary,times:binary"

    @F.arrow_udf(f"struct<{schema}>")
    def link(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = aligner(*paths)
        names, kinds = zip(*[(n, pa.int64()) for n in COUNTS], ("groups_sha256", pa.string()), ("codes", pa.binary()), ("times", pa.binary()))
        for column in columns:
            rows = []
            for value in column:
                n_a, n_b, n_groups, groups, links = own.align(value.as_py())
                codes, times = np.unique(links, return_counts=True)
                digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                rows.append((n_a, n_b, n_groups, len(links), digest, codes.astype("<u8").tobytes() if own.kind != "<u4" else codes.tobytes(), times.astype("<u4").tobytes()))
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (*RESULTS, text_col, "_at", "_link")]
    linked = docs.select(*kept, F.monotonically_increasing_id().alias("_at"), link(F.col(text_col)).alias("_link"))
    stored = settle(linked, "links")
    return stored.select(*kept, "_at", "_link.*")


def count_pairs(stored: DataFrame, paths: tuple[str, str]) -> tuple[np.ndarray, DataFrame]:
    """How many rows hold each pair linked: a vector by A id for pairs of the identity map, a stored table (code, n) for the others."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*paths)
        vector, held, size = np.zeros(len(own.names_a), np.int64), [], 0
        for batch in batches:
            for value in batch.column(0):
                codes = np.frombuffer(value.as_py(), own.kind).astype(np.int64)
                ids = codes // own.width
                mapped = own.identity[ids] == codes % own.width
                vector[ids[mapped]] += 1  # a row's codes are distinct
                held.append(codes[~mapped])
                size += len(held[-1])
                if size > HELD_CODES:
                    yield counted(*np.unique(np.concatenate(held), return_counts=True))
                    held, size = [], 0
        if held:
            yield counted(*np.unique(np.concatenate(held), return_counts=True))
        yield counted(-1 - np.flatnonzero(vector), vector[vector > 0])

    def counted(codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["code", "n"])

    counts = settle(stored.select("codes").mapInArrow(count, "code bigint, n bigint"), "counts")
    vector = np.zeros(len(aligner(*paths).names_a), np.int64)
    for row in counts.where("code < 0").groupBy("code").agg(F.sum("n").alias("n")).collect():  # a row per A id at most
        vector[-1 - row["code"]] = row["n"]
    return vector, settle(counts.where("code >= 0").groupBy("code").agg(F.sum("n").alias("n")), "pairs")


def align_tokens(docs: DataFrame, text_col: str = "text", path_a: str | None = None, path_b: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Replaces the text column by the columns of ``RESULTS``; a pair's count is the number of rows that hold it linked.

    The driver receives two numbers per A id and ``frequent`` pairs.
    """
    require(docs, text_col)
    paths = path_a or _path(VOCABULARY_A), path_b or _path(MODEL_B)
    own = aligner(*paths)
    stored = store_links(docs, text_col, paths)
    vector, pairs = count_pairs(stored, paths)
    best, width, kind, identity = vector.copy(), own.width, own.kind, own.identity
    for row in pairs.groupBy(F.floor(F.col("code") / width).alias("a")).agg(F.max("n").alias("n")).collect():  # a row per A id at most
        best[row["a"]] = max(best[row["a"]], row["n"])
    top = pairs.orderBy(F.desc("n"), "code").limit(frequent).toArrow()
    codes, numbers = (top.column(c).to_numpy() for c in ("code", "n"))
    order = np.argsort(codes)
    codes, numbers = codes[order], numbers[order]

    @F.arrow_udf("struct<n_best:bigint,count_sum:bigint,rest:array<struct<code:bigint,times:bigint>>>")
    def look_up(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        rest_kind = pa.list_(pa.struct([("code", pa.int64()), ("times", pa.int64())]))
        for all_links, all_times in columns:
            n_best, count_sum, rest = [], [], []
            for links, times in zip(all_links, all_times):
                found, times = np.frombuffer(links.as_py(), kind).astype(np.int64), np.frombuffer(times.as_py(), "<u4").astype(np.int64)
                ids = found // width
                mapped = identity[ids] == found % width
                place = np.minimum(np.searchsorted(codes, found), max(0, len(codes) - 1))
                known = (codes[place] == found if len(codes) else np.zeros(len(found), bool)) & ~mapped
                n = np.where(mapped, vector[ids], np.where(known, numbers[place] if len(codes) else 0, -1))
                n_best.append(int(times[n == best[ids]].sum()))
                count_sum.append(int((times * n)[n >= 0].sum()))
                rest.append([{"code": int(c), "times": int(t)} for c, t in zip(found[n < 0], times[n < 0])])
            yield pa.StructArray.from_arrays([pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(rest, rest_kind)], ["n_best", "count_sum", "rest"])

    looked = settle(stored.withColumn("_found", look_up("codes", "times")).drop("codes", "times"), "looked")
    peaks = docs.sparkSession.createDataFrame(pa.table({"a": np.flatnonzero(best), "_best": best[best > 0]}))
    rare = (
        looked.select("_at", F.explode("_found.rest").alias("_pair"))
        .select("_at", "_pair.code", "_pair.times")
        .join(pairs.withColumn("a", F.floor(F.col("code") / width)).join(F.broadcast(peaks), "a"), "code")
        .groupBy("_at")
        .agg(F.sum(F.when(F.col("n") == F.col("_best"), F.col("times")).otherwise(0)).alias("_n_best"), F.sum(F.col("times") * F.col("n")).alias("_count_sum"))
    )
    added = lambda name: (F.col(f"_found.{name}") + F.coalesce(F.col(f"_{name}"), F.lit(0))).alias(name)
    own_columns = [F.col(f"`{c}`") for c in looked.columns if c not in ("_at", "_found", "groups_sha256")]
    return looked.join(rare, "_at", "left").select(*own_columns, added("n_best"), added("count_sum"), "groups_sha256")


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op12_tokenizer_alignment": op12_tokenizer_alignment}
SQL: dict[str, str] = {}
