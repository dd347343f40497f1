"""SentencePiece encoding and decoding with a Viterbi pass shared between words.

A text is marked (a word mark for each space, one more in front) and cut into
marked words, which no piece crosses. The new distinct words of a batch are
sorted, which lists the leaves of their trie in depth-first order; the forward
states along the path to a word - last piece, score and number of pieces of the
best segmentation of each prefix - stay on a stack, so words with a common prefix
share them. The best segmentation is read back from the last state.

Two kinds of model are supported. In a *unigram* model the best segmentation has
the largest sum of piece scores. In a *merge* model scores rank merges, and the
sum of scores does not give the library's result; there the segmentation of a
prefix ends in the one piece that is compatible with the piece before it (merging
their characters together gives just these two), and the forward score is kept
along that path. Characters without a piece become byte pieces.

Null text counts as empty and has no pieces. Empty tables give empty tables. Other
columns are kept, and existing columns named like a result are replaced. Ids that
are null or outside the vocabulary are skipped in decoding.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require, slices, table
from tripmill.llm.suffixes import Recent, Suffixes

MODEL = "piece_bpe_32k.model"
MARK = "▁"
#: Bytes of words and their ids that each of a worker's two generations holds, about.
KEPT_BYTES = 96 << 20
#: Pairs of pieces kept per worker; a full store is emptied and fills again.
KEPT_PAIRS = 500_000
#: Steps of the automaton that follow its fallbacks, kept per worker in the same way.
KEPT_STEPS = 300_000
WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class Segmenter:
    """Best segmentations over a vocabulary of scored pieces."""

    def __init__(self, scores: dict[str, float], merges: bool):
        self.scores, self.merges = scores, merges
        self.names = [*scores, ""]
        self.sizes, self.worth = [*map(len, scores), 1], [*scores.values(), min(scores.values(), default=0.0) - 10.0]
        #: Number of the piece that stands for a character without one.
        self.unknown = len(scores)
        self.suffixes = Suffixes([[*map(ord, name)] for name in scores])
        self.pairs: dict[int, bool] = {}
        self.steps: dict[int, int] = {}
        self.parts: dict[str, tuple[str, str]] = {}
        self.word = ""
        # forward states by prefix: (number of the last piece, score and pieces of the prefix, state of the automaton)
        self.stack: list[tuple[int, float, int, int]] = [(-1, 0.0, 0, 0)]
        self.reused = self.computed = 0

    def compatible(self, left: str, right: str) -> bool:
        """Whether no merge across the border comes before the merges that made the two pieces.

        The merges are undone from the last one on; the parts that touch the border
        must not merge before the one just undone, and of equal merges the left one
        comes first.
        """
        rank, before = self.rank, np.inf
        while True:
            if rank(left + right) < before:
                return False
            of_left, of_right = rank(left) if len(left) > 1 else -np.inf, rank(right) if len(right) > 1 else -np.inf
            if of_left > of_right:
                before, left = of_left, self.halves(left)[1]
            elif len(right) > 1:
                before, right = np.nextafter(of_right, np.inf), self.halves(right)[0]
            else:
                return True

    def rank(self, piece: str) -> float:
        """Place of the merge that makes a piece: smaller is earlier, infinite if nothing makes it."""
        return -self.scores.get(piece, -np.inf)

    def halves(self, piece: str) -> tuple[str, str]:
        """The two parts of the last merge that makes a piece."""
        found = self.parts.get(piece)
        if found is None:
            parts = [*piece]
            while len(parts) > 2:
                _, at = min((self.rank(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            found = self.parts[piece] = (parts[0], parts[1])
        return found

    def path(self, word: str) -> list[int]:
        """Numbers of the pieces of a word; forward states of the prefix shared with the word before are reused."""
        shared = 0
        for old, new in zip(self.word, word):
            if old != new:
                break
            shared += 1
        stack, pairs, sizes, worth, unknown = self.stack, self.pairs, self.sizes, self.worth, self.unknown
        goto, steps, ends = self.suffixes.goto.get, self.steps.get, self.suffixes.ends
        del stack[shared + 1 :]
        self.reused += shared
        self.computed += len(word) - shared
        state = stack[shared][3]
        for end in range(shared + 1, len(word) + 1):
            key, best = state << 21 | ord(word[end - 1]), None
            state = goto(key)
            if state is None:
                state = steps(key)
                if state is None:
                    state = self._fall(key)
            found = ends[state]
            if not found or sizes[found[-1]] > 1:
                found = (*found, unknown)
            for piece in found:
                last, score, count, _ = stack[end - sizes[piece]]
                if not self.merges:
                    if best is None or score + worth[piece] > best[1]:
                        best = (piece, score + worth[piece], count + 1, state)
                    continue
                # a character without a piece never merges with what stands beside it
                if last >= 0 and last != unknown != piece:
                    pair = last << 21 | piece
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= KEPT_PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(self.names[last], self.names[piece])
                    if not fits:
                        continue
                best = (piece, score + worth[piece], count + 1, state)
                break
            stack.append(best)
        self.word = word
        pieces, end = [], len(word)
        while end:
            pieces.append(stack[end][0])
            end -= sizes[pieces[-1]]
        return pieces[::-1]

    def _fall(self, key: int) -> int:
        """The automaton's step for a state and a symbol that it has to fall back for."""
        if len(self.steps) >= KEPT_STEPS:
            self.steps.clear()
        found = self.steps[key] = self.suffixes.step(key >> 21, key & 0x1FFFFF)
        return found

    def segment(self, word: str) -> list[str]:
        """Pieces of a word as text."""
        pieces, end = [], 0
        for size in map(self.sizes.__getitem__, self.path(word)):
            pieces.append(word[end : end + size])
            end += size
        return pieces


class PieceCoder:
    """Ids of texts and texts of ids, for one SentencePiece model file of the merging kind."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))]
        self.ids = {names[i]: i for i in plain}
        self.unknown = model.unk_id()
        self.bytes = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        self.raw: list[bytes] = [b""] * size
        for i in plain:
            self.raw[i] = names[i].replace(MARK, " ").encode()
        for value, i in self.bytes.items():
            self.raw[i] = bytes([value])
        self.segmenter = Segmenter({names[i]: model.get_score(i) for i in plain}, merges=True)
        if any("\n" in name or MARK in name.lstrip(MARK) for name in self.ids):
            raise ValueError("pieces of this model cross word marks")
        self.known = Recent(KEPT_BYTES)
        #: Little-endian 32-bit ids by number of the piece.
        self.codes = [i.to_bytes(4, "little") for i in self.ids.values()]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; new marked words of all texts are segmented in sorted order."""
        store, codes, unknown = self.known, self.codes, self.segmenter.unknown
        store.turn()
        marked = [WORD.findall(MARK + text.replace(" ", MARK)) if text else [] for text in texts]
        coded = list(map(store.find, marked))
        gaps = [(own, words, [at for at, ids in enumerate(own) if ids is None]) for own, words in zip(coded, marked) if None in own]
        for word in sorted(store.missing(words[at] for _, words, places in gaps for at in places)):
            pieces = self.segmenter.path(word)
            if unknown in pieces:
                ids = [i for piece in self.segmenter.segment(word) for i in self._ids_of(piece)]
                store.keep(word, b"".join(i.to_bytes(4, "little") for i in ids))
            else:
                store.keep(word, b"".join([codes[piece] for piece in pieces]))
        young = store.young
        for own, words, places in gaps:
            for at in places:
                own[at] = young[words[at]]
        return [np.frombuffer(b"".join(own), "<u4") for own in coded]

    def _ids_of(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        if found is not None:
            return [found]
        return [self.bytes[b] for b in piece.encode()] if self.bytes else [self.unknown]

    def decode(self, ids) -> str:
        size = len(self.raw)
        if isinstance(ids, np.ndarray):
            known = ids[(ids >= 0) & (ids < size)].tolist()
        else:
            known = [i for i in ids if i is not None and 0 <= i < size]
        text = b"".join(map(self.raw.__getitem__, known)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def coder(path: str) -> PieceCoder:
    return PieceCoder(path)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Adds piece_ids."""
    require(docs, text_col)
    path = path or model_path()

    @F.arrow_udf("array<int>")
    def ids(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            out = []
            for piece in slices([pa.record_batch([column], ["text"])], "text", 1 << 20):
                out += [a.astype(np.int32) for a in coder(path).encode([t or "" for t in piece.column(0).to_pylist()])]
            yield pa.array(out, pa.list_(pa.int32()))

    return docs.withColumn("piece_ids", ids(F.col(text_col)))


def decode(rows: DataFrame, ids_col: str = "piece_ids", into: str = "text", path: str | None = None) -> DataFrame:
    """Adds the text of an id column; null ids give null."""
    require(rows, ids_col)
    path = path or model_path()

    @F.arrow_udf("string")
    def text(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([None if row is None else coder(path).decode(row) for row in column.to_pylist()], pa.string())

    return rows.withColumn(into, text(F.col(ids_col)))


def round_trips(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Per document: id, n_bytes, n_pieces, ids_crc32 (little-endian 32-bit ids), round_trip (decoding gives the text)."""
    import zlib

    require(docs, id_col, text_col)
    path = path or model_path()

    @F.arrow_udf("struct<n_pieces:bigint,ids_crc32:bigint,round_trip:boolean>")
    def check(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = coder(path)
        for column in columns:
            rows = []
            for piece in slices([pa.record_batch([column], ["text"])], "text", 1 << 20):
                texts = [t or "" for t in piece.column(0).to_pylist()]
                for text, ids in zip(texts, own.encode(texts)):
                    rows.append((len(ids), zlib.crc32(ids.tobytes()), own.decode(ids) == text))
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["n_pieces", "ids_crc32", "round_trip"])

    coded = docs.select(F.col(id_col), F.octet_length(F.coalesce(text_col, F.lit(""))).cast("long").alias("n_bytes"), check(F.col(text_col)).alias("_coded"))
    return coded.select(id_col, "n_bytes", "_coded.*")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(table(spark, sf_dir, "documents"))


QUERIES = {"op5_sentencepiece": op5_sentencepiece}
SQL: dict[str, str] = {}
