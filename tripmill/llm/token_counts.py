"""Token counts at every prefix of a text, by dynamic programming over prefixes.

A byte-pair encoding is the only sequence of tokens in which each neighbouring
pair is *compatible*: encoding the two tokens' bytes together gives the same two
tokens. So the last token of the encoding of ``word[:i]`` is the one vocabulary
suffix that is compatible with the last token of what stands before it, and the
count is one more than there. One pass over a word stores the exact count at
each of its prefixes; words repeat, so each worker keeps the counts of recent
words. Counts of whole texts are sums over words, and truncation and budget
questions read the stored counts instead of encoding again.

Null text counts as empty (0 tokens); an empty table gives an empty table; other
columns are kept, and existing columns named like a result are replaced.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import require, slices, table
from tripmill.llm.suffixes import Recent, Suffixes

LIMIT = 1024
VOCABULARY = "byte_bpe_50k.json"
#: Bytes of words and chunks that each of a worker's two generations holds, about.
KEPT_BYTES = 96 << 20
#: Pairs of tokens kept per worker; a full store is emptied and fills again.
KEPT_PAIRS = 500_000
#: Split of a text into words before merging (fixed value of this vocabulary).
WORDS = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: White space other than space, tab and line ends (fixed values), and what makes a space not begin a word.
ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
BESIDE_SPACE = ("  ", " \n", "\n ", " \t", "\t ", " \r", "\r ")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_of_symbol() -> dict[str, int]:
    """The printable symbols that byte-level vocabularies write bytes with."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Exact token counts of texts and of all their prefixes, for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols = _byte_of_symbol()
        to_bytes = lambda token: bytes(symbols[c] for c in token)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.ranks = {(to_bytes(a), to_bytes(b)): rank for rank, (a, b) in enumerate(merges)}
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.made: dict[bytes, int] = {}
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        for pair, rank in self.ranks.items():
            if self.made.setdefault(pair[0] + pair[1], rank) == rank:
                self.halves[pair[0] + pair[1]] = pair
        self.names = sorted({bytes([b]) for b in range(256)} | {a + b for a, b in self.ranks})
        self.sizes = list(map(len, self.names))
        self.suffixes = Suffixes(self.names)
        # a chunk that is one word has the count of that word, so both share a store
        self.counts = Recent(KEPT_BYTES)
        self.pairs: dict[int, bool] = {}
        self._word, self._last, self._counts, self._states = b"", [0], [0], [0]

    def compatible(self, left: bytes, right: bytes) -> bool:
        """Whether no merge across the border comes before the merges that made the two tokens.

        The merges are undone from the last one on. Each time, the two parts that
        touch the border must not merge earlier than the merge just undone; of
        equal merges the left one comes first.
        """
        ranks, made, halves = self.ranks, self.made, self.halves
        before = 1 << 30
        while True:
            if ranks.get((left, right), before) < before:
                return False
            of_left, of_right = made.get(left, -1), made.get(right, -1)
            if of_left > of_right:
                before, left = of_left, halves[left][1]
            elif of_right >= 0:
                before, right = of_right + 1, halves[right][0]
            else:
                return True

    def word_counts(self, word: bytes) -> list[int]:
        """Token count of each prefix of one word, from the empty one on.

        What the previous word shares with this one is kept, so sorted words
        share the work for their common prefixes.
        """
        last, counts, states, shared = self._last, self._counts, self._states, 0
        for old, new in zip(self._word, word):
            if old != new:
                break
            shared += 1
        del last[shared + 1 :], counts[shared + 1 :], states[shared + 1 :]
        names, sizes, pairs, goto, step, ends = self.names, self.sizes, self.pairs, self.suffixes.goto, self.suffixes.step, self.suffixes.ends
        state = states[shared]
        for end in range(shared + 1, len(word) + 1):
            state = goto.get(state << 21 | word[end - 1]) or step(state, word[end - 1])
            for token in ends[state]:
                start = end - sizes[token]
                if start:
                    pair = last[start] << 20 | token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= KEPT_PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(names[last[start]], names[token])
                    if not fits:
                        continue
                last.append(token)
                counts.append(counts[start] + 1)
                states.append(state)
                break
        self._word = word
        return counts

    def word_count(self, word: str) -> int:
        count = self.counts.young.get(word)
        if count is None:
            count = self.counts.old.get(word) or self.word_counts(word.encode())[-1]
            if len(word) <= 64:
                self.counts.keep(word, count)
        return count

    def prepare(self, texts: list[str]) -> list[tuple[list[str], list[int]] | None]:
        """Chunks of each text and their counts; new words of all texts are counted in sorted order."""
        store = self.counts
        store.turn()
        chunks = [self._chunks(text) for text in texts]
        counts = [store.find(own) if own else None for own in chunks]
        partly = [i for i, own in enumerate(counts) if own and None in own]
        split = {}
        for chunk in store.missing(c for i in partly for c, n in zip(chunks[i], counts[i]) if n is None):
            word = chunk[1:] if chunk[:1] == " " else chunk
            split[chunk] = (chunk,) if word.isascii() and word.isalpha() else WORDS.findall(chunk)
        young = store.young
        for word in sorted(store.missing(w for words in split.values() for w in words if w not in young)):
            store.keep(word, self.word_counts(word.encode())[-1])
        for chunk, words in split.items():
            if len(words) != 1:
                store.keep(chunk, sum(map(young.__getitem__, words)))
        for i in partly:
            counts[i] = store.find(chunks[i])
        return [None if own is None else (own, n or []) for own, n in zip(chunks, counts)]

    def _chunks(self, text: str) -> list[str] | None:
        """Chunks that begin with a single space each, or None if the text has to be split into words.

        A single space between two other characters always begins a word.
        """
        if text[:1] == " " or text[-1:] == " " or any(x in text for x in BESIDE_SPACE) or ODD_SPACE.search(text):
            return None
        if self.special is not None and "<|" in text and self.special.search(text):
            return None
        return text.replace(" ", "\0 ").split("\0") if "\0" not in text else None

    def _split(self, text: str) -> list[str]:
        """Words and special strings in order; special strings are single tokens."""
        if self.special is None or not self.special.search(text):
            return WORDS.findall(text)
        parts = self.special.split(text)
        return [w for i, part in enumerate(parts) for w in ([part] if i % 2 else WORDS.findall(part))]

    def count(self, text: str) -> int:
        return sum(self.chunk_counts(text)[1])

    def chunk_counts(self, text: str, prepared: tuple[list[str], list[int]] | None = None) -> tuple[list[str], list[int]]:
        """Chunks of a text that are encoded one by one, and their counts; ``prepared`` comes from ``prepare``."""
        found = prepared or self.prepare([text])[0]
        if found is None:
            words = self._split(text)
            return words, [1 if self.special and self.special.fullmatch(w) else self.word_count(w) for w in words]
        return found

    def count_and_fit(self, text: str, budget: int, prepared: tuple[list[str], list[int]] | None = None) -> tuple[int, int | None]:
        """Token count, and the characters of the longest prefix within ``budget`` if the text is longer."""
        chunks, counts = self.chunk_counts(text, prepared)
        total = sum(counts)
        if total <= budget:
            return total, None
        sums = list(accumulate(counts, initial=0))
        over = bisect_right(sums, budget)
        first, last = max(0, over - 4), min(len(chunks), over + 4)
        before = sum(map(len, chunks[:first]))
        part = Prefixes(self, "".join(chunks[first:last]))
        return total, before + part.longest_within(budget - sums[first])

    def prefixes(self, text: str) -> "Prefixes":
        return Prefixes(self, text)


class Prefixes:
    """Stored counts of one text: ``at(i)`` is the exact token count of ``text[:i]``."""

    def __init__(self, counter: PrefixCounter, text: str):
        self.counter, self.text = counter, text
        words = counter._split(text)
        special = counter.special
        self.ends = [0, *accumulate(map(len, words))]
        self.sums = [0, *accumulate(1 if special and special.fullmatch(w) else counter.word_count(w) for w in words)]
        self.inside: dict[int, list[int]] = {}

    def at(self, end: int) -> int:
        """A cut can only change how the last words before it are split, so those alone are split anew."""
        end = max(0, min(end, len(self.text)))
        word = bisect_right(self.ends, end) - 1
        if self.ends[word] == end and (end == len(self.text) or not self.text[end - 1 : end].isspace()):
            return self.sums[word]
        start = max(0, word - 1)
        while start and self.text[self.ends[start] : self.ends[start + 1]].isspace():
            start -= 1
        total = self.sums[start]
        for piece in self.counter._split(self.text[self.ends[start] : end]):
            if word < len(self.ends) - 1 and len(piece) > 64 and self.text.startswith(piece, self.ends[word]):
                total += self._long(word)[len(piece.encode())]
            else:
                total += 1 if self.counter.special and self.counter.special.fullmatch(piece) else self.counter.word_count(piece)
        return total

    def _long(self, word: int) -> list[int]:
        if word not in self.inside:
            self.inside[word] = self.counter.word_counts(self.text[self.ends[word] : self.ends[word + 1]].encode())[:]
        return self.inside[word]

    def longest_within(self, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if self.sums[-1] <= budget:
            return len(self.text)
        # a cut re-splits the few words before it only: no prefix beyond this word can fit
        last = min(len(self.ends) - 1, bisect_right(self.sums, budget) + 3)
        end = self.ends[last]
        while end > 0 and self.at(end) > budget:
            end -= 1
        return end


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, text_col: str = "text", limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """Adds n_bytes, n_tokens, over_limit and fit_bytes (bytes of the longest prefix within ``limit`` tokens)."""
    require(docs, text_col)
    path = path or vocabulary_path()

    @F.arrow_udf("struct<n_tokens:bigint,fit_bytes:bigint>")
    def measure(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = counter(path)
        for column in texts:
            rows = []
            for piece in slices([pa.record_batch([column], ["text"])], "text", 1 << 20):
                strings = [text or "" for text in piece.column(0).to_pylist()]
                for text, prepared in zip(strings, own.prepare(strings)):
                    tokens, cut = own.count_and_fit(text, limit, prepared)
                    rows.append((tokens, len(text[:cut].encode())))
            yield pa.StructArray.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], ["n_tokens", "fit_bytes"])

    results = ("n_bytes", "n_tokens", "over_limit", "fit_bytes")
    return (
        docs.withColumn("_counts", measure(F.col(text_col)))
        .select(
            *[c for c in docs.columns if c not in results],
            F.octet_length(F.coalesce(text_col, F.lit(""))).cast("long").alias("n_bytes"),
            F.col("_counts.n_tokens").alias("n_tokens"),
            (F.col("_counts.n_tokens") > limit).alias("over_limit"),
            F.col("_counts.fit_bytes").alias("fit_bytes"),
        )
    )


def prefix_counts(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """Adds prefix_tokens: exact token counts of all prefixes, by character, starting with the empty one."""
    require(docs, text_col)
    path = path or vocabulary_path()

    @F.arrow_udf("array<int>")
    def store(texts: pa.Array) -> pa.Array:
        own = counter(path)
        stored = [own.prefixes(value.as_py() or "") for value in texts]
        return pa.array([[p.at(i) for i in range(len(p.text) + 1)] for p in stored], pa.list_(pa.int32()))

    return docs.withColumn("prefix_tokens", store(F.col(text_col)))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(documents).drop("text")


QUERIES = {"op1_token_counts": op1_token_counts}
SQL: dict[str, str] = {}
