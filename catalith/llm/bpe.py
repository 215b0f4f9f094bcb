"""BPE encoding and decoding by forced boundaries: byte pairs that stand inside no token of the vocabulary are certain cuts."""

from __future__ import annotations

import heapq
import json
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The split of texts into words. A fixed value of the vocabulary's format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: Ends a word's last symbol in the vocabulary. A fixed value of its format.
END = "</w>"
#: Words, and fragments of words, that a Python worker remembers, at most; then it starts anew. Those with over LONGEST characters
#: aren't kept.
REMEMBERED, REMEMBERED_FRAGMENTS, LONGEST = 350_000, 50_000, 64
#: Rows that leave a task together.
TOGETHER = 256
#: Texts of these characters only are split here: their classes and lower cases are the same in all versions of Unicode, and they
#: are composed already. The rest is split by the normalizer and pre-tokenizer of the vocabulary's file.
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x84\\x86-ɏ‐-‧‰-⁞€]*")


def stand_ins() -> dict[str, int]:
    """Bytes by their printable stand-ins: printable Latin-1 characters stand for themselves, the rest in order from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Known(dict):
    """Words with what they give; one that isn't here yet is encoded, and kept unless it is long."""

    def __init__(self, own: Vocabulary):
        super().__init__()
        self.own = own

    def __missing__(self, word: str) -> tuple[bytes, str]:
        made = self.own._made([self.own.added[word]]) if word in self.own.added else self.own.word(word)
        if len(word) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = made
        return made


class Vocabulary:
    """A word-end BPE vocabulary of a tokenizers JSON file, with the pairs of bytes that stand side by side in a token."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        vocabulary, merges = read["model"]["vocab"], read["model"]["merges"]
        self.added = {x["content"]: x["id"] for x in read["added_tokens"]}
        self.tokens = {i: t for t, i in vocabulary.items()} | {i: t for t, i in self.added.items()}
        self.merges = {vocabulary[a] << 32 | vocabulary[b]: rank for rank, (a, b) in enumerate(merges)}
        self.gives = [vocabulary[a + b] for a, b in merges]
        stands = stand_ins()
        self.inner = [0] * 256
        self.last = [0] * 256
        for c, b in stands.items():
            self.inner[b], self.last[b] = vocabulary[c], vocabulary[c + END]
        # joined[0]: pairs inside of a token; joined[1]: pairs whose second byte ends a word.
        self.joined = np.zeros((2, 256, 256), bool)
        for token in vocabulary:
            ends = token.endswith(END) and token != END
            body = [stands[c] for c in (token[: -len(END)] if ends else token)]
            for i in range(len(body) - 1):
                self.joined[int(ends and i == len(body) - 2), body[i], body[i + 1]] = True
        self.inside, self.ending = (frozenset((int(x) << 8) | int(y) for x, y in np.argwhere(m)) for m in self.joined)
        self.words = regex.compile(WORDS)
        self.cut_at = re.compile("(" + "|".join(re.escape(x) for x in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.known = Known(self)
        self.fragments: dict[tuple[bytes, bool], list[int]] = {}

    def cuts(self, word: bytes) -> list[int]:
        """Places in a word's bytes where no token can reach across."""
        n = len(word)
        if n > 256:
            b = np.frombuffer(word, np.uint8)
            joined = self.joined[0][b[:-1], b[1:]]
            joined[-1] = self.joined[1][b[-2], b[-1]]
            return (np.flatnonzero(~joined) + 1).tolist()
        out = [i + 1 for i in range(n - 2) if (word[i] << 8 | word[i + 1]) not in self.inside]
        if n > 1 and (word[-2] << 8 | word[-1]) not in self.ending:
            out.append(n - 1)
        return out

    def merged(self, part: bytes, ends: bool) -> list[int]:
        """Ids of a fragment: always the pair that merges first, the leftmost of equal ones."""
        ids = [self.inner[b] for b in part]
        if ends:
            ids[-1] = self.last[part[-1]]
        if len(ids) > LONGEST:
            return self._merged_by_heap(ids)
        merges, never = self.merges, len(self.gives)
        ranks = [merges.get(a << 32 | b, never) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks and (rank := min(ranks)) < never:
            i = ranks.index(rank)
            ids[i : i + 2] = (self.gives[rank],)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = merges.get(ids[i] << 32 | ids[i + 1], never)
            if i:
                ranks[i - 1] = merges.get(ids[i - 1] << 32 | ids[i], never)
        return ids

    def _merged_by_heap(self, ids: list[int]) -> list[int]:
        """The same for long fragments: neighbours are linked and pairs wait in a heap, so n symbols take n log n steps."""
        n, merges, gives = len(ids), self.merges, self.gives
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        waiting = [(rank, i) for i in range(n - 1) if (rank := merges.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(waiting)
        while waiting:
            rank, i = heapq.heappop(waiting)
            j = after[i]
            if ids[i] < 0 or j >= n or merges.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = gives[rank], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (rank := merges.get(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(waiting, (rank, i))
            if (h := before[i]) >= 0 and (rank := merges.get(ids[h] << 32 | ids[i])) is not None:
                heapq.heappush(waiting, (rank, h))
        return [x for x in ids if x >= 0]

    def fragment(self, part: bytes, ends: bool) -> list[int]:
        if len(part) > LONGEST:
            return self.merged(part, ends)
        if (found := self.fragments.get((part, ends))) is None:
            if len(self.fragments) >= REMEMBERED_FRAGMENTS:
                self.fragments.clear()
            found = self.fragments[part, ends] = self.merged(part, ends)
        return found

    def _made(self, ids: list[int]) -> tuple[bytes, str]:
        return struct.pack(f"<{len(ids)}I", *ids), " ".join([self.tokens[i] for i in ids])

    def word(self, word: str) -> tuple[bytes, str]:
        """(ids as bytes, decoded text) of a word: fragments between its cuts, one after the other."""
        data = word.encode()
        ids: list[int] = []
        start = 0
        for cut in [*self.cuts(data), len(data)]:
            ids += self.fragment(data[start:cut], cut == len(data))
            start = cut
        return self._made(ids)

    def split(self, text: str) -> list[str]:
        """Words of a text without added tokens."""
        if PLAIN.fullmatch(text):
            return self.words.findall(text.lower())
        stands = stand_ins()
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(stands[c] for c in p).decode() for p, _ in pieces]

    def encode(self, text: str) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text)."""
        parts = self.cut_at.split(text) if self.cut_at else [text]
        words: list[str] = []
        for i, part in enumerate(parts):
            words += [part] if i % 2 else self.split(part) if part else []
        found = list(map(self.known.__getitem__, words))
        return b"".join([x for x, _ in found]), " ".join([y for _, y in found])

    def decode(self, ids: np.ndarray) -> str:
        """Tokens one after the other with a space between them, as a vocabulary without a decoder has it."""
        return " ".join([self.tokens[i] for i in ids.tolist()])


_vocabularies: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """Loaded once in each Python worker."""
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


def encode(docs: DataFrame, path: str, *, text: str = "text", ids: str = "ids", decoded: str = "decoded", columns: list[str] | None = None) -> DataFrame:
    """docs (or only these columns of it) with the ids of each whole text (binary: little-endian unsigned 32-bit integers) and
    what they decode to.

    Added tokens of the vocabulary's file are single ids wherever they stand in a text. What is between them is split into
    words; a word is cut at each pair of bytes that no token of the vocabulary holds side by side, as no merge can reach
    across; fragments are encoded by themselves and set one after the other. A null or empty text, and one of blanks, has no ids and
    decodes to an empty text. Rows are worked on one by one: repeated rows give equal ones, an empty table none; columns
    named like ids or decoded are replaced, others stay. A text's ids are held in one task, as the text is.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = vocabulary(path)
        for batch in batches:
            for i in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(i, TOGETHER)
                made = [own.encode(value.as_py() or "") for value in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in made], pa.binary()), pa.array([y for _, y in made], pa.string())], ["_row", "_ids", "_decoded"])

    kept = [c for c in (docs.columns if columns is None else columns) if c.lower() not in (ids.lower(), decoded.lower())]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(f"`{text}`").cast("string").alias("_text"))
    made = rows.mapInArrow(work, T.StructType([rows.schema["_row"], T.StructField("_ids", T.BinaryType()), T.StructField("_decoded", T.StringType())]))
    return made.select("_row.*", F.col("_ids").alias(ids), F.col("_decoded").alias(decoded))


def decode(rows: DataFrame, path: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with the text of their ids (as encode gives them); null ids give null."""

    @F.pandas_udf("string")
    def decoded(values):
        import pandas as pd

        own = vocabulary(path)
        return pd.Series([None if v is None else own.decode(np.frombuffer(v, "<u4")) for v in values], dtype=object)

    return rows.withColumn(out, decoded(F.col(ids)))
