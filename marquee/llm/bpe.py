"""BPE encoding and decoding; long texts by tree concatenation.

Texts up to ``longest`` characters are encoded whole, in batches per partition. A longer text is halved until
its pieces are short enough, cuts falling anywhere, also inside a word of any length. The pieces are spread
over the cluster and encoded in parallel; then neighbours are joined pairwise up the tree. At a join, a window
around the cut is encoded again and grows until it agrees with the left part on one token and with the right
part on another (same id, same characters, nothing else on these characters). A sequence of tokens is the
encoding of its text exactly if every two neighbours are, and each pair now stands inside one encoding, so the
result is the encoding of the whole. A window that covers both parts is the result itself.

Texts are cut at blanks, which this kind of tokenizer drops, and each distinct word is encoded once and
remembered (a bounded number of words per worker).

Defined results: a NULL text counts as empty and gives no tokens; repeated rows each get the whole answer; an
empty table gives an empty result; other columns are ignored. The tokenizer's file is read on each executor
from ``path``.
"""

from __future__ import annotations

import os
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole

LONGEST = 65_536
WINDOW = 64
REMEMBERED = 250_000
AT_ONCE = 256
SCHEMA = "doc_id long, ids array<int>, decoded string"
_ROWS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
_BLANKS = str.maketrans("\n\t\r", "   ")
_WORD = re.compile(r"[^ \n\t\r]+")


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=2)
def names(path: str) -> list[str]:
    found = tokenizer(path)
    return [found.id_to_token(number) for number in range(found.get_vocab_size(with_added_tokens=True))]


def _signs() -> dict[int, str]:
    """The sign that stands for each byte in a byte-level vocabulary: printable ones themselves, the others from
    256 on in order."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [byte for byte in range(256) if byte not in own]
    return {byte: chr(256 + place) for place, byte in enumerate(others)}


_SIGNS = _signs()
_LATIN_END = "\u0250"


class Words(dict):
    """Ids of words, remembered up to a bound.

    A word of Latin letters, with one full stop or comma at most, is one pre-token (or two), which the
    tokenizer's model encodes by itself; any other word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer, self.names = tokenizer(path), names(path)
        self.model, self[""] = self.tokenizer.model, ()

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
            self[""] = ()
        stop = word[-1] if word[-1] in ".," else ""
        core = unicodedata.normalize("NFC", word[: -1 if stop else None])
        low = core.lower()
        if low.isalpha() and max(core) < _LATIN_END and max(low) < _LATIN_END:
            plain = low if low.isascii() else low.encode().decode("latin-1").translate(_SIGNS)
            ids = tuple(token.id for token in self.model.tokenize(plain)) + (self.whole(stop) if stop else ())
        else:
            ids = self.whole(word)
        self[word] = ids
        return ids

    def whole(self, text: str) -> tuple[int, ...]:
        return tuple(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [list(chain.from_iterable(map(self.__getitem__, text.translate(_BLANKS).split(" ")))) for text in texts]

    def part(self, text: str, at: int) -> Part:
        """Tokens and their places of a text that begins at ``at`` of the whole."""
        found = Part(at, at + len(text), [], [], [])
        for hit in _WORD.finditer(text):
            word, start = hit.group(), at + hit.start()
            ids = self[word]
            widths = [len(self.names[number].removesuffix("</w>")) for number in ids]
            if word.isascii() and sum(widths) == len(word):
                lasts = list(accumulate(widths, initial=start))
                found.firsts += lasts[:-1]
                found.lasts += lasts[1:]
            else:
                offsets = self.tokenizer.encode(word, add_special_tokens=False).offsets
                found.firsts += [start + a for a, _ in offsets]
                found.lasts += [start + b for _, b in offsets]
            found.ids += ids
        return found


def decoded(ids: list[int], path: str) -> str:
    """The tokens' names, joined by one blank: what a tokenizer without a decoder decodes to."""
    return " ".join(map(names(path).__getitem__, ids))


def halves(length: int, longest: int) -> list[tuple[int, int]]:
    """Ends of the pieces that halving leaves, in order."""

    def split(start: int, end: int) -> Iterator[tuple[int, int]]:
        if end - start <= longest:
            yield start, end
        else:
            middle = (start + end) // 2
            yield from split(start, middle)
            yield from split(middle, end)

    return list(split(0, length))


class Part:
    """Tokens of text[start:end]: ids, and where each begins and ends in the whole text."""

    def __init__(self, start: int, end: int, ids: list[int], firsts: list[int], lasts: list[int]):
        self.start, self.end, self.ids, self.firsts, self.lasts = start, end, ids, firsts, lasts

    @classmethod
    def of(cls, text: str, start: int, end: int, coder) -> Part:
        found = coder.encode(text[start:end], add_special_tokens=False)
        return cls(start, end, list(found.ids), [start + a for a, _ in found.offsets], [start + b for _, b in found.offsets])

    def alone(self, at: int) -> bool:
        """No other token has characters of token ``at``."""
        before = at == 0 or self.lasts[at - 1] <= self.firsts[at]
        return before and (at + 1 == len(self.ids) or self.firsts[at + 1] >= self.lasts[at]) and self.firsts[at] < self.lasts[at]

    def find(self, token: tuple[int, int, int]) -> int | None:
        at = bisect_left(self.firsts, token[1])
        return at if at < len(self.ids) and (self.ids[at], self.firsts[at], self.lasts[at]) == token and self.alone(at) else None

    def agreed(self, window: Part, order: range) -> tuple[int, int] | None:
        """The first token in ``order`` that both have: places here and in the window."""
        for at in order:
            if window.alone(at):
                here = self.find((window.ids[at], window.firsts[at], window.lasts[at]))
                if here is not None:
                    return here, at
        return None


def joined(text: str, left: Part, right: Part, coder, radius: int = WINDOW) -> Part:
    """Encoding of both parts' text from their encodings."""
    cut = left.end
    while True:
        start, end = max(left.start, cut - radius), min(right.end, cut + radius)
        window = Part.of(text, start, end, coder)
        if (start, end) == (left.start, right.end):
            return window
        size = len(window.ids)
        on_left = (-1, -1) if start == left.start else left.agreed(window, range(size))
        on_right = (len(right.ids), size) if end == right.end else right.agreed(window, range(size - 1, -1, -1))
        if on_left and on_right and on_left[1] < on_right[1]:
            keep, first, last, rest = on_left[0] + 1, on_left[1] + 1, on_right[1], on_right[0]
            return Part(
                left.start,
                right.end,
                left.ids[:keep] + window.ids[first:last] + right.ids[rest:],
                left.firsts[:keep] + window.firsts[first:last] + right.firsts[rest:],
                left.lasts[:keep] + window.lasts[first:last] + right.lasts[rest:],
            )
        radius *= 2


def concatenated(text: str, parts: list[Part], coder) -> Part:
    """Joins neighbours pairwise until one part is left."""
    while len(parts) > 1:
        pairs = [joined(text, a, b, coder) for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + parts[len(parts) - len(parts) % 2 :]
    return parts[0]


def _batch(numbers: pa.Array | list, ids: list[list[int]], path: str) -> pa.RecordBatch:
    texts = pa.array([decoded(row, path) for row in ids], pa.string())
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(ids, pa.list_(pa.int32())), texts], schema=_ROWS)


def _short(docs: DataFrame, path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch in batches:
            for start in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(start, AT_ONCE)
                yield _batch(part.column("doc_id"), words.encode(part.column("text").to_pylist()), path)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def _long(docs: DataFrame, path: str, longest: int) -> DataFrame:
    keys = "doc_id long, row long, start long, stop long, text string"
    tokens = keys + ", ids array<int>, firsts array<long>, lasts array<long>"
    key_fields = [("doc_id", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("text", pa.string())]
    token_fields = [("ids", pa.list_(pa.int32())), ("firsts", pa.list_(pa.int64())), ("lasts", pa.list_(pa.int64()))]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"]
                pieces = [row | {"start": a, "stop": b, "text": text[a:b]} for a, b in halves(len(text), longest)]
                yield pa.RecordBatch.from_pylist(pieces, schema=pa.schema(key_fields))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(path)
        for batch in batches:
            for row in batch.to_pylist():
                part = words.part(row["text"], row["start"])
                row |= {"ids": part.ids, "firsts": part.firsts, "lasts": part.lasts}
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema(key_fields + token_fields))

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda row: row["start"])
        copies = sum(row["start"] == 0 for row in rows)
        rows = rows[::copies]
        parts = [Part(row["start"], row["stop"], row["ids"], row["firsts"], row["lasts"]) for row in rows]
        ids = concatenated("".join(row["text"] for row in rows), parts, tokenizer(path)).ids
        return pa.Table.from_batches([_batch([rows[0]["doc_id"]] * copies, [ids] * copies, path)])

    pieces = docs.select("doc_id", F.xxhash64("text").alias("row"), "text").mapInArrow(cut, keys)
    spread = pieces.repartition("doc_id", "row", "start").mapInArrow(encode, tokens)
    return spread.groupBy("doc_id", "row").applyInArrow(join, SCHEMA)


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST) -> DataFrame:
    """doc_id, ids and decoded text of every row."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    length = F.length("text")
    return _short(docs.where(length <= longest), path).unionByName(_long(docs.where(length > longest), path, longest))


def decode(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded text from doc_id and ids; missing ids count as none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch(batch.column("doc_id"), [row or [] for row in batch.column("ids").to_pylist()], path)

    return tokens.select("doc_id", "ids").mapInArrow(run, SCHEMA)


def digests(encoded: DataFrame, *more: str) -> DataFrame:
    """Token count and hashes of the contract from :func:`encode`'s rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
