"""Encoding a corpus with a public byte-level BPE tokenizer by tree concatenation.

A long text is halved until its parts are short.  A cut falls, where it can, on
a place that ends a pre-token whatever follows, so that the ids of both halves
can simply be put together.  A cut inside an unbroken run of one character
class is *fused*: a window of whole tokens around the join is re-encoded and
grows until its first token equals the left half's and its last token the right
half's.  In BPE a sequence is the encoding of its bytes exactly if every
adjacent pair of tokens is; the agreeing window makes every pair one that was
already valid, so the result is exact.

Parts of a text are encoded by several threads of its task (the library lets go
of the interpreter while it encodes).  A text has at most 2 GB, so that no task
holds more than one such; a table with giant texts can have their parts encoded
by different tasks instead (``giant_chars``), at the cost of a second scan.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import cut_lineage, spread

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""

LEAF_CHARS = 4_096
THREADS = 4
THREADED_CHARS = 1 << 20


def _kind(ch: str) -> str:
    """Character class of the pre-token pattern: space, letter, number or other."""
    if ch.isspace():
        return "s"
    if ch.isalpha():
        return "l"
    return "n" if ch.isnumeric() else "o"


def _is_cut(text: str, at: int) -> bool:
    """Whether a pre-token ends at ``at`` whatever stands further left or right."""
    before, after = text[at - 1], text[at]
    if before.isspace():
        return False
    if after in " \t\n\r":
        return True
    # Marks and other rare characters are classed differently by different libraries.
    if before == "'" or not (before.isascii() and after.isascii()) or not (before.isprintable() and after.isprintable()):
        return False
    return _kind(before) != _kind(after)


def halve(text: str, reach: int) -> tuple[int, bool]:
    """Where to cut a text near its middle, and whether the cut is inside an unbroken run."""
    middle = len(text) // 2
    for step in range(min(reach, middle - 1)):
        for at in (middle - step, middle + step):
            if 0 < at < len(text) and _is_cut(text, at):
                return at, False
    return middle, True


def cut_parts(text: str, leaf: int) -> list[tuple[str, bool]]:
    """Parts of at most about ``leaf`` characters in order; the flag says that a part is fused to the one before."""
    if len(text) <= max(leaf, 8):
        return [(text, False)]
    at, fused = halve(text, leaf // 2)
    left, right = cut_parts(text[:at], leaf), cut_parts(text[at:], leaf)
    return left + [(right[0][0], fused)] + right[1:]


class Codec:
    """One vocabulary in one process."""

    _loaded: dict[tuple[str, str], "Codec"] = {}

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        name = hashlib.md5((path + pattern).encode()).hexdigest()
        self.encoding = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    @classmethod
    def load(cls, path: str, pattern: str) -> "Codec":
        key = (path, pattern)
        if key not in cls._loaded:
            cls._loaded[key] = cls(path, pattern)
        return cls._loaded[key]

    def plain(self, text: str) -> np.ndarray:
        """The ids of a short text in one go."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        return self.encoding.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int32)

    def encode(self, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
        """The ids of a text of any length."""
        if len(text) <= leaf:
            return self.plain(text)
        parts = cut_parts(text, leaf)
        if len(text) < THREADED_CHARS:
            return self.join([(self.plain(part), fused) for part, fused in parts])
        with ThreadPoolExecutor(THREADS) as threads:
            ids = list(threads.map(self.plain, (part for part, _ in parts)))
            return self.join(list(zip(ids, (fused for _, fused in parts))))

    def join(self, parts: list[tuple[np.ndarray, bool]]) -> np.ndarray:
        """Put encoded parts together, two and two, level by level."""
        while len(parts) > 1:
            merged = [
                (self._concat(parts[i][0], parts[i + 1][0], parts[i + 1][1]), parts[i][1])
                for i in range(0, len(parts) - 1, 2)
            ]
            parts = merged + (parts[-1:] if len(parts) % 2 else [])
        return parts[0][0] if parts else np.zeros(0, dtype=np.int32)

    def _bytes(self, ids: np.ndarray) -> bytes:
        return self.encoding.decode_bytes(ids.tolist())

    def _concat(self, left: np.ndarray, right: np.ndarray, fused: bool) -> np.ndarray:
        """``left`` before ``right``; of a fused join, the tokens around it anew."""
        if not fused or not len(left) or not len(right):
            return np.concatenate([left, right])
        window = 8
        while True:
            k, m = min(window, len(left)), min(window, len(right))
            raw = self._bytes(np.concatenate([left[len(left) - k :], right[:m]]))
            again = self._window(raw, m == len(right))
            if again is not None and len(again):
                agrees_left = k == len(left) or again[0] == left[len(left) - k]
                agrees_right = m == len(right) or again[-1] == right[m - 1]
                if agrees_left and agrees_right:
                    return np.concatenate([left[: len(left) - k], again, right[m:]])
            if k == len(left) and m == len(right):
                raise ValueError("a fused join did not settle")
            window *= 2

    def _window(self, raw: bytes, last: bool) -> np.ndarray | None:
        """The ids of the bytes between two token ends, cut to pre-tokens.

        None if they aren't whole characters, or end, but for the last of all,
        in blanks, whose pre-tokens depend on what follows.
        """
        try:
            text = raw.decode()
        except UnicodeDecodeError:
            return None
        return None if text[-1:].isspace() and not last else self.plain(text)


def _id_batch(batch: pa.RecordBatch, arrays: list[np.ndarray]) -> pa.RecordBatch:
    """``batch`` with its last column replaced by lists of ids."""
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, dtype=np.int32)
    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=pa.int32()))
    return pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=[*batch.schema.names[:-1], "ids"])


def _slices(batch: pa.RecordBatch, rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def encode_corpus(
    documents: DataFrame,
    key: str = "doc_id",
    text: str | Column = "text",
    tokenizer: str = TOKENIZER,
    pattern: str = PATTERN,
    leaf_chars: int = LEAF_CHARS,
    giant_chars: int | None = None,
) -> DataFrame:
    """``(key, ids array<int>)``: the ids of every row's text, without special tokens.

    Null and empty texts give an empty list.  Repeated rows and keys stay as
    many rows; other columns are dropped, so that none can clash.  An empty
    table gives an empty result.  The strings of special tokens are ordinary
    text.  One scan and no shuffle; with ``giant_chars`` texts of more
    characters are cut into rows, whose parts several tasks encode.
    """
    body = F.col(text) if isinstance(text, str) else text
    rows = documents.select(F.col(key).alias(key), F.coalesce(body, F.lit("")).alias("__text"))
    key_type = rows.schema[key].dataType.simpleString()
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.load(tokenizer, pattern)
        for batch in batches:
            for part in _slices(batch):
                texts = part.column(part.num_columns - 1).to_pylist()
                yield _id_batch(part, [codec.encode(t, leaf_chars) for t in texts])

    if giant_chars is None:
        return spread(rows, key).mapInArrow(encode, f"`{key}` {key_type}, ids array<int>")
    giant = F.length("__text") > giant_chars
    usual = spread(rows, key).filter(~giant).mapInArrow(encode, f"`{key}` {key_type}, ids array<int>")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = cut_parts(whole, giant_chars // 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([digest] * len(parts), pa.string()),
                        pa.array(range(len(parts)), pa.int32()),
                        pa.array([fused for _, fused in parts], pa.bool_()),
                        pa.array([p for p, _ in parts], pa.string()),
                    ],
                    names=["digest", "part", "fused", "text"],
                )

    # Read once for both of its uses; of most tables nothing is left here.
    large = cut_lineage(rows.filter(giant).withColumn("digest", F.sha2("__text", 256)))
    parts = (
        large.select("digest", "__text")
        .dropDuplicates(["digest"])
        .mapInArrow(cut, "digest string, part int, fused boolean, text string")
        .repartition("digest", "part")
        .mapInArrow(encode, "digest string, part int, fused boolean, ids array<int>")
    )

    @F.udf("array<int>")
    def tree(pieces):
        codec = Codec.load(tokenizer, pattern)
        return codec.join([(np.asarray(p.ids, dtype=np.int32), p.fused) for p in pieces]).tolist()

    joined = parts.groupBy("digest").agg(
        tree(F.array_sort(F.collect_list(F.struct("part", "fused", "ids")))).alias("ids")
    )
    return usual.unionByName(large.select(key, "digest").join(joined, "digest").select(key, "ids"))
