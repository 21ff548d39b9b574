"""Byte-level BPE encoding and decoding as a monoid tree reduction.

The encodings of two neighbouring byte strings are joined without encoding the whole
again: the tokens next to the seam are re-encoded together, and the window grows until
the tokens outside can no longer change. That is decidable pair by pair: a token
sequence is the encoding of its bytes exactly when every adjacent pair of tokens is the
encoding of its own bytes, so the join is final once the pairs at both edges of the
window are. A long piece is encoded by halves, recursively; short ones are the leaves.
Decoding concatenates byte strings up a tree of the same form.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from tabulon.llm.common import Recent, small_batches, table

#: Pieces up to this many bytes are leaves of the tree.
LEAF_BYTES = 6
#: Distinct pieces, and pairs of tokens, of a generation of what a task remembers (see ``Recent``).
CACHED_PIECES = 150_000
#: Texts encoded before a task hands their rows on.
ROWS_AT_ONCE = 200


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> id from a rank file (a line per token: base64, space, id)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class BytePairs:
    """Encoder and decoder over ``ranks``; ``pattern`` splits a text into the pieces that
    are encoded separately."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.leaves = Recent(CACHED_PIECES)  # bytes -> ids
        self.fit = Recent(CACHED_PIECES)  # (id, id) -> bool
        self.cache = Recent(CACHED_PIECES)  # piece -> (ids, ids as decimals)

    def leaf(self, piece: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, the leftmost of equals, until no pair is
        a token. The pairs wait in a heap, so a long window costs n log n."""
        ranks = self.ranks
        n = len(piece)
        parts: list[bytes | None] = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get(parts[i] + parts[j]) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get(parts[i] + parts[k])) is not None:
                    heappush(heap, (r, i))
            if (k := before[i]) >= 0 and (r := ranks.get(parts[k] + parts[i])) is not None:
                heappush(heap, (r, k))
        return [ranks[p] for p in parts if p is not None]

    def short(self, data: bytes) -> list[int]:
        """``leaf``, remembered: parts of words come again far more often than words."""
        got = self.leaves[data]
        if got is None:
            got = self.leaf(data)
            if len(data) <= 2 * LEAF_BYTES:
                self.leaves.put(data, got)
        return got

    def fits(self, a: int, b: int) -> bool:
        """Whether tokens a, b next to each other are what their bytes encode to."""
        ok = self.fit[a, b]
        if ok is None:
            ok = self.fit.put((a, b), self.leaf(self.bytes_of[a] + self.bytes_of[b]) == [a, b])
        return ok

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of ``left`` followed by those of ``right``, both
        encodings themselves."""
        if not left or not right or self.fits(left[-1], right[0]):
            return left + right
        lo, hi, step = len(left) - 1, 1, 1
        while True:
            window = self.short(self.decode(left[lo:] + right[:hi]))
            left_ok = lo == 0 or self.fits(left[lo - 1], window[0])
            right_ok = hi == len(right) or self.fits(window[-1], right[hi])
            if left_ok and right_ok:
                return left[:lo] + window + right[hi:]
            if not left_ok:
                lo = max(0, lo - step)
            if not right_ok:
                hi = min(len(right), hi + step)
            step *= 2

    def piece(self, data: bytes) -> list[int]:
        """The encoding of one piece, by halves."""
        token = self.ranks.get(data)
        if token is not None:
            return [token]
        if len(data) <= LEAF_BYTES:
            return self.short(data)
        mid = len(data) // 2
        return self.join(self.piece(data[:mid]), self.piece(data[mid:]))

    def known(self, piece: str) -> tuple[tuple[int, ...], str]:
        got = self.cache[piece]
        if got is None:
            ids = tuple(self.piece(piece.encode("utf-8", "surrogatepass")))
            got = self.cache.put(piece, (ids, ",".join(map(str, ids))))
        return got

    def encode(self, text: str) -> tuple[list[int], str]:
        """Token ids of a text, and the same as decimals joined by commas."""
        found = [self.cache.get(p) or self.known(p) for p in self.split(text)]
        return [i for ids, _ in found for i in ids], ",".join([s for _, s in found])

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of a token sequence, concatenated up a tree."""
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])


_OUT = {"ids": ArrayType(IntegerType()), "n_tokens": LongType(), "ids_sha256": StringType(),
        "decoded": BinaryType(), "decoded_sha256": StringType()}
_ARROW = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64(), "ids_sha256": pa.string(),
          "decoded": pa.binary(), "decoded_sha256": pa.string()}


def _ranks_of(spark: SparkSession, ranks: dict[bytes, int] | str, max_tokens: int):
    ranks = read_ranks(ranks) if isinstance(ranks, str) else ranks
    if len(ranks) > max_tokens:
        raise ValueError(f"{len(ranks)} tokens; max_tokens allows {max_tokens}")
    return spark.sparkContext.broadcast(ranks)


def encode(docs: DataFrame, ranks: dict[bytes, int] | str, pattern: str, text_col: str = "text",
           keep: Sequence[str] = ("doc_id",), outputs: Sequence[str] = ("ids", "n_tokens"),
           max_tokens: int = 1_000_000) -> DataFrame:
    """Encode every whole text and decode it again; one row per input row with the ``keep``
    columns and the ``outputs``, any of: ids (array of int), n_tokens, ids_sha256 (hex of
    the decimal ids joined by commas), decoded (bytes), decoded_sha256.

    ``ranks`` is a rank file's path, read once by the driver, or its content; the
    vocabulary is broadcast (at most ``max_tokens`` entries). NULL and empty texts have
    no tokens. An output named like a ``keep`` column replaces it. Rows are independent,
    so repeated rows give repeated results and an empty table none.
    """
    spark = docs.sparkSession
    small_batches(spark)
    vocabulary = _ranks_of(spark, ranks, max_tokens)
    keep = [c for c in keep if c not in outputs]
    src = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = StructType([src.schema[c] for c in keep] + [StructField(o, _OUT[o]) for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(vocabulary.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                got: dict[str, list] = {o: [] for o in outputs}
                for text in part.column(len(keep)).to_pylist():
                    ids, decimals = pairs.encode(text or "")
                    if "decoded" in got or "decoded_sha256" in got:
                        data = pairs.decode(ids)
                    for o, column in got.items():
                        column.append(ids if o == "ids" else len(ids) if o == "n_tokens"
                                      else hashlib.sha256(decimals.encode()).hexdigest() if o == "ids_sha256"
                                      else data if o == "decoded" else hashlib.sha256(data).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    part.columns[:len(keep)] + [pa.array(got[o], _ARROW[o]) for o in outputs],
                    names=[*keep, *outputs])

    return src.mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks: dict[bytes, int] | str, pattern: str, ids_col: str = "ids",
           keep: Sequence[str] = ("doc_id",), max_tokens: int = 1_000_000) -> DataFrame:
    """The bytes that each row's token ids stand for, as column ``decoded``; NULL ids give
    no bytes, an id outside the vocabulary fails the job."""
    vocabulary = _ranks_of(tokens.sparkSession, ranks, max_tokens)
    keep = [c for c in keep if c != "decoded"]
    src = tokens.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids_col}`").alias("__ids"))
    schema = StructType([src.schema[c] for c in keep] + [StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = BytePairs(vocabulary.value, pattern)
        for batch in batches:
            data = [pairs.decode(ids or []) for ids in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns[:len(keep)] + [pa.array(data, pa.binary())],
                                             names=[*keep, "decoded"])

    return src.mapInArrow(run, schema)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                  public_tokenizers.PATTERN, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))
