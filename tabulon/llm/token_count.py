"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol per byte, linked to its neighbours, and the adjacent pairs that
can merge wait in a heap. The pair of lowest rank, the leftmost of equals, is merged again
and again; a merge takes one symbol away, so the count is the number of first symbols less
the number of merges. No token ids are made.

The vocabulary is a tokenizer file of the ``tokenizers`` library: BPE over byte-level
symbols whose words end in a suffix, after NFC and lower-casing, where a regular expression
finds the words and everything between them is dropped. Strings of its added tokens inside a
text are one token each, as by the library's default.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabulon.llm.common import table

#: Distinct words remembered by a task; when full, the older half goes. Longer words are
#: counted anew each time.
CACHED_WORDS, CACHED_CHARS = 200_000, 64
ROWS_AT_ONCE = 200
#: Tokens over which the query reports a text.
LIMIT = 2048

# What a file of this kind says of its text handling.
_NORMALIZERS = [("NFC", None), ("Replace", r"\s+"), ("Lowercase", None)]
_PRE_TOKENIZERS = ["Split", "ByteLevel"]


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the others by the code points from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def read_spec(path: str) -> dict:
    """What counting needs of a tokenizer file: the words' pattern, the added strings, the
    symbol of each byte inside a word and at its end, and for every pair of symbols that
    merges its rank and, by rank, the merged symbol. A file that asks for anything
    else is refused."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    steps = [(n["type"], n.get("pattern", {}).get("Regex")) for n in (spec["normalizer"] or {}).get("normalizers", [])]
    pre = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback",
                                           "fuse_unk", "ignore_merges"))
    if (model["type"] != "BPE" or not plain or not model.get("end_of_word_suffix") or steps != _NORMALIZERS
            or [p["type"] for p in pre] != _PRE_TOKENIZERS or pre[0]["behavior"] != "Removed" or not pre[0]["invert"]
            or pre[1]["add_prefix_space"] or pre[1]["use_regex"]
            or any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"])):
        raise ValueError(f"{path}: not a byte-level BPE tokenizer with word ends")
    vocab, end = model["vocab"], model["end_of_word_suffix"]
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    chars = byte_symbols()
    return {"pattern": pre[0]["pattern"]["Regex"], "added": [a["content"] for a in spec["added_tokens"]],
            "inner": [vocab[c] for c in chars], "last": [vocab[c + end] for c in chars],
            "rank": {vocab[a] << 20 | vocab[b]: k for k, (a, b) in enumerate(pairs)},
            "merged": [vocab[a + b] for a, b in pairs]}


class TokenCounter(dict):
    """Token count of every word met, filled as they come."""

    def __init__(self, spec: dict, cached: int = CACHED_WORDS):
        super().__init__()
        self.inner, self.last, self.rank, self.merged = spec["inner"], spec["last"], spec["rank"], spec["merged"]
        self.cached = cached
        self.words = regex.compile(spec["pattern"]).findall
        # of an ASCII text after lower-casing, letters are a-z and digits 0-9
        self.ascii_words = re.compile(spec["pattern"].replace(r"[\p{L}]", "[a-z]").replace(r"[\p{N}]", "[0-9]")
                                      .replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9"), re.A).findall
        added = sorted(spec["added"], key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))).split if added else None
        self.mark = added[0][:2] if len({a[:2] for a in added}) == 1 else ""

    def __missing__(self, word: str) -> int:
        n = self.tokens_of(word.encode("utf-8", "surrogatepass"))
        if len(word) <= CACHED_CHARS:
            if len(self) >= self.cached:
                for old in list(islice(self, self.cached // 2 + 1)):
                    del self[old]
            self[word] = n
        return n

    def tokens_of(self, data: bytes) -> int:
        """First symbols less merges."""
        rank, merged, n = self.rank.get, self.merged, len(data)
        inner = self.inner
        symbol = [inner[b] for b in data]
        symbol[-1] = self.last[data[-1]]
        heap = [r << 32 | i for i, (a, b) in enumerate(zip(symbol, symbol[1:])) if (r := rank(a << 20 | b)) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            top = heappop(heap)
            r, i = top >> 32, top & 0xFFFFFFFF
            a, j = symbol[i], after[i]
            if a < 0 or j >= n or rank(a << 20 | symbol[j]) != r:
                continue  # one of the two has merged since
            a = symbol[i] = merged[r]
            symbol[j] = -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (x := rank(a << 20 | symbol[k])) is not None:
                    heappush(heap, x << 32 | i)
            k = before[i]
            if k >= 0 and (x := rank(symbol[k] << 20 | a)) is not None:
                heappush(heap, x << 32 | k)
        return left

    def plain(self, text: str) -> int:
        """Tokens of a text without added strings."""
        if text.isascii():
            return sum(map(self.__getitem__, self.ascii_words(text.lower())))
        # letter by letter: a capital sigma is the same small one everywhere
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return sum(map(self.__getitem__, self.words(text)))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or self.mark not in text:
            return self.plain(text)
        parts = self.added(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


def count_tokens(docs: DataFrame, path: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                 max_merges: int = 1_000_000) -> DataFrame:
    """One row per input row: the ``keep`` columns, n_bytes (UTF-8) and n_tokens of the whole
    text, without begin, end or padding.

    ``path`` is read once, by the driver; its merges are broadcast (at most ``max_merges``).
    NULL and empty texts have no bytes and no tokens. Texts
    are as Python's Unicode tables have them: 14 code points that were assigned later count
    otherwise in the library. A ``keep`` column named like a result
    is replaced by it. Rows are independent: repeated rows repeat, an empty table gives none.
    """
    spec = read_spec(path)
    if len(spec["rank"]) > max_merges:
        raise ValueError(f"{len(spec['rank'])} merges; max_merges allows {max_merges}")
    shared = docs.sparkSession.sparkContext.broadcast(spec)
    keep = [c for c in keep if c not in ("n_bytes", "n_tokens")]
    text = F.col(f"`{text_col}`").cast("string")
    src = docs.select(*[F.col(f"`{c}`") for c in keep],
                      F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("__text"))
    schema = StructType([src.schema[c] for c in keep] + [StructField("n_bytes", LongType()),
                                                         StructField("n_tokens", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, k = TokenCounter(shared.value), len(keep)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                counts = [counter.count(t) for t in part.column(k + 1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:k + 1], pa.array(counts, pa.int64())],
                                                 names=[*keep, "n_bytes", "n_tokens"])

    return src.mapInArrow(run, schema)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return (count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
            .withColumn("over_limit", F.col("n_tokens") > LIMIT))
