"""Phrase collocations from count streams in prefix and suffix order.

Every language's phrases of one to five words are counted where they occur at least
``least`` times, order by order: a phrase can only be that frequent if the two phrases
one word shorter in it are. What is known to be frequent reaches the tasks as a bitmap of
fixed size, which lets some others pass too; those are counted exactly and dropped.

The counts then form two sorted streams. In prefix order a phrase stands right before its
extensions to the right, so one walk with the path of open phrases gives every phrase the
counts of all its first parts and its most frequent extension; in suffix order (words read
backwards) the same walk gives the counts of all last parts and of extensions to the left.
Streams are cut into ranges of keys; a phrase whose extensions reach into later ranges is
repeated at their beginning, so every range is walked on its own, and one hot first word
may fill many ranges.

Words are 63-bit hashes on the way; the words' table is checked for two words of one hash
(then another seed is taken), so phrases, being tuples of words, never mix.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import stored, table
from tabulon.llm.shingles import byte_slices, mix, word_hashes

#: Bytes of text worked on at once; occurrences counted together; rows of one range.
SLICE, TOGETHER, RANGE = 4 << 20, 1 << 20, 500_000
#: The bitmap of what is frequent has 2 ** BITS bits, in blocks of 2 ** BLOCK_BITS.
BITS, BLOCK_BITS = 26, 16
LONGEST = 5

_GAP = np.zeros(256, bool)  # space and tab stand between words
_GAP[[9, 32]] = True
_BREAK = np.zeros(256, bool)  # these stand between pieces
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_APART = _GAP | _BREAK
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _tag(lang: str, seed: int) -> int:
    data = np.frombuffer(lang.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint64)
    return int(reduce(lambda h, b: mix(h + b + _STEP), data, np.full(1, seed + 1, np.uint64))[0])


class Words:
    """The words of a slice of rows (lang, text): ``t`` their hashes with the language's,
    ``piece`` the number of the piece that each is in."""

    def __init__(self, part: pa.RecordBatch, seed: int):
        self.langs = part.column(0).to_pylist()
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in part.column(1).to_pylist()]
        self.data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        h, self.start, self.end = word_hashes(self.data, _APART)
        tags = {x: _tag(x, seed) for x in set(self.langs)}
        ends = np.cumsum([len(r) + 1 for r in raw])
        self.row = np.searchsorted(ends, self.start, "right")
        of_row = np.array([tags[x] for x in self.langs], np.uint64)
        self.t = np.maximum(mix(h + of_row[self.row]) >> np.uint64(1), np.uint64(1))
        self.piece = np.cumsum(_BREAK[self.data], dtype=np.int32)[self.start] if len(self.start) else np.zeros(0, np.int32)

    def text(self, i: int) -> str:
        return self.data[self.start[i]:self.end[i]].tobytes().lower().decode("utf-8", "surrogatepass")


def phrase_hash(columns: list[np.ndarray]) -> np.ndarray:
    return reduce(lambda h, c: mix(h + c * _STEP), columns[1:], mix(columns[0]))


def count_words(texts: DataFrame, seed: int) -> DataFrame:
    """From (lang, text): t, lang, word and f, how often it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, SLICE):
                w = Words(part, seed)
                t, first, n = np.unique(w.t, return_index=True, return_counts=True)
                langs = [w.langs[i] for i in w.row[first]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t.view(np.int64)), pa.array(langs, pa.string()),
                     pa.array([w.text(i) for i in first], pa.string()), pa.array(n.astype(np.int64))],
                    names=["t", "lang", "word", "n"])

    return (texts.mapInArrow(run, "t long, lang string, word string, n long")
            .groupBy("t", "lang", "word").agg(F.sum("n").alias("f")))


def clash(words: DataFrame) -> bool:
    """Whether two words, or the words of two languages, have one hash."""
    return not words.groupBy("t").count().where("count > 1").isEmpty()


def _names(n: int, letter: str = "c") -> list[str]:
    return [f"{letter}{i + 1}" for i in range(n)]


def bitmap(phrases: DataFrame, names: list[str], bits: int = BITS) -> np.ndarray:
    """A bit for every phrase's hash, as bytes 0 and 1 packed eight to a byte. However many
    phrases there are, 2 ** ``bits`` bits reach the driver."""
    block_bits = min(BLOCK_BITS, bits)

    def slots(batches):
        for batch in batches:
            h = phrase_hash([c.to_numpy(zero_copy_only=False).astype(np.uint64) for c in batch.columns])
            slot = np.unique(h >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot >> block_bits), pa.array(slot & ((1 << block_bits) - 1))],
                                             names=["block", "at"])

    def one(group: pa.Table) -> pa.Table:
        on = np.zeros(1 << block_bits, np.uint8)
        on[group["at"].to_numpy()] = 1
        return pa.table({"block": group["block"][:1], "bits": pa.array([np.packbits(on).tobytes()], pa.binary())})

    out = np.zeros(1 << bits >> 3, np.uint8)
    rows = (phrases.select(*names).mapInArrow(slots, "block long, at long").distinct()
            .groupBy("block").applyInArrow(one, "block long, bits binary"))
    step = (1 << block_bits) >> 3
    for r in rows.collect():
        out[r["block"] * step:(r["block"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return out


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[slot >> np.uint64(3)] >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8)) & 1 == 1


def _counted(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Equal tuples together, in the order of their hashes, with the sums of ``n``; also the
    hashes."""
    h = phrase_hash(columns)
    order = np.argsort(h)
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    if len(order) > 1:
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    sums = np.add.reduceat(n[order], first) if len(first) else n
    return [c[first] for c in columns], sums, h[order][first]


def count_phrases(texts: DataFrame, m: int, known, seed: int, least: int, buckets: int) -> DataFrame:
    """From (lang, text): c1..cm and f of the phrases of ``m`` words, within pieces, that
    occur ``least`` times or more, of those whose first and last m - 1 words are in the
    bitmap ``known`` (a broadcast).

    Tasks hand on sorted runs, a row of packed numbers for each of ``buckets`` ranges of
    hashes (a power of two); the runs of a range are merged together. Of a frequent
    phrase a run has one entry, however often it occurs.
    """
    names = _names(m)
    shift = np.uint64(65 - buckets.bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        kept: list[list[np.ndarray]] = []
        waiting = 0

        def hand_on():
            columns = [np.concatenate([k[i] for k in kept]) for i in range(m)]
            columns, n, h = _counted(columns, np.ones(len(columns[0]), np.uint64))
            bucket = (h >> shift).astype(np.int64) if buckets > 1 else np.zeros(len(h), np.int64)
            edge = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            runs = [np.stack([c[i:j] for c in [*columns, n]]).tobytes() for i, j in zip(edge[:-1], edge[1:])]
            for at in range(0, len(runs), 64):
                yield pa.RecordBatch.from_arrays([pa.array(bucket[edge[:-1]][at:at + 64]), pa.array(runs[at:at + 64], pa.binary())],
                                                 names=["bucket", "run"])

        for batch in batches:
            for part in byte_slices(batch, 1, SLICE):
                w = Words(part, seed)
                n = len(w.t) - m + 1
                if n < 1:
                    continue
                hit = _has(bits, phrase_hash([w.t[i:n + 1 + i] for i in range(m - 1)]))
                at = np.flatnonzero((w.piece[:n] == w.piece[m - 1:]) & hit[:-1] & hit[1:])
                kept.append([w.t[at + i] for i in range(m)])
                waiting += len(at)
                if waiting >= TOGETHER:
                    yield from hand_on()
                    kept, waiting = [], 0
        if waiting:
            yield from hand_on()

    def merged(group: pa.Table) -> pa.Table:
        runs = [np.frombuffer(r.as_buffer(), np.uint64).reshape(m + 1, -1) for r in group["run"]]
        columns, f, _ = _counted([np.concatenate([r[i] for r in runs]) for i in range(m)],
                                 np.concatenate([r[m] for r in runs]))
        enough = f >= least
        return pa.table({x: pa.array(c[enough].view(np.int64)) for x, c in zip([*names, "f"], [*columns, f])})

    fields = ", ".join(f"{c} long" for c in [*names, "f"])
    return texts.mapInArrow(run, "bucket long, run binary").groupBy("bucket").applyInArrow(merged, fields)


# ------------------------------------------------------------------ sorted streams

_PATH = [f"p{k}" for k in range(1, LONGEST)]


def _keys(columns: np.ndarray) -> np.ndarray:
    """Rows of words as byte strings in the order of the rows; a missing word (0) is least."""
    return np.ascontiguousarray(columns.astype(">u8")).view(f"S{8 * columns.shape[1]}").ravel()


def _backwards(c: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Every row's first m words in the opposite order."""
    i = m[:, None] - 1 - np.arange(c.shape[1])[None, :]
    return np.where(i >= 0, np.take_along_axis(c, np.maximum(i, 0), 1), 0)


def _matrix(batch: pa.RecordBatch, letter: str) -> np.ndarray:
    return np.stack([batch.column(x).to_numpy(zero_copy_only=False) for x in _names(LONGEST, letter)], axis=1)


def in_ranges(phrases: DataFrame, backwards: bool, rows: int) -> DataFrame:
    """The stream (part, d1..d5, m, f, n) in prefix order, or in suffix order with the words
    backwards, cut into ranges of about ``rows`` rows, each with the phrases before
    it that its own phrases begin with."""
    total = phrases.count()
    parts = max(1, -(-total // rows))
    names = _names(LONGEST)
    edges = np.zeros(0, f"S{8 * LONGEST}")
    if parts > 1:  # which rows are taken decides only where the ranges end
        every = max(1, total // (64 * parts))
        some = phrases.where(F.pmod(F.xxhash64(*names), F.lit(every)) == 0).select(*names, "m").toArrow()
        c = np.stack([some[x].to_numpy() for x in names], axis=1).reshape(-1, LONGEST)
        keys = np.unique(_keys(_backwards(c, some["m"].to_numpy()) if backwards else c))
        edges = np.unique(keys[[len(keys) * k // parts for k in range(1, parts)]]) if len(keys) else edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column("m").to_numpy()
            c = _matrix(batch, "c")
            d = _backwards(c, m) if backwards else c
            first = np.searchsorted(edges, _keys(d), "right")
            after = np.where(np.arange(LONGEST)[None, :] < m[:, None], d, np.iinfo(np.int64).max)
            times = np.searchsorted(edges, _keys(after), "right") - first + 1
            row = np.repeat(np.arange(len(m)), times)
            part = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int64)), *[pa.array(d[row, i]) for i in range(LONGEST)],
                 *[batch.column(x).take(pa.array(row)) for x in ("m", "f", "n")]],
                names=["part", *_names(LONGEST, "d"), "m", "f", "n"])

    fields = ", ".join(f"{x} long" for x in ["part", *_names(LONGEST, "d"), "m", "f", "n"])
    return (phrases.select(*names, "m", "f", "n").mapInArrow(run, fields).repartition(parts, "part")
            .sortWithinPartitions("part", *_names(LONGEST, "d")))


def walk(stream: DataFrame, backwards: bool) -> DataFrame:
    """One lockstep walk over all orders of a sorted stream. For every phrase, its words in
    reading order, m, f, n (of its first word as read in the stream), p1..p4: the
    counts of its first 1..4 words as read in the stream, and ext: the count of its most
    frequent extension in this range. A phrase comes once for each range that it is in, and
    again where a batch ends within its extensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*_names(LONGEST, "d"), "m", "f", "n"]
        path = np.zeros((0, len(names)), np.int64)
        for batch in batches:
            rows = np.stack([batch.column(x).fill_null(0).to_numpy(zero_copy_only=False) for x in names], axis=1)
            rows = np.concatenate([path, rows])
            m, f, n = rows[:, LONGEST], rows[:, LONGEST + 1], rows[:, LONGEST + 2]
            at = np.arange(len(rows))
            # the last phrase of k words up to a row is the one that the row begins with
            last = [np.maximum.accumulate(np.where(m == k, at, -1)) for k in range(1, LONGEST + 1)]
            counts = [np.where(m > k, f[last[k - 1]], 0) for k in range(1, LONGEST)]
            ext = np.zeros(len(rows), np.int64)
            for k in range(2, LONGEST + 1):
                own = np.flatnonzero(m == k)
                np.maximum.at(ext, last[k - 2][own], f[own])
            words = _backwards(rows[:, :LONGEST], m) if backwards else rows[:, :LONGEST]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in [*words.T.copy(), m, f, n[last[0]], *counts, ext]],
                names=[*_names(LONGEST), "m", "f", "n", *_PATH, "ext"])
            path = rows[[last[k - 1][-1] for k in range(1, int(m[-1]) + 1)]] if len(rows) else path

    fields = ", ".join(f"{x} long" for x in [*_names(LONGEST), "m", "f", "n", *_PATH, "ext"])
    return stream.mapInArrow(run, fields)


def merged_counts(phrases: DataFrame, rows: int = RANGE) -> DataFrame:
    """For every phrase: m, f, n, l1..l4 (counts of its first 1..4 words), r1..r4 (of its
    last), and ext, the count of its most frequent extension by a word on either side."""
    ahead = walk(in_ranges(phrases, False, rows), False)
    back = walk(in_ranges(phrases, True, rows), True)
    names = [*_names(LONGEST), "m"]
    none = F.lit(0).cast("long")
    both = ahead.select(*names, "f", "n", *[F.col(p).alias(f"l{p[1:]}") for p in _PATH],
                        *[none.alias(f"r{p[1:]}") for p in _PATH], "ext").unionByName(
        back.select(*names, "f", none.alias("n"), *[none.alias(f"l{p[1:]}") for p in _PATH],
                    *[F.col(p).alias(f"r{p[1:]}") for p in _PATH], "ext"))
    values = ["f", "n", *[f"l{p[1:]}" for p in _PATH], *[f"r{p[1:]}" for p in _PATH], "ext"]
    return both.groupBy(*names).agg(*[F.max(v).alias(v) for v in values])


# ------------------------------------------------------------------------ scores

def best_cut() -> Column:
    """The lowest-scoring cut as struct (score, k, l, r); ties to the smallest k. The
    products are decimals of 38 digits."""
    wide = "cast({} as decimal(38, 0))"
    cuts = []
    for k in range(1, LONGEST):
        right = f"element_at(array({', '.join(f'r{j}' for j in range(1, LONGEST))}), cast(m - {k} as int))"
        score = f"(1000 * {wide.format('f')} * {wide.format('n')}) div ({wide.format(f'l{k}')} * {wide.format(right)})"
        cuts.append(f"if(m > {k}, named_struct('score', {score}, 'k', {k}, 'l', l{k}, 'r', {right}), null)")
    return F.expr(f"array_min(array({', '.join(cuts)}))")


def count_all(texts: DataFrame, least: int, longest: int, seed: int = 0, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): the table t, lang, word, f, n of the frequent words, n being all
    words of the language; and c1..c5, m, f, n of all frequent phrases."""
    spark = texts.sparkSession
    while True:
        every = stored(count_words(texts, seed), "co_words")
        if not clash(every):
            break
        seed += 1
    totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
    # ranges that hold about TOGETHER different phrases at most
    buckets = 1 << ((totals.agg(F.sum("n")).first()[0] or 0) // TOGETHER).bit_length()
    words = stored(every.where(F.col("f") >= least).join(totals, "lang"), "co_frequent")
    orders = [words.select(F.col("t").alias("c1"), "f", "n")]
    last, names = orders[0], ["c1"]
    for m in range(2, longest + 1):
        known = spark.sparkContext.broadcast(bitmap(last, names, bits))
        last, names = stored(count_phrases(texts, m, known, seed, least, buckets), "co_phrases"), _names(m)
        if last.isEmpty():
            break
        orders.append(last)
    none = F.lit(0).cast("long")
    full = [o.select(*[F.col(c) if c in o.columns else none.alias(c) for c in _names(LONGEST)],
                     F.lit(k + 1).cast("long").alias("m"), "f", F.col("n") if k == 0 else F.lit(None).cast("long").alias("n"))
            for k, o in enumerate(orders)]
    return words, reduce(DataFrame.unionByName, full)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = LONGEST,
                 top: int = 2000, range_rows: int = RANGE, bits: int = BITS) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words that occur at least
    ``least`` times: lang, rank, phrase, a, l, r, n, score.

    A-Z count as a-z; words are parted by space and tab, pieces by ``.,;:!?`` and line ends.
    Phrases inside a longer one that is as frequent are left out. NULL text is empty, a NULL
    language is ``und`` (together with that one itself); repeated rows count each; equal
    scores go by a, then by the phrase in byte order. A table without such phrases gives
    no rows.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases of 2 to {LONGEST} words")
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    words, phrases = count_all(texts, least, longest, bits=bits)
    names = _names(LONGEST)
    alone = (merged_counts(stored(phrases, "co_counts"), range_rows).where("m > 1 and ext < f")
             .withColumn("cut", best_cut())
             .select(*names, "m", F.col("f").alias("a"), "cut.l", "cut.r", "n", "cut.score"))
    alone = stored(alone.join(words.select(F.col("t").alias("c1"), "lang"), "c1"), "co_alone")
    # texts are made for what can be among the first only: a language's last score and count
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    bar = (alone.select("lang", "score", "a").withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
           .groupBy("lang").agg(F.min(F.struct("score", "a")).alias("bar")))
    near = alone.join(bar, "lang").where(F.struct("score", "a") >= F.col("bar")).drop("bar")
    spelled = (near.select("*", F.posexplode(F.expr(f"slice(array({', '.join(names)}), 1, cast(m as int))")).alias("i", "t"))
               .join(words.select("t", "word"), "t")
               .groupBy("lang", *names, "a", "l", "r", "n", "score")
               .agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("spelled")))
    text = F.array_join(F.transform("spelled", lambda s: s["word"]), " ")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (spelled.withColumn("phrase", text).withColumn("rank", F.row_number().over(order).cast("long"))
            .where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with pieces as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws
  from (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) as piece from documents)),
total as (select lang, sum(len(ws))::bigint as n from pieces group by lang),
f as (
  select lang, m, phrase, count(*) as f
  from (select lang, m, unnest(list_transform(range(1, len(ws) - m + 2),
                                              lambda i : array_to_string(ws[i:i + m - 1], ' '))) as phrase
        from pieces, (values (1), (2), (3), (4), (5)) o(m) where len(ws) >= m)
  group by 1, 2, 3 having count(*) >= 100),
c as (select *, string_split(phrase, ' ') as ws from f where m > 1),
longer as (
  select lang, phrase, max(f) as ext
  from (select lang, f, array_to_string(ws[:-2], ' ') as phrase from c
        union all select lang, f, array_to_string(ws[2:], ' ') from c)
  group by 1, 2),
cuts as (
  select c.lang, c.phrase, c.f as a, l.f as l, r.f as r, n, k,
         ((1000::hugeint * c.f * n) // (l.f::hugeint * r.f))::bigint as score
  from c join total on total.lang = c.lang
  join (values (1), (2), (3), (4)) o(k) on k < c.m
  join f l on l.lang = c.lang and l.phrase = array_to_string(c.ws[:k], ' ')
  join f r on r.lang = c.lang and r.phrase = array_to_string(c.ws[k + 1:], ' ')
  left join longer on longer.lang = c.lang and longer.phrase = c.phrase
  where coalesce(longer.ext, 0) < c.f
  qualify row_number() over (partition by c.lang, c.phrase order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank,
       phrase, a, l, r, n, score
from cuts qualify rank <= 2000
"""
