"""Dedup of content-defined line chunks.

A window of two lines rolls over every text (blank lines between them belong to it, but are
no lines of their own), and its hash is made of the lines' hashes. Where a window's
hash comes again anywhere, its lines belong to a repeated chunk; a chunk begins and ends where
the windows stop repeating. So boundaries move with the content when lines are put in or
taken out, whatever stands around a passage, and a passage of two lines is found as surely
as a long one. Equal 64-bit hashes only nominate windows; their bytes decide. A repeated
chunk is removed everywhere but at its first occurrence.

DataFrame functions only: lines, hashes and windows are arrays within the row. Of the texts,
only the nominated windows are shuffled; the others and the rows themselves meet lists of
checked size in the tasks that read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import discard, packed, stored, table

#: Hashes, or windows to remove, that may be broadcast (a counted number of a few dozen
#: bytes each); beyond it the rows are shuffled to them.
BROADCAST = 1_000_000


def windows_of(text: str, bits: int = 64) -> Column:
    """The rolling windows of a text column, as array<struct<s, e, h>>: the first and last
    line, and the hash of the hashes of the lines from the one through the other (cut to
    ``bits`` for tests). ``transform(array(x), ...)[0]`` binds x to a name, so that it is
    computed once and not once per element."""
    cut = "" if bits == 64 else f" & {(1 << bits) - 1}L"
    return F.expr(f"""
      transform(array(split({text}, '\\n')), ls ->
        transform(array(transform(ls, l -> xxhash64(l))), hs ->
          transform(array(filter(sequence(0, size(ls) - 1), i -> get(ls, i) rlike '[^\\\\x20\\\\x09-\\\\x0D]')), at ->
            transform(if(size(at) > 1, slice(at, 1, size(at) - 1), cast(array() as array<int>)), (s, k) ->
              named_struct('s', s, 'e', get(at, k + 1),
                           'h', xxhash64(slice(hs, s + 1, get(at, k + 1) - s + 1)){cut})))[0])[0])[0]""")


def _fits(df: DataFrame, most: int) -> bool:
    return df.limit(most + 1).count() <= most


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64,
                broadcast: int = BROADCAST) -> DataFrame:
    """One row per input row: ``_row`` (the input row), text (what is left of it), n_lines,
    removed_lines.

    A line goes where it and a neighbour, blank lines between them left out of account,
    stood together before: in a document with a lesser id, or further up. So of every
    passage of two lines or more that occurs again no line is left but at its first
    occurrence, and the first occurrence of every single line stays. Blank lines within
    a passage go with it; they alone are none. Where a passage repeats itself with a
    line in common (a line three times over), that line stays.

    A NULL id comes first. Rows with the same id and text are one document: they get the
    same result and do not repeat each other. NULL text stays NULL, with no lines; an empty
    text is one empty line. An empty table gives no rows.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = packed(docs, id=F.col(f"`{id_col}`"), fp=F.xxhash64(text), text=text)
    cut = rows.where("text is not null").select("id", "fp", "text", F.explode(windows_of("text", bits)).alias("w"))
    windows = stored(cut.select("w.h", F.struct("id", "fp", "w.s", "w.e").alias("at")), "line_windows")
    often = stored(windows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "line_often")
    # the bytes of nominated windows: if the least and the greatest are equal, all are
    bytes_ = cut.select("w.h", F.struct("id", "fp", "w.s", "w.e").alias("at"), F.array_join(
        F.slice(F.split("text", "\n"), F.col("w.s") + 1, F.col("w.e") - F.col("w.s") + 1), "\n").alias("chunk"))
    if _fits(often, broadcast):
        same = bytes_.join(F.broadcast(often), "h", "left_semi")
    else:  # the nominated windows go to their rows, not the bytes of all windows to the hashes
        wanted = (windows.join(often, "h", "left_semi").groupBy(F.col("at.id").alias("l_id"), F.col("at.fp").alias("l_fp"))
                  .agg(F.collect_set(F.struct("at.s", "at.e", "h")).alias("ws")))
        here = F.col("id").eqNullSafe(F.col("l_id")) & (F.col("fp") == F.col("l_fp"))
        same = (rows.select("id", "fp", "text").join(wanted, here)
                .select("id", "fp", F.split("text", "\n").alias("ls"), F.explode("ws").alias("w"))
                .select("w.h", F.struct("id", "fp", "w.s", "w.e").alias("at"),
                        F.array_join(F.slice("ls", F.col("w.s") + 1, F.col("w.e") - F.col("w.s") + 1), "\n").alias("chunk")))
    first = stored(same.groupBy("h").agg(F.min("at").alias("first"), (F.min("chunk") != F.max("chunk")).alias("mixed")),
                   "line_first")
    pairs = windows.join(first.where("not mixed").select("h", "first"), "h").select("at", "first")
    mixed = first.where("mixed").select("h")
    if not mixed.isEmpty():  # different windows of one hash
        told = same.join(mixed, "h", "left_semi")
        of_text = told.groupBy("h", "chunk").agg(F.min("at").alias("first"))
        pairs = pairs.unionByName(told.join(of_text, ["h", "chunk"]).select("at", "first"))
    shared = F.expr("at.id <=> first.id and at.fp = first.fp and at.s = first.e")
    gone = (pairs.where(~F.col("at").eqNullSafe(F.col("first")))
            .select(F.col("at.id").alias("l_id"), F.col("at.fp").alias("l_fp"),
                    F.struct((F.col("at.s") + shared.cast("int")).alias("s"), F.col("at.e").alias("e")).alias("r"))
            .groupBy("l_id", "l_fp").agg(F.collect_set("r").alias("gone")))
    gone = stored(gone, "line_gone")
    discard(windows, often, first)
    small = (gone.agg(F.sum(F.size("gone"))).first()[0] or 0) <= broadcast
    # the row has its text, which is not shuffled a second time beside it
    joined = rows.drop("text").join(F.broadcast(gone) if small else gone,
                                    F.col("id").eqNullSafe(F.col("l_id")) & (F.col("fp") == F.col("l_fp")), "left")
    joined = joined.withColumn("text", F.col("_row")[text_col].cast("string"))
    parts = joined.withColumn("ls", F.when(F.col("gone").isNotNull(), F.split("text", "\n"))).withColumn("stay", F.expr(
        "array_except(sequence(0, size(ls) - 1), flatten(transform(gone, r -> sequence(r.s, r.e))))"))
    n_lines = F.coalesce(F.char_length("text") - F.char_length(F.translate("text", "\n", "")) + 1, F.lit(0))
    return parts.select(
        "_row", F.when(F.col("gone").isNull(), F.col("text")).otherwise(
            F.expr("array_join(transform(stay, i -> get(ls, i)), '\\n')")).alias("text"),
        n_lines.cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("ls") - F.size("stay")).cast("long").alias("removed_lines"))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (dedup_lines(table(spark, sf_dir, "documents"))
            .select("_row.doc_id", "n_lines", "removed_lines",
                    F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("text_sha256")))


OP1_SQL = r"""
with l as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as i
  from documents where text is not null),
p as (select doc_id, i as s, lead(i) over (partition by doc_id order by i) as e
      from l where regexp_matches(line, '[^\x20\x09-\x0D]')),
pairs as (select p.doc_id, s, e, string_agg(line, chr(10) order by i) as passage
          from p join l on l.doc_id = p.doc_id and i between s and e group by 1, 2, 3),
seen as (select *, row_number() over w as k, first_value(doc_id) over w as first_id, first_value(e) over w as first_e
         from pairs window w as (partition by passage order by doc_id, s)),
gone as (select distinct l.doc_id, i from seen join l
         on l.doc_id = seen.doc_id and i between s + (seen.doc_id = first_id and s = first_e)::int and e where k > 1),
r as (select l.doc_id, count(*) as n_lines, count(gone.i) as removed_lines,
             string_agg(line, chr(10) order by l.i) filter (gone.i is null) as text
      from l left join gone on gone.doc_id = l.doc_id and gone.i = l.i group by 1)
select doc_id, coalesce(n_lines, 0) as n_lines, coalesce(removed_lines, 0) as removed_lines,
       sha256(coalesce(r.text, '')) as text_sha256
from documents left join r using (doc_id)
"""
