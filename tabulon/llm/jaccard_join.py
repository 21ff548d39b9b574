"""Near-duplicate components by a set-similarity self-join with adaptive prefixes.

Shingles are put in one global order, rarest first. If two sets are similar enough to
share ``a`` shingles, their prefixes of ``size - a + l`` shingles share at least ``l``;
l = 1 is the usual prefix filter. Every document picks its own l by the estimated cost of
its candidates: where its prefix holds frequent shingles the prefix is lengthened, and
the more shared shingles are asked of its partners. A pair is a candidate if it shares
min(l, l') prefix shingles, which no similar pair can miss. Of the two, the smaller set needs
to share more of itself than the larger, so its prefix is the shorter: with it a document
waits for larger ones (``waits``), with the longer one it looks for smaller ones.

Equal sets are one class from the start. Of the candidates, those in the same block (the
candidates of the same document, each with the one it shares most prefix shingles with) are compared side by side in
one task; a block of very many documents or shingles is divided, its pivot going to each part. Documents that
still share much with a component not their own then meet all of it. Pairs that the
blocks have not brought together, and that are not in one component already, come from a
join of the postings; where very many documents wait under one shingle, they are dealt into
divisions and compared division against division, without a row for each pair. So no
candidate is lost.

Sets are sets of 64-bit hashes of shingles, and sizes and links are counted over them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabulon.llm.common import discard, small_batches, stored, table
from tabulon.llm.components import components
from tabulon.llm.shingles import byte_slices, shingle_sets

#: Frequent shingles whose counts are known to every task, 8 bytes and a count each: they
#: set the order and the prefixes' lengths, nothing else.
FREQUENT = 1 << 18
#: Documents, and shingles, of a block compared in one task.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 20
#: Waiting documents of one shingle that are paired by a join.
WAITING = 256
#: Shingles that a task counts, or looks up, together.
TOGETHER = 1 << 19
#: Ids that are broadcast to pick documents; above, a shuffle join picks them.
BROADCAST_IDS = 2_000_000
#: Prefix shingles' counts above which l is 2, 3, 4.
COSTS = (8, 64, 512)


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def set_digests(docs: DataFrame, words: int = 5) -> DataFrame:
    """From (id, text): rows (id, n, digest) with the size and a 128-bit digest of each
    document's set, and, with NULL id, (token, times) of shingles that a task has met more
    than once. One pass over the texts gives both."""

    def repeated(seen):
        tokens, times = np.unique(np.concatenate(seen), return_counts=True)
        tokens, times = tokens[times > 1].view(np.int64), times[times > 1].astype(np.int64)
        for at in range(0, len(tokens), 1 << 16):
            t = tokens[at:at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(t), pa.int64()), pa.nulls(len(t), pa.int64()),
                                              pa.nulls(len(t), pa.binary()), pa.array(t), pa.array(times[at:at + len(t)])],
                                             names=["id", "n", "digest", "token", "times"])

    def run(batches):
        seen, waiting = [], 0
        for batch in batches:
            for part in byte_slices(batch, 1):
                sets = shingle_sets(part.column(1).to_pylist(), words)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.nulls(len(sets), pa.int64()), pa.nulls(len(sets), pa.int64())],
                    names=["id", "n", "digest", "token", "times"])
                seen += sets
                waiting += sum(map(len, sets))
                if waiting >= 4 * TOGETHER:
                    yield from repeated(seen)
                    seen, waiting = [], 0
        if waiting:
            yield from repeated(seen)

    return docs.mapInArrow(run, "id long, n long, digest binary, token long, times long")


def frequent(counted: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of the highest counts, as many as ``most`` allows, sorted, with their
    counts: all of at least a count that leaves no more than that."""
    totals = stored(counted.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")), "jj_times")
    sizes = (totals.groupBy(F.floor(F.log2("times") * 4).alias("step")).agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("step")).collect())
    left, step = most, None
    for r in sizes:
        left -= r["n"]
        if left < 0:
            break
        step = r["step"]
    if step is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    got = totals.where(F.floor(F.log2("times") * 4) >= F.lit(step)).toArrow()
    tokens = got["token"].to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], got["times"].to_numpy()[order]


def in_order(tokens: np.ndarray, known: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A set in the global order, rare shingles (of no known count) first, then by count;
    ties by the hash. Also their counts, 0 for the rare."""
    count = np.zeros(len(tokens), np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
        hit = known[at] == tokens
        count[hit] = times[at[hit]]
    order = np.lexsort((tokens, count))
    return tokens[order], count[order]


def prefixes(docs: DataFrame, known, percent: int, words: int) -> DataFrame:
    """From (id, text): id, digest, n, need (the document's l), tokens: the prefix in order,
    and waits: how many of them are the prefix with which it waits for larger sets."""

    def run(batches):
        tokens_known, times = known.value
        for batch in batches:
            for part in byte_slices(batch, 1):
                n, need, tokens, waits, digest = [], [], [], [], []
                for s in shingle_sets(part.column(1).to_pylist(), words):
                    digest.append(_digest(s))
                    ordered, count = in_order(s, tokens_known, times)
                    least = -(-percent * len(s) // 100)  # a similar partner shares as many
                    of_larger = -(-2 * percent * len(s) // (100 + percent))  # a larger one as many
                    base = len(s) - least
                    cost = int(np.maximum(count[:base + 1], 1).sum())
                    l = min(max(1, least), 1 + sum(cost > c for c in COSTS))
                    n.append(len(s))
                    need.append(l)
                    tokens.append(ordered[:base + l].view(np.int64))
                    waits.append(len(s) - of_larger + l)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(digest, pa.binary()), pa.array(n, pa.int64()), pa.array(need, pa.int32()),
                     pa.array(tokens, pa.list_(pa.int64())), pa.array(waits, pa.int32())],
                    names=["id", "digest", "n", "need", "tokens", "waits"])

    return docs.mapInArrow(run, "id long, digest binary, n long, need int, tokens array<long>, waits int")


def similar_within(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is similar among a few documents: every two in reach of
    each other are connected by the result, pairs already connected are not compared.

    The sets lie one after the other in the order of their sizes, as numbers of the block's
    shingles; a document marks its own, and those that lie within reach of its size are
    counted by looking the marks up.
    """
    size = np.array([len(s) for s in sets], np.int64)
    order = np.lexsort((ids, size))
    size, ids = size[order], ids[order]
    flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)[1].astype(np.int32)
    edge = np.concatenate(([0], np.cumsum(size)))
    mark = np.zeros(int(flat.max(initial=-1)) + 1, bool)
    free = np.ones(len(ids), bool)
    links = []
    for root in np.argsort(ids, kind="stable"):
        if not free[root]:
            continue
        free[root] = False
        todo = [root]
        while todo:
            i = todo.pop()
            lo = np.searchsorted(size, -(-percent * size[i] // 100))
            hi = np.searchsorted(size, 100 * size[i] // percent, "right")
            mark[flat[edge[i]:edge[i + 1]]] = True
            at = lo
            while at < hi:  # a bounded number of shingles at once
                to = min(hi, max(at + 1, int(np.searchsorted(edge, edge[at] + TOGETHER, "right")) - 1))
                near = at + np.flatnonzero(free[at:to])
                if 4 * len(near) < to - at:  # few are left
                    shared = np.array([np.count_nonzero(mark[flat[edge[j]:edge[j + 1]]]) for j in near], np.int64)
                else:
                    shared = np.add.reduceat(mark[flat[edge[at]:edge[to]]], edge[at:to] - edge[at], dtype=np.int64)[near - at]
                found = near[100 * shared >= percent * (size[i] + size[near] - shared)]
                links += [(int(ids[j]), int(ids[root])) for j in found]
                free[found] = False
                todo += found.tolist()
                at = to
            mark[flat[edge[i]:edge[i + 1]]] = False
    return links


def compare_blocks(docs: DataFrame, members: DataFrame, percent: int, words: int) -> DataFrame:
    """Links (a, b) within blocks. ``members``: (id, block, part); every part of a block is
    compared on its own. Texts are picked by id, shingled where they lie, and only the
    sets are shuffled."""
    if members.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        members = F.broadcast(members)
    picked = docs.join(members, "id").select("id", "text", "block", "part")

    def shingled(batches):
        for batch in batches:
            for part in byte_slices(batch, 1):
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), part.column(3),
                     pa.array([s.tobytes() for s in shingle_sets(part.column(1).to_pylist(), words)], pa.binary())],
                    names=["id", "block", "part", "tokens"])

    def compared(group: pa.Table) -> pa.Table:
        rows = dict.fromkeys(zip(group["id"].to_pylist(), group["tokens"].to_pylist()))  # repeated rows once
        rows = [r for r in rows if r[1]]
        if not rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        ids = np.array([i for i, _ in rows], np.int64)
        sets = [np.frombuffer(t, np.uint64) for _, t in rows]
        links = similar_within(ids, sets, percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                         "b": pa.array([y for _, y in links], pa.int64())})

    return (picked.mapInArrow(shingled, "id long, block long, part int, tokens binary")
            .groupBy("block", "part").applyInArrow(compared, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75,
                    words: int = 5, block: int = BLOCK, most_frequent: int = FREQUENT, waiting: int = WAITING) -> DataFrame:
    """One row per input row: id, n_shingles, component (the least id reachable by links,
    itself included). Two documents link when 100 * shared >= percent * all of their sets.

    NULL text counts as empty; a document without words has no shingles and no links. A
    NULL id has no component. Rows with the same id and different texts are one node: they
    connect what each of them links with. An empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    seen = stored(set_digests(docs, words), "jj_sets")
    known = spark.sparkContext.broadcast(frequent(seen, most_frequent))
    sets = seen.where("digest is not null").select("id", "n", "digest")
    real = sets.where("n > 0 and id is not null")
    classes = stored(real.groupBy("digest", "n").agg(F.min("id").alias("rep")), "jj_classes")

    found = prefixes(docs.where("id is not null"), known, percent, words).where("n > 0")
    lists = (found.join(classes.select(F.col("rep").alias("id"), "digest"), ["id", "digest"])
             .dropDuplicates(["id", "digest"]))
    lists = lists.select("id", "n", "need", "waits", F.posexplode("tokens").alias("pos", "token")).select(
        "id", F.col("n").cast("int").alias("n"), "need", "token", (F.col("pos") < F.col("waits")).alias("waits"))
    lists = stored(lists, "jj_lists")
    # counted before any rows of a token come together: of a frequent one, a row from each task
    common = (lists.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.max(F.col("waits").cast("int")).alias("w"))
              .where("c > 1 and w > 0").select("token"))
    postings = stored(lists.join(common, "token"), "jj_postings")
    discard(lists)

    pivots = (postings.groupBy("token").agg(F.min(F.struct("id", "n", "need")).alias("p"))
              .select("token", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.need").alias("pivot_need")))
    near = f"100 * least(n, pivot_n) >= {percent} * greatest(n, pivot_n)"
    votes = (postings.join(pivots, "token").where("id != pivot").where(near)
             .groupBy("id", "n", "pivot", "need", "pivot_need").agg(F.count(F.lit(1)).alias("votes"))
             .where("votes >= least(need, pivot_need)"))
    own = votes.groupBy("id", "n").agg(F.max(F.struct("votes", (-F.col("pivot")).alias("p"))).alias("best"))
    own = stored(own.select("id", "n", (-F.col("best.p")).alias("block")), "jj_own")
    sizes = own.groupBy("block").agg(_parts(block).alias("parts"))
    own = own.drop("n")
    parted = own.join(sizes, "block")
    members = stored(parted.select("id", "block", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
                     .unionByName(sizes.select(F.col("block").alias("id"), "block",
                                               F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))),
                     "jj_members")
    links = stored(compare_blocks(docs, members, percent, words), "jj_blocks")
    # an id that comes with several sets connects them
    several = real.groupBy("id").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x != y").select("id")
    links = stored(links.unionByName(
        real.join(several, "id").join(classes, ["digest", "n"]).select(F.col("id").alias("a"), F.col("rep").alias("b"))),
        "jj_links")
    linked = components(links)

    # second blocks: a document with the component (not its own) that it shares most with
    home = own.join(members, ["id", "block"]).select("id", F.struct("block", "part").alias("home"))
    open_ = (postings.join(linked.select("id", "component"), "id", "left").join(home, "id", "left")
             .withColumn("component", F.coalesce("component", "id")))
    parts_of = open_.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"))
    most = (parts_of.groupBy("token").agg(F.max(F.struct("c", (-F.col("component")).alias("t"))).alias("best"),
                                          F.count(F.lit(1)).alias("several"))
            .where("several > 1").select("token", (-F.col("best.t")).alias("target")))
    open_ = stored(open_.join(stored(most, "jj_targets"), "token"), "jj_open")
    votes = (open_.where("component != target").groupBy("id", "n", "need", "target").agg(F.count(F.lit(1)).alias("votes"))
             .where("votes >= need"))
    voters = votes.groupBy("id", "n").agg(F.max(F.struct("votes", (-F.col("target")).alias("t"))).alias("best"))
    voters = stored(voters.select("id", "n", (-F.col("best.t")).alias("target")), "jj_voters")
    second, groups = _second_blocks(voters, linked, classes.groupBy(F.col("rep").alias("id")).agg(F.max("n").alias("n")), block)
    links2 = stored(compare_blocks(docs, second, percent, words), "jj_blocks2")
    after = linked if links2.isEmpty() else components(links.unionByName(links2))

    # what the blocks have not settled: candidates of different components
    open_before = open_
    open_ = (open_.drop("target").withColumnRenamed("component", "first")
             .join(after.select("id", "component"), "id", "left").join(groups, "id", "left")
             .withColumn("component", F.coalesce("component", "first")))
    mixed = (open_.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo != hi").select("token"))
    open_ = stored(open_.join(mixed, "token"), "jj_rest_open")
    discard(open_before)
    cols = ("id", "n", "need", "first", "component", "home", "target", "voters")
    crowds = stored(open_.groupBy("token").agg(F.count_if("waits").alias("w"), F.count(F.lit(1)).alias("c"))
                    .where(F.col("w") > waiting).select("token", "c"), "jj_crowds")
    single = open_.join(crowds, "token", "left_anti")
    x = single.where("waits").select("token", *[F.col(c).alias(f"{c}_a") for c in cols])
    y = single.select("token", *[F.col(c).alias(f"{c}_b") for c in cols])
    pairs = (x.join(y, "token")
             .where("(n_a < n_b or n_a = n_b and id_a < id_b) and component_a != component_b")
             .where("coalesce(home_a != home_b, true)")
             .where("coalesce(home_a.block != id_b, true) and coalesce(home_b.block != id_a, true)")
             .where("coalesce(target_a != first_b, true) and coalesce(target_b != first_a, true)")
             .where("coalesce(target_a != target_b, true) or coalesce(voters_a != voters_b, true)")
             .where(f"100 * n_a >= {percent} * n_b")
             .groupBy("id_a", "id_b").agg(F.count(F.lit(1)).alias("shared"), F.min("n_b").alias("n"),
                                          F.min(F.least("need_a", "need_b")).alias("need")))
    # shingles of a crowd are not counted here: a pair that has one in common is compared in
    # that crowd, and any other must share enough of these
    pairs = stored(pairs.where("shared >= need").select("id_a", "id_b", "n"), "jj_pairs")
    hubs = pairs.groupBy("id_a").agg(_parts(block).alias("parts"))
    rest = (pairs.join(hubs, "id_a").select(F.col("id_b").alias("id"), F.col("id_a").alias("block"),
                                            F.pmod(F.xxhash64("id_b"), F.col("parts")).cast("int").alias("part"))
            .unionByName(hubs.select(F.col("id_a").alias("id"), F.col("id_a").alias("block"),
                                     F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))))
    rest = rest.withColumn("of", F.lit("pair")).unionByName(_divisions(open_, crowds, block).withColumn("of", F.lit("crowd")))
    rest = rest.select("id", F.xxhash64("of", "block").alias("block"), "part")
    more = stored(compare_blocks(docs, stored(rest, "jj_rest"), percent, words), "jj_more")
    final = after if more.isEmpty() else components(links.unionByName(links2).unionByName(more))
    discard(postings, own, members, open_, voters, second, crowds, pairs, links, links2, more)
    return (sets.join(classes, ["digest", "n"], "left").withColumn("rep", F.coalesce("rep", "id"))
            .join(final.select(F.col("id").alias("rep"), "component"), "rep", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component")))


def _parts(block: int):
    """Parts of a block with so many documents and shingles (column n) at most, on average."""
    return F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")


def _divisions(open_: DataFrame, crowds: DataFrame, block: int) -> DataFrame:
    """(id, block, part): the documents of every crowded shingle in divisions, each division
    with each. Where all of a crowd have the same crowded shingle before this one, they
    have met there."""
    there = open_.join(crowds, "token").select("id", "n", "token").distinct()
    lists = there.groupBy("id", "n").agg(F.array_sort(F.collect_set("token")).alias("ts"))
    lists = lists.select("id", "n", F.posexplode("ts").alias("k", "token"), "ts").select(
        "id", "n", "token", F.expr("get(ts, k - 1)").alias("before"))
    lists = stored(lists, "jj_crowded")
    open_crowds = (lists.groupBy("token").agg(
        F.min("before").alias("lo"), F.max("before").alias("hi"), F.count("before").alias("with"),
        F.count(F.lit(1)).alias("c"), F.least(F.greatest(_parts(max(1, block // 2)), F.lit(1)), F.lit(30_000)).alias("parts"))
        .where("lo is null or lo != hi or with < c").select("token", "parts"))
    own = lists.join(stored(open_crowds, "jj_open_crowds"), "token").withColumn(
        "d", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    # division d meets itself and each other one once
    return own.select("id", F.col("token").alias("block"), F.explode(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda j: F.least("d", j) * F.col("parts") + F.greatest("d", j))).alias("part"))


def _second_blocks(voters: DataFrame, linked: DataFrame, sizes_of: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Blocks (id, block, part) that bring the voters of each target component together with
    all its documents; either side is divided where it has very many, and every division
    of one meets every division of the other. Also (id, target, voters): the division in
    which a voter met the others."""
    wanted = voters.select(F.col("target").alias("component")).distinct()
    whole = (linked.join(wanted, "component").select("id", "component")
             .union(wanted.select(F.col("component").alias("id"), "component")).distinct())
    whole = stored(whole.join(sizes_of, "id"), "jj_whole")
    sizes = (whole.groupBy("component").agg(_parts(block).alias("i"))
             .join(voters.groupBy(F.col("target").alias("component")).agg(_parts(block).alias("j")), "component"))
    sizes = stored(sizes, "jj_sizes")
    side = whole.join(sizes, "component").select(
        "id", F.col("component").alias("block"),
        F.explode(F.transform(F.sequence(F.lit(0), F.col("j") - 1),
                              lambda j: F.pmod(F.xxhash64("id"), F.col("i")).cast("int") * F.col("j") + j)).alias("part"))
    groups = (voters.join(sizes, voters["target"] == sizes["component"])
              .select("id", "target", F.pmod(F.xxhash64("id"), F.col("j")).cast("int").alias("voters"), "i", "j"))
    other = groups.select("id", F.col("target").alias("block"), F.explode(
        F.transform(F.sequence(F.lit(0), F.col("i") - 1), lambda i: i * F.col("j") + F.col("voters"))).alias("part"))
    return stored(side.unionByName(other), "jj_second"), groups.select("id", "target", "voters")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (near_duplicates(table(spark, sf_dir, "documents"))
            .select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id")))


OP7_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - 3), lambda i : array_to_string(ws[i:i + 4], ' '))) end) as sh
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.sh = b.sh and a.doc_id < b.doc_id
           group by 1, 2),
link as (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 75 * (x.n + y.n - k)),
pair as (select a, b from link union all select b, a from link),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select reach.doc_id, pair.b from reach join pair on reach.other = pair.a)
select reach.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(other) as component_id
from reach left join n on n.doc_id = reach.doc_id group by reach.doc_id
"""
