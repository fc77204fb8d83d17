"""Exact n-gram Jaccard join: size-aware, heavy-light, on distinct word shingles.

Two documents link when ``100 * |A and B| >= 75 * |A or B|``. Equal sets are one set from
the start (map-side dropped, then grouped by digest). Shingles are ordered rare first by
counts over the whole corpus, so two linked sets share at least ``l`` of the first
``n - ceil(0.75 n) + l`` shingles of each.

* light sets (below the boundary) enumerate the 2-subsets of that prefix (``l = 2``): two
  light sets that link meet in an equal subset;
* heavy sets scan inverted lists of single shingles (``l = 1``), which also hold the light
  sets large enough to reach a heavy one.

The boundary minimises subsets enumerated plus list entries scanned over the size histogram.

Groups are never expanded into all pairs. In each star round every list names its most
central set (the one with most of its entries shared, a pre-aggregated maximum); every
other set is verified against those of them that hold a fair part of its prefix (at most
``LIKELY``), and what links becomes one component: copies meet the text they come from. The
completing round takes the lists that still hold several components and drops the entries
too far down a set to be the first that a linked pair has in common; it verifies every
remaining pair across components that the bounds on sizes, positions and the number of
shared entries allow, so no link that could join two components is missed.

Before any text or pair of the completing round moves, parity bitmaps rule pairs out: bit ``h mod b`` of
a set's bitmap is the parity of its shingles there, so the set bits of two bitmaps' xor never exceed the
number of shingles that only one of the sets has, of which linked sets have at most ``(n + m) / 7``.

Sets are compared as 64-bit shingle hashes, equal sets found by a 64-bit digest.

Defined results: texts without words have an empty set and link with nothing; null ids
take part and never name a component unless it has no other id (then null); repeated rows
are copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.llm.common import digest16, discard, gram_hashes, mix64, signed, utf8_values, word_hashes, written
from meridian.llm.components import components

SHINGLE = 5
#: shingles whose order is decided by count; the rest is ordered by hash (bounds the broadcast)
ORDERED = 1 << 16
#: a shingle is reported by a task if it is in so large a share of the task's documents
TASK_SHARE = 0.001
#: documents whose sets a task holds at once
TASK_DOCS = 500
#: list entries of one shingle that one task scans; a longer list is dealt over several
SUBLIST = 50_000
#: boundaries tried by the cost model, and the cost of scanning against that of emitting an entry
BOUNDARIES = range(4, 65)
SCAN_COST = 0.5
#: star rounds; a star round tries a pair that shares this fraction (one over) of a prefix
ROUNDS, LIKELY = 1, 4
#: bits of a parity bitmap: the power of two from the set's size on, within these (larger sets are ruled out less often)
PARITY_BITS = 64, 4096
#: bits of the bitmap of sets whose texts are needed (fixed: 4 MiB)
NEEDED_BITS = 1 << 25


def shingles(text: bytes | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``k`` words are one shingle, none give none."""
    hashes = word_hashes((text or b"").lower().split())
    return np.unique(gram_hashes(hashes, min(k, len(hashes)))) if len(hashes) else hashes


def set_id(found: np.ndarray) -> int:
    return int.from_bytes(digest16(found.tobytes())[:8], "little", signed=True)


def parity(found: np.ndarray) -> list[int]:
    """The parity bitmap of a set as signed 64-bit words."""
    bits = min(max(1 << (max(len(found), 1) - 1).bit_length(), PARITY_BITS[0]), PARITY_BITS[1])
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def prefix(n: int, common: int) -> int:
    """Length of the prefixes in which sets with a link share ``common`` elements."""
    return min(n, n // 4 + common)


def _sets(docs: DataFrame) -> DataFrame:
    """Pass 1. Rows of documents (``doc_id, n, sid, key``) and of shingles frequent in a task (``h, c``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "key", "n", "sid", "bits", "h", "c"]
        seen_h, seen_c, n_docs, id_type = np.empty(0, np.uint64), np.empty(0, np.int64), 0, None
        for batch in (b.slice(i, TASK_DOCS) for b in batches for i in range(0, b.num_rows, TASK_DOCS)):
            id_type = batch.column(0).type
            sizes, sids, bits, held = [], [], [], []
            for text in utf8_values(batch.column(2)):
                found = shingles(text)
                sizes.append(len(found))
                bits.append(parity(found) if len(found) > 2 else None)
                sids.append(set_id(found) if len(found) else None)
                held.append(found)
            n_docs += len(held)
            h, c = np.unique(np.concatenate([seen_h, *held]), return_counts=True)
            c = c.astype(np.int64)
            c[np.searchsorted(h, seen_h)] += seen_c - 1
            keep = c >= max(2, TASK_SHARE * n_docs)  # what falls out here falls short of the share
            seen_h, seen_c = h[keep], c[keep]
            nulls = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(sids, pa.int64()),
                 pa.array(bits, pa.list_(pa.int64())), nulls, nulls], names=names)
        keep = seen_c >= max(3, TASK_SHARE * n_docs)
        if keep.any():
            m = int(keep.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, id_type), *(pa.nulls(m, pa.int64()) for _ in range(3)), pa.nulls(m, pa.list_(pa.int64())),
                 pa.array(signed(seen_h[keep])), pa.array(seen_c[keep])], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
            .mapInArrow(run, f"doc_id {kind}, key long, n long, sid long, bits array<long>, h long, c long"))


def boundary(sizes: dict[int, int], scan: float) -> int:
    """The light-heavy boundary of least cost for a histogram of set sizes below 64 and up."""
    def cost(x: int) -> float:
        light = sum(m * prefix(n, 2) * (prefix(n, 2) - 1) / 2 for n, m in sizes.items() if n < x)
        return light + sum(m * prefix(n, 1) * (1 + scan) for n, m in sizes.items() if 4 * n >= 3 * x)

    return min(BOUNDARIES, key=lambda x: (cost(x), x))


def _entries(docs: DataFrame, order, x: int) -> DataFrame:
    """Pass 2. List entries ``h, salt, sid, n, pos``: single shingles, and 2-subsets with ``pos < 0``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = order.value
        sent: dict[int, None] = {}
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            rows = 0
            for text in utf8_values(batch.column(0)):
                found = shingles(text)
                n = len(found)
                if n < 3:  # no different set can link
                    continue
                sid = set_id(found)
                if sid in sent:  # copies met by this task send their entries once
                    continue
                sent[sid] = None
                if len(sent) > 1 << 16:
                    sent.pop(next(iter(sent)))
                count = np.zeros(n, dtype=np.int64)
                if len(frequent):
                    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                    count = np.where(frequent[at] == found, counts[at], 0)
                rank = np.argsort(count, kind="stable")
                head, times = found[rank], count[rank]
                if n < x:
                    p = prefix(n, 2)
                    i, j = np.triu_indices(p, 1)
                    out[0].append(mix64(head[i] * np.uint64(3) + mix64(head[j])))
                    out[1].append(np.zeros(len(i), dtype=np.int64))
                    out[4].append(-1 - j.astype(np.int32))
                    out[2].append(np.full(len(i), sid, dtype=np.int64))
                    out[3].append(np.full(len(i), n, dtype=np.int32))
                    rows += len(i)
                if 4 * n >= 3 * x:
                    p = prefix(n, 1)
                    lists = -(-times[:p] // SUBLIST)
                    mine = mix64(head[:p] ^ np.uint64(sid & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(1)
                    out[0].append(head[:p])
                    out[1].append(np.where(lists > 1, 1 + mine.astype(np.int64) % np.maximum(lists, 1), 0))
                    out[4].append(np.arange(p, dtype=np.int32))
                    out[2].append(np.full(p, sid, dtype=np.int64))
                    out[3].append(np.full(p, n, dtype=np.int32))
                    rows += p
                if rows > 200_000:
                    yield batch_of(out)
                    out, rows = [[], [], [], [], []], 0
            if rows:
                yield batch_of(out)

    def batch_of(out: list[list[np.ndarray]]) -> pa.RecordBatch:
        h, salt, sid, n, pos = (np.concatenate(c) for c in out)
        return pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(salt.astype(np.int32)), pa.array(sid),
                                           pa.array(n), pa.array(pos)], names=["h", "salt", "sid", "n", "pos"])

    return docs.select("text").mapInArrow(run, "h long, salt int, sid long, n int, pos int")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of lists that hold several sets, each set once; of a dealt list (``salt > 0``) all.

    The input is sorted by ``h, salt, n, sid``; a list may span batches and is never held.
    """
    last = None  # the previous row and whether it was sent
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        if last is not None:
            cols = [np.concatenate([np.array([v], dtype=c.dtype), c]) for v, c in zip(last[0], cols, strict=True)]
        h, salt, sid = cols[:3]
        same_list = np.r_[False, (h[1:] == h[:-1]) & (salt[1:] == salt[:-1])]
        keep = ~(same_list & np.r_[False, sid[1:] == sid[:-1]])
        cols, same_list = [c[keep] for c in cols], same_list[keep]
        starts = np.flatnonzero(~same_list)
        group = np.cumsum(~same_list) - 1
        sizes = np.bincount(group)
        send = (sizes[group] > 1) | (cols[1] > 0)
        was_sent = last is not None and last[1]
        if was_sent:  # the list goes on: its first row here went with the batch before
            send |= group == 0
            send[0] = False
        done = sizes[-1] > 1 or (len(starts) == 1 and was_sent)
        if not done:  # a list of one so far: the next batch decides
            send[-1] = False
        last = tuple(c[-1] for c in cols), done
        if send.any():
            yield _entry_batch([c[send] for c in cols])
    if last is not None and not last[1] and last[0][1] > 0:
        yield _entry_batch([np.array([v]) for v in last[0]])


def _entry_batch(cols: list[np.ndarray]) -> pa.RecordBatch:
    h, _, sid, n, pos = cols
    return pa.RecordBatch.from_arrays([pa.array(h), pa.array(sid), pa.array(n.astype(np.int32)),
                                       pa.array(pos.astype(np.int32))], names=["h", "sid", "n", "pos"])


def _need(n: str, m: str) -> Column:
    """Least common shingles of linked sets of sizes ``n`` and ``m``."""
    return F.expr(f"(3L * ({n} + {m}) + 6) div 7")


def _alike(a: str, b: str, n: str, m: str) -> Column:
    """Whether the bitmaps of two sets (columns ``a`` and ``b``) let them be linked; the longer one is folded."""
    def half(x: str) -> str:
        return f"zip_with(slice({x}, 1, size({x}) div 2), slice({x}, size({x}) div 2 + 1, size({x}) div 2), (p, q) -> p ^ q)"

    def differing(x: str, y: str) -> str:
        return f"aggregate(zip_with({x}, {y}, (p, q) -> bit_count(p ^ q)), 0, (s, c) -> s + c)"

    return F.expr(f"""case when size({a}) = size({b}) then {differing(a, b)}
        when size({a}) = 2 * size({b}) then {differing(half(a), b)}
        when 2 * size({a}) = size({b}) then {differing(a, half(b))} else 0 end
        <= {n} + {m} - 2 * ((3L * ({n} + {m}) + 6) div 7)""")


def _possible(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """The pairs ``u, v`` that their bitmaps do not rule out."""
    for side in ("u", "v"):
        pairs = pairs.join(bits.select(F.col("sid").alias(side), F.col("n").alias(f"{side}_n"), F.col("bits").alias(f"{side}_bits")), side)
    return pairs.where(_alike("u_bits", "v_bits", "u_n", "v_n")).select("u", "v")


def _sharing_enough(pairs: DataFrame, lists: DataFrame, x: int) -> DataFrame:
    """The pairs whose prefixes share as many entries as a link needs.

    What is common beyond both prefixes lies in the rest of the set whose prefix ends first.
    """
    wanted = pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct()
    entries = lists.join(wanted, "sid", "left_semi").groupBy("sid").agg(
        F.max("n").alias("n"), F.collect_list(F.when(F.col("pos") >= 0, F.col("h"))).alias("one"),
        F.collect_list(F.when(F.col("pos") < 0, F.col("h"))).alias("two"))
    both = (pairs.join(entries.toDF("u", "n", "one_u", "two_u"), "u").join(entries.toDF("v", "m", "one_v", "two_v"), "v"))

    def least_common(extra: int) -> Column:
        return _need("n", "m") - F.greatest(*(F.expr(f"{y} - least({y}, {y} div 4 + {extra})") for y in ("n", "m")))

    single, double = least_common(1), least_common(2)
    enough = F.when(F.expr(f"4 * least(n, m) >= 3 * {x}"), F.size(F.array_intersect("one_u", "one_v")) >= single).otherwise(
        2 * F.size(F.array_intersect("two_u", "two_v")) >= double * (double - 1))
    return both.where(enough).select("u", "v")


def _texts_of(spark: SparkSession, docs: DataFrame, sets: DataFrame, sids: DataFrame) -> DataFrame:
    """``sid, text`` for the wanted sets; one document speaks for each set."""
    keys = written(spark, sets.where("n > 0").groupBy("sid").agg(F.min("key").alias("key"))
                   .join(sids, "sid", "left_semi"), "join-needed")
    cells = (keys.select(F.pmod("key", F.lit(NEEDED_BITS)).alias("bit"))
             .groupBy(F.shiftright("bit", 12).alias("page"))
             .agg(F.collect_set((F.col("bit") % 4096).cast("int")).alias("bits")))
    bitmap = np.zeros(NEEDED_BITS, dtype=bool)
    for page, bits in cells.toLocalIterator():
        bitmap[page * 4096 + np.array(bits, dtype=np.int64)] = True
    shared = spark.sparkContext.broadcast(np.packbits(bitmap, bitorder="little"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        sent: dict[int, None] = {}
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            at = keys % NEEDED_BITS
            chosen = []
            for i in np.flatnonzero((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).tolist():
                if keys[i] not in sent:  # copies met by this task go once
                    sent[keys[i]] = None
                    chosen.append(i)
            while len(sent) > 1 << 16:
                sent.pop(next(iter(sent)))
            if chosen:
                yield batch.take(pa.array(chosen))

    texts = docs.select(F.xxhash64("text").alias("key"), "text").where("text is not null").mapInArrow(
        run, "key long, text string")
    return (texts.join(keys, "key").dropDuplicates(["sid"])).select("sid", "text")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact check of pairs; a set met again in the next rows is not rebuilt."""
    known: dict[int, np.ndarray] = {}

    def built(sid: int, text: bytes) -> np.ndarray:
        if sid not in known:
            if len(known) >= 64:
                known.pop(next(iter(known)))
            known[sid] = shingles(text)
        return known[sid]

    for batch in batches:
        u, v = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        linked = []
        for a, b, ta, tb in zip(u, v, utf8_values(batch.column(2)), utf8_values(batch.column(3)), strict=True):
            one, two = built(a, ta), built(b, tb)
            common = len(np.intersect1d(one, two, assume_unique=True))
            linked.append(100 * common >= 75 * (len(one) + len(two) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())],
                                         names=["u", "v", "linked"])


def _checked(spark: SparkSession, docs: DataFrame, sets: DataFrame, pairs: DataFrame, label: str) -> DataFrame:
    """``u, v, linked`` for every candidate pair."""
    sids = pairs.select(F.explode(F.array("u", "v")).alias("sid")).distinct()
    texts = _texts_of(spark, docs, sets, sids)
    texts = written(spark, texts, f"{label}-texts")
    both = (pairs.join(texts.select(F.col("sid").alias("v"), F.col("text").alias("tv")), "v")
            .join(texts.select(F.col("sid").alias("u"), F.col("text").alias("tu")), "u")
            .select("u", "v", "tu", "tv"))
    found = written(spark, both.mapInArrow(_verify, "u long, v long, linked boolean"), label)
    discard(spark, texts)
    return found


def jaccard_join(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id``, the set's id ``sid`` and the text's xxhash64 ``key``."""
    out = written(spark, _sets(docs), "join-sets")
    sets = out.where("h is null").select("doc_id", "key", "n", "sid")
    bits = out.where("h is null and n > 2").groupBy("sid").agg(F.first("n").alias("n"), F.first("bits").alias("bits"))
    bits = written(spark, bits, "join-parity")
    frequent = (out.where("h is not null").groupBy("h").agg(F.sum("c").alias("c"))
                .orderBy(F.desc("c"), "h").limit(ORDERED).collect())
    hashes = np.array([r.h for r in frequent], dtype=np.int64).view(np.uint64)
    counts = np.array([r.c for r in frequent], dtype=np.int64)
    rank = np.argsort(hashes)
    order = spark.sparkContext.broadcast((hashes[rank], counts[rank]))

    total = sets.agg(F.sum("n")).first()[0] or 0
    scan = SCAN_COST * float((counts.astype(float) ** 2).sum()) / max(total, 1)
    sizes = {r.n: r["count"] for r in sets.where(f"n < {2 * BOUNDARIES[-1]}").groupBy("n").count().collect()}
    x = boundary(sizes, scan)

    lists = (_entries(docs, order, x).repartition("h", "salt").sortWithinPartitions("h", "salt", "n", "sid")
             .mapInArrow(_shared, "h long, sid long, n int, pos int"))
    lists = lists_of_sets = written(spark, lists, "join-lists")
    # a set all of whose entries are shared is likely what the others of its group were copied from
    central = lists.groupBy("sid").agg(F.expr("count(*) * 1000 div (max(n) div 4 + 1)").alias("w"))
    rest = lists.join(central, "sid").select("h", "sid", "n", "pos", F.col("sid").alias("comp"), "w")

    # star rounds: every set against the most central sets of other components that it meets in its lists
    checked = spark.createDataFrame([], "u long, v long, linked boolean")
    labels = spark.createDataFrame([], "node long, root long")
    for _ in range(ROUNDS):
        rest = written(spark, rest, "join-rest")
        leads = (rest.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.max(F.struct("w", "sid", "comp")).alias("lead"))
                 .where("lo <> hi").select("h", "lead"))
        mixed = written(spark, rest.join(leads, "h"), "join-mixed")
        discard(spark, rest)
        rest = mixed
        tries = (rest.where(F.col("comp") != F.col("lead.comp"))
                 .select("sid", "n", (F.col("pos") < 0).alias("light"), F.col("lead.sid").alias("other"))
                 .groupBy("sid", "other", "light").agg(F.count("*").alias("c"), F.max("n").alias("n"))
                 .where(F.expr(f"c * {LIKELY} >= case when light then (n div 4 + 2) * (n div 4 + 1) div 2 else n div 4 + 1 end"))
                 .select(F.least("sid", "other").alias("u"), F.greatest("sid", "other").alias("v")).distinct()
                 .join(checked, ["u", "v"], "left_anti"))
        tries = written(spark, tries, "join-tries")
        found = _checked(spark, docs, sets, written(spark, _possible(tries, bits), "join-possible"), "join-found")
        checked = written(spark, checked.union(found), "join-checked")
        if found.where("linked").limit(1).count():
            labels = components(spark, checked.where("linked").select("u", "v"))
        # who has led does not lead again
        led = rest.select(F.col("lead.sid").alias("led")).distinct()
        rest = (rest.join(labels, rest.sid == labels.node, "left").join(led, F.col("sid") == F.col("led"), "left")
                .select("h", "sid", "n", "pos", F.coalesce("root", "sid").alias("comp"),
                        F.when(F.col("led").isNull(), F.col("w")).otherwise(F.lit(-1)).cast("long").alias("w")))

    # completing round: pairs across components. The first common entry of a linked pair leaves enough
    # elements behind it in both sets; with the smallest partner of its list an entry must do so too
    rest = written(spark, rest.select("h", "sid", "n", "comp", F.expr("case when pos < 0 then n + 2 + pos else n - pos end").alias("left")),
                   "join-rest")
    if ROUNDS:
        discard(spark, mixed)
    for _ in range(2):
        lists = rest.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("m")).where("lo <> hi")
        near = rest.join(lists.select("h", F.col("m").alias("least")), "h").withColumn("least", F.greatest("least", F.expr("(3 * n + 3) div 4")))
        fewer = written(spark, near.where(F.col("left") >= _need("n", "least")).drop("least"), "join-rest")
        discard(spark, rest)
        rest = fewer
    wanted = bits.join(rest.select("sid").distinct(), "sid", "left_semi").select("sid", "bits")
    rest = written(spark, rest.join(wanted, "sid"), "join-bits")
    a, b = rest.alias("a"), rest.alias("b")
    pairs = (a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.comp") != F.col("b.comp"))
                    & ((F.col("a.n") < F.col("b.n")) | ((F.col("a.n") == F.col("b.n")) & (F.col("a.sid") < F.col("b.sid"))))
                    & F.expr("100L * a.n >= 75L * b.n") & (F.least("a.left", "b.left") >= _need("a.n", "b.n"))
                    & _alike("a.bits", "b.bits", "a.n", "b.n"))
             .select(F.least("a.sid", "b.sid").alias("u"), F.greatest("a.sid", "b.sid").alias("v")).distinct()
             .join(checked, ["u", "v"], "left_anti"))
    pairs = written(spark, _sharing_enough(written(spark, pairs, "join-near"), lists_of_sets, x), "join-pairs")
    found = _checked(spark, docs, sets, pairs, "join-found")
    if found.where("linked").limit(1).count():
        labels = components(spark, checked.union(found).where("linked").select("u", "v"))

    # component ids: the smallest doc_id, pre-aggregated per set, then looked up
    members = sets.where("n > 0").groupBy("sid").agg(F.min("doc_id").alias("low"))
    members = members.join(labels, members.sid == labels.node, "left").select(
        "sid", "low", F.coalesce("root", "sid").alias("comp"))
    members = written(spark, members, "join-members")
    lowest = members.groupBy("comp").agg(F.min("low").alias("component_id"))
    named_sets = written(spark, members.join(lowest, "comp").select(F.col("sid").alias("s"), "component_id"), "join-ids")
    return (sets.join(named_sets, sets.sid == named_sets.s, "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                    "sid", "key"))
