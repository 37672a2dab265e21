"""Near duplicates by DartMinHash signatures and banded joining.

A document is the weighted set of its word shingles; a shingle's weight is one more
than the whole part of the binary logarithm of its count, so that one line said a
hundred times does not drown the rest.  Over every unit of an element's weight, darts fall along the rank axis as
a unit-rate process drawn from hashes, so the darts below a rank in the region of
an element are as many as its area says, and equal regions get equal darts.  Each
dart names one of ``k`` coordinates, and a coordinate keeps its earliest dart;
ranks reach as far as fills all coordinates.  Two documents share a coordinate
with the probability of their weighted Jaccard similarity.  A text that repeats
shingles has a second signature, over the first unit of each element alone, for
the similarity by presence; for other texts both are the same.

Documents with equal weights are one node.  Bands of coordinates make buckets.
Every pair that shares a bucket is looked at once, inside a task, by its
signatures first and then by its exact similarity; what leaves the task are only
the links that join its members, not pairs.

A bucket of more than ``BLOCK`` members first holds each of them against its
leader, its smallest id, by their sets.  Jaccard distance is a metric: who is
within the link distance of the leader is joined to it, and cannot be linked to
one who is more than twice that distance away.  So members near the leader (a
large group of near copies) cost one row each, and only the rest meet in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .frames import stage_table, texts_of
from .textbuf import Texts, mix, split_chunks, words

BANDS, ROWS, SHINGLE = 30, 7, 5
#: Short digests of two signatures are held against each other before the sets are:
#: a pair is dropped only if they agree in so much less than the threshold (nearly 5 deviations).
SLACK = 0.13
#: Members of a block, on average; larger buckets have a leader.
BLOCK = 256
#: How a member stands to its leader: joined in both measures, far in both, or neither.
NEAR, BETWEEN, FAR = 0, 1, 2


def shingles(texts: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text index, element hash, unit number) of each unit of weight, sorted; a text of fewer words is one shingle."""
    start, end, text = words(texts)
    word = texts.hashes(start, end)
    n = np.bincount(text, minlength=len(texts))
    first = np.cumsum(n) - n
    left = first[text] + n[text] - np.arange(len(text))  # words from here to the text's end
    head = (left >= size) | ((np.arange(len(text)) == first[text]) & (n[text] < size))
    at = np.flatnonzero(head)
    h = np.zeros(len(at), np.uint64)
    for i in range(size):
        there = left[at] > i
        step = np.zeros(len(at), np.uint64)
        step[there] = word[at[there] + i]
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + step + np.uint64(i + 1))
    text = text[at]
    by = np.lexsort((h, text))
    text, h = text[by], h[by]
    opens = np.ones(len(h), bool)
    opens[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    run = np.flatnonzero(opens)
    nth = np.arange(len(h)) - np.repeat(run, np.diff(np.append(run, len(h)))) + 1
    unit = (nth & (nth - 1)) == 0  # the 1st, 2nd, 4th, 8th, ... time
    return text[unit], h[unit], nth[unit] - 1


def dart_signatures(text: np.ndarray, unit: np.ndarray, n_texts: int, k: int) -> np.ndarray:
    """(n_texts, k) uint64: the earliest dart of each coordinate; rows without units are 0.

    ``unit`` is the hash of one unit of weight of an element of text ``text``.
    """
    weight = np.bincount(text, minlength=n_texts)
    signature = np.zeros((n_texts, k), np.uint64)
    todo = weight > 0
    reach = np.zeros(n_texts)
    reach[todo] = k * (np.log(k) + 4.0) / weight[todo]
    while todo.any():
        best = np.full(n_texts * k, np.inf)
        dart_of = np.zeros(n_texts * k, np.uint64)
        mine = np.flatnonzero(todo[text])
        rank, seed, owner, throw = np.zeros(len(mine)), unit[mine], text[mine], 0
        while len(seed):
            throw += 1
            dart = mix(seed + np.uint64(throw * 0xD1342543DE82EF95 % (1 << 64)))
            gap = ((dart >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53
            rank = rank - np.log(gap)
            alive = rank < reach[owner]
            rank, seed, owner, dart = rank[alive], seed[alive], owner[alive], dart[alive]
            dart = mix(dart)
            cell = owner * k + ((dart >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(best, cell, rank)
            won = best[cell] == rank
            dart_of[cell[won]] = dart[won]
        full = np.isfinite(best).reshape(n_texts, k).all(axis=1) & todo
        signature[full] = dart_of.reshape(n_texts, k)[full]
        todo &= ~full
        reach[todo] *= 2.0
    return signature


def _banded(brief: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts, bands) bucket numbers of short signatures."""
    band = np.zeros((len(brief), bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        band = mix(band * np.uint64(0x9E3779B97F4A7C15) + brief[:, i::rows])
    return band


def _signed(bands: int, rows: int, shingle: int):
    k = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in split_chunks(batch.column(1), 1_000_000, rows=4_000):
                n = len(texts)
                text, h, copy = shingles(texts, shingle)
                unit = mix(h ^ (copy.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))
                signature = dart_signatures(text, unit, n, k)
                # 16 bits of each coordinate; bands are told from these too, so that both agree on what is common
                brief = (signature & np.uint64(0xFFFF)).astype(np.uint16)
                band = _banded(brief, bands, rows)
                # texts that repeat a shingle once more by presence; buckets are shared, so that they meet those that do not
                again = np.unique(text[copy > 0])
                repeats = np.zeros(n, bool)
                repeats[again] = True
                once = repeats[text] & (copy == 0)
                present = (dart_signatures(np.searchsorted(again, text[once]), unit[once], len(again), k) & np.uint64(0xFFFF)).astype(np.uint16)
                band_too = _banded(present, bands, rows)
                further = dict(zip(again.tolist(), range(len(again))))
                buckets = np.concatenate((band, np.zeros((n, bands), np.uint64)), axis=1)
                buckets[again, bands:] = band_too
                missing = np.zeros((n, 2 * bands), bool)
                missing[again, bands:] = band_too == band[again]
                briefs = [x.tobytes() + (present[further[i]].tobytes() if i in further else b"") for i, x in enumerate(brief)]
                # an element in 32 bits, the lowest says that it is a further copy
                short = (unit >> np.uint64(32)).astype(np.uint32) & np.uint32(0xFFFFFFFE) | (copy > 0).astype(np.uint32)
                by = np.lexsort((short, text))
                short = short[by]
                count = np.bincount(text, minlength=n)
                edge = np.concatenate(([0], np.cumsum(count)))
                sums = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
                some = np.flatnonzero(count)
                for total, salt in zip(sums, (1, 2)):
                    if len(some):
                        total[some] = np.add.reduceat(mix(unit + np.uint64(salt)), edge[some])
                empty = count == 0
                size = np.where(empty, 0, bands * (1 + repeats))
                there = np.arange(2 * bands) < size[:, None]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        *(pa.array(x.view(np.int64), mask=empty) for x in sums),
                        pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32)), pa.array(buckets[there].view(np.int64), mask=missing[there])),
                        pa.array(briefs, pa.binary()),
                        pa.array([short[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary()),
                    ],
                    ["doc_id", "f1", "f2", "bands", "brief", "units"],
                )

    return run


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    """The larger of the Jaccard similarities of two unit arrays, by weight and by presence."""
    best = 0.0
    for a, b in ((x, y), (x[x & 1 == 0], y[y & 1 == 0])):
        a, b = np.unique(a), np.unique(b)
        both = len(np.intersect1d(a, b, assume_unique=True))
        best = max(best, both / max(1, len(a) + len(b) - both))
    return best


def _led(threshold: float):
    """From (key, lead, doc_id, units, leads), leaders first in each key: (lead, doc_id, stands, linked)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_of, own = None, ()
        for batch in batches:
            out: list[tuple[int, int, int, bool]] = []
            for key, lead, doc, raw, leads in zip(*(c.to_pylist() for c in batch.columns)):
                units = np.frombuffer(raw, np.uint32)
                if leads:
                    head_of, own = key, [np.unique(units), np.unique(units[units & 1 == 0])]
                    continue
                if head_of != key:
                    raise ValueError(f"no leader for bucket group {key}")
                alike = []
                for a, b in zip(own, (units, units[units & 1 == 0])):
                    b = np.unique(b)
                    at = np.searchsorted(a, b)
                    both = int((a[np.minimum(at, len(a) - 1)] == b).sum()) if len(a) else 0
                    alike.append(both / max(1, len(a) + len(b) - both))
                stands = NEAR if min(alike) >= threshold else FAR if max(alike) < 2 * threshold - 1 - 1e-9 else BETWEEN
                out.append((lead, doc, stands, max(alike) >= threshold))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.bool_()))], ["lead", "doc_id", "stands", "linked"])

    return run


def _briefs(rows: list[tuple], k: int) -> np.ndarray:
    """(members, 2, k): short signatures by weight and by presence."""
    return np.frombuffer(b"".join(r[4] if len(r[4]) == 4 * k else r[4] * 2 for r in rows), np.uint16).reshape(len(rows), 2, k)


def _close_pairs(band: np.ndarray, block: np.ndarray, briefs: np.ndarray, bands: int, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, agreement) of the pairs of a group that this group has to settle.

    Those whose short signatures, by weight or by presence, agree in ``floor`` or
    more, whose first common band is the group's, and who stand in different blocks
    where the group has two.
    """
    apart = len(np.unique(block)) > 1
    kinds = [briefs[:, 0]] if (briefs[:, 0] == briefs[:, 1]).all() else [briefs[:, 0], briefs[:, 1]]
    parts = []
    for top in range(0, len(briefs) - 1, 64):
        same = [brief[top : top + 64, None, :] == brief[None, :, :] for brief in kinds]
        share = np.maximum.reduce([x.mean(axis=2) for x in same])
        i, j = np.nonzero((share >= floor) & (np.arange(len(briefs))[None, :] > np.arange(top, min(top + 64, len(briefs)))[:, None]))
        if apart:
            cross = block[top + i] != block[j]
            i, j = i[cross], j[cross]
        common = np.logical_or.reduce([x[i, j].reshape(len(i), bands, briefs.shape[2] // bands).all(axis=2) for x in same])
        mine = common.argmax(axis=1) == band[top + i]
        parts.append((top + i[mine], j[mine], share[i, j][mine]))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each value of the first column, which comes in runs."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][0] != row[0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _distinct(rows: list[tuple]) -> list[tuple]:
    return list({r[3]: r for r in rows}.values())


def _need_units(bands: int, k: int, floor: float):
    """The members (key, band, block, doc_id, brief) that stand in a pair to be settled."""
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []

        def batch():
            columns = [pa.array(x, t) for x, t in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["key", "band", "block", "doc_id", "brief"])

        for rows in _groups(batches):
            rows = _distinct(rows)
            if len(rows) < 2:
                continue
            i, j, _ = _close_pairs(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), _briefs(rows, k), bands, floor)
            out += [rows[m] for m in np.union1d(i, j)]
            if len(out) > 2_000:
                yield batch()
        if out:
            yield batch()

    return run


def _links(bands: int, k: int, floor: float, threshold: float):
    """Links among members (key, band, block, doc_id, brief, units), enough to join what is linked.

    Pairs are settled by exact similarity, the likeliest first; a pair that is
    joined already by other links of its group needs no test.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for rows in _groups(batches):
            rows = _distinct(rows)
            if len(rows) < 2:
                continue
            i, j, share = _close_pairs(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), _briefs(rows, k), bands, floor)
            units = [np.frombuffer(r[5], np.uint32) for r in rows]
            joined = list(range(len(rows)))

            def root(x: int) -> int:
                while joined[x] != x:
                    joined[x] = x = joined[joined[x]]
                return x

            for m in np.argsort(-share, kind="stable"):
                a, b = root(int(i[m])), root(int(j[m]))
                if a != b and similarity(units[i[m]], units[j[m]]) >= threshold:
                    joined[b] = a
                    out.append((rows[i[m]][3], rows[j[m]][3]))
            if len(out) > 5_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])
                out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["a", "b"])

    return run


def _blocks(n: Column, block: int) -> Column:
    return F.ceil(n / block).cast("int")


def _dealt(members: DataFrame, n: str, block: int) -> DataFrame:
    """Members (bucket, doc_id, ``n``) with ``own``, their block, once for each block ``other`` that theirs meets."""
    members = members.withColumn("blocks", _blocks(F.col(n), block))
    members = members.withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    return members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))


def _led_members(hot: DataFrame, near: DataFrame, threshold: float, block: int) -> tuple[DataFrame, DataFrame]:
    """For members (bucket, band, doc_id, n, lead) of large buckets: (links to leaders, groups (key, band, block, doc_id) of what is left to settle)."""
    # a leader leads in many bands; it meets a member once
    width = hot.groupBy("lead").agg(F.max("n").alias("n")).select("lead", _blocks(F.col("n"), block).alias("groups"))
    pairs = hot.where("doc_id != lead").select("lead", "doc_id").distinct().join(width, "lead")
    pairs = pairs.select(F.xxhash64("lead", F.pmod(F.xxhash64("doc_id"), F.col("groups"))).alias("key"), "lead", "doc_id", F.lit(False).alias("leads"))
    heads = width.withColumn("group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)))
    heads = heads.select(F.xxhash64("lead", F.col("group").cast("long")).alias("key"), "lead", F.col("lead").alias("doc_id"), F.lit(True).alias("leads"))
    both = pairs.unionByName(heads).join(near.select("doc_id", "units").hint("merge"), "doc_id")
    both = both.select("key", "lead", "doc_id", "units", "leads").repartition("key").sortWithinPartitions("key", F.desc("leads"))
    led = stage_table(both.mapInArrow(_led(threshold), "lead long, doc_id long, stands int, linked boolean"), "led")
    # in a bucket all that are not near meet each other, and those between meet the near ones too
    rest = hot.where("doc_id != lead").join(led.select("lead", "doc_id", "stands").hint("merge"), ["lead", "doc_id"])
    count = lambda test: F.sum(F.when(test, 1).otherwise(0))
    sizes = rest.groupBy("bucket").agg(
        count(F.col("stands") != NEAR).alias("n_rest"), count(F.col("stands") == BETWEEN).alias("n_between"), count(F.col("stands") == NEAR).alias("n_near")
    )
    rest = rest.select("bucket", "band", "doc_id", "stands").join(sizes.where("n_rest > 0").hint("shuffle_hash"), "bucket")
    rest = stage_table(rest.where((F.col("stands") != NEAR) | (F.col("n_between") > 0)), "rest")
    among = _dealt(rest.where(F.col("stands") != NEAR), "n_rest", block)
    among = among.select(F.xxhash64("bucket", F.lit("among"), F.least("own", "other"), F.greatest("own", "other")).alias("key"), "band", F.col("own").alias("block"), "doc_id")
    # a block of those between meets a block of near ones; each row goes once to each block of the other side
    across = rest.where((F.col("stands") != FAR) & (F.col("n_between") > 0) & (F.col("n_near") > 0))
    near = F.col("stands") == NEAR
    here, there = (F.when(near == side, F.col("n_near")).otherwise(F.col("n_between")) for side in (True, False))
    across = across.withColumn("own", F.pmod(F.xxhash64("doc_id"), _blocks(here, block)).cast("int"))
    across = across.withColumn("other", F.explode(F.sequence(F.lit(0), _blocks(there, block) - 1)))
    place = F.xxhash64("bucket", F.lit("across"), F.when(near, F.col("own")).otherwise(F.col("other")), F.when(near, F.col("other")).otherwise(F.col("own")))
    across = across.select(place.alias("key"), "band", near.cast("int").alias("block"), "doc_id")
    return led.where("linked").select(F.col("lead").alias("a"), F.col("doc_id").alias("b")), among.unionByName(across)


def near_duplicates(
    docs: DataFrame,
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
    shingle: int = SHINGLE,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its class), kept.

    A class is a connected component of the links; a link needs a Jaccard
    similarity of ``threshold`` or more, by weight or by presence of shingles.
    A pair at the threshold, by either measure, shares a band with probability 0.999 at the defaults.
    Null, empty and blank texts are classes of their own.  Texts of fewer than
    ``shingle`` words are one shingle, so only equal ones meet.  An empty table
    gives an empty result; further columns are not looked at.  Rows without an id
    are left out.
    """
    texts = texts_of(docs, id_col, text_col)
    signed = stage_table(
        texts.mapInArrow(_signed(bands, rows, shingle), "doc_id long, f1 long, f2 long, bands array<long>, brief binary, units binary"),
        "signed",
    )
    nodes = stage_table(signed.where("f1 is not null").groupBy("f1", "f2").agg(F.min("doc_id").alias("node")), "nodes")
    # a node stands for equal documents; it is one of them
    # (sort-merge joins throughout: a side that is small here is not so on a large corpus)
    own = signed.join(nodes.select(F.col("node").alias("doc_id")).hint("merge"), "doc_id", "left_semi")
    placed = own.select("doc_id", F.posexplode("bands").alias("place", "bucket")).where("bucket is not null")
    placed = placed.select("doc_id", (F.col("place") % bands).alias("band"), "bucket")
    # how many share a bucket, and the smallest of them: counted before and after the shuffle, so that no bucket is too large
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("doc_id").alias("lead")).where("n > 1")
    members = stage_table(placed.join(sizes.hint("shuffle_hash"), "bucket"), "members")
    # sets and signatures of those who have someone to meet; all others stay behind
    near = members.select("doc_id").distinct().hint("shuffle_hash")
    near = stage_table(signed.select("doc_id", "brief", "units").join(near, "doc_id", "left_semi"), "near")
    small, hot = members.where(F.col("n") <= block), members.where(F.col("n") > block)
    groups, led = small.select(F.col("bucket").alias("key"), "band", F.lit(0).alias("block"), "doc_id"), None
    if not hot.isEmpty():
        led, left = _led_members(hot, near, threshold, block)
        groups = groups.unionByName(left)
    floor = threshold - SLACK
    close = stage_table(
        groups.join(near.select("doc_id", "brief").hint("merge"), "doc_id").select("key", "band", "block", "doc_id", "brief").repartition("key").sortWithinPartitions("key")
        .mapInArrow(_need_units(bands, bands * rows, floor), "key long, band int, block int, doc_id long, brief binary"),
        "close",
    )
    links = stage_table(
        close.join(near.select("doc_id", "units").hint("merge"), "doc_id").select("key", "band", "block", "doc_id", "brief", "units")
        .repartition("key").sortWithinPartitions("key").mapInArrow(_links(bands, bands * rows, floor, threshold), "a long, b long"),
        "links",
    )
    if led is not None:
        links = links.unionByName(led)
    label = None if links.isEmpty() else components(links)
    of_node = nodes.select("f1", "f2", "node")
    classed = signed.select("doc_id", "f1", "f2").join(of_node, ["f1", "f2"], "left")
    if label is not None:
        of_node = stage_table(of_node.join(label.select("node", "component"), "node", "left").select("f1", "f2", F.coalesce("component", "node").alias("node")), "classes")
        classed = signed.select("doc_id", "f1", "f2").join(of_node, ["f1", "f2"], "left")
    return classed.select("doc_id", F.coalesce("node", "doc_id").alias("class_id")).withColumn("kept", F.col("doc_id") == F.col("class_id"))
