"""Packing of token pieces into sequences, shortest pack first over the length histogram.

Documents are encoded and cut into pieces of at most ``size`` ids.  Only the
histogram of piece lengths (``size`` numbers) reaches the driver.  Lengths are
placed longest first, each into the patterns with the most room; a pattern is a
list of lengths with a count, so the work depends on ``size`` and not on the
corpus.  Pieces then find their sequence and offset by their rank among the
pieces of their length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import stage_table, texts_of

SIZE = 1024


def _byte_of() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabularies, by the public rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def load_encoder(path: str):
    """A function from text to ids, as ``tokenizers`` gives them for the byte-level BPE file ``path``.

    Where ids stand in merge order, as in the public files, the ranks are handed to
    tiktoken, which gives the same ids several times faster; else tokenizers is used.
    """
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
    merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    ids = [vocab[a + b] for a, b in merges]
    split = spec["pre_tokenizer"] or {}
    if ids == sorted(ids) and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and spec.get("normalizer") is None:
        import public_tokenizers
        import tiktoken

        byte = _byte_of()
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}
        own = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        return lambda text: own.encode(text, allowed_special="all") if any(s in text for s in special) else own.encode_ordinary(text)
    plain = Tokenizer.from_file(path)
    return lambda text: plain.encode(text, add_special_tokens=False).ids


_encoders: dict[str, object] = {}


def _cut(path: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoders.get(path) or _encoders.setdefault(path, load_encoder(path))
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "")
                ids.append(end_id)
                raw = np.array(ids, "<u4")
                for start in range(0, len(raw), size):
                    part = raw[start : start + size]
                    rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(raw)))
            columns = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths, how many sequences have them) that hold every piece of the histogram."""
    room: list[list[tuple[list[int], int]]] = [[] for _ in range(size + 1)]  # by free ids
    widest = -1
    for length in range(size, 0, -1):
        left = histogram.get(length, 0)
        placed = []
        while left:
            while widest >= length and not room[widest]:
                widest -= 1
            if widest >= length:
                pattern, count = room[widest].pop()
                some = min(left, count)
                if count > some:
                    room[widest].append((pattern, count - some))
                placed.append((widest - length, [*pattern, length], some))
            else:
                some = left
                placed.append((size - length, [length], some))
            left -= some
            # what was just filled may take another piece of this length
            for free, pattern, count in placed:
                room[free].append((pattern, count))
                widest = max(widest, free)
            placed.clear()
    return [p for free in room for p in free]


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = SIZE,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 10_000,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: the
    piece holds the document's ids start..start+length (``end_id`` closes each
    document) and stands at ``offset`` in the sequence; offsets of a sequence have
    no gap.  A null text is empty, one piece of one id.  An empty table gives an
    empty result; further columns are not looked at.  Rows that repeat an id, or
    have none, are packed each.
    """
    texts = texts_of(docs, id_col, text_col, without_id=True)
    pieces = stage_table(texts.mapInArrow(_cut(tokenizer, size, end_id), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, taken, sequence = [], dict.fromkeys(histogram, 0), 0
    for pattern, count in shortest_pack_first(histogram, size):
        offset = 0
        for length in pattern:
            slots.append((length, taken[length], taken[length] + count, sequence, offset))
            taken[length] += count
            offset += length
        sequence += count
    spark = docs.sparkSession
    slots = spark.createDataFrame(slots, "length long, lo long, hi long, base long, offset long")
    # ranks: within shares of a length first, as many as keep a share small, then over the shares
    shares = max(16, sum(histogram.values()) // bucket_rows)
    pieces = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "start"), F.lit(shares)))
    within = Window.partitionBy("length", "share").orderBy("doc_id", "start")
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "share").agg(F.count("*").alias("n"))
    counts = counts.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    ranked = pieces.withColumn("r", F.row_number().over(within)).join(counts, ["length", "share"])
    ranked = ranked.withColumn("rank", F.col("skip") + F.col("r") - 1)
    # Placing a length takes whole patterns, which leaves their number as it is, and at most once splits one or
    # opens one: two patterns more a length at most.  So the slots are bounded by ``size``, whatever the corpus.
    found = ranked.join(F.broadcast(slots), "length").where("rank >= lo and rank < hi")
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("rank") - F.col("lo")).alias("sequence_id"), "offset")
