"""Best-fit packing of documents into fixed-length token sequences, certified by lower bounds.

Documents become pieces of at most `capacity` tokens. Pieces are dealt into parts by a hash, and each part is packed by
best-fit decreasing. Dual feasible functions give a lower bound of each part's sequences; a part that meets it is
certified. Full sequences are final. The pieces of all other sequences, those of parts with a gap and the last, partly
filled ones of certified parts, are exchanged: pooled, dealt into fewer parts and packed again, until one part is left
or `rounds` are over. No part has more than about `part_pieces` pieces, whatever the size of the corpus, and token ids
are never shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm import byte_bpe
from monthmill.llm.common import staged

PIECE = "doc_id string, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int | None = 2, with_ids: bool = False) -> DataFrame:
    """The token pieces of each text: doc_id, piece, start, length, ids_crc32 and, if asked for, the ids.

    Only a document of more than `capacity` tokens is cut; its first piece is the short one. NULL texts are empty, and an
    empty text has the end id alone. The tokenizer's added tokens are found in the texts. Repeated rows give repeated pieces; columns beside doc_id and text are ignored.
    """
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = byte_bpe.load(tokenizer, added=True).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = encode(text or "") + end
                n = len(ids) // 4
                a, b = 0, n % capacity or min(n, capacity)
                for piece in range(max(1, -(-n // capacity))):
                    part = ids[4 * a : 4 * b]
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(part), *([np.frombuffer(part, "<u4").tolist()] if with_ids else [])))
                    a, b = b, b + capacity
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])])
            yield out

    # Ids travel as text, since pandas would make floats of a column of longs with a NULL.
    rows = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return _ids_as_longs(rows.mapInPandas(cut, PIECE + (", ids array<long>" if with_ids else "")))


def _ids_as_longs(df: DataFrame) -> DataFrame:
    return df.withColumn("doc_id", F.col("doc_id").cast("long"))


@lru_cache(maxsize=8)
def _dual_feasible(capacity: int) -> np.ndarray:
    """One row per dual feasible function, over the lengths 0 to `capacity`; integers in units of each row's last value.

    A threshold t counts lengths above capacity - t as whole sequences and those below t as nothing. The rounding
    functions of order k map x to floor((k + 1) x) / k, except where (k + 1) x is whole.
    """
    x = np.arange(capacity + 1)
    rows = [np.where(x > capacity - t, capacity, np.where(x < t, 0, x)) * 1.0 / capacity for t in range(1, capacity // 2 + 1)]
    for k in range(1, 21):
        scaled = (k + 1) * x
        rows.append(np.where(scaled % capacity == 0, x / capacity, scaled // capacity / k))
    return np.array(rows)


def sequences_at_least(lengths: np.ndarray, capacity: int) -> int:
    """A lower bound of the sequences that pieces of these lengths need."""
    counts = np.bincount(lengths, minlength=capacity + 1)
    weight = max(float((_dual_feasible(capacity) @ counts).max(initial=0)), float(counts @ np.arange(capacity + 1)) / capacity)
    return int(np.ceil(weight - 1e-6))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lengths in decreasing order: each one's sequence, its place there, and the room each sequence has left.

    Open sequences stand in one stack per room left; a bit set of the rooms in use finds the tightest that fits.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    in_use, room = 0, []
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for n, length in enumerate(lengths.tolist()):
        fitting = in_use >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            at = stacks[left].pop()
            if not stacks[left]:
                in_use &= ~(1 << left)
        else:
            left, at = capacity, len(room)
            room.append(capacity)
        sequence[n], offset[n] = at, capacity - left
        left -= length
        room[at] = left
        if left:
            stacks[left].append(at)
            in_use |= 1 << left
    return sequence, offset, np.array(room, np.int64)


def _pack_part(capacity: int, number: int, last: bool):
    """Pack one part; pieces of sequences that are not full stay open, except in the last round."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True], ignore_index=True)
        lengths = part["length"].to_numpy()
        sequence, offset, room = best_fit_decreasing(lengths, capacity)
        part["certified"] = len(room) == sequences_at_least(lengths, capacity)
        part["open"] = False if last else room[sequence] > 0
        part["sequence_id"] = (number << 56) + (part["part"].to_numpy() << 24) + sequence
        part["offset"] = offset
        return part

    return pack


def pack(items: DataFrame, capacity: int = 1024, part_pieces: int = 4096, rounds: int = 4) -> DataFrame:
    """`items` (the columns of `pieces`) with sequence_id, offset, and certified: whether its part met its lower bound.

    Every piece comes back once. Equal rows are packed one by one. An empty table gives an empty table.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"{PIECE}, part long, certified boolean, open boolean, sequence_id long, offset long"
    open_, done = staged(items.select(F.col("doc_id").cast("string"), *names[1:]), "pieces"), []
    for number in range(rounds):
        parts = -(-open_.count() // part_pieces)
        last = number == rounds - 1 or parts <= 1
        dealt = open_.withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(number)), F.lit(max(parts, 1))))
        packed = staged(dealt.groupBy("part").applyInPandas(_pack_part(capacity, number, last), schema), "packed")
        done.append(packed.where(~F.col("open")))
        open_ = packed.where("open").select(*names)
        if last:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return _ids_as_longs(out).select(*names, "sequence_id", "offset", "certified")
