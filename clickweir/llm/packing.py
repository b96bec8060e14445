"""Cost-balanced packing of documents into training sequences.

Every task tokenizes the documents it reads and packs them in groups of about a million
tokens; nothing is shuffled. Within a group the number of sequences follows from the tokens:
as many full ones as fit, and one for each power of two in what is left, so that no
sequence needs padding. Documents, cut to at most one sequence, are assigned in descending
order of their estimated cost, linear plus quadratic in the length, to the sequence of the
lowest cost so far that still has room; what does not fit goes on to the next one.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from clickweir.llm.byte_bpe import shared
from clickweir.llm.workers import releasing

SEQUENCE = 1024          # tokens of a sequence; a power of two
GROUP_TOKENS = 1 << 20   # tokens that a task packs together
LINEAR, QUADRATIC = 1.0, 1.0 / 2048   # cost of a token, and of a pair of tokens that attend

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
          "sequence_id bigint, offset bigint")

class Encoder:
    """Token ids as little-endian 32-bit bytes. `cached_words` has no effect: nothing of the texts is kept."""

    def __init__(self, tokenizer_json: str, cached_words: int = 0):
        self.model = shared(tokenizer_json)

    def __call__(self, texts: list[str]) -> list[bytes]:
        return [self.model.ids(t).tobytes() for t in texts]


def capacities(tokens: int, sequence: int = SEQUENCE) -> list[int]:
    """Lengths of the sequences that hold exactly so many tokens without padding."""
    rest = tokens % sequence
    return [sequence] * (tokens // sequence) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], sequence: int = SEQUENCE, linear: float = LINEAR,
           quadratic: float = QUADRATIC) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; `lengths` in tokens."""
    room = capacities(sum(lengths), sequence)
    used = [0] * len(room)
    pieces = [(min(sequence, n - at), d, at) for d, n in enumerate(lengths) for at in range(0, n, sequence)]
    pieces.sort(key=lambda p: (-p[0], p[1], p[2]))   # the cost rises with the length
    cheapest = [(0.0, -r, s) for s, r in enumerate(room)]
    heapq.heapify(cheapest)
    for length, d, at in pieces:
        while length:
            cost, _, s = heapq.heappop(cheapest)
            n = min(length, room[s] - used[s])
            yield d, at, n, s, used[s]
            used[s] += n
            at, length = at + n, length - n
            if used[s] < room[s]:
                heapq.heappush(cheapest, (cost + linear * n + quadratic * n * n, used[s] - room[s], s))


def _pack_batches(batches: Iterable[pa.RecordBatch], tokenizer_json: str, sequence: int, group_tokens: int,
                  linear: float, quadratic: float, with_ids: bool) -> Iterator[pa.RecordBatch]:
    encode = Encoder(tokenizer_json)
    end = np.zeros(1, "<u4").tobytes()
    part = TaskContext.get().partitionId()
    made = 0
    keys: list = []
    ids: list[bytes] = []

    def packed() -> pa.RecordBatch:
        nonlocal made
        tokens = [len(b) // 4 for b in ids]
        rows = list(assign(tokens, sequence, linear, quadratic))
        cuts = [ids[d][4 * at:4 * (at + n)] for d, at, n, _, _ in rows]
        first = (part << 36) + made
        made += max((s for _, _, _, s, _ in rows), default=-1) + 1
        columns = {
            "doc_id": pa.array([keys[d] for d, *_ in rows], pa.int64()),
            "start": pa.array([r[1] for r in rows], pa.int64()),
            "length": pa.array([r[2] for r in rows], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(c) for c in cuts], pa.int64()),
            "doc_tokens": pa.array([tokens[d] for d, *_ in rows], pa.int64()),
            "sequence_id": pa.array([first + r[3] for r in rows], pa.int64()),
            "offset": pa.array([r[4] for r in rows], pa.int64()),
        }
        if with_ids:
            columns["ids"] = pa.array([np.frombuffer(c, "<u4").astype("int32") for c in cuts], pa.list_(pa.int32()))
        keys.clear()
        ids.clear()
        return pa.RecordBatch.from_pydict(columns)

    waiting = 0
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            keys.append(key)
            ids.append(encode([text.as_py() or ""])[0] + end)
            waiting += len(ids[-1]) // 4
            if waiting >= group_tokens:
                yield packed()
                waiting = 0
    if keys:
        yield packed()


def pack(docs: DataFrame, tokenizer_json: str, id_col: str = "doc_id", text_col: str = "text",
         sequence: int = SEQUENCE, group_tokens: int = GROUP_TOKENS, linear: float = LINEAR,
         quadratic: float = QUADRATIC, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document; with `with_ids` also the piece's token ids.

    A document's tokens are its text's ids and one id 0. Null or empty text: the id 0 alone.
    A null id stays null. Repeated rows are packed once each. Very long texts are cut like
    others. An empty table gives no rows. Other columns are not read. A sequence's number
    holds its task, so a rerun over the same file splits gives the same numbers.
    """
    if sequence & (sequence - 1):
        raise ValueError("sequence must be a power of two")
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(
        releasing(lambda batches: _pack_batches(batches, tokenizer_json, sequence, group_tokens, linear, quadratic, with_ids)),
        schema)
