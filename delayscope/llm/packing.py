"""Order-preserving packing of documents into token sequences by dynamic programming.

Documents stay in the order they are read. Sequences are windows over the stream of their
tokens; a window may be cut at the end of a document, at the end of a sentence, or, in a
stretch without either, anywhere. The cuts minimise padding plus a penalty per cut that is
not the end of a document.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delayscope.llm.common import few_rows, stored

WINDOW = 2048
#: Id that ends every document: fixed by the contract.
END = 1
#: What a cut costs, in tokens of padding: after a sentence, and inside one.
SENTENCE_CUT, INNER_CUT = 4.0, 48.0
#: Stretches longer than this without an end of a sentence get inner cuts this far apart.
STRETCH, INNER_STEP = 256, 32
#: Lengths that need no padding besides the full window: the larger powers of two.
UNPADDED = (256, 512, 1024)
#: Tokens packed at a time. The last window of a block is cut at its end, so this costs at
#: most one part-filled window in about five hundred.
BLOCK_TOKENS = 1 << 20

#: Fixed value: how the vocabulary splits text before merging, in possessive form.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
SPECIAL = {"<|endoftext|>": 50256}


def load_encoding(path: str, pattern: str = SPLIT, special: dict[str, int] | None = None):
    """The byte-level BPE of a ranks file (one base64 token and its id per line)."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL if special is None else special)


def sentence_ends(encoding) -> np.ndarray:
    """For every id, whether a sentence can end after it."""
    ends = np.zeros(encoding.n_vocab + 1, bool)
    for i in range(encoding.n_vocab):
        try:
            token = encoding.decode_single_token_bytes(i)
        except KeyError:
            continue
        ends[i] = re.search(rb"[.!?]['\")\]]*\s*$|\n", token) is not None
    return ends


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a window may be cut, ascending from 0, and the penalty of each."""
    sentence = np.flatnonzero(ends[ids]) + 1
    marks = np.unique(np.concatenate([[0], sentence, doc_ends]))
    gaps = np.diff(marks)
    inner = [np.arange(marks[k] + INNER_STEP, marks[k + 1], INNER_STEP) for k in np.flatnonzero(gaps > STRETCH)]
    positions = np.unique(np.concatenate([marks, *inner])) if inner else marks
    cost = np.full(len(positions), INNER_CUT)
    cost[np.searchsorted(positions, sentence)] = SENTENCE_CUT
    cost[np.searchsorted(positions, doc_ends)] = 0.0
    return positions, cost


def best_cuts(positions: np.ndarray, penalties: np.ndarray, window: int = WINDOW, unpadded: tuple[int, ...] = UNPADDED) -> list[int]:
    """Cut positions, from 0 to the last one, of the cheapest split into windows.

    best(j) = penalty(j) + min over i of best(i) + (window - (p(j) - p(i))), where the
    minimum over the i within reach is that of best(i) + p(i): a monotone queue gives it in
    constant time. A window whose length is one of ``unpadded`` costs no padding.
    """
    p, cost = positions.tolist(), penalties.tolist()
    at = {v: i for i, v in enumerate(p)}
    best, back = [0.0] * len(p), [0] * len(p)
    queue: deque[tuple[float, int]] = deque([(0.0, 0)])
    for j in range(1, len(p)):
        here = p[j]
        while p[queue[0][1]] < here - window:
            queue.popleft()
        value, i = queue[0]
        value += window - here
        for length in unpadded:
            k = at.get(here - length)
            if k is not None and best[k] < value:
                value, i = best[k], k
        best[j], back[j] = value + cost[j], i
        reach = best[j] + here
        while queue and queue[-1][0] >= reach:
            queue.pop()
        queue.append((reach, j))
    cuts = [len(p) - 1]
    while cuts[-1]:
        cuts.append(back[cuts[-1]])
    return [p[i] for i in reversed(cuts)]


PIECES = (
    "part int, local long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, `offset` long"
)
_NAMES = ("part", "local", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "offset")


def _pack(docs: list, tokens: list[np.ndarray], ends: np.ndarray, first: int) -> tuple[dict, int]:
    """Pieces of one block, sequences numbered from ``first``; and the next free number."""
    ids = np.concatenate(tokens)
    lengths = np.array([len(t) for t in tokens])
    doc_ends = np.cumsum(lengths)
    cuts = np.array(best_cuts(*candidates(ids, doc_ends, ends)))
    edges = np.unique(np.concatenate([cuts, doc_ends]))
    begin, stop = edges[:-1], edges[1:]
    doc = np.searchsorted(doc_ends, begin, side="right")
    seq = np.searchsorted(cuts, begin, side="right") - 1
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    return {
        "local": first + seq, "doc_id": [docs[d] for d in doc], "start": begin - (doc_ends - lengths)[doc], "length": stop - begin,
        "ids_crc32": [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(begin.tolist(), stop.tolist())],
        "doc_tokens": lengths[doc], "offset": begin - cuts[seq],
    }, first + len(cuts) - 1


def pack(docs: DataFrame, ranks_path: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its tokens and the end id; null or empty text is the end id alone, so
    every row of the input has at least one piece, also rows that repeat or lack an id.
    A sequence has at most 2048 tokens; its pieces are gapless from offset 0 and follow the
    order of the documents. ``ids_crc32`` is over the ids as little-endian 32-bit integers.

    Every task packs what it reads, a block of about a million tokens at a time, and
    nothing is shuffled: sequences are numbered by adding up the counts of the tasks
    before. A document of any length is one block at most. An empty table gives an empty
    result; other columns are not read. ``ranks_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_path)
        ends = sentence_ends(encoding)
        part, first = TaskContext.get().partitionId(), 0
        ids: list = []
        tokens: list[np.ndarray] = []
        held = 0

        def flush():
            nonlocal first, held
            pieces, first = _pack(ids, tokens, ends, first)
            n = len(pieces["local"])
            columns = {"part": np.full(n, part, np.int32), **pieces}
            kinds = {"part": pa.int32()}
            ids.clear(), tokens.clear()
            held = 0
            return pa.record_batch([pa.array(columns[c], kinds.get(c, pa.int64())) for c in _NAMES], names=list(_NAMES))

        for batch in few_rows(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                body = encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=()) if text else ()
                one = np.empty(len(body) + 1, np.uint32)
                one[:-1], one[-1] = body, END
                ids.append(doc), tokens.append(one)
                held += len(one)
                if held >= BLOCK_TOKENS:
                    yield flush()
        if ids:
            yield flush()

    pieces = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)
    pieces = stored(pieces, "pieces")
    # One row per task that read documents: small whatever the documents hold.
    counts = pieces.groupBy("part").agg((F.max("local") + 1).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return pieces.join(F.broadcast(offsets), "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("earlier") + F.col("local")).alias("sequence_id"), "offset"
    )
