"""Packing of documents into training windows.

Order-preserving dynamic programming. The documents of an input partition form one
stream of ids in the order in which they are read. Window cuts may fall at document
ends, at sentence ends (at a cost), between words of a long sentence (at a higher
cost) and, where a single word is longer than half a window, inside it. Among all
cuts into windows of at most `window` ids the ones with the least sum of padding and
cut costs are taken. The least cost up to a cut is

    best(j) = cost(j) + min over i with j - i <= window of (best(i) + window - (j - i)),

a minimum over a sliding range, kept by a monotone queue, so a cut costs constant
time. A window whose length is a power of two needs no padding; these few transitions
are tried beside the queue.

Partitions are packed independently and without a shuffle: each ends with one window
that may be short. A partition's stream is solved in blocks of about `block` ids, cut
at document ends, so memory does not grow with the partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from jobtide.llm.bpe import ByteEncoder, byte_encoder, public_vocabulary
from jobtide.llm.frames import pick

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)
ARROW = pa.schema(
    [
        *[(c, pa.int64()) for c in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")],
        ("ids", pa.binary()),
    ]
)


@dataclass(frozen=True)
class Costs:
    """What a cut costs, in ids of padding."""

    window: int = 1024
    sentence: float = 4.0
    word: float = 16.0
    inside: float = 64.0
    opening: float = 16.0  # for each window, so that short windows without padding stay rare
    least_power: int = 256  # windows with a smaller power of two are not looked for
    long_sentence: int = 96  # ids; longer sentences may be cut between words
    between: int = 16  # ids that lie between such cuts at least
    block: int = 1 << 20


def block_cuts(
    ids: np.ndarray, ends: np.ndarray, encoder: ByteEncoder, costs: Costs
) -> tuple[np.ndarray, np.ndarray]:
    """The places where a block of documents may be cut, and their costs.

    `ids` holds the documents one behind the other, each with its separator, and `ends`
    where each one ends, a place at no cost. A sentence ends behind an id that ends in a
    stop if a space or line end follows, and before a line end.
    """
    before, after = ids[:-1], ids[1:]
    separator = np.zeros(len(ids), bool)
    separator[ends - 1] = True
    inside = ~(separator[:-1] | separator[1:])
    line = encoder.lined[after] & ~encoder.blank[before]
    space = encoder.spaced[after] & inside
    stops = np.flatnonzero((line & inside) | (space & encoder.stops[before])) + 1
    edges = np.sort(np.concatenate(([0], stops, ends)))
    long = np.diff(edges) > costs.long_sentence
    spaces = np.flatnonzero(space) + 1
    sentence = np.searchsorted(edges, spaces, "right") - 1
    inner = long[sentence] & (spaces > edges[sentence])
    spaces, sentence = spaces[inner], sentence[inner]
    # The first space of each stretch of `between` ids of a long sentence.
    stretch = (spaces - edges[sentence]) // costs.between
    first = np.ones(len(spaces), bool)
    first[1:] = (sentence[1:] != sentence[:-1]) | (stretch[1:] != stretch[:-1])
    spaces = spaces[first]
    known = np.sort(np.concatenate((edges, spaces)))
    half = costs.window // 2
    wide = np.flatnonzero(np.diff(known) > half)
    wide = wide[long[np.searchsorted(edges, known[wide], "right") - 1]]
    more = [at for k in wide.tolist() for at in range(int(known[k]) + half, int(known[k + 1]), half)]
    places = np.concatenate((stops, spaces, np.array(more, np.int64), ends))
    price = (costs.sentence, costs.word, costs.inside, 0.0)
    prices = np.repeat(price, (len(stops), len(spaces), len(more), len(ends)))
    order = np.argsort(places)
    return places[order], prices[order]


def best_cuts(places: Sequence[int], prices: Sequence[float], costs: Costs) -> list[int]:
    """Ends of the windows over a stream that starts at 0 and ends at the last place.

    Places rise strictly, no two further apart than the window.
    """
    window = costs.window
    stream = np.concatenate(([0], places))
    powers = [1 << k for k in range(window.bit_length()) if costs.least_power <= 1 << k <= window]
    # The few places that lie a power of two behind another one, found for all at once.
    exact: dict[int, list[int]] = {}
    for power in powers:
        back = np.searchsorted(stream, stream - power)
        hits = np.flatnonzero(stream[back] == stream - power)
        for j, i in zip(hits.tolist(), back[hits].tolist()):
            exact.setdefault(j, []).append(i)
    place = stream.tolist()
    steps = (np.asarray(prices, float) + costs.opening).tolist()
    best, shifted, came = [0.0], [0.0], [0]
    queue, head, front = [0], 0, 0  # from `head` on; `front` is the place of the first
    for j, (at, step) in enumerate(zip(place[1:], steps), 1):
        while front < at - window:
            head += 1
            front = place[queue[head]]
        source = queue[head]
        least = shifted[source] + window - at
        if j in exact:
            for i in exact[j]:
                if best[i] < least:
                    least, source = best[i], i
        least += step
        best.append(least)
        came.append(source)
        value = least + at
        shifted.append(value)
        while len(queue) > head and shifted[queue[-1]] >= value:
            queue.pop()
        if len(queue) == head:
            front = at
        queue.append(j)
    ends, j = [], len(place) - 1
    while j:
        ends.append(place[j])
        j = came[j]
    return ends[::-1]


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    costs: Costs = Costs(),
    separator: int = 0,
) -> DataFrame:
    """Pack the whole texts of `docs` (doc_id, text); one row for each piece.

    Columns: doc_id; start, the ids of its document before it; length; doc_tokens, the
    document's ids with the separator; sequence_id; offset, its place in the sequence;
    ids, little-endian unsigned 32-bit integers. The pieces of a sequence lie without
    gap from offset 0 in the order of the input rows; the sequence id holds the input
    partition and a running number, so a task that runs again gives the same ids.

    Null texts are empty: their piece is the separator alone. Null doc_ids stay null.
    Repeated rows are documents of their own. An empty table gives no rows. Other
    columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(vocabulary or public_vocabulary())
        base = TaskContext.get().partitionId() << 36
        made = 0
        end = np.array([separator], np.uint32)
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal made, held
            ids = np.concatenate(parts)
            ends = np.cumsum([len(own) + 1 for own in parts[::2]])
            windows = np.array(best_cuts(*block_cuts(ids, ends, encoder, costs), costs))
            # A piece lies between two cuts, be they of a document or of a window.
            stops = np.union1d(ends, windows)
            starts = np.concatenate(([0], stops[:-1]))
            doc = np.searchsorted(ends, starts, "right")
            window = np.searchsorted(windows, starts, "right")
            sizes = np.diff(ends, prepend=0)
            columns = [
                pa.array(doc_ids, pa.int64()).take(pa.array(doc)),
                pa.array(starts - (ends - sizes)[doc]),
                pa.array(stops - starts),
                pa.array(sizes[doc]),
                pa.array(base + made + window),
                pa.array(starts - np.concatenate(([0], windows))[window]),
                pa.Array.from_buffers(
                    pa.binary(),
                    len(stops),
                    [
                        None,
                        pa.py_buffer((4 * np.concatenate(([0], stops))).astype(np.int32)),
                        pa.py_buffer(ids.astype("<u4")),
                    ],
                ),
            ]
            made += len(windows)
            held = 0
            doc_ids.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays(columns, schema=ARROW)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.encode(text or "")
                doc_ids.append(doc_id)
                parts += (ids, end)
                held += len(ids) + 1
                if held >= costs.block:
                    yield close()
        if doc_ids:
            yield close()

    return pick(docs, doc_id="long", text="string").mapInArrow(run, PIECES)
