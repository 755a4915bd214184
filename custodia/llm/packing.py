"""Best-fit packing of documents into token sequences, certified by lower bounds.

Every document is tokenized whole and ends with one end id. A longer one than a
sequence is cut into pieces of a whole sequence each, but for its first piece. Each
partition packs its pieces by best-fit decreasing while it reads them. Dual feasible
functions over its lengths then give a lower bound: where it equals the number of
bins, no packing of these pieces alone has fewer. Where there is a gap, bins exchange documents and are packed again. A
certified partition hands on only its bins with room, which is lost to rounding; one
that keeps a gap hands on all pieces shorter than a sequence. Pieces handed on are dealt
anew into partitions of bounded size and packed again, where they keep their old bins
unless the new ones are fewer. Rounds end when all that is handed on fits into one
partition, or a round saves no bin.

Defined results: a null or empty text is the end id alone; every row is a document of
its own, also one whose id is null or repeated; equal rows give equal pieces in bins of
their own; an empty table gives an empty table; columns other than the id and the
text are not read. Strings of special tokens in a text are ordinary text; bytes that
are not UTF-8 become U+FFFD.
"""

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custodia.llm.common import like, text_chunks
from custodia.storage import stage

#: Tokens of a sequence.
CAPACITY = 1024
#: Pieces that one task packs at once; a partition with more packs them in several runs.
RUN_PIECES = 100_000
#: Rounds of packing handed-on pieces again, at most.
ROUNDS = 6
#: Exchanges between the bins of a partition with a gap, at most, and how many of its roomiest bins take part.
EXCHANGES, GATHERERS, GIVERS = 2000, 48, 400
#: Bytes of text that are tokenized at once.
TEXT_BYTES = 500_000
#: Rows of a batch that a task returns.
BATCH_ROWS = 50_000

# A sequence's number: round, run (partition and number in it), and bin.
_BIN_BITS, _RUN_BITS = 20, 38

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("released", pa.bool_()),
    ]
)
_DDL = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, "
    "released boolean"
)
PACKED = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


# --- Tokens.


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens of a byte-level vocabulary file, as bytes, with their ids, which must be their ranks too."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    # The alphabet of such files: printable bytes stand for themselves, the others follow from U+0100.
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}
    vocabulary = model["vocab"]
    ranks = {}
    for token, i in vocabulary.items():
        if all(char in byte_of for char in token):
            ranks[bytes(byte_of[char] for char in token)] = i
    merged = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:], strict=False)):
        raise ValueError(f"the ids of {path} are not in the order of its merges")
    # Specials such as an end marker are no result of merges.
    made = {*merged, *(ranks[bytes([b])] for b in range(256))}
    return {token: i for token, i in ranks.items() if i in made}


_ENCODINGS: dict[str, tiktoken.Encoding] = {}


def _encoding(shared) -> tiktoken.Encoding:
    """The encoding of a broadcast vocabulary, built once per Python worker."""
    name, pattern, ranks = shared.value
    if name not in _ENCODINGS:
        _ENCODINGS[name] = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[name]


class _Pieces:
    """Pieces of documents, as growing columns."""

    def __init__(self):
        self.columns: list[list[np.ndarray]] = [[] for _ in range(5)]
        self.n = 0

    def add(self, *columns: np.ndarray) -> None:
        for held, new in zip(self.columns, columns, strict=True):
            held.append(new)
        self.n += len(columns[0])

    def take(self) -> list[np.ndarray]:
        out = [np.concatenate(held) for held in self.columns]
        self.__init__()
        return out


def cut(n_ids: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences, after a first piece that may be shorter."""
    first = (n_ids - 1) % capacity + 1
    return [(0, first), *((at, capacity) for at in range(first, n_ids, capacity))]


# --- Packing.


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of every length, and the free room of every bin.

    Bins lie in stacks by free room, and bit r of ``open_`` says whether stack r has any, so the fullest
    bin that a length fits into is found in one step.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_, found, free = 0, [], []
    order = np.argsort(-lengths, kind="stable")
    for size in lengths[order].tolist():
        fitting = open_ >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = stacks[room].pop()
            if not stacks[room]:
                open_ ^= 1 << room
        else:
            room, number = capacity, len(free)
            free.append(capacity)
        found.append(number)
        left = room - size
        free[number] = left
        if left:
            stacks[left].append(number)
            open_ |= 1 << left
    bins = np.empty(len(lengths), np.int64)
    bins[order] = found
    return bins, np.array(free, np.int64)


def dual_feasible(capacity: int, most: int = 12) -> Iterator[tuple[np.ndarray, int]]:
    """Dual feasible functions over lengths 0 to ``capacity``, each with the most that a full bin can sum to.

    Thresholds first: lengths below e count nothing and those above capacity - e count as a whole bin.
    Then rounding with k: a length of (k + 1) x / capacity parts counts as so many k-ths, rounded down
    unless it is a whole number. Both keep a bin's sum within its bound, and so does one after the other.
    """
    x = np.arange(capacity + 1, dtype=np.int64)
    below = x[: capacity // 2 + 1, None]
    thresholds = np.where(x > capacity - below, capacity, np.where(x < below, 0, x))
    yield thresholds, capacity
    for k in range(1, most + 1):
        scaled = (k + 1) * thresholds
        yield np.where(scaled % capacity == 0, k * thresholds, capacity * (scaled // capacity)), k * capacity


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The fewest bins that any packing needs, as far as the functions tell, from counts by length."""
    return max(int(-(-(f @ counts).max() // full)) for f, full in dual_feasible(capacity))


def exchange(lengths: np.ndarray, bins: np.ndarray, free: np.ndarray, fewest: int) -> np.ndarray:
    """Empties bins by moving lengths out of the emptiest one, in place; returns the free room of what is left.

    A length goes to the fullest other bin that has room for it. If none has, free room is gathered: of
    the lengths in the roomiest bins, one changes places with a shorter one whose bin has room for the
    difference, so that rooms become less even. Ends at ``fewest`` bins, when nothing can be moved, or
    after `EXCHANGES` moves.
    """
    gone = np.zeros(len(free), bool)
    for _ in range(EXCHANGES):
        if len(free) - gone.sum() == fewest:
            break
        rooms = np.where(gone, -1, free)
        emptiest = int(np.argmax(rooms))
        mine = np.flatnonzero(bins == emptiest)
        rooms[emptiest] = -1
        whole = mine[lengths[mine] <= rooms.max()]
        if len(whole):
            i = whole[np.argmax(lengths[whole])]
            to = int(np.argmin(np.where(rooms >= lengths[i], rooms, np.iinfo(np.int64).max)))
            bins[i] = to
            free[to] -= lengths[i]
            free[emptiest] += lengths[i]
            gone[emptiest] = len(mine) == 1
            continue
        rooms[emptiest] = free[emptiest]
        order = np.argsort(-rooms, kind="stable")
        gatherers, givers = np.zeros(len(free), bool), np.zeros(len(free), bool)
        gatherers[order[:GATHERERS]] = True
        givers[order[:GIVERS]] = True
        i, j = np.flatnonzero(gatherers[bins]), np.flatnonzero((givers & (rooms > 0))[bins])
        gain, given = lengths[i][:, None] - lengths[j], rooms[bins[j]]
        # How much less even: half the growth of the sum of squared rooms.
        better = gain * (gain + rooms[bins[i]][:, None] - given)
        better[(gain <= 0) | (gain > given) | (bins[i][:, None] == bins[j])] = 0
        if better.max(initial=0) <= 0:
            break
        y, x = np.unravel_index(np.argmax(better), better.shape)
        i, j, moved = i[y], j[x], gain[y, x]
        free[bins[i]] += moved
        free[bins[j]] -= moved
        bins[i], bins[j] = bins[j], bins[i]
    numbers = np.cumsum(~gone) - 1
    bins[:] = numbers[bins]
    return free[~gone]


def repack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """Bins by best-fit decreasing, after exchanges if the bound leaves a gap; their free room; whether it is closed."""
    bins, free = best_fit_decreasing(lengths, capacity)
    fewest = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
    if len(free) > fewest:
        free = exchange(lengths, bins, free, fewest)
    return bins, free, len(free) == fewest


def offsets_of(bins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Where every length starts in its bin: after those of the same bin before it."""
    order = np.argsort(bins, kind="stable")
    ends = np.cumsum(lengths[order])
    sorted_bins = bins[order]
    first = np.searchsorted(sorted_bins, sorted_bins)
    offsets = np.empty(len(bins), np.int64)
    offsets[order] = ends - lengths[order] - (ends - lengths[order])[first]
    return offsets


def handed_on(lengths: np.ndarray, bins: np.ndarray, free: np.ndarray, certified: bool, capacity: int) -> np.ndarray:
    """Which lengths are to be packed again with those of others."""
    return free[bins] > 0 if certified else lengths < capacity


def _numbered(round_: int, run: int, bins: np.ndarray) -> np.ndarray:
    return (((round_ << _RUN_BITS) | run) << _BIN_BITS) | bins


def _batches(columns: list, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), BATCH_ROWS):
        part = [c[at : at + BATCH_ROWS] for c in columns]
        yield like(dict(zip(schema.names, part, strict=True)), schema)


def pack_documents(docs: DataFrame, shared, end_id: int, capacity: int) -> DataFrame:
    """Pieces of all documents, packed where they are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, task = _encoding(shared), TaskContext.get().partitionId()
        held, ids, number = _Pieces(), [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            piece, start, length, crc, row = held.take()
            run_id = (task << 14) | number
            bins, free, certified = repack(length, capacity)
            again = handed_on(length, bins, free, certified, capacity)
            names = pa.concat_arrays(ids).take(pa.array(row))
            sequences = _numbered(0, run_id, bins)
            yield from _batches([names, piece, start, length, crc, sequences, offsets_of(bins, length), again], PIECES)

        n_rows = 0
        for batch, texts in text_chunks(batches, limit=TEXT_BYTES):
            ids.append(batch.column(0))
            for text in texts:
                tokens = np.array([*encoding.encode_ordinary(text.decode("utf-8", "replace")), end_id], "<u4")
                spans = cut(len(tokens), capacity)
                start, length = np.array(spans, np.int64).T
                crc = np.array([zlib.crc32(tokens[a : a + n].tobytes()) for a, n in spans], np.int64)
                held.add(np.arange(len(spans)), start, length, crc, np.full(len(spans), n_rows))
                n_rows += 1
            if held.n >= RUN_PIECES:
                yield from packed()
                ids, n_rows, number = [], 0, number + 1
        if held.n:
            yield from packed()

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, _DDL)


def pack_again(released: DataFrame, n_tasks: int, round_: int, capacity: int) -> DataFrame:
    """Pieces handed on, dealt into ``n_tasks`` partitions by their bins and packed again there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [batch for batch in batches if batch.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches).combine_chunks()
        # By content, so that another attempt at the task gives the same bins.
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        length, old = (table.column(name).to_numpy() for name in ("length", "sequence_id"))
        run_id = TaskContext.get().partitionId() << 14
        bins, free, certified = repack(length, capacity)
        sequences = _numbered(round_, run_id, bins)
        if len(free) >= len(np.unique(old)):
            sequences, bins = old, np.unique(old, return_inverse=True)[1]
            free = capacity - np.bincount(bins, length).astype(np.int64)
        again = handed_on(length, bins, free, certified, capacity)
        same = [table.column(name).combine_chunks() for name in PACKED[:5]]
        yield from _batches([*same, sequences, offsets_of(bins, length), again], PIECES)

    # The deal differs by round, so partitions get other bins each time; a bin stays whole.
    dealt = F.pmod(F.xxhash64("sequence_id", F.lit(round_)), F.lit(n_tasks)).cast("int")
    return released.repartitionById(n_tasks, dealt).mapInArrow(run, _DDL)


def pack(
    docs: DataFrame, vocabulary: str, pattern: str, end_id: int, capacity: int = CAPACITY, run_pieces: int = RUN_PIECES
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    The vocabulary is broadcast; its size is fixed (some 50,000 tokens). The driver
    learns how many pieces and bins a round hands on.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((vocabulary, pattern, read_ranks(vocabulary)))
    current = stage(pack_documents(docs, shared, end_id, capacity), "packed")
    done = [current]
    for round_ in range(1, ROUNDS + 1):
        released = current.filter("released")
        counts = released.agg(F.count("*").alias("n"), F.count_if(F.col("offset") == 0).alias("bins")).first()
        if not counts.bins:
            break
        n_tasks = -(-counts.n // run_pieces)
        done[-1] = current.filter("NOT released")
        current = stage(pack_again(released, n_tasks, round_, capacity), "packed")
        done.append(current)
        if n_tasks == 1 or current.filter("offset = 0").count() >= counts.bins:
            break
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return every.select(*PACKED)


def certificate(packed: DataFrame, capacity: int = CAPACITY) -> tuple[int, int]:
    """The number of sequences of a packing, and the fewest that any packing of its pieces can have.

    Lengths are counted first, so the driver gets one row for each length at most.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for row in packed.groupBy("length").count().collect():
        counts[row["length"]] = row["count"]
    return packed.filter("offset = 0").count(), lower_bound(counts, capacity)
