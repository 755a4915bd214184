"""Byte-level BPE encoding and decoding over length-bucketed numpy matrices.

Texts are cut into pieces by the published pattern, each distinct piece of a
block of texts is encoded once, and equal pieces share the result. Pieces of
similar length form the rows of a padded matrix; in every round each row merges
its leftmost pair of minimum rank. Ranks come from a hash table over pairs.

Defined results: a null or empty text has no ids and decodes to no bytes; equal
rows give equal results; an empty table gives an empty table; columns other
than the id and the text are not read. A piece of any length is encoded whole.
"""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from custodia.llm.common import bounds, distinct_segments, like, text_chunks

NO_RANK = np.int32(2**31 - 1)

# Character classes of the pattern.
LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3

#: Endings that the pattern splits off after an apostrophe. Fixed values.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

#: Texts of one set of arrays; pieces are shared within it.
BLOCK_BYTES = 1_000_000
#: Cells of one matrix.
MATRIX_CELLS = 1_000_000

ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file with one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


class PairTable:
    """Ranks of merged pairs: open addressing with linear probing over numpy arrays."""

    def __init__(self, tokens: list[bytes]):
        rank = {token: i for i, token in enumerate(tokens)}
        pairs = {
            (rank[token[:cut]] << 32) | rank[token[cut:]]: i
            for token, i in rank.items()
            for cut in range(1, len(token))
            if token[:cut] in rank and token[cut:] in rank
        }
        self.bits = np.uint64(max(4, (4 * max(1, len(pairs))).bit_length()))
        self.keys = np.full(1 << int(self.bits), -1, np.int64)
        self.ranks = np.full(len(self.keys), NO_RANK, np.int32)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slots = self._slots(keys)
        self.longest = 1
        while len(keys):
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]  # of several for one slot the last one gets it
            put = self.keys[slots] == keys
            self.ranks[slots[put]] = ranks[put]
            keys, ranks, slots = keys[~put], ranks[~put], (slots[~put] + 1) & (len(self.keys) - 1)
            self.longest += 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> (np.uint64(64) - self.bits)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NO_RANK where they don't merge or an id is negative."""
        shape, left, right = left.shape, left.ravel(), right.ravel()
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        keys[(left < 0) | (right < 0)] = -2
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.ranks[slots], NO_RANK)
        open_ = np.flatnonzero((held != keys) & (held != -1) & (keys != -2))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & (len(self.keys) - 1)
            held = self.keys[slots[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out.reshape(shape)


def gather(flat: np.ndarray, first: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated runs ``which`` of a flat array, and their lengths."""
    lengths = (first[1:] - first[:-1])[which]
    at = np.arange(int(lengths.sum())) - np.repeat(bounds(lengths)[:-1], lengths)
    return flat[np.repeat(first[:-1][which], lengths) + at], lengths


def _flat(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(strings), np.uint8), bounds(np.fromiter(map(len, strings), np.int64, len(strings)))


def character_classes() -> np.ndarray:
    """Class of every code point under the pattern."""
    points = np.arange(0x110000, dtype="<u4")
    points[0xD800:0xE000] = 0  # surrogates are no characters
    every = points.tobytes().decode("utf-32-le")
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for run in regex.finditer(pattern, every):
            out[run.start() : run.end()] = kind
    return out


def piece_starts(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pattern's matches start, in characters of concatenated texts that start at ``first``.

    A match is a run of one class, with the last space before it if that is a
    plain one. Of other white space before a run, the last character stands alone.
    """
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes[points]
    begins = np.zeros(n, bool)
    begins[first[:-1][np.diff(first) > 0]] = True
    run = begins.copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    # A space run ends before `after`, the start of another run in the same text.
    after = np.flatnonzero(run & ~begins & (kind != SPACE))
    after = after[kind[after - 1] == SPACE]
    start[after - 1] = True
    plain = points[after - 1] == 0x20
    start[after[plain]] = False
    # A contraction: an apostrophe that starts a match, with an ending after it in the same text.
    quote = np.flatnonzero(start & (points == ord("'")))
    text_end = first[np.searchsorted(first, quote, "right")]
    for ending in CONTRACTIONS:
        fits = quote + len(ending) < text_end
        at, end = quote[fits], text_end[fits]
        for k, letter in enumerate(ending, 1):
            hit = points[at + k] == ord(letter)
            at, end = at[hit], end[hit]
        start[at + 1] = False
        rest = at + 1 + len(ending)
        start[rest[rest < end]] = True
    return np.flatnonzero(start)


class Codec:
    """Encoder and decoder of one vocabulary: a few arrays of some 6 MB in all."""

    def __init__(self, tokens: list[bytes]):
        self.classes = character_classes()
        self.pairs = PairTable(tokens)
        self.tokens, self.first_token = _flat(tokens)
        self.numbers, self.first_number = _flat([b"%d " % i for i in range(len(tokens))])
        self.byte_ids = np.full(256, -1, np.int32)
        for i, token in enumerate(tokens):
            if len(token) == 1:
                self.byte_ids[token[0]] = i

    def encode_pieces(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of byte pieces, and where each piece's ids start."""
        lengths = np.diff(first)
        counts = lengths.copy()
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        order = np.argsort(lengths, kind="stable")
        start = 0
        while start < len(order):
            # A bucket holds lengths of up to about a quarter above its shortest.
            shortest = int(lengths[order[start]])
            width = max(2, shortest + shortest // 4)
            end = int(np.searchsorted(lengths[order], width, "right"))
            end = min(end, start + max(1, MATRIX_CELLS // width))
            rows = order[start:end]
            ids, n = self._merge(data, first, rows, int(lengths[rows[-1]]))
            parts.append((rows, ids, n))
            counts[rows] = n
            start = end
        firsts = bounds(counts)
        flat = np.zeros(int(firsts[-1]), np.int32)
        for rows, ids, n in parts:
            at = np.arange(len(ids)) - np.repeat(bounds(n)[:-1], n)
            flat[np.repeat(firsts[rows], n) + at] = ids
        return flat, firsts

    def _merge(self, data: np.ndarray, first: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces of at most ``width`` bytes, flat, and their number per piece."""
        lengths = first[rows + 1] - first[rows]
        column = np.arange(width)
        filled = column < lengths[:, None]
        ids = np.full((len(rows), width), -1, np.int32)
        ids[filled] = self.byte_ids[data[(first[rows][:, None] + column)[filled]]]
        done_ids: list[np.ndarray] = []
        done_rows: list[np.ndarray] = []
        live = np.arange(len(rows))
        while len(live):
            self._merge_rounds(ids)
            kept = ids >= 0
            counts = kept.sum(axis=1)
            packed = np.full((len(live), int(counts.max())), -1, np.int32)
            packed[np.arange(packed.shape[1]) < counts[:, None]] = ids[kept]
            over = self._ranks(packed).min(axis=1) == NO_RANK
            done_ids.append(packed[over][packed[over] >= 0])
            done_rows.append(np.repeat(live[over], counts[over]))
            live, ids = live[~over], packed[~over]
        flat = np.concatenate([np.zeros(0, np.int32), *done_ids])
        owner = np.concatenate([np.zeros(0, np.int64), *done_rows])
        return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(rows))

    def _ranks(self, ids: np.ndarray) -> np.ndarray:
        """Rank of each cell's merge with the cell after it."""
        ranks = np.full(ids.shape, NO_RANK, np.int32)
        ranks[:, :-1] = self.pairs.lookup(ids[:, :-1], ids[:, 1:])
        return ranks

    def _merge_rounds(self, ids: np.ndarray) -> None:
        """Merge in place; a merged pair leaves one cell empty.

        Links skip empty cells. The rounds end when about half of the width is
        empty or half of the rows are done, so that the caller can compact.
        """
        n, width = ids.shape
        ranks = self._ranks(ids)
        following = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
        before = following - 2
        every = np.arange(n)
        for _ in range(max(1, width // 2)):
            best = ranks.argmin(axis=1)
            row = np.flatnonzero(ranks[every, best] != NO_RANK)
            if len(row) <= n // 2:
                return
            left = best[row]
            right = following[row, left]
            beyond = following[row, right]
            ids[row, left] = ranks[row, left]
            ids[row, right] = -1
            ranks[row, right] = NO_RANK
            following[row, left] = beyond
            inside = beyond < width
            before[row[inside], beyond[inside]] = left[inside]
            next_id = np.where(inside, ids[row, np.minimum(beyond, width - 1)], -1)
            ranks[row, left] = self.pairs.lookup(ids[row, left], next_id)
            earlier = before[row, left]
            has = earlier >= 0
            row, left, earlier = row[has], left[has], earlier[has]
            ranks[row, earlier] = self.pairs.lookup(ids[row, earlier], ids[row, left])

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of texts, and where each text's ids start."""
        points = np.frombuffer(b"".join(texts).decode().encode("utf-32-le"), np.uint32)
        data = np.frombuffer(b"".join(texts), np.uint8)
        first_byte = bounds(np.fromiter(map(len, texts), np.int64, len(texts)))
        lead = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each character
        first_char = np.searchsorted(lead, first_byte)
        starts = piece_starts(points, first_char, self.classes)
        cuts = np.append(lead[starts], len(data))
        sample, which = distinct_segments(data, cuts)
        pieces, piece_lengths = gather(data, cuts, sample)
        ids, first_id = self.encode_pieces(pieces, bounds(piece_lengths))
        flat, counts = gather(ids, first_id, which)
        first_piece = np.searchsorted(cuts[:-1], first_byte)
        return flat, bounds(counts)[first_piece]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """Bytes of runs of ids."""
        data, lengths = gather(self.tokens, self.first_token, ids)
        cuts = bounds(lengths)[first]
        blob = data.tobytes()
        return [blob[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def decimal(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        """Decimal ids of runs, joined by one space."""
        data, lengths = gather(self.numbers, self.first_number, ids)
        cuts = bounds(lengths)[first]
        blob = data.tobytes()
        return [blob[a : max(a, b - 1)] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def broadcast_codec(spark: SparkSession, path: str):
    """The codec of a vocabulary, which the driver reads; its size is fixed (some 50,000 tokens)."""
    return spark.sparkContext.broadcast(Codec(read_ranks(path)))


def encode_documents(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Per document the number of ids, and digests of the ids and of the bytes decoded from them."""
    held = broadcast_codec(docs.sparkSession, ranks_path)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held.value
        for batch, texts in text_chunks(batches, limit=BLOCK_BYTES):
            ids, first = codec.encode(texts)
            yield like(
                {
                    "doc_id": batch.column(0),
                    "n_tokens": np.diff(first),
                    "ids_sha256": [hashlib.sha256(x).hexdigest() for x in codec.decimal(ids, first)],
                    "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in codec.decode(ids, first)],
                },
                schema,
            )

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(encode, ENCODED)
