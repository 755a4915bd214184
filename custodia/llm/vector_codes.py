"""Compression of vectors to codes by Lloyd rounds whose members stay with their entry's owner.

A vector becomes integers and is cut into equal parts; every position has a codebook of
its own. The parts are a table bucketed by (position, entry, salt): a bucket owns the
entries that hash to it, and its rows are their resident members. The salt cuts a hot
entry into many groups. In a round, owners sum up their members where they lie, the sums
make the new entries, and every part is compared with them in place. Only parts whose
entry changed are shuffled to their new owners before the next round; the others are read
from their buckets as they are. All arithmetic is on integers, so no order of rows matters.

The driver holds the codebooks: entries times the vector's length. They are what is
broadcast, too.

Defined results: rows whose vector is null, or holds a null or a component that is not
finite, are left out; rows that share an id are vectors of their own; ids may be null and
come last in the order that starts the codebooks, rows with one id in the order of their
vectors; fewer vectors than entries start fewer entries; rows with a null label share an
error; an empty table gives an empty table; other columns are not read. Vectors of
different lengths, a length that the parts don't divide, and components too large for
exact 64-bit distances stop the query.
"""

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custodia.storage import new_folder, remove_folder, stage

#: Parts of a vector, entries of a codebook, rounds, and what components are multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Parts that are compared with a codebook at once.
BLOCK_ROWS = 4096

OWNER = ["position", "entry", "salt"]


def integer_vectors(table: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, label and the integers of every vector without null or non-finite components."""
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    kept = table.filter(F.col(column).isNotNull() & finite)
    integers = F.transform(column, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", integers.alias("vector"))


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """The parts of the first vectors: [position, entry, place in the part]."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    lengths = {len(row.vector) for row in first}
    if len(lengths) > 1 or any(n % parts for n in lengths):
        raise ValueError(f"vectors of {sorted(lengths)} components cannot be cut into {parts} equal parts")
    book = np.array([row.vector for row in first], np.int64)
    return book.reshape(len(first), parts, -1).transpose(1, 0, 2)


def exact_limit(width: int) -> int:
    """The largest component for which squared distances of parts fit 64 bits."""
    return math.isqrt((1 << 62) // max(1, width)) // 2


def part_rows(vectors: DataFrame, parts: int, length: int) -> DataFrame:
    """row, vec_id, label, position, part; the id and the label go with the part at position 0."""
    width, limit = length // parts, min(exact_limit(length // parts), (1 << 31) - 1)
    fits = F.forall("vector", lambda x: x.between(-limit, limit))
    wrong = F.raise_error(F.lit(f"a vector hasn't {length} components within {limit}")).cast("array<int>")
    checked = F.when((F.size("vector") == length) & fits, F.transform("vector", lambda x: x.cast("int"))).otherwise(wrong)
    cut = F.array(*[F.slice("checked", p * width + 1, width) for p in range(parts)])
    rows = vectors.withColumn("row", F.monotonically_increasing_id()).withColumn("checked", checked)
    exploded = rows.select("row", "vec_id", "label", F.posexplode(cut).alias("position", "part"))
    first = F.col("position") == 0
    return exploded.select(
        "row", F.when(first, F.col("vec_id")).alias("vec_id"), F.when(first, F.col("label")).alias("label"), "position", "part"
    )


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of each part, the lowest of equally near ones, and the squared distance."""
    width = max(1, book.shape[1])
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(book).max(initial=0)))
    best = np.zeros(len(parts), np.int32)
    distance = np.zeros(len(parts), np.int64)
    # Doubles hold whole numbers up to 2^53, and matrix products of doubles are fast.
    doubles = 4 * width * most * most < 1 << 53
    if doubles:
        book_t, squares = book.T.astype(np.float64), (book * book).sum(axis=1).astype(np.float64)
    for at in range(0, len(parts), BLOCK_ROWS):
        x = parts[at : at + BLOCK_ROWS]
        if doubles:
            near = squares - 2 * (x.astype(np.float64) @ book_t)
            best[at : at + len(x)] = near.argmin(axis=1)
        else:
            low = np.full(len(x), np.iinfo(np.int64).max)
            for k, entry in enumerate(book):
                d = ((x - entry) ** 2).sum(axis=1)
                best[at : at + len(x)][d < low] = k
                low = np.minimum(low, d)
        off = x - book[best[at : at + len(x)]]
        distance[at : at + len(x)] = (off * off).sum(axis=1)
    return best, distance


def _compared(batch: pa.RecordBatch, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries and distances of a batch's parts."""
    position = batch.column("position").to_numpy()
    part = batch.column("part").flatten().to_numpy().astype(np.int64).reshape(len(position), books.shape[2])
    entry, distance = np.zeros(len(position), np.int32), np.zeros(len(position), np.int64)
    for p in range(len(books)):
        mine = position == p
        entry[mine], distance[mine] = nearest(part[mine], books[p])
    return entry, distance


def assign(rows: DataFrame, books, name: str) -> DataFrame:
    """Adds the nearest entry of every part as ``name``, and its distance; rows stay where they are."""
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, distance = _compared(batch, books.value)
            held = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*held, pa.array(entry), pa.array(distance)], names=[*columns, name, "distance"]
            )

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{types}, {name} int, distance long")


class Residents:
    """Members by owner: a bucketed table, with the parts that leave in a partition of its own."""

    def __init__(self, spark: SparkSession, n_buckets: int):
        self.spark, self.n_buckets = spark, n_buckets
        self.name = self.path = None

    def settle(self, rows: DataFrame) -> None:
        """Write rows under their owners in place of what was held before."""
        name, path = f"members_{uuid.uuid4().hex}", new_folder(self.spark, "members")
        writer = rows.write.format("parquet").partitionBy("moved").bucketBy(self.n_buckets, *OWNER)
        writer.option("path", path).saveAsTable(name)
        self.clear()
        self.name, self.path = name, path

    def members(self) -> DataFrame:
        """All parts by their present entry: those that stayed, as they lie, and those that moved, shuffled."""
        held = self.spark.table(self.name)
        columns = [c for c in held.columns if c not in ("moved", "target")]
        stayed = held.filter("NOT moved").select(*columns)
        moved = held.filter("moved").select(*[F.col("target" if c == "entry" else c).alias(c) for c in columns])
        return stayed.unionByName(moved.repartition(self.n_buckets, *OWNER))

    def clear(self) -> None:
        if self.name:
            self.spark.sql(f"DROP TABLE {self.name}")
            remove_folder(self.spark, self.path)
            self.name = self.path = None


def updated(members: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks with every entry replaced by the floored mean of its members, unless it has none."""
    width = books.shape[2]
    sums = [F.sum(F.col("part")[i].cast("long")).alias(f"s{i}") for i in range(width)]
    # Owners sum up where the members lie; what is shuffled is a row for each of their groups.
    totals = members.groupBy("position", "entry").agg(F.count("*").alias("n"), *sums)
    out = books.copy()
    for row in totals.collect():
        out[row["position"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return out


def codebook_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def _codes(compared: DataFrame, parts: int) -> DataFrame:
    """vec_id, label, code and error of every vector, from its compared parts."""
    two = F.lpad(F.lower(F.hex(F.col("code").cast("long"))), 2, "0")
    digits = [F.max(F.when(F.col("position") == p, two)) for p in range(parts)]
    return compared.groupBy("row").agg(
        F.max("vec_id").alias("vec_id"),
        F.max("label").alias("label"),
        F.concat(*digits).alias("code"),
        F.sum("distance").alias("error"),
    )


def encode_vectors(
    table: DataFrame,
    column: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that is kept; at most 256 entries."""
    spark = table.sparkSession
    vectors = integer_vectors(table, column, scale)
    books = first_codebooks(vectors, parts, entries)
    if books.shape[1] == 0:
        nothing = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], nothing)
    n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, n_buckets // 2)
    residents = Residents(spark, n_buckets)
    rows = part_rows(vectors, parts, parts * books.shape[2])
    try:
        shared = spark.sparkContext.broadcast(books)
        placed = assign(rows, shared, "entry").drop("distance")
        placed = placed.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
        arrived = placed.repartition(n_buckets, *OWNER)
        residents.settle(arrived.withColumns({"target": F.col("entry"), "moved": F.lit(False)}))
        for _ in range(rounds - 1):
            books = updated(residents.members(), books)
            shared = spark.sparkContext.broadcast(books)
            compared = assign(residents.members(), shared, "target").drop("distance")
            residents.settle(compared.withColumn("moved", F.col("target") != F.col("entry")))
        members = residents.members()
        if rounds:
            books = updated(members, books)
        compared = assign(members, spark.sparkContext.broadcast(books), "code")
        codes = stage(_codes(compared, parts), "vector-codes")
    finally:
        residents.clear()
    totals = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    totals = stage(totals, "label-errors")
    joined = codes.join(totals, F.col("label").eqNullSafe(F.col("of")))
    digest = F.lit(codebook_digest(books)).alias("codebooks_sha256")
    return joined.select("vec_id", "code", "error", "label_error", digest)
