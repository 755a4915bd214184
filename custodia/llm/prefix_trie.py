"""The trie of shared prefixes of conversations, by collapsing whole sequences first.

Conversations are rebuilt: the first few turns come from another one of the same family.
Turns are digests from then on. A prefix is told by its depth and a digest of the sums,
lane by lane, of its turns' digests with their places, so prefix sums over bounded blocks
give all prefixes of a conversation of any length.

Identical conversations collapse into one weighted sequence with the list of their ends,
and only its smallest member's turns go on. Sequences that are proper prefixes of others
drop out by an anti-join; what is left are the leaves. Weighted prefixes of all sequences
sum up to nodes. Every node is charged to one leaf below it, the one with the smallest
conversation, so suffix sums along the leaves' paths, summed by node, are sums over
subtrees, without a step for each depth.

Defined results: null roles and texts are empty; null turns come first, turns with one
number in the order of role and text digest; repeated rows are turns of their own; rows
without a conversation belong to none and are left out; conversations without turns end
at the root; a conversation's family is its id less the remainder by 20, with the
remainder's sign that of the id; an empty table gives an empty table; other columns are
not read. Prefixes are told apart by 128-bit digests of sums of SHA-256 digests.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from custodia.llm.common import n_words
from custodia.storage import stage

#: Conversations of a family, and how many turns at most one takes from the first of them, plus one.
FAMILY, BORROWED = 20, 4
#: Turns in a block of prefix sums.
BLOCK = 1024
#: Ends of a sequence in one row of text.
ENDS = 4096

LANES = ["a", "b", "c", "d"]
NODE = ["depth", "key"]


def _digest(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _key(lanes: list[Column]) -> Column:
    """A prefix's digest, from the sums of its lanes."""
    return F.unhex(F.md5(F.concat_ws(",", *[lane.cast("string") for lane in lanes])))


def root_key() -> Column:
    return _key([F.lit(0)] * len(LANES))


def ordered_turns(table: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), turn digest and number of words of every turn.

    Turns are sorted by ranges, so a conversation with a large share of all rows
    spreads over tasks; its rows in earlier ranges are then counted in.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    rows = table.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        _digest(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
        n_words(text).alias("words"),
    )
    order = ["conv_id", "turn", "role", "digest"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_ = stage(dealt.select("conv_id", "digest", "words", F.monotonically_increasing_id().alias("id")), "trie-sorted")
    ranged = sorted_.withColumn("range", F.shiftright("id", 33))
    counts = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    # One row for each range that a conversation lies in.
    earlier = W.partitionBy("conv_id").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    joined = ranged.join(stage(starts, "trie-starts"), ["conv_id", "range"])
    return joined.select("conv_id", (F.col("start") + F.col("id") - F.col("first")).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame, family: int = FAMILY, borrowed: int = BORROWED) -> tuple[DataFrame, DataFrame]:
    """Conversations as rebuilt: turns (conv_id, pos, length, digest, words), and (conv_id, length) of all.

    A conversation takes the first turns of its family's first one, and its own after as many.
    """
    sizes = stage(turns.groupBy("conv_id").agg(F.count("*").alias("n")), "trie-sizes")
    takes = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(borrowed))
    convs = sizes.select("conv_id", "n", takes.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("from"))
    given = sizes.select(F.col("conv_id").alias("from"), F.col("n").alias("n_from"))
    convs = convs.join(given, "from", "left").withColumn("k", F.least("h", F.coalesce("n_from", F.lit(0))))
    length = F.col("k") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    convs = stage(convs.select("conv_id", "from", "h", "k", length.alias("length")), "trie-conversations")
    own = turns.join(convs, "conv_id").filter("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "length", "digest", "words")
    heads = turns.filter(F.col("pos") < borrowed - 1).withColumnRenamed("conv_id", "from")
    taken = heads.join(convs, "from").filter("pos < h").select("conv_id", "pos", "length", "digest", "words")
    return own.unionByName(taken), convs.select("conv_id", "length")


def _block_sums(rows: DataFrame, owner: str, place: str, columns: list[str], backwards: bool = False) -> DataFrame:
    """Adds running sums of columns, as ``sum_<name>``, over an owner's rows in the order of ``place``.

    Sums run within blocks of bounded size; totals of the blocks before are added, of
    which an owner with few rows has none.
    """
    rows = rows.withColumn("block", F.floor(F.col(place) / BLOCK).cast("long"))
    order = F.col(place).desc() if backwards else F.col(place)
    inside = W.partitionBy(owner, "block").orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    totals = rows.groupBy(owner, "block").agg(*[F.sum(c).alias(f"total_{c}") for c in columns])
    by_block = F.col("block").desc() if backwards else F.col("block")
    earlier = W.partitionBy(owner).orderBy(by_block).rowsBetween(W.unboundedPreceding, -1)
    before = totals.select(owner, "block", *[F.sum(f"total_{c}").over(earlier).alias(f"before_{c}") for c in columns])
    # A first block has nothing before it.
    before = stage(before.filter(F.col(f"before_{columns[0]}").isNotNull()), "trie-blocks")
    summed = rows.select("*", *[F.sum(c).over(inside).alias(f"inside_{c}") for c in columns])
    joined = summed.join(before, [owner, "block"], "left")
    sums = {f"sum_{c}": F.col(f"inside_{c}") + F.coalesce(f"before_{c}", F.lit(0)) for c in columns}
    return joined.withColumns(sums).select(*[c for c in rows.columns if c != "block"], *sums)


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, length, depth, key, parent's key, and words of the last turn, of every prefix with a turn."""
    placed = F.sha2(F.concat("digest", F.col("pos").cast("string").cast("binary")), 256)
    hashed = turns.withColumn("hex", placed)
    lanes = [F.conv(F.substring("hex", 1 + 8 * i, 8), 16, 10).cast("long").alias(x) for i, x in enumerate(LANES)]
    summed = _block_sums(hashed.select("conv_id", "pos", "length", "words", *lanes), "conv_id", "pos", LANES)
    return summed.select(
        "conv_id",
        "length",
        (F.col("pos") + 1).alias("depth"),
        _key([F.col(f"sum_{x}") for x in LANES]).alias("key"),
        _key([F.col(f"sum_{x}") - F.col(x) for x in LANES]).alias("parent"),
        "words",
    )


def ends_digests(finals: DataFrame) -> DataFrame:
    """Per sequence the digest of its conversations' ids: depth, key, ends_sha256.

    Ids are sorted by ranges and joined into texts of bounded size. A digest is sequential by
    nature, so a sequence's texts are streamed through one task.
    """
    order = [*NODE, "conv_id"]

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids = None, 0, []
        out: list[tuple] = []

        def close() -> None:
            if ids:
                out.append((*node, first, ",".join(ids)))

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            for depth, key, conv in zip(*columns, strict=True):
                if (depth, key) != node or len(ids) == ENDS:
                    close()
                    node, first, ids = (depth, key), conv, []
                ids.append(str(conv))
            if out:
                yield _batch(out, texts)
                out = []
        close()
        if out:
            yield _batch(out, texts)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for depth, key, _, ids in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if (depth, key) == node:
                    sha.update(b",")
                else:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = (depth, key), hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield _batch(out, digests)
        if node:
            yield _batch([(*node, sha.hexdigest())], digests)

    node_fields = [("depth", pa.int64()), ("key", pa.binary())]
    texts = pa.schema([*node_fields, ("first", pa.int64()), ("ids", pa.string())])
    digests = pa.schema([*node_fields, ("ends_sha256", pa.string())])
    dealt = finals.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = dealt.mapInArrow(join_ids, "depth long, key binary, first long, ids string")
    together = joined.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return together.mapInArrow(digest, "depth long, key binary, ends_sha256 string")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def prefix_trie(table: DataFrame) -> DataFrame:
    """The nodes: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(stage(ordered_turns(table), "trie-turns"))
    paths = stage(prefixes(turns), "trie-prefixes")

    # Identical conversations are one sequence, for which its smallest member stands.
    finals = paths.filter("depth = length").select("conv_id", *NODE)
    turnless = convs.filter("length = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), root_key().alias("key"))
    finals = stage(finals.unionByName(turnless), "trie-ends")
    sequences = finals.groupBy(*NODE).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"))
    sequences = stage(sequences, "trie-sequences")
    own = paths.join(sequences.select("conv_id", "weight"), "conv_id")
    at_root = sequences.select(
        "conv_id",
        F.col("depth").alias("length"),
        F.lit(0).cast("long").alias("depth"),
        root_key().alias("key"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(0).cast("long").alias("words"),
        "weight",
    )
    own = stage(own.unionByName(at_root), "trie-paths")

    # Leaves: sequences that are no proper prefix of another one.
    proper = own.filter("depth < length").select(*NODE).distinct()
    leaves = stage(sequences.join(proper, NODE, "left_anti").select("conv_id"), "trie-leaves")
    down = stage(own.join(leaves, "conv_id", "left_semi").select("conv_id", *NODE), "trie-down")

    # Weighted prefixes are nodes; each is charged to the leaf with the smallest conversation.
    nodes = own.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.max("parent").alias("parent"),
        F.max("words").alias("words"),
    )
    below = down.groupBy(*NODE).agg(F.count("*").alias("n_leaves"), F.min("conv_id").alias("leaf"))
    nodes = stage(nodes.join(below, NODE), "trie-nodes")
    charges = nodes.select(F.col("leaf").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("charge"))
    charged = down.join(charges, ["conv_id", "depth"], "left").withColumn("charge", F.coalesce("charge", F.lit(0)))
    suffixes = _block_sums(charged, "conv_id", "depth", ["charge"], backwards=True)
    saved = suffixes.groupBy(*NODE).agg(F.sum("sum_charge").alias("saved_tokens"))

    inner = nodes.filter("depth > 0")
    above = [(F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")]
    children = inner.groupBy(*above).agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id")
    )
    found = nodes.join(stage(parents, "trie-parents"), ["depth", "parent"], "left")
    found = found.join(saved, NODE).join(children, NODE, "left").join(ends_digests(finals), NODE, "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
