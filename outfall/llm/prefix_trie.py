"""A trie of conversation prefixes from vertical bitmaps.

A turn is a 128-bit digest of its role and text. Conversations are dealt into shards by ranges of
their ids. In a shard, every place and turn has a bitset of the conversations that have that turn
there. The trie of the shard is walked depth first: the children of a node are its bitset
intersected with the postings of the next place, as many intersections as there are children, and
what is left over are the conversations that end there. Places come in blocks, so a task holds a shard's
bitsets for one block, however long its conversations are.

Nodes are known by a digest chained over their turns, so those of all shards are added up by it. For sums
over subtrees, a node belongs to its member with the smallest id. The nodes of one member are a chain,
and chains hang from chains; their sums go up in rounds that double the distance, and then along each
chain. Lists of ends are packed by shard and hashed as a stream in order.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from outfall.llm.words import BROADCAST_ROWS, WORD, small, whole_text
from outfall.session import settle

#: Conversation ids in a shard, as a power of two, and places in a block.
SHARD_BITS = 10
BLOCK = 64
#: Rows that are handed on at once.
_ROWS = 20_000
ROOT = bytes(16)
_LOCAL = "key binary, parent binary, depth long, n long, first long, tokens long, shard long, ends string"
_NAMES = [c.split()[0] for c in _LOCAL.split(", ")]


def turn_digest(role: Column, text: Column) -> Column:
    """128 bits of role and text; the role's length keeps the two apart."""
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.md5(named.cast("binary")))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` from 1, ``digest`` and ``tokens`` of every turn that has a conversation."""
    role, text = whole_text(F.col("role")), whole_text(F.col("text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        turn_digest(role, text).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest")
    return turns.withColumn("pos", F.row_number().over(order).cast("long")).drop("turn")


def with_shared_starts(turns: DataFrame, group: int, starts: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Conversations that begin like the first one of their ``group`` ids, and go on as they were.

    The first h turns of conversation c are those of c - c % ``group``, h being the crc32 of c's decimals modulo
    ``starts``; all of them if there are fewer, none if there is no such conversation. Every conversation
    also has a row with ``pos`` 0, so that one without turns is not lost.
    """
    turn = F.struct("pos", "digest", "tokens")
    given = turns.filter((F.col("conv_id") % group == 0) & (F.col("pos") < starts))
    given = given.groupBy(F.col("conv_id").alias("_from")).agg(F.sort_array(F.collect_list(turn)).alias("_given"))
    rows = turns.withColumn("_from", F.col("conv_id") - F.col("conv_id") % group)
    rows = rows.withColumn("_h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % starts)
    kind = "array<struct<pos:bigint,digest:binary,tokens:bigint>>"
    taken = F.slice(F.coalesce(F.col("_given"), F.array().cast(kind)), 1, F.col("_h").cast("int"))
    rows = rows.join(small(settle(given), max_rows), "_from", "left").withColumn("_taken", taken)
    own = F.struct((F.size("_taken") + F.col("pos") - F.col("_h")).alias("pos"), "digest", "tokens")
    nothing = F.array().cast(kind)
    mark = F.array(F.struct(F.lit(0).cast("long").alias("pos"), F.lit(ROOT).alias("digest"), F.lit(0).cast("long").alias("tokens")))
    # The first row of a conversation brings what it begins with.
    every = F.concat(
        F.when(F.col("pos") == 1, F.concat(mark, F.col("_taken"))).otherwise(nothing),
        F.when(F.col("pos") > F.col("_h"), F.array(own)).otherwise(nothing),
    )
    return rows.select("conv_id", F.explode(every).alias("_t")).select("conv_id", "_t.*")


def _bits(members: int) -> Iterator[int]:
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


class _Shard:
    """The walk through one shard's trie, block by block."""

    def __init__(self, shard: int):
        self._shard = shard
        #: Nodes whose children lie in the next block: key, depth, members.
        self._open: list[tuple[bytes, int, int]] = []

    def walk(self, rows: Iterable[tuple[int, int, bytes, int]], end: int | None) -> Iterator[tuple]:
        """Nodes and lists of ends, from the rows (place, member, digest, tokens) of places up to ``end``.

        Without ``end``, all conversations are over.
        """
        postings: dict[tuple[int, bytes], int] = defaultdict(int)
        turn_of: dict[tuple[int, int], tuple[bytes, int]] = {}
        present: dict[int, int] = defaultdict(int)
        for pos, member, digest, tokens in rows:
            bit = 1 << member
            postings[pos, digest] |= bit
            present[pos] |= bit
            turn_of[pos, member] = digest, tokens
        base = self._shard << SHARD_BITS
        if present.get(0):
            members = present[0]
            yield ROOT, None, 0, members.bit_count(), base | next(_bits(members)), 0, self._shard, None
            self._open.append((ROOT, 0, members))
        stack, self._open = self._open[::-1], []
        while stack:
            key, depth, members = node = stack.pop()
            if depth == end:
                self._open.append(node)
                continue
            depth += 1
            rest = members & present.get(depth, 0)
            if ended := members & ~rest:
                yield key, None, None, None, None, None, self._shard, ",".join([str(base | i) for i in _bits(ended)])
            children = []
            while rest:
                least = (rest & -rest).bit_length() - 1
                digest, tokens = turn_of[depth, least]
                child = rest & postings[depth, digest]
                rest ^= child
                name = hashlib.md5(key + digest, usedforsecurity=False).digest()
                yield name, key, depth, child.bit_count(), base | least, tokens, self._shard, None
                children.append((name, depth, child))
            stack += children[::-1]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def local_tries(turns: DataFrame) -> DataFrame:
    """Nodes (``n`` members, the ``first`` of them) and lists of ends (``ends`` not null) of every shard."""
    member = F.col("conv_id").bitwiseAND(F.lit((1 << SHARD_BITS) - 1))
    placed = turns.select(
        F.shiftright("conv_id", SHARD_BITS).alias("shard"), "pos", member.alias("member"), "digest", "tokens"
    )
    placed = placed.repartition("shard").sortWithinPartitions("shard", "pos", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []

        def found() -> Iterator[tuple]:
            shard, trie, held, end = None, None, [], BLOCK
            for at, *row in _rows(batches):
                if at != shard:
                    if trie is not None:
                        yield from trie.walk(held, None)
                    shard, trie, held, end = at, _Shard(at), [], BLOCK
                while row[0] > end:
                    yield from trie.walk(held, end)
                    held, end = [], end + BLOCK
                held.append(row)
            if trie is not None:
                yield from trie.walk(held, None)

        schema = pa.schema(list(zip(_NAMES, [pa.binary()] * 2 + [pa.int64()] * 5 + [pa.string()], strict=True)))
        for row in found():
            done.append(row)
            if len(done) >= _ROWS or row[-1] and len(row[-1]) > 1_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)
                done = []
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)

    return placed.mapInArrow(run, _LOCAL)


def hashed_ends(lists: DataFrame) -> DataFrame:
    """``key`` and ``ends_sha256`` of all lists of a key, joined in the order of their shards."""
    ordered = lists.select("key", "shard", "ends").repartition("key").sortWithinPartitions("key", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done = []
            for name, _, ends in _rows(iter([batch])):
                if name == key:
                    state.update(b"," + ends.encode())
                    continue
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = name, hashlib.sha256(ends.encode())
            yield _hashes(done)
        if key is not None:
            yield _hashes([(key, state.hexdigest())])

    def _hashes(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
        columns = [pa.array([k for k, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["key", "ends_sha256"])

    return ordered.mapInArrow(run, "key binary, ends_sha256 string")


def subtree_totals(chains: DataFrame, root: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``chains`` (``chain``, ``parent``, sums) with the sums of all chains below added to each.

    After round k every chain has the sums of those fewer than 2^k steps below it, and
    ``_up`` is its ancestor 2^k steps above. No chain is above that of ``root``.
    """
    sums = ["leaves", "saved"]
    state = settle(chains.withColumn("_up", F.col("parent")))
    while not state.filter(F.col("_up").isNotNull()).isEmpty():
        below = state.filter(F.col("_up").isNotNull()).groupBy(F.col("_up").alias("chain")).agg(*[F.sum(s).alias(f"_{s}") for s in sums])
        # Most chains hang from that of the root, which ends their way.
        ups = small(settle(state.filter(F.col("_up") != root).select(F.col("chain").alias("_up"), F.col("_up").alias("_next"))), max_rows)
        onward = F.when(F.col("_up") != root, F.col("_up"))
        state = settle(
            state.join(small(settle(below), max_rows), "chain", "left")
            .withColumn("_up", onward)
            .join(ups, "_up", "left")
            .select("chain", "parent", "head", *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums], F.col("_next").alias("_up"))
        )
    return state.drop("_up")


def trie_nodes(turns: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """All nodes of the trie of ``turns`` (``conv_id``, ``pos`` from 1 without gaps, ``digest``, ``tokens``).

    Every conversation has a row with ``pos`` 0 as well. Returns, per node, ``conv_id`` (its smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``. No conversation gives no node, not even the root.
    """
    local = settle(local_tries(turns))
    nodes = local.filter(F.col("ends").isNull()).groupBy("key").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.sum("n").alias("n_convs"),
        F.min("first").alias("conv_id"), F.max("tokens").alias("tokens"),
    )
    nodes = settle(nodes)
    first = nodes.filter(F.col("depth") == 0).select("conv_id").first()
    root = first[0] if first else 0
    children = nodes.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    ends = hashed_ends(local.filter(F.col("ends").isNotNull()))
    nodes = nodes.join(children, "key", "left").join(ends, "key", "left")
    nodes = settle(
        nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("tokens"))
    )
    chains = nodes.groupBy(F.col("conv_id").alias("chain")).agg(
        F.min("depth").alias("head"), F.min_by("parent", "depth").alias("key"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )
    chains = settle(chains)
    # Below the first turn, a chain hangs from the owner of the node above its head.
    deep = chains.filter(F.col("head") > 1)
    wanted = settle(deep.select("key").distinct())
    owners = settle(nodes.select("key", F.col("conv_id").alias("parent")).join(small(wanted, max_rows), "key", "left_semi"))
    deep = deep.join(small(owners, max_rows), "key").drop("key")
    top = chains.filter(F.col("head") <= 1).withColumn("parent", F.when(F.col("head") == 1, F.lit(root).cast("long"))).drop("key")
    totals = subtree_totals(top.unionByName(deep), root, max_rows)

    hung = totals.filter(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("conv_id"), (F.col("head") - 1).alias("depth"))
    hung = hung.agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
    heads = totals.select(F.col("chain").alias("conv_id"), F.col("head"), F.col("parent").alias("_parent"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth"))

    def along(name: str) -> Column:
        return F.sum(F.col(name) + F.coalesce(f"_{name}", F.lit(0))).over(below)

    return (
        nodes.join(hung, ["conv_id", "depth"], "left")
        .join(small(settle(heads), max_rows), "conv_id")
        .select(
            "conv_id", "depth",
            F.when(F.col("depth") == F.col("head"), F.col("_parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            "n_convs", "n_children", along("leaves").alias("n_leaves"), along("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame, group: int = 20, starts: int = 4, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The trie of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``) that were given shared starts.

    Turns are ordered by ``turn``, null first; equal ones by their digest, so that the result does not depend on
    the order of rows. A null role or text is empty; rows that repeat are turns of their own; rows without a
    ``conv_id`` belong to no conversation and are left out. Other columns are not read.
    """
    return trie_nodes(with_shared_starts(ordered_turns(conversations), group, starts, max_rows), max_rows)
