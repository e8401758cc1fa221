"""Trie of conversation prefixes, with sharing counts per node.

Method: vertical bitmaps. Conversations are dealt into shards of neighbouring ids. A shard indexes each
(position, turn) to the bitset of its conversations that have this turn there. From the bitset of all, a depth-first walk
intersects a node's bitset with the postings of the next position: what is left are its children, the
bits are its members, and the conversations that end there its end list. Nodes of all shards meet under the
hash of their prefix (128 bits of a cryptographic hash, chained turn by turn): counts add up, and the end lists, each
a stretch of neighbouring ids, follow one another into the digest.

Subtree sums: a node belongs to the smallest id among its members, and the nodes of one owner form a chain that hangs from
a node of a smaller id. So a node is (owner, depth), its subtree is the rest of its chain and the chains that
hang from it, and chains are added up along their ancestors at distance 1, 2, 4, ...: rounds grow with the
logarithm of the nesting of chains, not with the length of conversations.

Scale: texts become digests and word counts in the scan; only those are shuffled. A prefix that a third of all
conversations share is one row per shard, combined map-side. A conversation's turns are sorted, numbered and walked as a
stream: what a shard holds is bounded, longer conversations go on as a chain (``_Shard``). The digest of one end list is
one stream by definition; it passes through a task, one row per shard, and is never held.

Edge cases: turns are ordered by ``turn`` (null first), equal ones by their digest; null role and text are empty; repeated
rows are turns of their own; rows without a conversation id belong to no conversation; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.llm.storage import written
from boreal.llm.worker import claim

ROOT = b"\0" * 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Ids of a shard, and the turns that one holds at once.
WIDTH, MAX_TURNS = 1280, 1 << 16


def ordered_turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, pos, key, words): every turn's place in its conversation (from 1), digest and number of words."""
    role_, text_ = (F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in (role, text))
    # the role's length keeps role and text apart
    key = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length(role_).cast("string"), role_, text_), 256), 1, 32))
    rows = conversations.filter(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"), key.alias("key"),
        F.regexp_count(text_, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "key")
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "key", "words")


def with_shared_heads(turns: DataFrame, family: int, head: Column, longest: int) -> DataFrame:
    """Every conversation c with its first ``head`` (of ``conv_id``, at most ``longest``) turns replaced by those of conversation
    c - c % family: (conv_id, pos, key, words) in the order of ``pos``, which may skip numbers, and one row of
    position 0 without a key per conversation, also of those left without turns."""
    turns = written(turns, "turns")
    every = turns.filter("pos = 1").select("conv_id", head.cast("long").alias("head"))
    host = turns.filter((F.col("pos") <= longest) & (F.col("conv_id") % family == 0)).select(
        F.col("conv_id").alias("host"), "pos", "key", "words")
    given = every.filter("head > 0").withColumn("host", F.col("conv_id") - F.col("conv_id") % family).join(
        host, "host").filter("pos <= head").select("conv_id", "pos", "key", "words")
    own = turns.filter(F.col("pos") > head).withColumn("pos", F.col("pos") + longest)
    mark = every.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("key"),
                        F.lit(0).cast("long").alias("words"))
    return own.unionByName(given).unionByName(mark)


def _chained(node: bytes, key: bytes) -> bytes:
    return hashlib.blake2b(node + key, digest_size=16).digest()


class _Shard:
    """The conversations of a shard, at most ``max_turns`` turns of them and of each; gives rows of nodes."""

    def __init__(self, max_turns: int):
        self.max_turns = max_turns
        self.rows: list[tuple] = []  # node, parent, depth, conv_id, n_convs, words, first_end, ends
        self.tail: tuple | None = None  # the last node of a conversation that goes on beyond max_turns
        self.clear()

    def clear(self) -> None:
        self.ids: list[int] = []
        self.turns: list[list[int]] = []
        self.whole: list[bool] = []  # whether the conversation ends with its turns here
        self.names: dict[bytes, int] = {}
        self.words: list[int] = []
        self.held = 0

    def begin(self, conv_id: int) -> None:
        self.end()
        if self.held >= self.max_turns:
            self.walk()
        self.ids.append(conv_id)
        self.turns.append([])
        self.whole.append(True)

    def add(self, key: bytes, words: int) -> None:
        turns = self.turns[-1]
        if len(turns) < self.max_turns:
            name = self.names.setdefault(key, len(self.names))
            if name == len(self.words):
                self.words.append(words)
            turns.append(name)
            self.held += 1
            return
        if self.tail is None:
            self.whole[-1] = False
            keys, node = list(self.names), ROOT
            for name in turns:
                node = _chained(node, keys[name])
            depth = len(turns)
        else:
            self.rows.append(self.tail)
            node, depth = self.tail[0], self.tail[2]
        self.tail = (_chained(node, key), node, depth + 1, self.ids[-1], 1, words, None, None)

    def end(self) -> None:
        """The last conversation has no more turns."""
        if self.tail is not None:
            self.rows.append((*self.tail[:6], self.ids[-1], str(self.ids[-1])))
            self.tail = None

    def walk(self) -> None:
        """Rows of all nodes of the conversations held, which are then let go."""
        self.end()
        ids, turns = self.ids, self.turns
        postings: dict[tuple[int, int], int] = {}
        ending: dict[int, int] = {}
        going_on: dict[int, int] = {}
        for i, names in enumerate(turns):
            bit = 1 << i
            for at, name in enumerate(names):
                postings[at, name] = postings.get((at, name), 0) | bit
            last = ending if self.whole[i] else going_on
            last[len(names)] = last.get(len(names), 0) | bit
        keys = list(self.names)
        stack = [((1 << len(ids)) - 1, 0, ROOT, None, 0)] if ids else []
        while stack:
            members, depth, node, parent, words = stack.pop()
            first = ids[(members & -members).bit_length() - 1]
            ends, here = [], members & ending.get(depth, 0)
            rest = members & ~here & ~going_on.get(depth, 0)
            while here:
                low = here & -here
                ends.append(ids[low.bit_length() - 1])
                here ^= low
            self.rows.append((node, parent, depth, first, members.bit_count(), words, ends[0] if ends else None,
                              ",".join(map(str, ends)) if ends else None))
            while rest:
                name = turns[(rest & -rest).bit_length() - 1][depth]
                child = members & postings[depth, name]
                rest &= ~child
                stack.append((child, depth + 1, _chained(node, keys[name]), node, self.words[name]))
        self.clear()


NODES = ("node binary, parent binary, depth long, conv_id long, n_convs long, words long, first_end long, ends string")
_ARROW = pa.schema([("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("conv_id", pa.int64()),
                    ("n_convs", pa.int64()), ("words", pa.int64()), ("first_end", pa.int64()), ("ends", pa.string())])


def shard_nodes(turns: DataFrame, width: int = WIDTH, max_turns: int = MAX_TURNS) -> DataFrame:
    """The nodes of every shard of ``width`` ids with their members there; a node comes once per shard, or more
    often where conversations pass ``max_turns``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("conversation_trie")
        shard, number, conv = _Shard(max_turns), None, None
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("shard", "conv_id", "key", "words"))
            for at, c, key, words in zip(*columns):
                if at != number:
                    shard.walk()
                    number, conv = at, None
                if c != conv:
                    shard.begin(c)
                    conv = c
                if key is not None:
                    shard.add(key, words)
                if len(shard.rows) >= 1 << 14:
                    yield _batch(shard.rows)
        shard.walk()
        yield _batch(shard.rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _ARROW)] if rows else [
            pa.array([], t.type) for t in _ARROW], schema=_ARROW)
        rows.clear()
        return out

    dealt = turns.withColumn("shard", F.floor(F.col("conv_id") / width)).repartition("shard")
    return dealt.sortWithinPartitions("shard", "conv_id", "pos").select("shard", "conv_id", "key", "words").mapInArrow(run, NODES)


def end_digests(shards: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end: the shards' lists pass in ascending order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("conversation_trie")
        node, digest = None, None
        for batch in batches:
            done = []
            for at, ends in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if at == node:
                    digest.update(b"," + ends.encode())
                    continue
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = at, hashlib.sha256(ends.encode())
            yield pa.RecordBatch.from_pydict({"node": pa.array([d[0] for d in done], pa.binary()),
                                              "ends_sha256": pa.array([d[1] for d in done], pa.string())})
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.binary()), "ends_sha256": [digest.hexdigest()]})

    lists = shards.filter("ends IS NOT NULL").select("node", "first_end", "ends")
    return (lists.repartition("node").sortWithinPartitions("node", "first_end").select("node", "ends")
            .mapInArrow(run, "node binary, ends_sha256 string"))


def chain_totals(chains: DataFrame) -> DataFrame:
    """``chains`` (conv_id, above: the chain it hangs from, leaves, saved) with leaves and saved summed over all that hang
    below, directly or not: ancestors at distance 1, 2, 4, ... each receive what has been summed so far."""
    while True:
        chains = written(chains, "chains")
        hanging = chains.filter("above IS NOT NULL")
        if hanging.isEmpty():
            return chains.drop("above")
        below = hanging.groupBy(F.col("above").alias("conv_id")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = chains.select(F.col("conv_id").alias("above"), F.col("above").alias("further"))
        chains = chains.join(below, "conv_id", "left").join(further, "above", "left").select(
            "conv_id", F.col("further").alias("above"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"))


def prefix_trie(turns: DataFrame, width: int = WIDTH, max_turns: int = MAX_TURNS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos, key, words; a conversation without turns is a row without a
    key): conv_id (smallest member), depth, parent_conv_id (the parent's conv_id), n_convs, n_children, n_leaves, saved_tokens
    (words that members after the first would repeat, over the subtree), ends_sha256."""
    shards = written(shard_nodes(turns, width, max_turns), "trie-shards")
    nodes = shards.groupBy("node").agg(
        F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"), F.min("words").alias("words")).join(end_digests(shards), "node", "left")
    nodes = written(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("words")), "trie-nodes")

    owned = nodes.groupBy("conv_id").agg(F.min(F.struct("depth", "parent")).alias("top"), F.max("depth").alias("last"),
                                         F.sum("saved").alias("saved"))
    shared = nodes.filter("n_convs > 1").select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    chains = written(owned.select("conv_id", "last", "saved", F.col("top.depth").alias("start"), F.col("top.parent").alias("parent"))
                     .join(shared, "parent", "left").drop("parent"), "chains")
    hung = chains.filter("above IS NOT NULL").select(F.col("above").alias("conv_id"), (F.col("start") - 1).alias("last")).distinct()
    leaf = chains.join(hung.withColumn("hung", F.lit(True)), ["conv_id", "last"], "left").select(
        "conv_id", "above", F.col("hung").isNull().cast("long").alias("leaves"), "saved", "start", "last")
    leaf = written(leaf, "chains")
    totals = chain_totals(leaf.select("conv_id", "above", "leaves", "saved"))
    hanging = (leaf.filter("above IS NOT NULL").select("conv_id", "above", (F.col("start") - 1).alias("depth"))
               .join(totals, "conv_id").groupBy(F.col("above").alias("conv_id"), "depth")
               .agg(F.count(F.lit(1)).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))

    # what happens at (owner, depth): the node itself, the start of the chain, its childless end, chains that hang there
    blank = {"node": "boolean", "n_convs": "long", "ends_sha256": "string", "start": "boolean", "above": "long",
             "children": "long", "leaves": "long", "saved": "long"}

    def event(df: DataFrame, **columns: Column) -> DataFrame:
        return df.select("conv_id", columns.pop("depth", F.col("depth")).alias("depth"), *(
            columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in blank.items()))

    events = event(nodes, node=F.lit(True), **{c: F.col(c) for c in ("n_convs", "ends_sha256", "saved")}).unionByName(
        event(leaf, depth=F.col("start"), start=F.lit(True), above=F.col("above"))).unionByName(
        event(leaf.filter("leaves > 0"), depth=F.col("last"), leaves=F.col("leaves"))).unionByName(
        event(hanging, **{c: F.col(c) for c in ("children", "leaves", "saved")}))
    chain = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    below, here = chain.rangeBetween(Window.unboundedPreceding, 0), chain.rangeBetween(0, 0)

    def total(column: str, over) -> Column:
        return F.coalesce(F.sum(column).over(over), F.lit(0)).cast("long").alias(column)

    out = events.select(
        "node", "conv_id", "depth", "n_convs", "ends_sha256",
        F.max("start").over(here).alias("start"), F.max("above").over(here).alias("above"), F.max("depth").over(below).alias("last"),
        total("children", here), total("leaves", below), total("saved", below)).filter("node")
    return out.select(
        "conv_id", "depth", F.when(F.col("start"), F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"), "n_convs",
        (F.col("children") + (F.col("depth") < F.col("last")).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))
