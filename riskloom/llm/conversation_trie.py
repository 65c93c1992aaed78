"""Prefix trie of conversations: double-array tries over shards of sorted turn sequences, merged over shards."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import common as C
from riskloom.session import discard, settle

#: Turns of a conversation that travel as one row; longer conversations are cut into levels of so many turns.
LEVEL_TURNS = 256
#: Turns that one trie holds at most (and one sequence more).
SHARD_TURNS = 1 << 20
#: Ids that a list is cut into where it reaches beyond its task.
BLOCK_IDS = 4096
STEP = np.dtype("V16")
KEY = ("depth", "x1", "x2")


# --- turns in their order -------------------------------------------------------------------------------------------


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of every turn among those of its conversation in this sorted run."""
    run, last, held = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        conv = np.asarray(batch.column("conv_id"))
        if not len(conv):
            continue
        starts = np.flatnonzero(C.run_starts(conv))
        begin = np.repeat(starts, np.diff(np.append(starts, len(conv))))
        at = np.arange(len(conv)) - begin
        if conv[0] == last:
            at[begin == 0] += held
        last, held = conv[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(conv), run, np.int32)), batch.column("conv_id"), pa.array(at), batch.column("step"), batch.column("size")],
            ["run", "conv_id", "at", "step", "size"])


def ordered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``turns`` (conv_id, at, step, size) with places from 0, and ``counts`` (conv_id, n).

    Turns are dealt by ranges of their whole order, so that a conversation may fill any number of tasks; a run then only
    needs the number of turns that its first conversation has in earlier runs.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "step", "place"]
    runs = settle(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("step"),
            F.octet_length(text).cast("long").alias("size"), F.monotonically_increasing_id().alias("place"))
        .repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "step", "size")
        .mapInArrow(_numbered, "run int, conv_id long, at long, step binary, size long"), "turns")
    parts = runs.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1))
    # at most one conversation of a run began in another, so there are fewer rows than runs
    begun = parts.select("conv_id", "run", before.alias("before")).where("before > 0")
    turns = runs.join(F.broadcast(begun), ["conv_id", "run"], "left").select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("at"), "step", "size")
    turns._settled_path = runs._settled_path
    return turns, parts.groupBy("conv_id").agg(F.sum("n").alias("n"))


def rebuilt(turns: DataFrame, counts: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings: the first h turns are those of the first conversation of a group of ids.

    h is the checksum of the id modulo ``most``. Returns ``steps`` (conv_id, pos, step, size, total) and ``totals``
    (conv_id, total), the latter with every conversation.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = F.crc32(F.col("conv_id").cast("string")) % most
    plan = counts.select("conv_id", "n", base.alias("base"), heads.alias("h"))
    whole = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = plan.join(whole, "base", "left").withColumn("lead", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = settle(plan.select("conv_id", "base", "h", "lead", (F.col("lead") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "plan")
    own = turns.join(plan, "conv_id").where("at >= h").select("conv_id", (F.col("lead") + F.col("at") - F.col("h")).alias("pos"), "step", "size", "total")
    openings = turns.where((F.col("at") < most - 1) & (F.col("conv_id") == base)).withColumnRenamed("conv_id", "base")
    given = openings.join(plan, "base").where("at < h").select("conv_id", F.col("at").alias("pos"), "step", "size", "total")
    totals = plan.select("conv_id", "total")
    totals._settled_path = plan._settled_path
    return own.unionByName(given), totals


# --- sequences ------------------------------------------------------------------------------------------------------


def _flat(column: pa.Array, kind: np.dtype | type) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-width values packed in binaries, and the offsets of each binary's values."""
    raw, at = C.bytes_of(column)
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw.tobytes(), kind), at // width


def _digests(steps: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Two numbers per turn and place; a prefix is known by the exclusive or of those of its turns."""
    halves = steps.view(np.uint64).reshape(-1, 2)
    place = C.mixed(pos.astype(np.uint64) + np.uint64(1))
    return np.stack([C.mixed(halves[:, 0] ^ place), C.mixed(halves[:, 1] + place)])


def _within(values: np.ndarray, at: np.ndarray, op) -> np.ndarray:
    """Running ``op`` within each range of offsets, the value itself included (xor or sum: both have an inverse)."""
    run = op.accumulate(values, axis=-1)
    starts = np.repeat(at[:-1], np.diff(at))
    before = np.where(starts > 0, run[..., np.maximum(starts - 1, 0)], 0)
    return run ^ before if op is np.bitwise_xor else run - before


def _last(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The last of the running values of each range, 0 for empty ones."""
    return np.where(at[1:] > at[:-1], values[..., np.maximum(at[1:] - 1, 0)], 0) if values.shape[-1] else np.zeros((*values.shape[:-1], len(at) - 1), values.dtype)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gathered turns of each level in order, as binaries, with the digest and bytes of them all."""
    for batch in batches:
        turns = batch.column("turns")
        at = np.asarray(turns.offsets, dtype=np.int64)
        at, part = at - at[0], turns.flatten()
        pos = np.asarray(part.field("pos"), dtype=np.int64)
        order = np.lexsort((pos, np.repeat(np.arange(len(at) - 1), np.diff(at))))
        steps = np.frombuffer(C.bytes_of(part.field("step"))[0].tobytes(), STEP)[order]
        sizes = np.asarray(part.field("size"), dtype=np.int64)[order]
        x = _last(_within(_digests(steps, pos[order]), at, np.bitwise_xor), at)
        size = _last(_within(sizes, at, np.add), at)
        pairs = list(zip(at[:-1].tolist(), at[1:].tolist()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("level"), batch.column("total"), pa.array([steps[a:b].tobytes() for a, b in pairs], pa.binary()),
             pa.array([sizes[a:b].tobytes() for a, b in pairs], pa.binary()), pa.array(x[0].view(np.int64)), pa.array(x[1].view(np.int64)), pa.array(size)],
            ["conv_id", "level", "total", "steps", "sizes", "x1", "x2", "bytes"])


def sequences(steps: DataFrame, totals: DataFrame, level_turns: int) -> DataFrame:
    """One row per conversation and level of ``level_turns`` turns: its turns, and the prefix before and up to its end."""
    level = F.floor(F.col("pos") / level_turns).cast("long")
    gathered = steps.groupBy("conv_id", level.alias("level")).agg(F.max("total").alias("total"), F.collect_list(F.struct("pos", "step", "size")).alias("turns"))
    silent = totals.where("total = 0").select("conv_id", F.lit(0).cast("long").alias("level"), "total", F.array().cast(gathered.schema["turns"].dataType).alias("turns"))
    cut = settle(gathered.unionByName(silent).mapInArrow(
        _packed, "conv_id long, level long, total long, steps binary, sizes binary, x1 long, x2 long, bytes long"), "sequences")
    earlier = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    is_long = F.col("total") > level_turns
    anchors = cut.where(is_long).select(
        "conv_id", "level", *(F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"a{c[1]}") for c in ("x1", "x2")),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before"))
    zero = F.lit(0).cast("long")
    whole = cut.where(~is_long).select("*", zero.alias("a1"), zero.alias("a2"), zero.alias("before"))
    placed = whole.unionByName(cut.where(is_long).join(anchors, ["conv_id", "level"]))
    out = placed.select(
        "conv_id", "level", "steps", "sizes", "a1", "a2", "before", F.least("total", (F.col("level") + 1) * level_turns).alias("depth"),
        F.col("a1").bitwiseXOR(F.col("x1")).alias("x1"), F.col("a2").bitwiseXOR(F.col("x2")).alias("x2"),
        (F.col("before") + F.col("bytes")).alias("bytes"), (F.col("total") <= (F.col("level") + 1) * level_turns).alias("last"))
    out._settled_path = cut._settled_path
    return out


# --- the trie of a shard --------------------------------------------------------------------------------------------


class DoubleArray:
    """A trie in two arrays: the child of slot s by symbol c is ``base[s] + c``, if ``check`` there holds s.

    Built from symbol sequences (numbers from 0, flat, with offsets); slot 0 is the root.
    """

    def __init__(self, symbols: np.ndarray, at: np.ndarray):
        parent, symbol = self._edges(symbols, at)
        order = np.argsort(parent, kind="stable")
        owners, first, number = np.unique(parent[order], return_index=True, return_counts=True)
        bases, slots = np.zeros(len(parent) + 1, np.int64), np.zeros(len(parent) + 1, np.int64)
        used, free_from = np.zeros(2 * len(parent) + 2, bool), 1
        used[0] = True
        several = np.flatnonzero(number > 1)
        for k in several[np.argsort(-number[several], kind="stable")].tolist():
            own = symbol[order[first[k]:first[k] + number[k]]]
            low, span = int(own.min()), own - own.min()
            while used[free_from]:
                free_from += 1
            if free_from + int(span.max()) + 64 >= len(used):
                used = np.append(used, np.zeros(max(len(used), int(span.max()) + 64), bool))
            near = np.flatnonzero(~used[free_from:free_from + 4 * len(own) + 64]) + free_from
            spot = next((f for f in near[:64].tolist() if f + int(span.max()) < len(used) and not used[f + span].any()), None)
            if spot is None:
                spot = int(np.flatnonzero(used)[-1]) + 1
                if spot + int(span.max()) + 64 >= len(used):
                    used = np.append(used, np.zeros(max(len(used), int(span.max()) + 64), bool))
            used[spot + span] = True
            bases[owners[k]] = spot - low
        alone = np.flatnonzero(number == 1)
        free = np.flatnonzero(~used)
        if len(free) < len(alone):
            free = np.append(free, np.arange(len(used), len(used) + len(alone) - len(free)))
        bases[owners[alone]] = free[:len(alone)] - symbol[order[first[alone]]]
        slots[1:] = bases[parent] + symbol
        self.base = np.zeros(int(slots.max()) + 1, np.int64)
        self.check = np.full(len(self.base), -1, np.int64)
        self.base[slots] = bases
        self.check[slots[1:]] = slots[parent]

    @staticmethod
    def _edges(symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parent and symbol of the nodes 1, 2, 3..., breadth first."""
        sizes, width = np.diff(at), int(symbols.max(initial=0)) + 1
        node, known, parents, labels = np.zeros(len(sizes), np.int64), 1, [], []
        left = np.flatnonzero(sizes > 0)
        depth = 0
        while len(left):
            edge, which = np.unique(node[left] * width + symbols[at[left] + depth], return_inverse=True)
            parents.append(edge // width)
            labels.append(edge % width)
            node[left] = known + which
            known += len(edge)
            depth += 1
            left = left[sizes[left] > depth]
        return (np.concatenate(parents), np.concatenate(labels)) if parents else (np.zeros(0, np.int64),) * 2

    def walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The slot that each sequence reaches with each of its symbols, -1 from where it leaves the trie."""
        out, sizes = np.full(len(symbols), -1, np.int64), np.diff(at)
        state, left, depth = np.zeros(len(sizes), np.int64), np.flatnonzero(sizes > 0), 0
        while len(left):
            place = at[left] + depth
            there = self.base[state[left]] + symbols[place]
            good = (there > 0) & (there < len(self.base))
            good[good] = self.check[there[good]] == state[left[good]]
            left, there, place = left[good], there[good], place[good]
            out[place] = state[left] = there
            depth += 1
            left = left[sizes[left] > depth]
        return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows in tables of up to SHARD_TURNS turns."""
    held, turns = [], 0
    for batch in batches:
        sizes = np.cumsum(np.diff(C.bytes_of(batch.column("steps"))[1]) // 16 + 1)
        while batch.num_rows:
            n = max(1, int(np.searchsorted(sizes, SHARD_TURNS - turns, "right"))) if not held or turns < SHARD_TURNS else 0
            n = min(n, batch.num_rows)
            if n:
                held.append(batch.slice(0, n))
                turns += int(sizes[n - 1])
                batch, sizes = batch.slice(n), sizes[n:] - sizes[n - 1]
            if turns >= SHARD_TURNS or batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, turns = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class Shard:
    """The trie of some sequences, and the nodes that each of them passes, the textless top of level 0 included."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch, number = batch, batch.num_rows
        steps, at = _flat(batch.column("steps"), STEP)
        sizes, _ = _flat(batch.column("sizes"), np.int64)
        level, a1, a2, self.depth, self.before = (self.numbers(c) for c in ("level", "a1", "a2", "depth", "before"))
        lengths = np.diff(at)
        # a symbol for the place where a level begins, then one for each turn
        anchor = np.unique(np.stack([level, a1, a2], axis=1), axis=0, return_inverse=True)[1].ravel()
        _, first, turn = np.unique(steps, return_index=True, return_inverse=True)
        tops = int(anchor.max(initial=-1)) + 1
        # siblings are mostly seen together, so numbers by first sight lie close for them
        seen = np.argsort(np.argsort(first))
        where = at + np.arange(number + 1)
        top = np.zeros(where[-1], bool)
        top[where[:-1]] = True
        symbols = np.zeros(len(top), np.int64)
        symbols[top], symbols[~top] = anchor, seen[turn] + tops
        slots = DoubleArray(symbols, where).walk(symbols, where)
        self.row = np.repeat(np.arange(number), lengths + 1)
        begins = self.depth - lengths
        self.at = begins[self.row] + np.arange(len(top)) - where[:-1][self.row]
        self.size, digests = np.zeros(len(top), np.int64), np.zeros((2, len(top)), np.uint64)
        self.size[~top] = sizes
        digests[:, ~top] = _digests(steps, self.at[~top] - 1)
        digests[:, top] = np.stack([a1, a2]).view(np.uint64)
        self.key = _within(digests, where, np.bitwise_xor)
        self.above = np.zeros_like(self.key)
        self.above[:, 1:] = self.key[:, :-1]
        self.bytes = self.before[self.row] + _within(self.size, where, np.add)
        shown = ~top | (level[self.row] == 0)
        self.row, self.at, self.size, self.key, self.above, self.bytes, slots = (
            v[..., shown] for v in (self.row, self.at, self.size, self.key, self.above, self.bytes, slots))
        _, self.first, self.node = np.unique(slots, return_index=True, return_inverse=True)

    def numbers(self, column: str) -> np.ndarray:
        return np.asarray(self.batch.column(column), dtype=np.int64)

    def summed(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.first), np.int64)
        np.add.at(out, self.node, values)
        return out

    def rows(self, **values: np.ndarray) -> pa.RecordBatch:
        f = self.first
        x = self.key[:, f].view(np.int64)
        columns = {"depth": self.at[f], "x1": x[0], "x2": x[1], **values}
        return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], list(columns))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node of each shard: members, smallest member, members that end here, and what the node is."""
    for batch in _shards(batches):
        s = Shard(batch)
        n, least, ended = (s.numbers(c) for c in ("n", "least", "ended"))
        smallest = np.full(len(s.first), np.iinfo(np.int64).max)
        np.minimum.at(smallest, s.node, least[s.row])
        up = s.above[:, s.first].view(np.int64)
        root = s.at[s.first] == 0
        yield s.rows(
            n_convs=s.summed(n[s.row]), least=smallest, ended=s.summed(np.where(s.at == s.depth[s.row], ended[s.row], 0)), size=s.size[s.first],
            before=(s.bytes - s.size)[s.first], p1=np.where(root, 0, up[0]), p2=np.where(root, 0, up[1]))


def _savings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each node of each shard: what its members share with smaller ones from here on, and the leaves they stand for."""
    for batch in _shards(batches):
        s = Shard(batch)
        n, leaves, others, own = (s.numbers(c)[s.row] for c in ("n", "leaves", "shared_others", "shared_least"))
        before = s.bytes - s.size
        yield s.rows(saved_tokens=s.summed(others - (n - 1) * before + np.maximum(own - before, 0)), n_leaves=s.summed(leaves))


# --- lists of ids ---------------------------------------------------------------------------------------------------


def _text(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, id) rows: the digest of a list that surely ends here, else its blocks."""
    held, keys, first = np.zeros(0, np.int64), None, True

    def out(rows):
        names = [*KEY, "start", "block", "sha"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 4 + [pa.binary(), pa.string()])], names)

    for batch in batches:
        key = np.stack([np.asarray(batch.column(c)) for c in KEY], axis=1)
        ids, rows = np.asarray(batch.column("conv_id")), []
        starts = np.flatnonzero(C.run_starts(*key.T))
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(ids)).tolist()):
            if keys != (now := tuple(key[a].tolist())):
                if keys is not None and len(held):
                    rows.append((*keys, int(held[0]), *((_text(held), None) if first else (None, hashlib.sha256(_text(held)).hexdigest()))))
                first, held, keys = keys is None, np.zeros(0, np.int64), now
            held = np.concatenate([held, ids[a:b]])
            while len(held) > BLOCK_IDS:
                # a long list goes on as blocks, wherever it ends
                rows.append((*keys, int(held[0]), _text(held[:BLOCK_IDS]), None))
                held, first = held[BLOCK_IDS:], True
        if rows:
            yield out(rows)
    if len(held):
        yield out([(*keys, int(held[0]), _text(held), None)])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of lists from their blocks in order, one block in memory at a time."""
    keys, running = None, None

    def done():
        return pa.RecordBatch.from_arrays([*(pa.array([k], pa.int64()) for k in keys), pa.array([running.hexdigest()])], [*KEY, "sha"])

    for batch in batches:
        for *now, block in zip(*(batch.column(c).to_pylist() for c in (*KEY, "block"))):
            if now != keys:
                if keys is not None:
                    yield done()
                keys, running = now, hashlib.sha256(block)
            else:
                running.update(b"," + block)
    if keys is not None:
        yield done()


def listed(members: DataFrame) -> DataFrame:
    """SHA-256 of the ascending, comma-joined conv_ids of every key.

    Ids are dealt by ranges of (key, id). A list within one task is done there; one that crosses tasks, or a long one,
    goes on as blocks of BLOCK_IDS ids, which one task per list hashes in order, as this digest demands.
    """
    order = [*KEY, "conv_id"]
    blocks = settle(members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _listed, "depth long, x1 long, x2 long, start long, block binary, sha string"), "lists")
    long = blocks.where("block is not null").repartition(*KEY).sortWithinPartitions(*KEY, "start").mapInArrow(_joined, "depth long, x1 long, x2 long, sha string")
    return blocks.where("sha is not null").select(*KEY, "sha").unionByName(long)


# --- the whole ------------------------------------------------------------------------------------------------------


def _sharded(segments: DataFrame) -> DataFrame:
    """Sequences by ranges: those that begin alike stand together, and a beginning shared by very many is split by the rest."""
    order = ["level", "a1", "a2", F.substring("steps", 1, 64), "x1", "x2"]
    return segments.repartitionByRange(*order).sortWithinPartitions(*order)


def prefix_trie(steps: DataFrame, totals: DataFrame, level_turns: int = LEVEL_TURNS) -> DataFrame:
    """All distinct beginnings of the conversations, one row per node.

    ``steps`` holds the turns (conv_id, pos from 0, step: 16-byte digest, size: bytes, total: turns of the conversation);
    ``totals`` every conversation with its number of turns. Result: conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256, and size (bytes of the node's last turn).

    Conversations become rows of up to ``level_turns`` turns; equal rows are one sequence with a count. Sequences are
    dealt by ranges of their first turns. Every shard packs its sequences into a double array over dense turn ids and
    walks them through it; nodes that several shards hold, the upper ones above all, are merged by their depth and a
    128-bit digest of the prefix. Two walks are made: the first finds members and smallest members; then a conversation's
    shared bytes are known (those above the first node that it is the smallest member of), and the second walk sums them
    over each subtree, because a node's subtree saves what its members share below it.
    """
    segments = sequences(steps, totals, level_turns)
    same = segments.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.sum(F.col("last").cast("long")).alias("ended"), F.max("level").alias("level"))
    kept = segments.select(F.col("conv_id").alias("least"), "level", "steps", "sizes", "a1", "a2", "before")
    distinct = settle(same.join(kept, ["least", "level"]), "distinct")
    one = [F.max(c).alias(c) for c in ("size", "before", "p1", "p2")]
    partial = _sharded(distinct).mapInArrow(
        _members, "depth long, x1 long, x2 long, n_convs long, least long, ended long, size long, before long, p1 long, p2 long")
    nodes = settle(partial.groupBy(*KEY).agg(F.sum("n_convs").alias("n_convs"), F.min("least").alias("least"), F.sum("ended").alias("ended"), *one), "nodes")

    owners = nodes.groupBy(F.col("least").alias("conv_id")).agg(F.min("before").alias("before"), F.max((F.col("n_convs") == F.col("ended")).cast("long")).alias("leaf"))
    everyone = segments.where("last").select("conv_id", "bytes").join(owners, "conv_id", "left")
    shares = everyone.select("conv_id", F.coalesce("before", "bytes").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    weights = segments.select("conv_id", *KEY).join(shares, "conv_id").groupBy(*KEY).agg(
        F.sum("shared").alias("shared"), F.sum("leaf").alias("leaves"), F.min(F.struct("conv_id", "shared"))["shared"].alias("shared_least"))
    weighed = distinct.join(weights, list(KEY)).withColumn("shared_others", F.col("shared") - F.col("shared_least"))
    sums = _sharded(weighed).mapInArrow(_savings, "depth long, x1 long, x2 long, saved_tokens long, n_leaves long")

    kids = nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"), F.lit(1).cast("long").alias("n_children"))
    lists = listed(segments.where("last"))
    parts = nodes.unionByName(kids, True).unionByName(sums, True).unionByName(lists, True)
    summed = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    carried = ("n_convs", "least", "size", "p1", "p2")
    whole = settle(parts.groupBy(*KEY).agg(*(F.max(c).alias(c) for c in carried), *summed, F.max("sha").alias("sha")), "whole")
    above = whole.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("least").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    out = whole.join(above, ["depth", "p1", "p2"], "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(empty)).alias("ends_sha256"), "size")
    discard(segments, distinct, nodes)
    return out


def conversation_trie(conversations: DataFrame, level_turns: int = LEVEL_TURNS) -> DataFrame:
    """``prefix_trie`` of the rebuilt conversations of a table (conv_id, turn, role, text).

    Turns are ordered by their number, null first; turns of one number by a digest of role and text, so that the result
    does not depend on the order of rows. Null roles and texts count as empty; rows without conv_id belong to no
    conversation and are left out; other columns are not read. An empty table has no nodes, not even a root.
    """
    turns, counts = ordered_turns(conversations)
    steps, totals = rebuilt(turns, counts)
    out = prefix_trie(steps, totals, level_turns)
    discard(turns, totals)
    return out
