"""Operator 12, conversation prefix trie: partial tries a partition, merged by node hash, then rolled up from the ends.

A node is a distinct sequence of first turns. Its name is 127 bits: the turns' hashes as digits of a number modulo the prime
2 ** 127 - 1 (Rabin and Karp), so names of prefixes extend by one turn at a time and pieces of a conversation can be joined.

1. Rows shrink to (conversation, turn, hash, code points). They are dealt by range of (conversation, turn), so that one of any
   length lies in many tasks, and folded there; a driver's table with a row a partition carries folds on (`scanned`).
2. Conversations are rebuilt: the first few turns are those of another one (at most HEAD, so heads are small rows).
3. A second scan names every prefix. Tasks combine what they hold into partial tries: a table of nodes with number of members,
   smallest member, and the ends, as the ascending list of conversations that end there. Rounds of merges by hash of node and
   of FAN neighbouring partitions add up members and join end lists, in pieces of ENDS bytes; the last round digests them.
4. Roll-up: a node belongs to its smallest member. Each conversation sums its own nodes from its end upwards (a third scan);
   as every node of a subtree belongs to a member of the subtree's top, a node's total is the sum of its members' sums at its
   depth. No step follows the trie level by level, and rows stay as many as the conversations have turns.

Nulls: a null turn comes first, null role and text are empty, rows without a conv_id belong to no conversation and are left
out. Rows of equal turn are ordered by a hash of role and text; repeated rows are turns of their own. An empty table has no
nodes. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.common import disposable, hash128, own_columns, partitions, written

PRIME, BASE = 2**127 - 1, 0x5D1F2C0B9A37E64821C7F3A5B0D98E63
INVERSE = pow(BASE, -1, PRIME)
#: Turns that a conversation may take from another one at most.
HEAD = 5
#: Partitions whose partial tries meet in a merge, nodes that a task combines before it emits them, and bytes of an end list.
FAN, TABLE, ENDS = 16, 100_000, 1 << 16


class Fold(NamedTuple):
    """How a scan sums up a conversation's rows: from columns to a state of numbers, and two neighbouring states to one."""

    inputs: tuple[str, ...]
    outputs: tuple[str, ...]  #: columns of the state
    of: Callable[[tuple], tuple]
    join: Callable[[tuple, tuple], tuple]


COUNT = Fold((), ("n",), lambda x: (1,), lambda a, b: (a[0] + b[0],))
SUMS = Fold(("saved", "leaf"), ("up_saved", "up_leaves"), lambda x: x, lambda a, b: (a[0] + b[0], a[1] + b[1]))


def _name_join(a: tuple, b: tuple) -> tuple:
    shift = BASE if b[0] == 1 else pow(BASE, b[0], PRIME)
    return a[0] + b[0], (a[1] * shift + b[1]) % PRIME


def _digit(turn: bytes) -> int:
    """Never 0, so a prefix and a shorter one have names of their own."""
    return int.from_bytes(turn, "big") % (PRIME - 1) + 1


#: Turns and name of the prefix that ends with a turn.
NAME = Fold(("hash",), ("n", "name"), lambda x: (1, _digit(x[0])), _name_join)
_TYPES = {"n": "long", "name": "binary", "up_saved": "decimal(38,0)", "up_leaves": "long"}
_ARROW = {"n": pa.int64(), "name": pa.binary(), "up_saved": pa.decimal128(38, 0), "up_leaves": pa.int64()}


def _out(c: str, values: list) -> pa.Array:
    return pa.array([x.to_bytes(16, "big") for x in values] if c == "name" else values, _ARROW[c])


def _in(c: str, x: Any) -> int:
    return int.from_bytes(x, "big") if c == "name" else int(x)


def scanned(rows: DataFrame, order: list[str], fold: Fold, label: str) -> DataFrame:
    """rows plus the fold of each one's conversation up to it, in the given order (conv_id first), __block (the range that it
    came in) and is_end (whether it is its conversation's last).

    First each range is folded by itself; then what a conversation had before the range is joined on. Of each range only its
    first conversation can have begun before, so the driver holds one state a partition.
    """
    spark = rows.sparkSession
    n = partitions(spark)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, last, state = TaskContext.get().partitionId(), None, None
        held: tuple[pa.RecordBatch, list[bool]] | None = None
        add = lambda batch, ends: pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.bool_())], [*batch.schema.names, "is_end"])
        for batch in batches:
            if not batch.num_rows:
                continue
            states, convs = [], batch.column("conv_id").to_pylist()
            if held:
                held[1][-1] = convs[0] != last
                yield add(*held)
            inputs = zip(*(batch.column(c).to_pylist() for c in fold.inputs), strict=True) if fold.inputs else [()] * len(convs)
            for conv, x in zip(convs, inputs, strict=True):
                state = fold.join(state, fold.of(x)) if conv == last else fold.of(x)
                last = conv
                states.append(state)
            columns = [_out(c, [s[i] for s in states]) for i, c in enumerate(fold.outputs)]
            batch = pa.RecordBatch.from_arrays([*batch.columns, *columns, pa.array([block] * len(convs), pa.int32())], [*batch.schema.names, *fold.outputs, "__block"])
            held = batch, [*(a != b for a, b in zip(convs[:-1], convs[1:], strict=True)), True]
        if held:
            yield add(*held)

    added = ", ".join(f"{c} {_TYPES[c]}" for c in fold.outputs)
    dealt = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + f", {added}, __block int, is_end boolean"
    folded = written(dealt.mapInArrow(local, schema), label)
    carried, going_on = _carried(folded, order, fold)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = list(zip(batch.column("__block").to_pylist(), batch.column("conv_id").to_pylist(), strict=True))
            if any(k in going_on for k in at):
                ends = [e and k not in going_on for e, k in zip(batch.column("is_end").to_pylist(), at, strict=True)]
                batch = batch.set_column(batch.schema.get_field_index("is_end"), "is_end", pa.array(ends, pa.bool_()))
            if hit := [i for i, k in enumerate(at) if k in carried]:
                states = [[_in(c, x) for x in batch.column(c).to_pylist()] for c in fold.outputs]
                for i in hit:
                    state = fold.join(carried[at[i]], tuple(x[i] for x in states))
                    for x, v in zip(states, state, strict=True):
                        x[i] = v
                for c, x in zip(fold.outputs, states, strict=True):
                    batch = batch.set_column(batch.schema.get_field_index(c), c, _out(c, x))
            yield batch

    return folded.mapInArrow(whole, schema) if carried else folded


def _carried(folded: DataFrame, order: list[str], fold: Fold) -> tuple[dict[tuple[int, Any], tuple], set[tuple[int, Any]]]:
    """By range and its first conversation, the fold of what that one had before, if anything; and ranges whose last one goes on."""
    last = F.max_by(F.struct("conv_id", *fold.outputs), F.struct(*order))
    ends = folded.groupBy("__block").agg(F.min("conv_id").alias("first"), last.alias("last")).collect()  # a row a partition
    carried: dict[tuple[int, Any], tuple] = {}
    going_on: set[tuple[int, Any]] = set()
    before: tuple[int, Any, tuple] | None = None
    for r in sorted(ends, key=lambda r: r[0]):
        state = tuple(_in(c, r.last[c]) for c in fold.outputs)
        if before and before[1] == r.first:
            carried[r[0], r.first] = before[2]
            going_on.add(before[:2])
            if r.last.conv_id == r.first:
                state = fold.join(before[2], state)
        before = r[0], r.last.conv_id, state
    return carried, going_on


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0, with gaps; 0 is the start, which has no turn), hash, chars of the rebuilt conversations.

    conv_id's first h turns are those of conv_id - conv_id % 100, h being crc32(conv_id) % 6; its own follow after its first h.
    """
    rows = own_columns(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    text = F.coalesce("text", F.lit(""))
    short = rows.select("conv_id", "turn", hash128(F.coalesce("role", F.lit("")), text).alias("hash"), F.length(text).cast("long").alias("chars"))
    own = scanned(short, ["conv_id", "turn", "hash"], COUNT, "turns").drop("__block", "turn", "is_end")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    heads = own.where((F.col("conv_id") % 100 == 0) & (F.col("n") <= HEAD)).groupBy(F.col("conv_id").alias("__from")).agg(F.array_sort(F.collect_list(F.struct("n", "hash", "chars"))).alias("head"))
    convs = own.where("n = 1").select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("__from"))
    taken = convs.join(heads, "__from", "left").select("conv_id", F.explode_outer(F.slice("head", F.lit(1), F.col("h"))).alias("x"))
    taken = taken.where("x IS NOT NULL").select("conv_id", F.col("x.n").alias("place"), "x.hash", "x.chars")
    rest = own.where(F.col("n") > h).select("conv_id", F.col("n").alias("place"), "hash", "chars")
    top = convs.select("conv_id", F.lit(0).cast("long").alias("place"), F.lit(None).cast("binary").alias("hash"), F.lit(0).cast("long").alias("chars"))
    return top.unionByName(taken).unionByName(rest)


#: A partial trie's rows. part: the partitions it is of, in order; first: the first conversation of its ends.
_PARTIAL = "node binary, part int, first long, parent binary, depth long, chars long, n_convs long, conv_id long, ends binary"
_PARTIAL_ARROW = [pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
_PARTIAL_NAMES = [c.split()[0] for c in _PARTIAL.split(", ")]


def _partials(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(_PARTIAL_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _PARTIAL_ARROW, strict=True)], _PARTIAL_NAMES)


def _before(node: bytes, turn: bytes) -> bytes:
    """The name of the prefix without its last turn."""
    return ((int.from_bytes(node, "big") - _digit(turn)) * INVERSE % PRIME).to_bytes(16, "big")


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Named prefixes, in order of conversations -> partial tries. A table goes when it is full or the next range begins."""
    table: dict[bytes, list] = {}
    block = None

    def flush() -> Iterator[pa.RecordBatch]:
        rows = [(node, block, x[5], *x[:5], x[6].encode() if x[6] is not None else None) for node, x in table.items()]
        for lo in range(0, len(rows), 10_000):
            yield _partials(rows[lo : lo + 10_000])
        table.clear()

    names = ("__block", "conv_id", "name", "hash", "n", "chars", "is_end")
    for batch in batches:
        for b, conv, node, turn, depth, chars, end in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            if b != block or len(table) >= TABLE:
                yield from flush()
                block = b
            x = table.get(node)
            if x is None:
                x = table[node] = [_before(node, turn) if depth > 1 else None, depth - 1, chars, 0, conv, None, None]
            x[3] += 1
            x[4] = min(x[4], conv)
            if end:
                x[5] = conv if x[5] is None else x[5]
                x[6] = str(conv) if x[6] is None else f"{x[6]},{conv}"
                if len(x[6]) >= ENDS:
                    yield _partials([(node, block, x[5], *x[:5], x[6].encode())])
                    del table[node]
    yield from flush()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial tries sorted by node, part and first -> one row a node and part, and more for long end lists."""
    held: list | None = None
    out: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in _PARTIAL_NAMES), strict=True):
            if held is not None and held[:2] == list(row[:2]):
                held[6] += row[6]
                held[7] = min(held[7], row[7])
                if row[8] is not None:
                    if held[8] is not None and len(held[8]) + len(row[8]) > ENDS:
                        out.append((*held[:6], 0, *held[7:]))  # its members stay with the next piece
                        held[2], held[8] = row[2], None
                    held[2] = row[2] if held[8] is None else held[2]
                    held[8] = row[8] if held[8] is None else held[8] + b"," + row[8]
            else:
                if held is not None:
                    out.append(tuple(held))
                held = list(row)
            if len(out) >= 1000:
                yield _partials(out)
                out = []
    yield _partials([*out, *([tuple(held)] if held is not None else [])])


_NODE = "node binary, parent binary, depth long, chars long, n_convs long, conv_id long, ends_sha256 string"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial tries of one part, sorted by node and first -> nodes. End lists stream through their digest."""
    kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in _NODE.split(", ")]
    held: list | None = None
    out: list[tuple] = []
    done = lambda h: (*h[:6], h[6].hexdigest())
    pack = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [()] * 7, kinds, strict=True)], names)
    for batch in batches:
        for node, _, _, parent, depth, chars, n, conv, ends in zip(*(batch.column(c).to_pylist() for c in _PARTIAL_NAMES), strict=True):
            if held is None or held[0] != node:
                if held is not None:
                    out.append(done(held))
                held = [node, parent, depth, chars, 0, conv, sha256(), False]
            held[4] += n
            held[5] = min(held[5], conv)
            if ends is not None:
                held[6].update(b"," + ends if held[7] else ends)
                held[7] = True
            if len(out) >= 1000:
                yield pack(out)
                out = []
    yield pack([*out, *([done(held)] if held is not None else [])])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node."""
    spark = conversations.sparkSession
    n = partitions(spark)
    conversations = conversations.withColumn("conv_id", F.col("conv_id").cast("long"))
    with disposable(spark) as keep:
        turns = rebuilt(conversations)
        # The start counts as a turn of a fixed hash, so its name is the same in all, and a depth is one less than the count.
        turns = turns.withColumn("hash", F.coalesce("hash", F.lit(b"start")))
        named = scanned(turns, ["conv_id", "place"], NAME, "prefixes")
        parts = named.mapInArrow(_tries, _PARTIAL)
        blocks = n
        while blocks > 1:
            blocks = -(-blocks // FAN)
            dealt = parts.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).repartition(n, "node", "part").sortWithinPartitions("node", "part", F.col("first").asc_nulls_last())
            parts = dealt.mapInArrow(_merged, _PARTIAL) if blocks > 1 else dealt
        if n == 1:
            parts = parts.repartition(n, "node").sortWithinPartitions("node", F.col("first").asc_nulls_last())
        nodes = written(parts.mapInArrow(_digested, _NODE), "nodes")
        children = nodes.where("depth > 0").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
        nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        nodes = written(nodes, "counted")
        # Own values of each conversation's own nodes, at its prefixes; then sums from its end upwards.
        worth = (F.col("n_convs") - 1).cast("decimal(20,0)") * F.col("chars").cast("decimal(18,0)")
        own = nodes.select("conv_id", "depth", worth.cast("decimal(38,0)").alias("saved"), (F.col("n_children") == 0).cast("long").alias("leaf"))
        owners = own.select("conv_id").distinct()
        prefixes = named.select("conv_id", (F.col("n") - 1).alias("depth"), (-F.col("n")).alias("down"), F.col("name").alias("node"))
        at = prefixes.join(owners, "conv_id", "left_semi").join(own, ["conv_id", "depth"], "left")
        at = at.select("conv_id", "down", "node", F.coalesce("saved", F.lit(0).cast("decimal(38,0)")).alias("saved"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf"))
        summed = scanned(at, ["conv_id", "down"], SUMS, "sums").where((F.col("up_saved") != 0) | (F.col("up_leaves") != 0))
        total = summed.groupBy("node").agg(F.sum("up_leaves").alias("n_leaves"), F.sum("up_saved").cast("long").alias("saved_tokens"))
        parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        out = nodes.join(total, "node").join(parents, "parent", "left")
        out = written(out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"), "trie")
        keep(out)
    return out



def _crc32(text: str) -> str:
    """DuckDB has no crc32; this is its definition, bit by bit, over ASCII text."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda y: ascii(y)::BIGINT)), lambda a, b: {byte}), 4294967295)"


SQL = f"""WITH t AS (SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS ts, CAST({_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS INTEGER) AS h FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
b AS (SELECT c.conv_id, list_concat(coalesce(p.ts[1:c.h], []), c.ts[c.h + 1:]) AS ts FROM t c LEFT JOIN t p ON p.conv_id = c.conv_id - c.conv_id % 100),
m0 AS (SELECT conv_id, ts, unnest(range(0, len(ts) + 1)) AS d FROM b),
m AS (SELECT conv_id, d, sha256(CAST(to_json(ts[1:d]) AS VARCHAR)) AS node, CASE WHEN d > 0 THEN sha256(CAST(to_json(ts[1:d - 1]) AS VARCHAR)) END AS parent, CASE WHEN d > 0 THEN length(ts[d].x) ELSE 0 END AS chars, d = len(ts) AS last FROM m0),
n AS (SELECT node, d AS depth, min(conv_id) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, any_value(chars) AS chars, sha256(coalesce(string_agg(CASE WHEN last THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM m GROUP BY node, d),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY parent),
u AS (SELECT m.node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved FROM n LEFT JOIN k ON k.node = n.node JOIN m ON m.conv_id = n.conv_id AND m.d <= n.depth GROUP BY m.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, u.n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN u ON u.node = n.node LEFT JOIN k ON k.node = n.node LEFT JOIN n p ON p.node = n.parent"""
