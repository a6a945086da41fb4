"""Prefix trie of conversations, built from adaptive radix trees over fixed-width turn ids.

A turn is ``WIDTH`` bytes, a conversation the bytes of its turns one after the other. Equal conversations are one
key. Sorted keys are cut into runs; each run is one tree in one task, whose nodes at whole turns are nodes of the
trie. Only nodes on the path shared by neighbouring runs occur in more than one tree: these are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwatch.llm.art import RadixTree
from ledgerwatch.session import stored

#: 16 bytes of a SHA-256 over role and text, then the text's length in UTF-8 bytes, both big-endian.
WIDTH = 20
_DIGEST = 16
#: Bytes of keys, and of rows beside them, that make up a run.
RUN_BYTES, _ROW_BYTES = 8 << 20, 64
#: Ids that are joined to text at once: those with equal higher bits.
_ID_BITS = 12
NOBODY = hashlib.sha256(b"").hexdigest()
_SALTS = 16


def turn_id(role_col: str = "role", text_col: str = "text") -> Column:
    """The ``WIDTH`` bytes of a turn; null role or text count as empty."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    length = F.octet_length(text)
    both = F.concat(F.lpad(F.hex(F.octet_length(role)), 8, "0"), role, text)
    return F.concat(F.unhex(F.substring(F.sha2(both, 256), 1, 2 * _DIGEST)), F.unhex(F.lpad(F.hex(length), 8, "0")))


def turn_sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id`` and ``turns`` (array of turn ids in order) of every conversation.

    Turns go by number, null first; equal numbers by turn id. Rows without a conversation id belong to
    none and are left out; repeated rows are turns of their own.
    """
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"), F.struct(F.col(turn_col).isNotNull().alias("b"), F.col(turn_col).alias("n"), turn_id(role_col, text_col).alias("id")).alias("t")
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["id"].alias("turns"))


def _ends(keyed: DataFrame) -> DataFrame:
    """``kd`` and ``ends``: the SHA-256 over the ascending ids, joined by commas, of the conversations of each key.

    Ids are joined to text in blocks of neighbouring ids, wherever they are; a key of several blocks is
    hashed block by block, one in memory at a time.
    """
    blocks = keyed.groupBy("kd", F.shiftright("conv_id", _ID_BITS).alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select("kd", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    blocks = stored(blocks, "trie-ends")
    sizes = blocks.groupBy("kd").agg(F.count("*").alias("blocks"), F.min("ids").alias("only"))
    few = sizes.where("blocks = 1").select("kd", F.sha2("only", 256).alias("ends"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            done: tuple[list, list] = ([], [])
            for kd, ids in zip(batch.column("kd").to_pylist(), batch.column("ids").to_pylist()):
                if kd == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done[0].append(key)
                        done[1].append(state.hexdigest())
                    key, state = kd, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(done[0], pa.binary()), pa.array(done[1], pa.string())], ["kd", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], ["kd", "ends"])

    many = blocks.join(sizes.where("blocks > 1").select("kd"), "kd", "left_semi").repartition("kd").sortWithinPartitions("kd", "block")
    return few.unionByName(many.select("kd", "ids").mapInArrow(run, "kd binary, ends string"))


def _shared_turns(a: bytes | None, b: bytes | None) -> int:
    """Leading turns that two keys share; -1 if there is no such key."""
    if a is None or b is None:
        return -1
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


def _path_ids(key: bytes, depth: int) -> list[bytes]:
    """Ids of the nodes on the way to ``depth`` turns of a key, the root's first."""
    state, out = hashlib.sha256(), []
    for d in range(depth + 1):
        out.append(state.digest())
        state.update(key[d * WIDTH : (d + 1) * WIDTH])
    return out


_COLUMNS = {"conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "node": pa.binary(), "parent": pa.binary()}
_SCHEMA = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, node binary, parent binary"


def run_nodes(keys: list[bytes], n_convs: list[int], firsts: list[int], ends: list[str], before: bytes | None, after: bytes | None) -> dict[str, list]:
    """The nodes of one run of sorted, different keys, ``before`` and ``after`` being the neighbouring keys of other runs.

    Nodes that another run has too carry their id in ``node``, their children's rows carry it in ``parent``. Every
    column of such a node is a summand: what several runs would count is counted by the first that has it.
    """
    tree = RadixTree()
    for number, key in enumerate(keys):
        tree.insert(key, number)
    # nodes at whole turns, parents first
    up: list[int] = []
    depths: list[int] = []
    key_of: list[int] = []
    end_of = [0] * len(keys)
    lowest: list[int] = []  # of each tree node: the last of its own nodes at whole turns, or its parent's
    for parent, top, last, number in tree.walk():
        above = lowest[parent] if parent >= 0 else -1
        low = top // WIDTH + 1 if parent >= 0 else 0
        for depth in range(low, last // WIDTH + 1):
            up.append(above)
            depths.append(depth)
            key_of.append(-1)
            above = len(up) - 1
        lowest.append(above)
        if number >= 0:
            key_of[above] = number
            end_of[number] = above
    size = len(up)
    members, first = [0] * size, [0] * size
    children, leaves, uses, once = [0] * size, [0] * size, [0] * size, [0] * size
    some = [-1] * size  # a key that passes through the node
    # the nodes shared with the neighbouring runs
    shared_before, shared_after = _shared_turns(before, keys[0]), _shared_turns(keys[-1], after)
    def beginning(end: int, turns: int) -> list[int]:
        """The nodes from the root to ``turns`` turns on the way to ``end``."""
        path = []
        while end >= 0:
            path.append(end)
            end = up[end]
        return path[::-1][: turns + 1]

    first_path, last_path = beginning(end_of[0], shared_before), beginning(end_of[-1], shared_after)
    ids = dict(zip(first_path, _path_ids(keys[0], shared_before))) | dict(zip(last_path, _path_ids(keys[-1], shared_after)))
    theirs = set(first_path)  # counted by an earlier run
    goes_on = end_of[-1] if shared_after == len(keys[-1]) // WIDTH else -1  # its first child is in the next run
    for at in range(size - 1, -1, -1):
        number = key_of[at]
        if number >= 0:
            first[at] = min(first[at], firsts[number]) if members[at] else firsts[number]
            members[at] += n_convs[number]
            some[at] = number
        key, depth = keys[some[at]], depths[at]
        n_bytes = int.from_bytes(key[depth * WIDTH - 4 : depth * WIDTH], "big") if depth else 0
        own = at not in theirs
        uses[at] += members[at] * n_bytes
        if own:
            once[at] += n_bytes
            if not children[at] and at != goes_on:
                leaves[at] = 1
        above = up[at]
        if above >= 0:
            first[above] = min(first[above], first[at]) if members[above] else first[at]
            members[above] += members[at]
            children[above] += own
            leaves[above] += leaves[at]
            uses[above] += uses[at]
            once[above] += once[at]
            some[above] = some[at]
    return {
        "conv_id": first,
        "depth": depths,
        "parent_conv_id": [None if a < 0 or a in ids else first[a] for a in up],
        "n_convs": members,
        "n_children": children,
        "n_leaves": leaves,
        "saved_tokens": [u - o for u, o in zip(uses, once)],
        "ends_sha256": [ends[k] if k >= 0 else None for k in key_of],
        "node": [ids.get(a) for a in range(size)],
        "parent": [ids.get(a) if a >= 0 else None for a in up],
    }


def prefix_trie(sequences: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """One row for each distinct beginning of the conversations, the empty one (the root, depth 0) included.

    ``sequences`` has ``conv_id`` (long, distinct) and ``turns`` (array of ``WIDTH`` bytes, maybe empty). Columns
    (long): ``conv_id``, the smallest member's; ``depth``; ``parent_conv_id`` (root: null); ``n_convs``, members;
    ``n_children``; ``n_leaves``, childless nodes of the subtree; ``saved_tokens``, over the subtree the bytes of a
    node's last text times the members beyond the first; ``ends_sha256`` over the ids of the members that end here.
    Without conversations there are no nodes. A null ``turns`` counts as empty.

    A conversation is one record of ``WIDTH`` bytes a turn; any number of equal or alike conversations is fine:
    equal ones are counted before keys are sorted, and a run ends after ``run_bytes`` wherever that is.
    """
    spark = sequences.sparkSession
    key = F.coalesce(F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t)), "")), F.lit(b""))
    keyed = sequences.select("conv_id", key.alias("key")).withColumn("kd", F.unhex(F.sha2("key", 256)))
    keyed = stored(keyed, "trie-keys")
    distinct = keyed.groupBy("kd").agg(F.first("key").alias("key"), F.count("*").alias("n"), F.min("conv_id").alias("first"))
    distinct = stored(distinct.join(_ends(keyed.select("kd", "conv_id")), "kd").drop("kd"), "trie-distinct")
    total = distinct.agg(F.sum(F.octet_length("key") + _ROW_BYTES)).first()[0] or 0
    runs = max(1, -(-int(total) // run_bytes))
    sorted_keys = distinct.repartitionByRange(runs, "key").withColumn("run", F.spark_partition_id())
    sorted_keys = stored(sorted_keys, "trie-sorted")
    # the key before and the key after each run; one row a run
    order = Window.orderBy("run")
    edges = sorted_keys.groupBy("run").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    edges = edges.select("run", F.lag("high").over(order).alias("before"), F.lead("low").over(order).alias("after"))
    edges = stored(edges, "trie-edges")

    def build(part: pa.Table, edge: pa.Table) -> pa.Table:
        part = part.sort_by("key")
        columns = [part.column(c).to_pylist() for c in ("key", "n", "first", "ends")]
        found = run_nodes(*columns, edge.column("before")[0].as_py(), edge.column("after")[0].as_py())
        return pa.table({c: pa.array(found[c], t) for c, t in _COLUMNS.items()})

    nodes = stored(sorted_keys.groupBy("run").cogroup(edges.groupBy("run")).applyInArrow(build, _SCHEMA), "trie-nodes")
    longs = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    # a shared node's parent is shared too, so its parent_conv_id is null here and comes from the join below
    shared = nodes.where("node IS NOT NULL").groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), *(F.sum(c).alias(c) for c in longs), F.max("ends_sha256").alias("ends_sha256"), F.max("parent").alias("parent")
    )
    shared = stored(shared, "trie-shared")
    final = ["conv_id", "depth", "parent_conv_id", *longs, F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256")]
    whole = nodes.where("node IS NULL AND parent IS NULL").select(*final)
    # a shared node may have very many children: these are spread, the shared ones repeated
    below = nodes.where("node IS NULL AND parent IS NOT NULL").drop("node", "parent_conv_id").unionByName(shared.where("parent IS NOT NULL").drop("node"))
    below = below.withColumn("salt", F.pmod(F.xxhash64("conv_id", "depth"), F.lit(_SALTS)).cast("int"))
    above = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    tops = shared.where("parent IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long")).select(*final)
    return whole.unionByName(below.join(above, ["parent", "salt"]).select(*final)).unionByName(tops)
