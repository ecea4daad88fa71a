"""Merkle manifest of a dataset by time-forward processing.

Rows are leaves. Per group they ascend by id, and every ``ARITY`` consecutive nodes of a level become one
node of the next, until one is left; the groups' last nodes are joined in the same way into the root.

A node is labelled by the last leaf below it and its level, so children come before their parent in
order of label. Nodes are processed in that order: a priority queue ordered by label holds the digests sent
to parents that are still to come, a few per level. A reversed sweep goes through the labels backwards
and sends every child what its proof has from there to the root.

Both sweeps run on blocks of ``ARITY ** LEVELS`` leaves, which Spark deals out and sorts by label: the shuffle
is the external part of the queue, and a task holds one block. Block roots are the leaves of the next
round, so there are as many rounds as a group has blocks of blocks of blocks; each round's nodes are a
table. On the way back each block gets the rest of the proof of its root as the first row of its block.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dwellrank.operators.ranking import with_row_number
from dwellrank.operators.skew import join_lookup
from dwellrank.session import pin, pin_measured

ARITY = 8
LEVELS = 4  # levels of a block
BLOCK = ARITY**LEVELS
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PROOF = "array<struct<left:string,right:string>>"
_NODE = "grp string, pos long, n long, digest string"


# --- digests ---------------------------------------------------------------------------------------


def leaf_digest(columns: list[str] = COLUMNS, changed: dict[str, Column] | None = None) -> Column:
    """SHA-256 over the columns: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    values = [(changed or {}).get(c, F.col(c)).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, leaf, lambda acc, step: F.sha2(F.concat(step["left"], acc, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings of a proof, from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


# --- sweeps over one block -------------------------------------------------------------------------


def _parent(last: int, level: int, n: int) -> int:
    """Last leaf below the parent of a node at ``level`` whose last leaf is ``last``; leaves are 0 to n - 1."""
    width = ARITY ** (level + 1)
    return min((last // width + 1) * width, n) - 1


def height(n: int) -> int:
    """Levels from ``n`` leaves to one node."""
    found = 0
    while n > 1:
        n, found = -(-n // ARITY), found + 1
    return found


def forward_sweep(digests: list[str], top: int) -> Iterator[tuple[int, int, str, list[str]]]:
    """(last leaf, level, digest, digests of the children) of all nodes, in order of label, up to ``top``.

    The queue holds (label of the receiver, label of the sender, digest); what lies ahead of the next leaf is
    delivered first.
    """
    n = len(digests)
    queue: list[tuple[int, int, int, str]] = []
    for place, leaf in enumerate(digests):
        last, level, digest, children = place, 0, leaf, []
        while True:
            yield last, level, digest, children
            if level < top:
                heapq.heappush(queue, (_parent(last, level, n), level + 1, last, digest))
            if not queue or queue[0][0] > place:
                break
            last, level = queue[0][:2]
            children = []
            while queue and queue[0][:2] == (last, level):
                children.append(heapq.heappop(queue)[3])
            digest = sha256("".join(children).encode()).hexdigest()


def reversed_sweep(nodes: list[tuple[int, int, str, list[str]]], n: int) -> list[tuple]:
    """Proof of every leaf inside the block as a chain (left, right, chain of the parent) or None.

    ``nodes`` are those of the forward sweep. The queue is ordered by label, largest first.
    """
    last, level, _, _ = nodes[-1]
    queue: list[tuple[int, int, tuple | None]] = [(-last, -level, None)]
    chains: list = [None] * n
    for last, level, _, children in reversed(nodes):
        # The receiver of the next message is the node at hand: every node gets exactly one.
        chain = heapq.heappop(queue)[2]
        if not level:
            chains[last] = chain
            continue
        width = ARITY ** (level - 1)
        first = last // (ARITY * width) * ARITY * width
        for i in range(len(children)):
            end = min(first + (i + 1) * width, n) - 1
            step = ("".join(children[:i]), "".join(children[i + 1 :]), chain)
            heapq.heappush(queue, (-end, 1 - level, step))
    return chains


def _expanded(chains: list) -> tuple[list[int], list[str], list[str]]:
    """Lengths of chains and their steps one after another."""
    lengths, left, right = [], [], []
    for chain in chains:
        before = len(left)
        while chain is not None:
            left.append(chain[0])
            right.append(chain[1])
            chain = chain[2]
        lengths.append(len(left) - before)
    return lengths, left, right


# --- blocks in tasks ---------------------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one (grp, block) at a time; tasks are sorted by them."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column("grp").to_pylist()
        blocks = batch.column("block").to_numpy()
        edges = [0] + [i for i in range(1, len(groups)) if blocks[i] != blocks[i - 1] or groups[i] != groups[i - 1]]
        for start, end in zip(edges, edges[1:] + [len(groups)]):
            now = (groups[start], blocks[start])
            if held and now != key:
                yield pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _block_top(n: int) -> int:
    """Levels that a block of a group with ``n`` nodes goes up."""
    return LEVELS if n > BLOCK else height(n)


def _block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        n = block.column("n")[0].as_py()
        *_, (_, _, root, _) = forward_sweep(block.column("digest").to_pylist(), _block_top(n))
        yield pa.RecordBatch.from_pydict(
            {
                "grp": pa.array([block.column("grp")[0].as_py()], pa.string()),
                "pos": pa.array([block.column("block")[0].as_py()], pa.int64()),
                "n": pa.array([-(-n // BLOCK)], pa.int64()),
                "digest": pa.array([root], pa.string()),
            }
        )


_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def _block_proofs(payload: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            message, block = rows.slice(0, 1), rows.slice(1).combine_chunks()
            n = block.column("n")[0].as_py()
            digests = block.column("digest").to_pylist()
            nodes = list(forward_sweep(digests, _block_top(n)))
            lengths, left, right = _expanded(reversed_sweep(nodes, len(digests)))
            rest = message.column("proof")[0].as_py()
            if rest:
                counts = np.array(lengths)
                ends = np.cumsum(counts).tolist()
                own_left, own_right, left, right, at = left, right, [], [], 0
                more_left, more_right = [s["left"] for s in rest], [s["right"] for s in rest]
                for end in ends:
                    left += own_left[at:end] + more_left
                    right += own_right[at:end] + more_right
                    at = end
                lengths = (counts + len(rest)).tolist()
            steps = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], fields=list(_STEP))
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            out = {c: block.column(c) for c in ["grp", "pos", "n", "digest", *payload]}
            out["subroot"] = pa.repeat(message.column("subroot")[0], len(digests))
            out["proof"] = pa.ListArray.from_arrays(offsets, steps)
            for batch in pa.table(out).to_batches():
                # A proof has some 500 bytes a level, so batches are kept short.
                for start in range(0, batch.num_rows, 512):
                    yield batch.slice(start, 512)

    return run


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", *order)


def _with_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK))


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of nodes by round, ``nodes`` first, and (grp, digest) of each group's last node.

    ``nodes`` has grp, pos from 0, n (nodes of the group) and digest.
    """
    rounds, done = [nodes], []
    while True:
        blocks = _dealt(_with_block(rounds[-1].select("grp", "pos", "n", "digest")), "pos")
        above, counted = pin_measured(blocks.mapInArrow(_block_roots, _NODE), "manifest-nodes", most=F.max("n"))
        done.append(above.filter("n = 1").select("grp", "digest"))
        if counted["most"] <= 1:
            break
        rounds.append(above.filter("n > 1"))
    last = done[0]
    for table in done[1:]:
        last = last.unionByName(table)
    return rounds, last


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The first round's rows with ``subroot`` and ``proof``.

    ``tops`` has grp, subroot and proof: what follows above each group's last node.
    """
    spark = rounds[0].sparkSession
    from_above = None
    for depth in reversed(range(len(rounds))):
        nodes = rounds[depth]
        payload = [c for c in nodes.columns if c not in ("grp", "pos", "n", "digest")]
        # A group ends in this round if it is in none above; then its message is its top's.
        messages = tops.withColumn("block", F.lit(0).cast("long"))
        if from_above is not None:
            higher = rounds[depth + 1].select("grp").distinct()
            messages = messages.join(higher, "grp", "left_anti").unionByName(
                from_above.select("grp", "subroot", "proof", F.col("pos").alias("block"))
            )
        if depth:
            here = nodes.select("grp").distinct()
            messages = messages.join(here, "grp", "left_semi")
        both = messages.withColumn("kind", F.lit(0)).unionByName(
            _with_block(nodes).withColumn("kind", F.lit(1)), allowMissingColumns=True
        )
        schema = nodes.select(*_columns(payload)).schema
        full = spark.createDataFrame([], schema).selectExpr("*", "'' as subroot", f"cast(null as {PROOF}) as proof").schema
        from_above = _dealt(both, "kind", "pos").mapInArrow(_block_proofs(payload), full)
        if depth:
            from_above = pin(from_above, "manifest-proofs")
    return from_above


def _columns(payload: list[str]) -> list[str]:
    return ["grp", "pos", "n", "digest", *payload]


# --- the manifest ------------------------------------------------------------------------------------


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", columns: list[str] = COLUMNS, tampered: dict[str, Column] | None = None) -> DataFrame:
    """``key``, leaf, tampered_leaf, subroot, root and proof of every row.

    Leaves of a group ascend by ``key``, nulls first; rows with one key follow the order of their leaves,
    so the root does not depend on the order of the input. Rows equal in all columns are leaves of their own.
    The null group comes first, the others bytewise. A proof lists, from the leaf to the root, the digests
    left and right of the path; a run of one has none, and fold and count as a level all the same.
    ``tampered`` are columns to take in place of those in the table, for a second leaf which is checked against
    the proof of the first. Only ``columns`` count; others in the table, whatever their names, are
    left out. An empty table gives no rows. Texts are hashed in place and go no further.
    """
    named = F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group).cast("string")))
    leaves = pin(
        docs.select(
            F.col(key).alias("key"), named.alias("grp"), leaf_digest(columns).alias("digest"),
            leaf_digest(columns, tampered).alias("tampered_leaf"),
        ),
        "manifest-leaves",
    )
    # Copies of one row are told apart by their place in the table, so they share no sorting task.
    told = leaves.withColumn("_copy", F.monotonically_increasing_id())
    numbered = with_row_number(told, [F.col("grp"), F.col("key").asc_nulls_first(), F.col("digest"), F.col("_copy")], "row").drop("_copy")
    groups = pin(numbered.groupBy("grp").agg(F.min("row").alias("first"), F.count("*").alias("n")), "manifest-groups")
    placed = join_lookup(numbered, groups, "grp")
    nodes = placed.select("grp", (F.col("row") - F.col("first")).alias("pos"), "n", "digest", "key", "tampered_leaf")
    rounds, subroots = climb(nodes)
    # The groups' last nodes are the leaves of one more tree.
    upper = with_row_number(subroots, [F.col("grp")], "row", total="n").select(
        F.lit("").alias("grp"), (F.col("row") - 1).alias("pos"), "n", "digest", F.col("grp").alias("of")
    )
    upper_rounds, root = climb(upper)
    top = root.select("grp", F.col("digest").alias("subroot"), F.array().cast(PROOF).alias("proof"))
    tops = pin(
        descend(upper_rounds, top).select(F.col("of").alias("grp"), F.col("digest").alias("subroot"), "proof"), "manifest-tops"
    )
    last = root.first()
    return descend(rounds, tops).select(
        F.col("key").alias(key), F.col("digest").alias("leaf"), "tampered_leaf", "subroot",
        F.lit(last.digest if last else None).cast("string").alias("root"), "proof",
    )


def verified(rows: DataFrame) -> DataFrame:
    """``manifest`` rows with folded_root, from the tampered leaf and the proof, and whether it is the root."""
    return rows.withColumn("folded_root", folded(F.col("tampered_leaf"), F.col("proof"))).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )
