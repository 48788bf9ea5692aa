"""Merkle manifest of a table, with a proof for every row, by butterfly exchange.

A row's leaf is the hash of its fields. Leaves are ordered by id within a group; runs of ``FANOUT`` consecutive nodes are hashed together, level by level, until
one is left, the group's subroot. The subroots, ordered by group, give the root in the same way.

1. Leaves are hashed where the rows are read; texts are never shuffled. They are dealt by range and numbered by the counts of the ranges, so no task
   orders a whole group, and cut into aligned partitions of ``FANOUT ** HEIGHT`` leaves.
2. Each partition hashes its own subtree. Then round by round: in round r the ``FANOUT`` partitions whose numbers differ in digit r only swap the roots
   of their subtrees of that level, and each hashes the common ancestor itself. So after the last round every partition has
   the subroot and all upper proofs, and nothing has to come down again. In a last subtree that is not full a partition stands in for the
   missing ones, so all of its sibling's partitions hear of it. The groups' subroots are exchanged likewise.
3. A partition's upper proof meets its leaves once more; each leaf gets its proof and is folded up to the root.

H is the lower-case hex SHA-256; digests are concatenated as hex text. A field is ``-`` if null, else its length in UTF-8 bytes, ``:`` and the value.

Defined cases: a null id comes before any other, a null group is the first group; rows that share an id are ordered by leaf (equal leaves are
interchangeable); texts of any length are hashed whole; an empty table gives an empty result and no root; columns other than
those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorloom.llm.keys import NULL_ID, id_of
from vectorloom.session import stored

FANOUT, HEIGHT = 8, 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64
_PATH = "array<struct<place: int, digests: array<string>>>"


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by ``grp`` get the number of their range and their number in it and the group."""
    part, last, had = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        code = batch.column("grp").dictionary_encode().indices.to_numpy()
        begin = np.concatenate([[0], np.flatnonzero(code[1:] != code[:-1]) + 1])
        sizes = np.diff(np.append(begin, len(code)))
        at = np.arange(len(code)) - np.repeat(begin, sizes)
        if batch.column("grp")[0].as_py() == last:
            at[: sizes[0]] += had
        last, had = batch.column("grp")[-1].as_py(), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(code), part), pa.int64()), pa.array(at, pa.int64())], [*batch.schema.names, "range", "at"]
        )


def positions(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the number from 0 within their ``grp`` in the given order, and ``total``, the group's size."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", range long, at long"
    dealt = stored(
        rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order).mapInArrow(_numbered, schema), "ranges"
    )
    counts = dealt.groupBy("grp", "range").agg(F.count("*").alias("n"))  # a row for each range, and one more for each group
    whole = Window.partitionBy("grp")
    offsets = counts.select(
        "grp", "range", (F.sum("n").over(whole.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("offset"),
        F.sum("n").over(whole).alias("total"),
    )
    return dealt.join(offsets, ["grp", "range"]).withColumn("pos", F.col("offset") + F.col("at")).drop("range", "at", "offset")


def butterfly(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Swap subtree roots until each node has its group's root.

    ``nodes`` has grp, part (0..parts-1), parts and digest, and further columns that come along. ``digest`` becomes the root;
    ``path`` holds, level by level, the run of digests that the node's ancestor lies in, and its place there.
    """
    others = [c for c in nodes.columns if c != "digest"]
    most = nodes.agg(F.max("parts")).first()[0] or 0
    now, span = nodes.withColumn("path", F.expr(f"cast(array() as {_PATH})")), 1
    while span < most:
        sub, low = F.floor(F.col("part") / span), F.col("part") % span
        active = now.where(F.col("parts") > span).withColumn("sub", sub).withColumn("low", low)
        size = F.least(F.lit(span).cast("long"), F.col("parts") - F.col("sub") * span)
        # A partition of a full subtree speaks to its own counterparts, one of a shorter subtree also to those without one.
        sent = active.withColumn("to", F.explode(F.sequence(F.col("low"), F.lit(span - 1).cast("long"), size))).select(
            "grp", F.floor(F.col("sub") / fanout).alias("parent"), "to",
            F.struct((F.col("sub") % fanout).cast("int").alias("place"), "digest",
                     F.when(F.col("to") == F.col("low"), F.struct(*others, "path")).alias("own")).alias("m"),
        )
        swapped = sent.groupBy("grp", "parent", "to").agg(F.collect_list("m").alias("run")).withColumn(  # ``fanout`` messages at most
            "run", F.array_sort("run", lambda a, b: a["place"] - b["place"])
        )
        known = swapped.select(
            F.col("run.digest").alias("digests"), F.explode(F.filter("run", lambda m: m["own"].isNotNull())).alias("m")
        )
        step = F.struct(F.col("m.place").alias("place"), "digests")
        hashed = known.select(
            *[F.col(f"m.own.{c}").alias(c) for c in others], F.sha2(F.array_join("digests", ""), 256).alias("digest"),
            F.concat("m.own.path", F.array(step)).cast(_PATH).alias("path"),
        )
        now = hashed.unionByName(now.where(F.col("parts") <= span))
        span *= fanout
    return now


def _parent(nodes: list[str], fanout: int) -> list[str]:
    return [sha256("".join(nodes[i : i + fanout]).encode()).hexdigest() for i in range(0, len(nodes), fanout)]


def subtree(leaves: list[str], whole: bool, fanout: int, height: int) -> list[list[str]]:
    """Levels of a partition's tree: up to a single node if it is the ``whole`` group, else ``height`` levels above the leaves."""
    levels = [leaves]
    while len(levels[-1]) > 1 if whole else len(levels) <= height:
        levels.append(_parent(levels[-1], fanout))
    return levels


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[list]]]:
    """Rows sorted by (grp, part), one partition's at a time, as lists by column."""
    key, held = None, [[] for _ in names]
    for batch in batches:
        if not batch.num_rows:
            continue
        grp, part = batch.column("grp"), batch.column("part").to_numpy()
        code = pc.fill_null(grp.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((code[1:] != code[:-1]) | (part[1:] != part[:-1])) + 1
        columns = [batch.column(n).to_pylist() for n in names]
        for lo, hi in zip([0, *cuts], [*cuts, len(part)]):
            now = (grp[int(lo)].as_py(), int(part[lo]))
            if now != key and key is not None:
                yield key, held
                held = [[] for _ in names]
            key = now
            for into, column in zip(held, columns):
                into += column[lo:hi]
    if key is not None:
        yield key, held


def _root_rows(fanout: int, height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (grp, part), (leaves, totals) in _groups(batches, ["leaf", "total"]):
            parts = -(-totals[0] // fanout**height)
            top = subtree(leaves, parts == 1, fanout, height)[-1][0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([grp]), pa.array([part], pa.int64()), pa.array([parts], pa.int64()), pa.array([top])], ["grp", "part", "parts", "digest"]
            )

    return run


def _proof_rows(fanout: int, height: int, with_proof: bool):
    names = ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root"] + ["proof"] * with_proof

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (key, leaves, altered, totals, subroot, root, path) in _groups(batches, ["key", "leaf", "altered", "total", "subroot", "root", "path"]):
            # The first row is the partition's upper proof.
            whole = -(-totals[1] // fanout**height) == 1
            levels = subtree(leaves[1:], whole, fanout, height)
            upper = [("".join(p["digests"]), p["place"]) for p in path[0]]
            after = "".join(run[: at * _HEX] + run[(at + 1) * _HEX :] for run, at in upper)
            runs = [["".join(level[i : i + fanout]) for i in range(0, len(level), fanout)] for level in levels[:-1]]
            proofs, folds, whole_proofs = [], [], []
            for i, (own, other) in enumerate(zip(leaves[1:], altered[1:])):
                now, at, siblings = other or own, i, []
                for level in runs:
                    lo = at % fanout * _HEX
                    at //= fanout
                    before, behind = level[at][:lo], level[at][lo + _HEX :]
                    siblings.append(before + behind)
                    now = sha256((before + now + behind).encode()).hexdigest()
                for run_, place in upper:
                    now = sha256((run_[: place * _HEX] + now + run_[(place + 1) * _HEX :]).encode()).hexdigest()
                proofs.append(sha256(("".join(siblings) + after).encode()).hexdigest())
                folds.append(now)
                if with_proof:
                    local = [(r[i // fanout ** (n + 1)], i // fanout**n % fanout) for n, r in enumerate(runs)]
                    whole_proofs.append([{"place": p, "digests": [r[a : a + _HEX] for a in range(0, len(r), _HEX)]} for r, p in [*local, *upper]])
            n = len(proofs)
            columns = [pa.array(key[1:], pa.int64()), pa.array(leaves[1:]), pa.array([subroot[0]] * n), pa.array([root[0]] * n), pa.array(proofs), pa.array(folds)]
            if with_proof:
                columns.append(pa.array(whole_proofs, pa.list_(pa.struct([("place", pa.int32()), ("digests", pa.list_(pa.string()))]))))
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def manifest(
    rows: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", altered: Column | None = None,
    fanout: int = FANOUT, height: int = HEIGHT, with_proof: bool = False,
) -> DataFrame:
    """One row per row: id, leaf, subroot, root, proof_sha256 (hash of all siblings, from the leaf to the root), folded_root and verified.

    ``altered`` is the leaf as found when checking, null where it is as recorded; it is folded with the recorded siblings. ``with_proof`` adds
    ``proof``: per level the run that holds the node, and its place.
    """
    leaves = stored(
        rows.select(
            F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("")).alias("grp"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("key"), leaf([F.col(c) for c in columns]).alias("leaf"),
            (F.lit(None).cast("string") if altered is None else altered).alias("altered"),
        ),
        "leaves",
    )
    placed = positions(leaves.withColumn("row", F.monotonically_increasing_id()), ["key", "leaf", "row"])
    cut = stored(placed.select("grp", F.floor(F.col("pos") / fanout**height).alias("part"), "pos", "key", "leaf", "altered", "total"), "partitions")
    tops = stored(
        cut.select("grp", "part", "pos", "leaf", "total").repartition("grp", "part").sortWithinPartitions("grp", "part", "pos")
        .mapInArrow(_root_rows(fanout, height), "grp string, part long, parts long, digest string"),
        "subtrees",
    )
    inner = stored(butterfly(tops, fanout), "subroots")
    groups = inner.where("part = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    ordered = positions(groups, ["name"]).select("grp", F.col("pos").alias("part"), F.col("total").alias("parts"), "digest", "name")
    outer = stored(butterfly(stored(ordered, "groups"), fanout), "roots").select(
        F.col("name").alias("grp"), F.col("digest").alias("root"), F.col("path").alias("outer")
    )
    upper = inner.join(outer, "grp").select(
        "grp", "part", F.lit(-1).cast("long").alias("pos"), F.col("digest").alias("subroot"), "root", F.concat("path", "outer").alias("path")
    )
    proofs = (
        cut.unionByName(upper, allowMissingColumns=True).repartition("grp", "part").sortWithinPartitions("grp", "part", "pos")
        .mapInArrow(
            _proof_rows(fanout, height, with_proof),
            "key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string" + f", proof {_PATH}" * with_proof,
        )
    )
    return proofs.select(
        id_of().alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
        *["proof"] * with_proof,
    )
