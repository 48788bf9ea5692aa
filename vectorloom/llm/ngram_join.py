"""Self-join of documents by Jaccard similarity of their word shingles: MinHash LSH forest, then exact verification.

1. Documents with the same shingle set form a class; from here on a class is one row, however many copies it has.
2. Each class gets ``TREES`` MinHash signatures of ``DEPTH`` values. A tree of the forest is the prefix trie of one
   signature: a node of depth k is the set of classes whose first k values agree.
3. Matching begins at full depth. In every node the smallest class is compared with the others by a sketch of all
   values (no pairs). What is similar enough is tied to it; what is so close to it that all its own partners must be tied
   as well is settled; the rest goes on with its next smallest class. After ``TURNS`` turns what is left of a node
   is tied without a look at the sketches, so nothing is lost. Groups of candidates are the components of the ties.
4. All pairs inside a group are verified exactly. A group is cut into blocks of ``BLOCK_SHINGLES``
   shingles or ``BLOCK_CLASSES`` classes, and each pair of blocks is one unit of work: a matrix product over the shingles that both
   blocks hold. A unit gives the number of links of each class, a spanning forest of its links and its lowest similarity, never
   the pairs. So a group with a third of all documents is spread over many tasks and still counted in full.
5. Prefixes are shortened as far as the links themselves ask for it: to the depth k at which a link of the lowest similarity s found shares a node
   with a chance ``1 - (1 - s^k)^TREES`` of at least the target recall, 0.9999. First the sketches are asked, then the
   verified links, until the depth stays. Data whose copies are all close stay at full depth; a single link near the threshold
   shortens the prefixes for all. Links below the lowest one found would all have to be missed at the depth reached: at 0.8 and
   full depth that has a chance of 0.0035 for one link, of 0.00001 for two, whatever the size of the corpus.

Words are lower-cased (A-Z) and separated by ASCII white space, punctuation and control characters. Shingles are sets of
five words; a shorter text has one shingle of all its words. Hashes have 64 bits, the class digest 128.

Defined cases: a null text, and one without words, links with nothing; rows of one id are rows of
their own, so a repeated row is a copy; a null id counts as smaller than any other and gives a null class
where it is the smallest; equal texts are linked; further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.components import components
from vectorloom.llm.keys import id_of, keyed
from vectorloom.llm.words import PLAIN, distinct_pairs, lists, mix, shingles, signed, slices, words_of
from vectorloom.session import stored

SIZE, THRESHOLD, RECALL = 5, 0.8, 0.9999
TREES, DEPTH = 24, 7
#: Estimated similarity from which a class is tied to the smallest of its node, and from which it is settled by that.
TIED, SETTLED = 0.45, 0.85
TURNS = 3
BLOCK_SHINGLES, BLOCK_CLASSES = 1 << 20, 2048
_STRIP = 2048
#: A text with words has such a character.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_PERMUTED = np.random.default_rng(7).integers(0, 1 << 32, (TREES * DEPTH, 2), dtype=np.uint32) | np.uint32(1)

#: Unequal halves of a byte that is the difference of two sketches.
_UNEQUAL = np.array([(i >> 4 > 0) + (i & 15 > 0) for i in range(256)], np.uint8)


def prefix_length(threshold: float, recall: float, trees: int, depth: int) -> int:
    """Longest prefix at which a pair of the similarity ``threshold`` shares a node of some tree with the target recall."""
    k = depth
    while k > 1 and 1 - (1 - threshold**k) ** trees < recall:
        k -= 1
    return k


def _signatures(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """TREES * DEPTH MinHash values of 16 bits for each text."""
    low = (values >> np.uint64(32)).astype(np.uint32) ^ values.astype(np.uint32)
    out = np.empty((len(begin), TREES * DEPTH), np.uint16)
    work = np.empty_like(low)
    for j, (a, b) in enumerate(_PERMUTED):
        np.bitwise_xor(low, b, out=work)
        np.multiply(work, a, out=work)
        np.bitwise_xor(work, work >> np.uint32(15), out=work)
        np.multiply(work, np.uint32(0x2C1B3C6D), out=work)
        out[:, j] = mix(np.minimum.reduceat(work, begin).astype(np.uint64) + np.uint64(j + 1)) >> np.uint64(40)
    return out


def _sketches(values: np.ndarray) -> pa.Array:
    """Four bits of each MinHash value."""
    packed = ((values[:, ::2] & 15) << 4 | values[:, 1::2] & 15).astype(np.uint8)
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(packed.shape[1]), len(packed), [None, pa.py_buffer(np.ascontiguousarray(packed))]
    ).cast(pa.binary())


def _estimates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of the two classes of each row by the share of equal values in their sketches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sides = [
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            for c in ("sketch", "low_sketch")
        ]
        equal = 1 - _UNEQUAL[sides[0] ^ sides[1]].sum(1) / (TREES * DEPTH)
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), batch.column("low"), pa.array((equal * 16 - 1) / 15)], ["node", "low", "similarity"]
        )


def _sets(piece: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    words = words_of(piece.column("text"), PLAIN)
    values, owner = shingles(words.hashes(), words.bounds, size)
    owner, values = distinct_pairs(owner, values)
    return values, np.bincount(owner, minlength=piece.num_rows)


def _signature_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                values, counts = _sets(piece, size)
                full = np.flatnonzero(counts)
                begin = (np.cumsum(counts) - counts)[full]
                if len(full):
                    digest = [np.add.reduceat(mix(values + np.uint64(c)), begin) for c in (1, 2)]
                    minima = _signatures(values, begin)
                else:
                    digest, minima = [np.empty(0, np.uint64)] * 2, np.empty((0, TREES * DEPTH), np.uint16)
                at = pa.array(full)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key").take(at), piece.column("tag").take(at), pa.array(signed(digest[0])),
                     pa.array(signed(digest[1])), pa.array(counts[full].astype(np.int64)),
                     lists(minima.view(np.int16).ravel(), np.full(len(full), TREES * DEPTH), pa.int16()), _sketches(minima)],
                    ["key", "tag", "d1", "d2", "n", "minima", "sketch"],
                )

    return run


def _set_rows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                values, counts = _sets(piece, size)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in ("node", "copies", "part", "grp", "parts")]
                    + [lists(signed(values), counts, pa.int64())],
                    ["node", "copies", "part", "grp", "parts", "shingles"],
                )

    return run


def _overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matrices of left x right: sizes of the intersection and of the union of the sets."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.append(0, flat[1:] != flat[:-1]))
    shared = np.bincount(column)[column] > 1
    owner, column = owner[shared], column[shared]
    column = np.cumsum(np.append(0, column[1:] != column[:-1])) if len(column) else column
    row = np.full(len(sets), -1), np.full(len(sets), -1)
    row[0][left], row[1][right] = np.arange(len(left)), np.arange(len(right))
    common = np.zeros((len(left), len(right)), np.float32)
    n_columns = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, n_columns, _STRIP):
        a, b = np.searchsorted(column, [lo, lo + _STRIP])
        who, col = owner[a:b], column[a:b] - lo
        sides = []
        for place, n in ((row[0], len(left)), (row[1], len(right))):
            m = np.zeros((n, min(_STRIP, n_columns - lo)), np.float32)
            in_side = place[who] >= 0
            m[place[who[in_side]], col[in_side]] = 1
            sides.append(m)
        common += sides[0] @ sides[1].T
    return common, sizes[left][:, None] + sizes[right][None, :] - common


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Spanning forest of the links of a True matrix over row and column numbers in 0..n-1, by whole-row visits."""
    seen = np.zeros(n, dtype=bool)
    out = []
    for i in range(n):
        if seen[i]:
            continue
        seen[i] = True
        stack = [i]
        while stack:
            at = stack.pop()
            new = np.flatnonzero(pairs[at] & ~seen)
            seen[new] = True
            out += [(at, int(x)) for x in new]
            stack += new.tolist()
    return out


def _unit(node, copies, part, sets, pair, threshold) -> pa.RecordBatch:
    """Links of one pair of blocks: their number for each class, a spanning forest, the lowest similarity."""
    node, first = np.unique(node, return_index=True)
    copies, part, sets = copies[first], part[first], [sets[i] for i in first]
    a, b = pair
    left, right = np.flatnonzero(part == a), np.flatnonzero(part == b)
    n = len(node)
    links, tree, low = np.zeros(n, np.int64), [], None
    if len(left) and len(right) and n > 1:
        common, union = _overlaps(sets, left, right)
        linked = common >= threshold * union - 1e-6
        if a == b:
            np.fill_diagonal(linked, False)
        if linked.any():
            low = float((common[linked] / union[linked]).min())
        if a == b:
            links[left] = linked @ copies[right]
            tree = _forest(linked, len(left))
            tree = [(left[i], left[j]) for i, j in tree]
        else:
            links[left] += linked @ copies[right]
            links[right] += linked.T @ copies[left]
            both = np.zeros((n, n), dtype=bool)
            both[np.ix_(left, right)] = linked
            both |= both.T
            tree = _forest(both, n)
    have = np.flatnonzero(links)
    x = np.array([t[0] for t in tree], np.int64)
    y = np.array([t[1] for t in tree], np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([node[have], node[x]])),
         pa.array(np.concatenate([links[have], np.zeros(len(x), np.int64)])),
         pa.concat_arrays([pa.nulls(len(have), pa.int64()), pa.array(node[y])]),
         pa.array([low] * (len(have) + len(x)), pa.float64())],
        ["node", "links", "other", "lowest"],
    )


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []

        def done():
            node, copies, part = (np.array([r[i] for r in rows], np.int64) for i in range(3))
            return _unit(node, copies, part, [r[3] for r in rows], (key[1], key[2]), threshold)

        for batch in batches:
            grp, a, b, node, copies, part = (batch.column(c).to_pylist() for c in ("grp", "a", "b", "node", "copies", "part"))
            sets = batch.column("shingles")
            flat, where = sets.values.to_numpy(), sets.offsets.to_numpy()
            for i in range(batch.num_rows):
                now = (grp[i], a[i], b[i])
                if key is not None and now != key:
                    yield done()
                    rows = []
                key = now
                rows.append((node[i], copies[i], part[i], flat[where[i] : where[i + 1]].copy()))
        if rows:
            yield done()

    return run


def _ties(classes: DataFrame, depth: int) -> DataFrame:
    """(node, low, similarity): what the trie nodes of one depth tie; the similarity is estimated, null where it was not asked."""
    label = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.xxhash64(t, F.slice("minima", t * DEPTH + 1, F.lit(depth)))
    )
    sketches = classes.select(F.col("d1").alias("node"), "sketch")
    left, out = classes.select(F.col("d1").alias("node"), F.explode(label).alias("at")), None
    for turn in range(TURNS + 1):
        smallest = left.groupBy("at").agg(F.min("node").alias("low"), F.count("*").alias("c")).where("c > 1")
        met = stored(left.join(smallest, "at").where("node != low").select("at", "node", "low"), "met")
        pairs = met.select("node", "low").distinct()
        if turn == TURNS:
            return out.unionByName(pairs.withColumn("similarity", F.lit(None).cast("double")))
        judged = stored(
            pairs.join(sketches, "node")
            .join(sketches.select(F.col("node").alias("low"), F.col("sketch").alias("low_sketch")), "low")
            .mapInArrow(_estimates, "node long, low long, similarity double"),
            "judged",
        )
        tied = judged.where(F.col("similarity") >= TIED)
        out = tied if out is None else out.unionByName(tied)
        # The smallest class has met all others of its node and leaves as well.
        left = met.join(judged.where(F.col("similarity") >= SETTLED), ["node", "low"], "left_anti").select("node", "at")
        if left.groupBy("at").count().where("count > 1").isEmpty():
            return out


def _verify(rows: DataFrame, classes: DataFrame, ties: DataFrame, size: int, threshold: float) -> DataFrame:
    """Exact links inside the components of the ties: numbers for each class, spanning trees, lowest similarity of the unit."""
    grouped = components(ties, "node", "low").withColumnRenamed("component", "grp")
    members = stored(
        classes.select(F.col("d1").alias("node"), "rep", "copies", "n").join(grouped, "node"), "members"
    )
    volumes = members.groupBy("grp").agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_CLASSES)).cast("int").alias("parts")
    )
    cut = members.join(volumes, "grp").select(
        F.col("rep.key").alias("key"), F.col("rep.tag").alias("tag"), "node", "copies", "grp", "parts",
        F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part"),
    )
    # Always by merge: the plan of a large corpus, also where the few members would fit a broadcast.
    sets = rows.join(cut.hint("merge"), ["key", "tag"]).select("node", "copies", "part", "grp", "parts", "text").mapInArrow(
        _set_rows(size), "node long, copies long, part int, grp long, parts int, shingles array<long>"
    )
    units = sets.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "grp", F.least("part", "with").alias("a"), F.greatest("part", "with").alias("b"), "node", "copies", "part", "shingles"
    )
    return stored(
        units.repartition("grp", "a", "b").sortWithinPartitions("grp", "a", "b")
        .mapInArrow(_verified(threshold), "node long, links long, other long, lowest double"),
        "verified",
    )


def forest_links(
    rows: DataFrame, classes: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL
) -> tuple[DataFrame, int]:
    """Verified links of the classes, and the depth of prefix that they asked for."""
    depth, ties = DEPTH, _ties(classes, DEPTH)
    spread = 2 * (threshold * (1 - threshold) / (TREES * DEPTH)) ** 0.5
    lowest = ties.agg(F.min(F.when(F.col("similarity") >= threshold - spread, F.col("similarity")))).first()[0]
    found = None
    while True:
        # At least the depth of the threshold: nothing below it is a link.
        need = depth if lowest is None else prefix_length(max(lowest, threshold), recall, TREES, DEPTH)
        if need < depth:
            depth, ties = need, ties.unionByName(_ties(classes, need))
        elif found is not None:
            return found, depth
        found = _verify(rows, classes, ties, size, threshold)
        lowest = found.agg(F.min("lowest")).first()[0]


def _classed(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the digest of their shingle set; the classes, one row for each digest."""
    signed_rows = stored(
        rows.mapInArrow(
            _signature_rows(size), "key long, tag long, d1 long, d2 long, n long, minima array<short>, sketch binary"
        ),
        "signatures",
    )
    classes = stored(
        signed_rows.groupBy("d1", "d2").agg(
            F.min(F.struct("key", "tag")).alias("rep"), F.count("*").alias("copies"), F.first("n").alias("n"),
            F.first("minima").alias("minima"), F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    return signed_rows, classes


def ngram_classes(docs: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, copy_of, is_head, and internal key and tag.

    class_id is the smallest doc_id that links reach, n_links the number of other rows with a similarity of at least
    the threshold, copy_of the smallest doc_id with the same shingles; is_head marks the row that stands for its class.
    """
    rows = keyed(docs)
    signed_rows, classes = _classed(rows, size)
    found, _ = forest_links(rows, classes, size, threshold, recall)
    reach = components(found.where("other is not null"), "node", "other")
    links = found.where("other is null").groupBy("node").agg(F.sum("links").alias("links"))
    parts = classes.select(F.col("d1").alias("node"), "d2", "rep", "copies").join(reach, "node", "left").join(links, "node", "left")
    parts = parts.withColumn("component", F.coalesce("component", "node"))
    heads = parts.groupBy("component").agg(F.min("rep").alias("head"))
    table = parts.join(heads, "component").select(
        F.col("node").alias("d1"), "d2", "head", "rep",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    judged = signed_rows.select("key", "tag", "d1", "d2").join(table, ["d1", "d2"])
    wordless = rows.select("key", "tag", "text").where(~F.col("text").rlike(_WORD)).select(
        "key", "tag", F.struct("key", "tag").alias("head"), F.struct("key", "tag").alias("rep"), F.lit(0).cast("long").alias("n_links")
    )
    return judged.select("key", "tag", "head", "rep", "n_links").unionByName(wordless).select(
        id_of().alias("doc_id"), id_of("head.key").alias("class_id"), "n_links", id_of("rep.key").alias("copy_of"),
        (F.struct("key", "tag") == F.col("head")).alias("is_head"), "key", "tag",
    )


def drop_near_copies(docs: DataFrame, **settings) -> DataFrame:
    """The documents of which one of each class stays, with all their columns: the smallest id, and of
    rows with that same id and text one. Every document without words stays."""
    found = ngram_classes(docs, **settings).where("is_head").select("key", "tag").distinct()
    worded = F.coalesce(F.col("text").rlike(_WORD), F.lit(False))
    names = docs.columns
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("key"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("tag"), worded.alias("worded"),
    )
    kept = marked.where("worded").join(found, ["key", "tag"]).dropDuplicates(["key", "tag"])
    return kept.select("row.*").unionByName(marked.where("not worded").select("row.*"))
