"""Product-quantised vector codes by dual-tree Lloyd iterations.

Components become integers; vectors are cut into PARTS equal parts, and each part position has a codebook of up to
ENTRIES integer vectors. Rows are dealt into blocks, and each block keeps a tree over its parts of every position: boxes,
counts and sums of every node, written once and read in every round. In a round each task holds a tree over the
entries of the codebook and walks pairs of nodes, one of each tree. The largest distance between two boxes bounds
what a node's parts can be away from their nearest entry; pairs whose least distance is above that bound go. A node left with one
entry is assigned as a whole by its cached sum and count; where leaves keep several entries, integer distances
of the single parts decide, ties to the lower index. All of it is exact, so the result does not depend on the blocks.

A task returns one sum per entry; Spark adds them, and only the codebook (PARTS x ENTRIES x length of a part numbers)
reaches the driver.

Defined cases: vectors that are null, empty, or hold null or non-finite components are dropped; so are those whose length is
not the commonest one that PARTS divides. Components beyond 2**15 count as 2**15. With fewer rows than ENTRIES, each row is an
entry. Rows without an id come last when the first codebook is taken; of rows that share an id the smaller integers come first, and
each row has a result of its own. Equal entries are the lower one. Null labels are one label. An empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from plumbline.llm.common import binary, joined_to_groups, saved, table
from plumbline.llm.vectors import as_matrix, commonest_length, integer_rows

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 4096  # rows of a block
LEAF = 32  # parts of a leaf
EXACT = 2**53  # integers below are exact as doubles


# ---------------------------------------------------------------- trees


def grown(x: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The row at each place of a balanced tree, which places count, and the number of levels below the root.

    Every node splits its widest dimension at the median. Rows are padded to leaf * 2**levels places by copies of the
    last one that do not count.
    """
    levels = max(0, int(np.ceil(np.log2(max(1, len(x)) / leaf))))
    size = leaf << levels
    order = np.minimum(np.arange(size), len(x) - 1)
    counts = np.arange(size) < len(x)
    for level in range(levels):
        points = x[order].reshape(1 << level, -1, x.shape[1])
        wide = (points.max(axis=1) - points.min(axis=1)).argmax(axis=1)
        keys = np.take_along_axis(points, wide[:, None, None], axis=2)[:, :, 0]
        sort = keys.argsort(axis=1, kind="stable")
        order = np.take_along_axis(order.reshape(1 << level, -1), sort, axis=1).ravel()
        counts = np.take_along_axis(counts.reshape(1 << level, -1), sort, axis=1).ravel()
    return order, counts, levels


def node_values(x: np.ndarray, order: np.ndarray, counts: np.ndarray, levels: int) -> tuple[np.ndarray, ...]:
    """Lowest and highest corner, sum and count of every node; the children of node i are 2i + 1 and 2i + 2."""
    points = x[order].reshape(1 << levels, -1, x.shape[1])
    weight = counts.reshape(1 << levels, -1)
    now = [points.min(axis=1), points.max(axis=1), (points * weight[:, :, None]).sum(axis=1), weight.sum(axis=1)]
    stack = [now]
    for _ in range(levels):
        a, b = [v[0::2] for v in now], [v[1::2] for v in now]
        now = [np.minimum(a[0], b[0]), np.maximum(a[1], b[1]), a[2] + b[2], a[3] + b[3]]
        stack.append(now)
    return tuple(np.concatenate([level[i] for level in reversed(stack)]) for i in range(4))


class EntryTree:
    """A tree with one entry per leaf over the different entries of a codebook."""

    def __init__(self, book: np.ndarray):
        entries, first = np.unique(book, axis=0, return_index=True)
        order, counts, levels = grown(entries, 1)
        self.book, self.leaves = book, 1 << levels
        self.low, self.high, _, self.count = node_values(entries, order, counts, levels)
        self.entry = first[order]  # of each leaf, the lowest index of equal entries
        self.width = diameter(self.low, self.high)


def diameter(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return ((high - low) ** 2).sum(axis=1)


def walk(low: np.ndarray, high: np.ndarray, leaves: int, tree: EntryTree) -> tuple[np.ndarray, ...]:
    """Nodes assigned as a whole with their entries, and (leaf node, entry) pairs that integers have to decide.

    All pairs of a node take the same step: its entry nodes are split while one of them is wider than the node, then
    the node itself is.
    """
    best, width = np.full(len(low), np.iinfo(np.int64).max), diameter(low, high)
    q, r = np.zeros(1, np.int64), np.zeros(1, np.int64)
    whole, undecided = [np.zeros((2, 0), np.int64)], [np.zeros((2, 0), np.int64)]
    while len(q):
        apart = np.maximum(0, np.maximum(low[q] - tree.high[r], tree.low[r] - high[q]))
        across = np.maximum(high[q] - tree.low[r], tree.high[r] - low[q])
        nearest, farthest = (apart * apart).sum(axis=1), (across * across).sum(axis=1)
        np.minimum.at(best, q, farthest)
        stays = nearest <= best[q]  # an entry at the same distance stays: the lower index decides
        q, r = q[stays], r[stays]
        q_leaf, r_leaf = q >= leaves - 1, r >= tree.leaves - 1
        alone = r_leaf & (np.bincount(q, minlength=len(low))[q] == 1)
        ended = q_leaf & r_leaf & ~alone
        for kind, out in ((alone, whole), (ended, undecided)):
            out.append(np.stack([q[kind], tree.entry[r[kind] - tree.leaves + 1]]))
        go = ~alone & ~ended
        q, r, q_leaf, r_leaf = q[go], r[go], q_leaf[go], r_leaf[go]
        widest = np.zeros(len(low), np.int64)
        np.maximum.at(widest, q, tree.width[r])
        down = ~r_leaf & (q_leaf | (widest[q] >= width[q]))  # the entry nodes of a node are all on one level
        child = np.concatenate([2 * q[~down] + 1, 2 * q[~down] + 2])
        best[child] = best[(child - 1) // 2]
        q, r = (
            np.concatenate([child, q[down], q[down]]),
            np.concatenate([r[~down], r[~down], 2 * r[down] + 1, 2 * r[down] + 2]))
        counted = tree.count[r] > 0
        q, r = q[counted], r[counted]
    return *np.concatenate(whole, axis=1), *np.concatenate(undecided, axis=1)


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer matrices."""
    most = max(np.abs(x).max(initial=0), np.abs(y).max(initial=0))
    if 4 * x.shape[1] * int(most) ** 2 < EXACT:  # products and sums are integers that doubles hold exactly
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype(np.int64)
    out = np.zeros((len(x), len(y)), np.int64)
    for i in range(x.shape[1]):
        out += (x[:, i, None] - y[None, :, i]) ** 2
    return out


class Block:
    """The parts of one position of a block with their tree."""

    def __init__(self, x, order, counts, low, high, sums, n):
        self.x, self.order, self.counts, self.low, self.high, self.sums, self.n = x, order, counts, low, high, sums, n
        self.leaves = (len(n) + 1) // 2
        self.leaf = len(order) // self.leaves

    def decided(self, tree: EntryTree) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Nodes with one entry and that entry; places of the other leaves and their entries."""
        nodes, entries, leaf, entry = walk(self.low, self.high, self.leaves, tree)
        by_leaf = np.lexsort((entry, leaf))
        leaf, entry = leaf[by_leaf], entry[by_leaf]
        edges = np.flatnonzero(np.diff(leaf, prepend=-1, append=-1)).tolist()
        places, chosen = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in zip(edges, edges[1:]):
            place = (leaf[a] - self.leaves + 1) * self.leaf + np.arange(self.leaf)
            candidates = entry[a:b]
            nearest = squared_distances(self.x[self.order[place]], tree.book[candidates]).argmin(axis=1)
            places.append(place)
            chosen.append(candidates[nearest])  # the first, so the lowest, of equally near ones
        return nodes, entries, np.concatenate(places), np.concatenate(chosen)

    def add_to(self, total: np.ndarray, tree: EntryTree) -> None:
        """Add the number (column 0) and the sums of the parts of each entry."""
        nodes, entries, places, chosen = self.decided(tree)
        np.add.at(total, entries, np.concatenate([self.n[nodes][:, None], self.sums[nodes]], axis=1))
        ones = self.counts[places].astype(np.int64)[:, None]
        np.add.at(total, chosen, np.concatenate([ones, self.x[self.order[places]] * ones], axis=1))

    def labels(self, tree: EntryTree) -> np.ndarray:
        """The entry of every part."""
        nodes, entries, places, chosen = self.decided(tree)
        at = np.zeros(len(self.order), np.int64)
        at[places] = chosen
        level = np.frexp(nodes + 1)[1] - 1
        size = len(self.order) >> level
        for start, stop, entry in zip(((nodes + 1 - (1 << level)) * size).tolist(), ((nodes + 2 - (1 << level)) * size).tolist(), entries.tolist()):
            at[start:stop] = entry
        out = np.zeros(len(self.x), np.int64)
        out[self.order[self.counts]] = at[self.counts]
        return out


# ---------------------------------------------------------------- on tables


NODE = ("low", "high", "sums", "n")
FIELDS = ("order", "counts", *NODE)
KINDS = {"order": "<i4", "counts": "?", "low": "<i4", "high": "<i4", "sums": "<i8", "n": "<i4"}


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of rows with their trees, written: ids, labels, vectors, and per position the places and nodes."""
    kind = rows.schema["label"].dataType.simpleString()

    def planted(held: pa.Table) -> pa.RecordBatch:
        held = held.combine_chunks()
        x = as_matrix(held.column("vector").chunk(0))
        trees: dict[str, list[bytes]] = {f: [] for f in FIELDS}
        for part in np.split(x, PARTS, axis=1):
            order, counts, levels = grown(part, LEAF)
            for f, values in zip(FIELDS, (order, counts, *node_values(part, order, counts, levels))):
                trees[f].append(values.astype(KINDS[f]).tobytes())
        one = lambda column: pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
        return pa.RecordBatch.from_arrays(
            [one(held.column("vec_id").chunk(0)), one(held.column("label").chunk(0)),
             binary([x.astype("<i4").tobytes()]), *[pa.array([trees[f]], pa.list_(pa.binary())) for f in FIELDS]],
            ["ids", "labels", "vectors", *FIELDS])

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while len(held) >= BLOCK:
                yield planted(held.slice(0, BLOCK))
                held = held.slice(BLOCK)
        if held is not None and len(held):
            yield planted(held)

    fields = ", ".join(f"{f} array<binary>" for f in FIELDS)
    return saved(
        rows.select("vec_id", "label", "vector").mapInArrow(plant, f"ids array<long>, labels array<{kind}>, vectors binary, {fields}"),
        "blocks")


def read_block(batch: pa.RecordBatch, i: int, dim: int) -> tuple[np.ndarray, list[Block]]:
    """Vectors and the trees of every position of one block."""
    x = np.frombuffer(batch.column("vectors")[i].as_buffer(), "<i4").reshape(-1, dim).astype(np.int64)
    width, trees = dim // PARTS, []
    for p, part in enumerate(np.split(x, PARTS, axis=1)):
        values = {f: np.frombuffer(batch.column(f)[i].values[p].as_buffer(), KINDS[f]) for f in FIELDS}
        corners = {f: values[f].astype(np.int64).reshape(-1, width) for f in ("low", "high", "sums")}
        trees.append(Block(part, values["order"], values["counts"], n=values["n"].astype(np.int64), **corners))
    return x, trees


def improved(stored: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: every used entry becomes the floor of the mean of its parts."""
    dim = PARTS * books.shape[2]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(b) for b in books]
        total = np.zeros((PARTS, books.shape[1], books.shape[2] + 1), np.int64)
        for batch in batches:
            for i in range(len(batch)):
                for p, block in enumerate(read_block(batch, i, dim)[1]):
                    block.add_to(total[p], trees[p])
        part, entry = np.nonzero(total[:, :, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(list(total[part, entry]), pa.list_(pa.int64()))],
            ["part", "entry", "sums"])

    parts = stored.select("vectors", *FIELDS).mapInArrow(sums, "part int, entry int, sums array<long>")
    added = parts.select("part", "entry", F.posexplode("sums").alias("at", "value")).groupBy("part", "entry", "at").agg(
        F.sum(F.col("value").cast("decimal(20,0)")).alias("value"))
    found = {(r.part, r.entry, r.at): int(r.value) for r in added.collect()}  # one number per place of a codebook
    out = books.copy()
    for (p, e, at), value in found.items():
        if at:
            out[p, e, at - 1] = value // found[p, e, 0]
    return out


def assigned(stored: DataFrame, books: np.ndarray, kind: str) -> DataFrame:
    """(vec_id, label, code, error) of every row, written."""
    dim = PARTS * books.shape[2]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(b) for b in books]
        for batch in batches:
            for i in range(len(batch)):
                x, own = read_block(batch, i, dim)
                labels = np.stack([block.labels(tree) for block, tree in zip(own, trees)], axis=1)
                near = np.concatenate([books[p][labels[:, p]] for p in range(PARTS)], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values,
                     pa.array(["".join(f"{e:02x}" for e in row) for row in labels.tolist()], pa.string()),
                     pa.array(((x - near) ** 2).sum(axis=1))], ["vec_id", "label", "code", "error"])

    return saved(stored.mapInArrow(assign, f"vec_id long, label {kind}, code string, error long"), "codes")


def trained(rows: DataFrame, stored: DataFrame, dim: int) -> np.ndarray:
    """Codebooks (position, entry, component) after ROUNDS rounds, from the rows with the smallest ids."""
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(ENTRIES).collect()
    start = np.stack([np.frombuffer(r.vector, "<i4") for r in first]).astype(np.int64)
    books = np.stack(np.split(start, PARTS, axis=1))
    for _ in range(ROUNDS):
        books = improved(stored, books)
    return books


def coded(embeddings: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of the usable rows, and the codebooks."""
    kind = embeddings.schema["label"].dataType.simpleString()
    all_rows = integer_rows(embeddings, SCALE, ["vec_id", "label"])
    dim = commonest_length(all_rows.filter(F.col("dim") % PARTS == 0))
    if dim is None:
        none = embeddings.sparkSession.createDataFrame([], f"vec_id long, label {kind}, code string, error long")
        return none, np.zeros((PARTS, 0, 0), np.int64)
    rows = all_rows.filter(F.col("dim") == dim)
    stored = blocks(rows)
    books = trained(rows, stored, dim)
    return assigned(stored, books, kind), books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by position, entry and place, as decimals."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def op12_dual_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = coded(table(spark, sf_dir, "embeddings"))
    errors = saved(
        rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    return joined_to_groups(rows, errors, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    finite_vector = "embedding IS NOT NULL AND len(embedding) > 0 AND list_sum(list_transform(embedding, lambda x: CAST(coalesce(isfinite(x), FALSE) AS INTEGER))) = len(embedding)"
    steps = [f"""kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings WHERE {finite_vector}
), cut AS MATERIALIZED (
  SELECT vec_id, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM kept, range({PARTS}) r(p)
), e0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS i, x AS y FROM cut
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})
)"""]
    for k in range(ROUNDS + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
  SELECT vec_id, c.p, any_value(x) AS x, min({{'d': CAST(list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y) AS BIGINT), 'i': i}}) AS best
  FROM cut c JOIN e{k} e ON c.p = e.p GROUP BY vec_id, c.p
)""")
        if k < ROUNDS:
            steps.append(f"""s{k} AS (
  SELECT p, best.i AS i, unnest(x) AS value, unnest(range(len(x))) AS spot FROM a{k}
), m{k} AS (
  SELECT p, i, spot, sum(CAST(value AS BIGINT)) AS total, count(*) AS n FROM s{k} GROUP BY p, i, spot
), f{k} AS (
  SELECT p, i, list(CAST((total - ((total % n) + n) % n) // n AS DOUBLE) ORDER BY spot) AS y FROM m{k} GROUP BY p, i
), e{k + 1} AS MATERIALIZED (
  SELECT e.p, e.i, coalesce(f.y, e.y) AS y FROM e{k} e LEFT JOIN f{k} f ON e.p = f.p AND e.i = f.i
)""")
    return "WITH " + ", ".join(steps) + f""", told AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(best.i AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id
), numbers AS (
  SELECT p, i, unnest(y) AS value, unnest(range(len(y))) AS spot FROM e{ROUNDS}
), books AS (
  SELECT sha256(string_agg(CAST(CAST(value AS BIGINT) AS VARCHAR), ',' ORDER BY p, i, spot)) AS codebooks_sha256 FROM numbers
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM told JOIN kept USING (vec_id), books
"""


OP12_SQL = _sql()
