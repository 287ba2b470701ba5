"""Exact nearest binary codes by incremental multi-index hashing.

A 64-bit code is cut into m segments, fewer the more codes there are, and each segment value points to its codes. A query probes, segment by segment, all values at Hamming distance 0, then 1, then 2 and so on. After
radius s in the first a+1 segments (and s-1 in the rest) every code within m*s + a of the query has been met, so a
query is done once its k-th verified distance is no larger. A code is verified only at the first step that
meets it.

Rows with equal codes are one index entry with their k smallest ids, and queries with equal codes are searched
once; whatever share of the table one code holds, it is one candidate. All steps are DataFrame operations, and
the table of the best so far is written after each, so a lost executor costs no earlier step.

Defined cases: rows without an id, an embedding or a code are neither found nor searched for; a null component counts as 0, and
vectors of any length have a code (see ``sign_code``); ties go to the smaller id; repeated
rows count once; fewer than k rows give fewer results; an empty table gives none.
"""

from __future__ import annotations

import functools
import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from plumbline.llm.common import saved, table

BITS = 64
K = 10
_PROBES = 1000  # most probes of each query in a step, beyond the first radii, which are steps of their own


def sign_code(embedding: str) -> Column:
    """Bit i is set where the sum of the components i, i + 64, i + 128, ... is positive; null without an embedding.

    So all components of a vector count; in one of up to 64 each bit is the sign of one component. A missing component
    adds nothing.
    """
    e = f"transform({embedding}, x -> coalesce(CAST(x AS DOUBLE), 0D))"
    piece = lambda at: f"slice({e}, {at}, {BITS})"
    folded = (
        f"aggregate(sequence(1, CAST(ceil(size({embedding}) / {BITS}) AS INT) - 1), {piece('1')}, "
        f"(sums, k) -> zip_with(sums, {piece(f'k * {BITS} + 1')}, (a, b) -> a + coalesce(b, 0D)))")
    sums = f"if(size({embedding}) <= {BITS}, {e}, {folded})"
    return F.expr(f"aggregate(transform({sums}, (x, i) -> if(x > 0, shiftleft(1L, i), 0L)), 0L, (a, b) -> a | b)")


def _even(m: int) -> list[tuple[int, int]]:
    """(first bit, bits) of m segments of about equal length."""
    cuts = [round(i * BITS / m) for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def segments(n: int, k: int = K) -> list[tuple[int, int]]:
    """Segments for an index of n codes: the cheapest split for codes without structure.

    Their k-th neighbour lies at about the distance within which k of n random codes fall; a split costs the
    probes that cover this distance and the codes these find. Other data need more or fewer steps, not another result.
    """
    near, within = 0, 1
    while n * within < k << BITS and near < BITS:
        near += 1
        within += math.comb(BITS, near)

    def cost(m: int) -> float:
        total = 0.0
        for radius in range(BITS + 1):
            for j, (_, bits) in enumerate(_even(m)):
                total += math.comb(bits, radius) * (1 + n / 2**bits)
                if m * radius + j >= near:
                    return total
        return total

    return _even(min(range(2, 17), key=cost))


def _value(code: str, segment: tuple[int, int]) -> Column:
    first, bits = segment
    return F.shiftrightunsigned(F.col(code), first).bitwiseAND(F.lit((1 << bits) - 1))


def _masks(bits: int, radius: int) -> Column:
    """All numbers of so many bits with ``radius`` ones, as a constant array."""
    found = (sum(1 << b for b in ones) for ones in itertools.combinations(range(bits), radius))
    return F.expr(f"transform(split('{','.join(map(str, found))}', ','), x -> cast(x as bigint))")


def _best(found: DataFrame, k: int) -> DataFrame:
    """Of the codes met by each query, those that can hold one of its k nearest rows.

    A row can only be among them if the first row of its code is, and if nearer codes hold fewer than k rows.
    ``upto``: rows at this distance or nearer.
    """
    order = W.partitionBy("query").orderBy("distance", "first_id")
    near = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).drop("place")
    by_distance = W.partitionBy("query").orderBy("distance")
    nearer = F.sum("n").over(by_distance.rangeBetween(W.unboundedPreceding, -1))
    upto = F.sum("n").over(by_distance.rangeBetween(W.unboundedPreceding, W.currentRow))
    return near.withColumns({"nearer": F.coalesce(nearer, F.lit(0)), "upto": upto}).filter(F.col("nearer") < k).drop("nearer")


def search(items: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """items (id, code), queries (id, code) -> query_id, rank, id, distance: the k nearest rows of each query."""
    spark = items.sparkSession
    rows = items.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    by_code = W.partitionBy("code").orderBy("id")
    entries = saved(rows.withColumn("place", F.row_number().over(by_code)).filter(F.col("place") <= k), "entries")
    codes = saved(entries.groupBy("code").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")), "codes")
    cut = segments(codes.count(), k)
    m = len(cut)
    index = saved(codes.select(
        "code", "first_id", "n", F.posexplode(F.array(*[_value("code", s) for s in cut])).alias("segment", "value")), "index")
    wanted = queries.filter("id IS NOT NULL AND code IS NOT NULL").select("id", "code").distinct()
    open_queries = saved(wanted.select(F.col("code").alias("query"), F.lit(BITS).alias("within")).distinct(), "queries")
    best = spark.createDataFrame([], "query long, code long, first_id long, n long, distance int, upto long")

    for step in _steps(cut):
        best = saved(_best(best.drop("upto").unionByName(_met(open_queries, index, cut, step)), k), "best")
        radius, j = step[-1]
        kth = best.filter(F.col("upto") >= k).groupBy("query").agg(F.min("distance").alias("kth"))
        # The k-th distance so far bounds what later steps need to bring.
        open_queries = saved(
            open_queries.select("query").join(kth, "query", "left")
            .filter(F.coalesce(F.col("kth") > m * radius + j, F.lit(True)))
            .select("query", F.coalesce("kth", F.lit(BITS)).alias("within")), "queries")
        if open_queries.isEmpty():
            break
    order = W.partitionBy("query_id", "query").orderBy("distance", "id")
    return (
        wanted.select(F.col("id").alias("query_id"), F.col("code").alias("query"))
        .join(best.select("query", "code", "distance"), "query")
        .join(entries.select("id", "code"), "code")
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "distance")
    )


def _steps(cut: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """(radius, segment) in growing order: each of the first radii a step, then steps of about _PROBES probes."""
    steps, probes = [[]], 0
    for radius in range(max(bits for _, bits in cut) + 1):
        for j, (_, bits) in enumerate(cut):
            if probes >= _PROBES or (radius <= 3 and j == 0 and steps[-1]):
                steps.append([])
                probes = 0
            steps[-1].append((radius, j))
            probes += math.comb(bits, radius)
    return steps


def _met(queries: DataFrame, index: DataFrame, cut: list[tuple[int, int]], step: list[tuple[int, int]]) -> DataFrame:
    """Codes that the probes of a step are the first to meet, no farther than needed, with their distances."""
    probes = []
    for radius, j in step:
        if cut[j][1] >= radius:
            own_value = _value("query", cut[j])
            values = F.transform(_masks(cut[j][1], radius), own_value.bitwiseXOR)
            probes.append(queries.select(
                "query", "within", F.lit(radius).alias("radius"), F.lit(j).alias("segment"), F.explode(values).alias("value")))
    if not probes:
        return index.sparkSession.createDataFrame([], "query long, code long, first_id long, n long, distance int")
    other = F.col("query").bitwiseXOR(F.col("code"))
    first = F.bit_count(other) <= F.col("within")
    for j, (start, bits) in enumerate(cut):
        apart = F.bit_count(F.shiftrightunsigned(other, start).bitwiseAND(F.lit((1 << bits) - 1)))
        first = first & F.when(F.col("segment") > j, apart > F.col("radius")).when(
            F.col("segment") < j, apart >= F.col("radius")).otherwise(True)
    # Spark's size estimate misses that probes are exploded; without the hint it may broadcast them.
    met = functools.reduce(DataFrame.unionByName, probes).join(index.hint("merge"), ["segment", "value"]).filter(first)
    return met.select("query", "code", "first_id", "n", F.bit_count(other).alias("distance"))


def op3_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("id"), sign_code("embedding").alias("code"))
    return search(rows, rows.filter("id % 20 = 0")).withColumnRenamed("id", "vec_id")


OP3_SQL = f"""
WITH signs AS (
  SELECT vec_id, list_transform(range(1, {BITS + 1}), lambda b: coalesce(
    list_sum(list_transform(embedding[b:len(embedding):{BITS}], lambda x: coalesce(CAST(x AS DOUBLE), 0))) > 0, FALSE)) AS bits
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
), pairs AS (
  SELECT q.vec_id AS query_id, i.vec_id,
    CAST(list_sum(list_transform(range(1, {BITS + 1}), lambda b: CAST(q.bits[b] <> i.bits[b] AS INTEGER))) AS INTEGER) AS distance
  FROM signs q CROSS JOIN signs i WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INTEGER) AS rank, vec_id, distance FROM pairs
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= {K}
"""
