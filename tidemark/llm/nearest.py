"""Nearest neighbours by cosine over randomly rotated one-bit codes.

1. Equal vectors become one class with its smallest ids, at most k + 1, which are all that k nearest can name; a window ranks the ids, so
   Spark cuts hot classes down in the map tasks.
2. Index: every class's unit vector is rotated at random into `bits` dimensions, and only the signs are kept, packed, with two numbers: what
   turns the inner product with the signs into an estimate of the cosine, and how far that may be off. The rotation is drawn from a seed,
   nothing is fitted. The index is a table in the shared folder.
3. Queries go to the index in rounds of at most `ROUND` bytes, broadcast; the index stays where it is. A task estimates the inner products
   of a block of codes with all queries of the round by one product with the unpacked bits. It reranks, in double precision on the original
   vectors, those whose estimate plus error bound reaches the k-th best cosine it has found for the query, and gives up k rows per query.
4. A window keeps the best k of these.

The error of an estimate is a coordinate of a random unit vector in bits - 1 dimensions times a known factor; the bound is `sigmas` of its
standard deviations. So a neighbour is missed only if its error is larger than that: at 4, one in some 30,000.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.llm.frames import share
from tidemark.scratch import materialize

#: Code bits for each entry of a vector; more bits make narrower bounds.
BITS_PER_ENTRY = 4
SIGMAS = 4.0
SEED = 12
#: Most bytes of queries in one round, with their rotated form; bounds the broadcast.
ROUND = 64 << 20
#: Codes and queries that are estimated at once, and pairs that are compared at once.
CODES, QUERIES, PAIRS = 8192, 512, 1 << 16


def code_bits(dim: int, per_entry: int = BITS_PER_ENTRY) -> int:
    return -(-dim * per_entry // 64) * 64


def rotation(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """bits x dim, with orthonormal columns drawn at random."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim, bits]).standard_normal((bits, dim)))
    return q * np.sign(np.diag(r))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector by a power of two, so that its largest entry lies between 1/2 and 1; cosines do not change in any digit."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(1))[1][:, None])


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def encode(vectors: np.ndarray, turn: np.ndarray, sigmas: float = SIGMAS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, the factor of the estimate and its error bound, for each vector."""
    turned = unit(vectors) @ turn.T
    bits = len(turn)
    kept = np.abs(turned).sum(1) / np.sqrt(bits)  # inner product of the rotated vector and its signs
    error = sigmas * np.sqrt(np.maximum(1 - kept * kept, 0)) / (kept * np.sqrt(bits - 1))
    # a little more for single precision
    return np.packbits(turned > 0, axis=1), (1 / (kept * np.sqrt(bits))).astype(np.float32), (error + 1e-5).astype(np.float32)


def estimates(codes: np.ndarray, factor: np.ndarray, turned: np.ndarray) -> np.ndarray:
    """Cosines of rotated queries (rows) with coded vectors (columns), as far as the codes tell."""
    bits = np.unpackbits(codes, axis=1, count=turned.shape[1]).astype(np.float32)
    return (2 * (turned @ bits.T) - turned.sum(1, keepdims=True)) * factor


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows in double precision, summed from the first entry to the last."""
    a, b = scaled(a), scaled(b)

    def total(x: np.ndarray) -> np.ndarray:
        return np.cumsum(x, axis=1)[:, -1]

    return total(a * b) / (np.sqrt(total(a * a)) * np.sqrt(total(b * b)))


class Best:
    """The k best (cosine, id) of each query so far, best first, ties to the smaller id; empty places have cosine -2."""

    def __init__(self, own: np.ndarray, vectors: np.ndarray, turned: np.ndarray, k: int):
        self.own, self.vectors, self.units, self.turned, self.k = own, vectors, unit(vectors), turned, k
        self.scores, self.ids = np.full((len(own), k), -2.0), np.zeros((len(own), k), np.int64)

    def see(self, codes: np.ndarray, factor: np.ndarray, error: np.ndarray, ids: np.ndarray, first: np.ndarray, vectors: np.ndarray) -> None:
        """A block of classes: class j has ids[first[j]:first[j + 1]]."""
        units = unit(vectors)
        for begin in range(0, len(self.own), QUERIES):
            rows = slice(begin, begin + QUERIES)
            guess = estimates(codes, factor, self.turned[rows])
            if (self.scores[rows, -1] < -1).any():  # the first block: those that look nearest give a first bar
                take = min(self.k + 1, guess.shape[1])
                top = np.argpartition(-guess, take - 1, axis=1)[:, :take]
                self._compare(begin, np.repeat(np.arange(len(guess)), take), top.ravel(), ids, first, vectors, units)
            bar = self.scores[rows, -1].astype(np.float32) - np.float32(1e-6)
            near, at = np.nonzero(guess + error >= bar[:, None])
            for part in range(0, len(near), PAIRS):
                self._compare(begin, near[part : part + PAIRS], at[part : part + PAIRS], ids, first, vectors, units)

    def _compare(self, begin, rows, at, ids, first, vectors, units) -> None:
        rows = rows + begin
        rough = np.einsum("pd,pd->p", self.units[rows], units[at])
        good = rough >= self.scores[rows, -1] - 1e-9
        rows, at = rows[good], at[good]
        if not len(rows):
            return
        exact = cosines(self.vectors[rows], vectors[at])
        counts = first[at + 1] - first[at]
        places = np.repeat(first[at] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        rows, exact, named = np.repeat(rows, counts), np.repeat(exact, counts), ids[places]
        other = named != self.own[rows]
        rows, exact, named = rows[other], exact[other], named[other]
        touched = np.unique(rows)
        held = self.scores[touched] > -1.5
        rows = np.concatenate([rows, np.repeat(touched, held.sum(1))])
        exact, named = np.concatenate([exact, self.scores[touched][held]]), np.concatenate([named, self.ids[touched][held]])
        order = np.lexsort((named, -exact, rows))
        rows, exact, named = rows[order], exact[order], named[order]
        # a block may be seen in two steps, so a class may come twice
        fresh = np.concatenate([[True], (rows[1:] != rows[:-1]) | (exact[1:] != exact[:-1]) | (named[1:] != named[:-1])])[: len(rows)]
        rows, exact, named = rows[fresh], exact[fresh], named[fresh]
        starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))[: len(touched)]
        rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(rows)]])))
        keep = rank < self.k
        self.scores[rows[keep], rank[keep]], self.ids[rows[keep], rank[keep]] = exact[keep], named[keep]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)


def sound_vectors(embeddings: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Rows that take part, as vec_id and embedding (doubles)."""
    rows = embeddings.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("embedding"))
    return rows.where("""vec_id IS NOT NULL AND coalesce(size(embedding), 0) > 0 AND exists(embedding, e -> e <> 0)
      AND forall(embedding, e -> e IS NOT NULL AND NOT isnan(e) AND abs(e) < double('infinity'))""").select(
        "vec_id", F.transform("embedding", lambda e: e + 0.0).alias("embedding")  # no negative zeros, so that equal vectors are one class
    )


def build_index(rows: DataFrame, k: int, sigmas: float = SIGMAS, per_entry: int = BITS_PER_ENTRY) -> DataFrame:
    """The stored index: dim, ids (the k + 1 smallest of each distinct vector), code, factor, error, embedding."""
    order = Window.partitionBy("embedding").orderBy("vec_id")
    ranked = rows.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
    classes = ranked.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.size("embedding").alias("dim"), "ids", "embedding")

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in turns:
                    turns[dim] = rotation(dim, code_bits(dim, per_entry))
                own = batch.filter(pa.array(dims == dim))
                codes, factor, error = encode(_matrix(own.column(2), dim), turns[dim], sigmas)
                packed = pa.array([c.tobytes() for c in codes], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [own.column(0), own.column(1), packed, pa.array(factor), pa.array(error), own.column(2)], names=["dim", "ids", "code", "factor", "error", "embedding"]
                )

    return materialize(classes.mapInArrow(code, "dim int, ids array<long>, code binary, factor float, error float, embedding array<double>"), "nearest-index")


def _search(index: DataFrame, queries: DataFrame, k: int, per_entry: int) -> DataFrame:
    """The best k of every task for each of the queries, which are few enough to be held by a task: query, query_id, vec_id, score."""
    held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    table = queries.toArrow().combine_chunks()
    for batch in table.to_batches():
        dims = batch.column(2).to_numpy()
        for dim in np.unique(dims).tolist():
            own = batch.filter(pa.array(dims == dim))
            held[dim] = (own.column(0).to_numpy(), own.column(1).to_numpy(), _matrix(own.column(3), dim))
    shared = share(index.sparkSession, held)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, best = shared(), {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in asked:
                    continue
                if dim not in best:
                    _, own_ids, vectors = asked[dim]
                    turn = rotation(dim, code_bits(dim, per_entry))
                    best[dim] = Best(own_ids, vectors, (unit(vectors) @ turn.T).astype(np.float32), k)
                every = batch.filter(pa.array(dims == dim))
                for begin in range(0, every.num_rows, CODES):
                    own = every.slice(begin, CODES)
                    ids = own.column(1)
                    first = ids.offsets.to_numpy()
                    codes = np.frombuffer(b"".join(own.column(2).to_pylist()), np.uint8).reshape(own.num_rows, -1)
                    best[dim].see(codes, own.column(3).to_numpy(), own.column(4).to_numpy(), ids.flatten().to_numpy(), first - first[0], _matrix(own.column(5), dim))
        for dim, found in best.items():
            rows, places = np.nonzero(found.scores > -1.5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(asked[dim][0][rows]), pa.array(found.own[rows]), pa.array(found.ids[rows, places]), pa.array(found.scores[rows, places])],
                names=["query", "query_id", "vec_id", "score"],
            )

    return index.mapInArrow(look, "query long, query_id long, vec_id long, score double")


def nearest(
    embeddings: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding", sigmas: float = SIGMAS,
    per_entry: int = BITS_PER_ENTRY, round_bytes: int = ROUND,
) -> DataFrame:
    """The k nearest rows of `embeddings` for each row of `queries` (same columns): query_id, rank, vec_id, score (cosine), nearest first, ties
    to the smaller id. Fewer where there are fewer candidates.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without an id, take no part on either side. Only vectors
    of the query's length are candidates, and none that carries the query's own id. A row that is repeated with its id counts once; one id with several
    vectors is as many queries, and a candidate once for each cosine. Other columns are not read.
    """
    spark: SparkSession = embeddings.sparkSession
    index = build_index(sound_vectors(embeddings, vec_id, embedding), k, sigmas, per_entry)
    asked = sound_vectors(queries, vec_id, embedding).distinct().withColumn("dim", F.size("embedding"))
    # a query takes its vector twice and its rotated form; rounds are dealt by hash, so their sizes hardly differ
    size = asked.agg(F.sum(F.col("dim") * (16 + 4 * per_entry) + 256)).head()[0] or 0
    rounds = -(-size // round_bytes)
    dealt = materialize(
        asked.select(F.xxhash64("vec_id", "embedding").alias("query"), "vec_id", "dim", "embedding").withColumn("round", F.pmod("query", F.lit(max(rounds, 1)))), "nearest-queries"
    )
    found = None
    for r in range(rounds):
        part = _search(index, dealt.where(F.col("round") == r).drop("round"), k, per_entry)
        part = materialize(part, "nearest-round") if rounds > 1 else part
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
    best = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
