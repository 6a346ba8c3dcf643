"""Search and recommend from SQL text (M6, 2.11): the table function ``search_index``.

    SELECT * FROM search_index(TABLE(asked), '/path/of/index', 10, 768)

``asked`` holds ``query_id``, ``query_vec``, ``query_norm``, ``bucket`` and any columns to pass on. The
function asks Spark to partition its table by ``bucket`` (the index's own, see
:mod:`cadenza.sources.index_source`), so one task answers all queries from one bucket, whose files it reads
itself: queries are shuffled, the index is not. Queries are held in blocks of bounded bytes; the bucket is
read once per block. It returns the ``k`` best rows of each bucket per query; :data:`RECOMMEND_SQL` deals
the queries to all buckets and ranks what they return. The version to read is fixed when Spark analyses
the statement, so all tasks read the same one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

from cadenza.operators import knn as K
from cadenza.plans.recommend import RESULTS_PER_QUERY
from cadenza.sources import index_source as I

VEC, NORM = "emotions_embeddings", "norm"
QUERY_PARTS = ("query_vec", "query_norm", "bucket")
DIGITS = 6
BLOCK_BYTES = 32 << 20

RECOMMEND_SQL = """
WITH asked AS (SELECT *, explode(sequence(0, {buckets} - 1)) AS bucket FROM {{queries}}),
found AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, link) AS rank
          FROM search_index(TABLE(SELECT * FROM asked), '{base}', {k}, {dim}))
SELECT query_id, user_emotions, rank, artist, song, link, llm_labeled_emotions, score FROM found WHERE rank <= {k}
"""


@dataclass
class SearchPlan(AnalyzeResult):
    """What the tasks need to know besides the result's schema."""

    base: str = ""
    version: int = 0
    k: int = 0
    dim: int = 0
    passed: tuple[str, ...] = ()
    payload: tuple[str, ...] = ()
    stored: StructType | None = None


class SearchIndex:
    @staticmethod
    def analyze(queries: AnalyzeArgument, index: AnalyzeArgument, k: AnalyzeArgument, dim: AnalyzeArgument) -> SearchPlan:
        if not queries.isTable:
            raise ValueError("search_index: the first argument must be TABLE(queries)")
        missing = [c for c in ("query_id", *QUERY_PARTS) if c not in queries.dataType.names]
        if missing:
            raise ValueError(f"search_index: the queries lack {', '.join(missing)}")
        if index.value is None or k.value is None or k.value < 1 or dim.value is None or dim.value < 1:
            raise ValueError("search_index: index, k and dim must be constants, k and dim at least 1")
        newest = I.state_versions(index.value, None)[-1]
        stored = StructType.fromJson(json.loads(newest.meta["schema"]))
        payload = [f for f in stored if f.name not in (I.KEY, VEC, NORM, *I.STATE)]
        passed = [f for f in queries.dataType if f.name not in QUERY_PARTS]
        clash = {f.name for f in passed} & {I.KEY, "score", *(f.name for f in payload)}
        if clash:
            raise ValueError(f"search_index: columns of both sides: {', '.join(sorted(clash))}")
        fields = [*passed, stored[I.KEY], *payload, StructField("score", DoubleType())]
        return SearchPlan(schema=StructType(fields), partitionBy=[PartitioningColumn("bucket")], base=index.value,
                          version=newest.number, k=k.value, dim=dim.value, passed=tuple(f.name for f in passed),
                          payload=tuple(f.name for f in payload), stored=stored)

    def __init__(self, plan: SearchPlan):
        self.plan, self.bucket = plan, None
        self.rows, self.vecs, self.norms = [], [], []

    def eval(self, queries, index, k, dim) -> Iterator[tuple]:
        self.bucket = queries["bucket"]
        vec, norm = queries["query_vec"], queries["query_norm"]
        if vec is None or norm is None or len(vec) != self.plan.dim or None in vec:
            return
        vec = np.array(vec, np.float64)
        if not (np.isfinite(vec).all() and 0 < norm < np.inf):
            return
        self.rows.append(tuple(queries[c] for c in self.plan.passed))
        self.vecs.append(vec)
        self.norms.append(norm)
        if len(self.vecs) * self.plan.dim * 8 >= BLOCK_BYTES:
            yield from self.answers()

    def terminate(self) -> Iterator[tuple]:
        yield from self.answers()

    def batches(self) -> Iterator[pa.RecordBatch]:
        """The live rows of this task's bucket."""
        p = self.plan
        chosen = I.state_versions(p.base, p.version)
        if not 0 <= self.bucket < chosen[0].meta["buckets"]:
            raise ValueError(f"the index has no bucket {self.bucket}")
        reader = I.IndexReader(p.base, StructType([p.stored[c] for c in (I.KEY, VEC, NORM, *p.payload)]), p.version)
        return reader.read(I.bucket_files(chosen, self.bucket))

    def answers(self) -> Iterator[tuple]:
        if not self.vecs:
            return
        p = self.plan
        Q, qn = np.stack(self.vecs), np.array(self.norms, np.float64)
        best = K._Best(len(Q), p.k)
        for batch in self.batches():
            part = K._valid_rows(pa.Table.from_batches([batch]), VEC, NORM, p.dim, "cosine")
            if part.num_rows == 0:
                continue
            keys, xn = part[I.KEY].combine_chunks(), part[NORM].to_numpy().astype(np.float64)
            X = K._matrix(part[VEC], p.dim)
            # rows of one vector score alike: the k of smallest key are its only answers, the first stands for it
            order = np.argsort(K._key_rank(keys))
            number: dict = {}
            like = np.array([number.setdefault(v, len(number)) for v in zip(K._packed(X[order]), xn[order].tolist())])
            by = np.argsort(like, kind="stable")
            start = np.searchsorted(like[by], np.arange(len(number) + 1))
            rows = order[by]
            first = rows[start[:-1]]
            qi, vi, si = K._score_block(Q, qn, None, X[first], xn[first], keys.take(pa.array(first)), p.k, DIGITS, "cosine",
                                        False, best.floor)
            n = np.minimum(start[1:] - start[:-1], p.k)[vi]
            xi = rows[np.repeat(start[vi] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            best.add(np.repeat(qi, n), xi, np.repeat(si, n),
                     {"_ik": keys, **{f"_{c}": part[c].combine_chunks() for c in p.payload}})
        found = best.table()
        if found is not None:
            columns = [found[c].to_pylist() for c in ("_ik", *(f"_{c}" for c in p.payload))]
            scores = (found["score"].to_numpy() / float(10 ** DIGITS)).tolist()
            for q, *hit in zip(found["_q"].to_pylist(), *columns, scores):
                yield (*self.rows[q], *hit)
        self.rows, self.vecs, self.norms = [], [], []


def register(spark: SparkSession) -> None:
    """``search_index`` in the session's SQL."""
    spark.udtf.register("search_index", udtf(SearchIndex))


def recommend_sql(queries: DataFrame, base: str, dim: int, k: int = RESULTS_PER_QUERY) -> DataFrame:
    """:data:`RECOMMEND_SQL` over query vectors (see :func:`cadenza.plans.recommend.query_vectors`) and
    the newest version of an index written through its data source.

    Sentences of the same emotions have the same vector: every distinct vector is dealt to the buckets
    and searched once, and its answers join the sentences. Give saved queries, they are read twice."""
    spark = queries.sparkSession
    register(spark)
    buckets = I.state_versions(base, None)[0].meta["buckets"]
    exact = F.concat_ws("|", F.col("query_vec").cast("string"), F.col("query_norm").cast("string"))
    named = queries.where(F.col("query_vec").isNotNull() & F.col("query_norm").isNotNull()).withColumn("_vector", F.sha2(exact, 256))
    vectors = named.dropDuplicates(["_vector"]).select(F.col("_vector").alias("query_id"), "user_emotions", "query_vec", "query_norm")
    found = spark.sql(RECOMMEND_SQL.format(buckets=buckets, base=base, k=k, dim=dim), queries=vectors)
    columns, best = found.columns, Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("link"))
    found = found.withColumnRenamed("query_id", "_vector").drop("user_emotions", "rank")
    asked = named.select("query_id", "user_emotions", "_vector")
    return (asked.join(found, "_vector").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select(*columns))
