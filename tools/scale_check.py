"""How the plans grow with the data: run them on a test table and on an N× copy.

    python tools/scale_check.py [--sf 0.1] [--times 10]

The N× documents table is derived by Spark from the given one (each text N times under new
keys, so there are many exact ties) and written once under the session's shared folder.
Prints one line per size with the times of `recommend`, the store build, serving and
`label_emotions`.
"""

from __future__ import annotations

import argparse
import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))


def main() -> None:
    from pyspark.sql import functions as F

    from cadenza.plans import catalog as C
    from cadenza.plans import store as PL
    from cadenza.session import get_spark, scratch_path
    from cadenza.sources.tables import sentences, songs

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.1")
    ap.add_argument("--times", type=int, default=10)
    args = ap.parse_args()
    base = f"/root/testdata/sf{args.sf}"
    spark = get_spark()

    big = scratch_path(spark, f"x{args.times}")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    copies = docs.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(args.times - 1))))
    new_id = F.col("doc_id") + F.col("copy").cast("bigint") * F.lit(1_000_000_000)
    (copies.select(new_id.alias("doc_id"), "text", "lang", "source", "n_chars")
     .repartition(4 * spark.sparkContext.defaultParallelism)
     .write.mode("overwrite").parquet(f"{big}/documents.parquet"))
    spark.read.parquet(f"{base}/conversations.parquet").write.mode("overwrite").parquet(f"{big}/conversations.parquet")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    noop(C.q_recommend(spark, base))  # warm-up
    for d in (base, big):
        t = time.time(); noop(C.q_recommend(spark, d)); rec = time.time() - t
        t = time.time(); store = PL.build_store(songs(spark, d), scratch_path(spark, "scale-store")); build = time.time() - t
        t = time.time(); noop(PL.recommend_from_store(sentences(spark, d), store)); serve = time.time() - t
        t = time.time(); noop(C.q_label_emotions(spark, d)); lab = time.time() - t
        print(f"{d}: recommend {rec:.1f}s build_store {build:.1f}s serve {serve:.1f}s label_emotions {lab:.1f}s",
              flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
