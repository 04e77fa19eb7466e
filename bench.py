"""Headline timings; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from topicweave.functions import text  # noqa: E402
from topicweave.operators import cleaning, heads  # noqa: E402
from topicweave.plans import clean, gibbs, study  # noqa: E402
from topicweave.session import build_session, materialize  # noqa: E402
from topicweave.sources.tables import table  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g",
        spark__topicweave__inputPartitions=cpus, spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    docs = table(spark, folder, "documents")
    times: dict[str, float] = {}

    def timed(name: str, action):
        begin = time.perf_counter()
        out = action()
        times[name] = round(time.perf_counter() - begin, 3)
        return out

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    docs.select(F.max(F.length("text"))).collect()
    timed("term_counts", lambda: drain(clean.term_counts(docs)))
    timed("top_terms_by_category", lambda: study.top_terms_by_category(spark, folder).collect())
    counts = timed("filtered_counts", lambda: materialize(clean.filtered_counts(docs), "counts"))
    timed("bigrams", lambda: drain(cleaning.token_rows(docs, text.ngrams(2), name="ngram")))
    pages = table(spark, folder, "pages")
    timed("html_tokens", lambda: drain(
        cleaning.token_rows(
            pages.select("page_id", text.html_text(F.col("html")).alias("text")), keys=("page_id",)
        ).groupBy("page_id", "word").count()
    ))
    for name, model in (
        ("block_k4", gibbs.Model(k=4)), ("block_k5", gibbs.Model(k=5)), ("token_k5", gibbs.Model(k=5, grain="token")),
        ("block_k31", gibbs.Model(k=31)),
    ):
        chain = gibbs.Chain(spark, model)
        timed(f"{name}_start", lambda: chain.start(counts, written=True))
        if model.k < 10:
            chain.run(1)
        timed(f"{name}_sweep", lambda: chain.run(1))
        if name == "block_k4":
            last = chain
    timed("gamma_beta_sample", lambda: last.store_sample())
    blocks = materialize(gibbs.block_probabilities(gibbs.weigh(last.state(), last.model), 4), "blocks")
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("y"))
    features = heads.mean_probabilities(blocks, 4).join(labels, "doc_id")
    timed("class_statistics", lambda: heads.class_statistics(features, 4, "y").collect())
    eta = [[0.1 * (i - j) for j in range(4)] for i in range(4)]
    timed("label_likelihood_gradient", lambda: heads.slda_gradient(blocks, labels, eta, 4).collect())
    print(json.dumps({
        "metric": "headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(folder.rstrip("/")), "master": f"local[{cpus}]", "pairs": counts.count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
