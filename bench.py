"""Benchmark of the headline queries.

Runs each query to completion (noop sink, so the full plan executes without
collecting to the driver) at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gistlet.session import get_spark  # noqa: E402


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(f"local[{cpus}]", app="gistlet-bench", shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": "16g"})
    from pyspark.sql import functions as F

    from gistlet.operators import summarize as SU
    from gistlet.operators.train import ScorerTrainer, init_weights
    from gistlet.plans import queries as Q
    from gistlet.session import new_work_path

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    times: dict = {}
    stds: dict = {}
    # untimed warm-up on the smaller sibling table (same code paths: JIT, codegen,
    # Python workers), as the reference's timing protocol warms up before timing
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    warm = warm if os.path.isdir(warm) and warm != sf_dir else sf_dir
    for q in (Q.q_build_vocab, Q.q_summarize_articles, Q.q_oracle_labels, Q.q_rouge1, Q.q_encode_tokens,
              Q.q_flatten_ordinals):
        run(q(spark, warm))

    def timed(name, fn, repeat=1):
        vals = []
        for _ in range(repeat):
            t0 = time.time()
            fn()
            vals.append(time.time() - t0)
        times[name] = round(statistics.mean(vals), 3)
        if len(vals) > 1:
            stds[name] = round(statistics.stdev(vals), 3)

    # The table is one file with one row group, which only one task can read. It is written once as
    # the many files that a large table has; the time counts.
    given, sf_dir = sf_dir, new_work_path(spark, "bench-input")

    def lay_out():
        (spark.read.parquet(f"{given}/documents.parquet").repartition(int(cpus) * 4)
         .write.parquet(f"{sf_dir}/documents.parquet"))
    timed("lay_out_input", lay_out)

    # vocabulary first: the other queries reuse it, as they reuse a saved vocabulary file
    timed("build_vocab", lambda: run(Q.q_build_vocab(spark, sf_dir)))
    v = Q.vocabulary(spark, sf_dir)
    model = init_weights(v.size, 32, 64, seed=0, seq_len=v.seq_len)      # of a trained model's shape
    timed("summarize_articles", lambda: run(SU.summarize_articles(Q.articles(spark, sf_dir), v, model)), repeat=3)
    timed("encode_tokens", lambda: run(Q.q_encode_tokens(spark, sf_dir)))
    timed("score_sentences", lambda: run(Q.q_score_sentences(spark, sf_dir)))
    timed("topk_sentences", lambda: run(Q.q_topk_sentences(spark, sf_dir)))
    timed("oracle_labels", lambda: run(Q.q_oracle_labels(spark, sf_dir)))
    timed("rouge1", lambda: run(Q.q_rouge1(spark, sf_dir)))
    timed("evaluate_rouge", lambda: run(Q.q_evaluate_rouge(spark, sf_dir)))
    timed("flatten_ordinals", lambda: run(Q.q_flatten_ordinals(spark, sf_dir)))
    timed("flatten_sentences", lambda: run(Q.q_flatten_sentences(spark, sf_dir)))

    # training: the labeled, encoded train table is prepared once (oracle labels +
    # encoding, written to the work folder), then 3 epochs run on it
    prepared = new_work_path(spark, "bench-train")

    def prepare():
        (Q.encoded_labeled(spark, sf_dir).where(F.col("split") == "train").select("x", "y")
         .write.parquet(prepared))
    timed("prepare_training_table", prepare)

    def three_epochs():
        ScorerTrainer(vocab_size=v.size, seq_len=v.seq_len, epochs=3, seed=0).fit(spark.read.parquet(prepared), None)
    timed("train_3_epochs", three_epochs)

    n_sent = Q.sentence_rows(spark, sf_dir).count()
    total = round(sum(times.values()), 3)
    out = {
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "queries_std": stds,
        "sf": os.path.basename(given).replace("sf", ""),
        "sentences": n_sent,
        "sentences_per_sec": {k: round(n_sent / t) for k, t in times.items()},
        "summarize_sentences_per_sec": round(n_sent / times["summarize_articles"], 1),
        "train_sec_per_epoch": round(times["train_3_epochs"] / 3, 3),
        "baseline_sentences_per_sec": round(11 / 0.003656625747680664, 1),
    }
    out["speedup_vs_baseline"] = round(out["summarize_sentences_per_sec"] / out["baseline_sentences_per_sec"], 2)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
