"""Times the plain form of five jobs beside the form this library uses; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window, functions as F
from pyspark.sql.types import DoubleType

from tabloom.catalog.base import LINE_ORDER, NUMERIC, modelling, scored
from tabloom.operators import association, encode, evaluate, learners, ranking
from tabloom.session import build_session


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "pairs", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g", spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    noop = lambda df: df.write.format("noop").mode("overwrite").save()
    scores = scored(spark, sf_dir)
    rows = modelling(spark, sf_dir).select(*NUMERIC, "y").persist()
    rows.count()

    def ntile_plain():
        order = Window.orderBy(F.desc("score"), *LINE_ORDER)
        noop(scores.withColumn("d", F.ntile(10).over(order)).groupBy("d").agg(F.sum("y")))

    def ntile_ours():
        noop(ranking.global_ntile(scores, "score", LINE_ORDER, 10, out="d").groupBy("d").agg(F.sum("y")))

    def woe_plain():
        for f in NUMERIC:
            binned = encode.quantile_binner(rows, [f], 20).transform(rows.select(f, "y"))
            grouped = binned.groupBy(f"{f}_bin")
            for agg in (F.count("y"), F.sum("y"), F.min(f), F.max(f)):
                grouped.agg(agg).collect()

    def woe_ours():
        association.woe_table(rows, NUMERIC, "y").collect()

    def vif_plain():
        for f in NUMERIC:
            vectors = encode.assemble(rows, [c for c in NUMERIC if c != f], f)
            learners.train(vectors, "linear_regression", label=f).summary.r2

    def vif_ours():
        association.vif(rows, NUMERIC).collect()

    def roc_plain():
        scores.select("y", "score").collect()

    def roc_ours():
        evaluate.curve_points(scores, "y", "score").collect()

    vectors = encode.assemble(rows, NUMERIC, "y")
    scored_rows = learners.train(vectors, "logistic", label="y", maxIter=10).transform(vectors)
    element = F.udf(lambda v: float(v[1]), DoubleType())

    def udf_plain():
        noop(scored_rows.select(element("probability")))

    def udf_ours():
        noop(scored_rows.select(vector_to_array("probability")[1]))

    pairs = {
        "deciles": (ntile_plain, ntile_ours), "woe": (woe_plain, woe_ours), "vif": (vif_plain, vif_ours),
        "roc": (roc_plain, roc_ours), "probability": (udf_plain, udf_ours),
    }
    out = {}
    for name, forms in pairs.items():
        seconds = []
        for form in forms:
            form()
            runs = []
            for _ in range(3):
                start = time.perf_counter()
                form()
                runs.append(time.perf_counter() - start)
            seconds.append(round(sorted(runs)[1], 3))
        out[name] = {"plain": seconds[0], "ours": seconds[1]}
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
