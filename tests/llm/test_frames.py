"""Row numbers of the operators on training text."""

from pyspark.sql import functions as F


def test_row_numbers_stay_when_executors_go(spark, folder):
    from tablehandoff import session
    from tablehandoff.llm.frames import numbered

    spark.range(64).select("id", F.col("id").cast("string").alias("text")).repartition(8).write.parquet(folder + "/d")
    cores, cost = "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes"
    held = []
    try:
        spark.conf.set(cost, "1")
        for n in ("64", "1"):
            spark.conf.set(cores, n)
            docs = session.configure(spark).read.parquet(folder + "/d")
            held.append(sorted((r.row, r.text) for r in numbered(docs, "text").collect()))
    finally:
        spark.conf.unset(cores)
        spark.conf.unset(cost)
    assert held[0] == held[1]
