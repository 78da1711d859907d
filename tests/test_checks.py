"""Observed counters, constraints, and files by size."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from editloom.operators import checks
from editloom.sources import sinks


def pairs(spark):
    rows = [("a x", "AC", "II", "a y", "G", "I", True), ("b", "AC", "I", "b", "G", "I", True), ("c", "AC", "II", "d", "G", "II", False), ("a:B1", "A", "I", "a:B2", "A", None, True)]
    return spark.createDataFrame(rows, "name string, seq1 string, qual1 string, name2 string, seq2 string, qual2 string, marked boolean")


def test_failures_are_counted_with_examples(spark):
    found = checks.failures(pairs(spark), checks.pair_constraints() | checks.barcode_constraints(), F.col("name"))
    assert {r["check"]: (r["total"], r["failed"], r["example"]) for r in found.collect()} == {
        "records have their marks": (4, 1, "c"), "qualities of R1": (4, 1, "b"), "qualities of R2": (4, 2, "a:B1"), "names of mates": (4, 2, "a:B1"), "barcodes of mates": (4, 2, "a:B1")}
    assert [(r["total"], r["failed"], r["example"]) for r in checks.failures(pairs(spark).limit(0), {"x": F.lit(False)}, F.col("name")).collect()] == [(0, 0, None)]


def test_a_broken_constraint_fails_with_an_example(spark, tmp_path):
    write = lambda df: df.write.parquet(f"file://{tmp_path}/out")
    with pytest.raises(ValueError, match="qualities of R1: 1 rows, such as 'b'"):
        checks.checked(pairs(spark), checks.pair_constraints(), F.col("name"), write)
    assert checks.checked(pairs(spark).where("name = 'a x'"), checks.pair_constraints(), F.col("name"), lambda df: df.count()) == 1


def test_counters_of_a_sink_read_its_input_once(spark, tmp_path):
    """Rows that a Python stage gives are counted by an accumulator: each is made once for counters and sink together."""
    made = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    source = spark.range(0, 1000, numPartitions=4).mapInArrow(rows, "id long")
    watched = checks.Watched(source, {"n": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)})
    watched.df.where("id < 10").write.parquet(f"file://{tmp_path}/out")
    assert watched.counts == {"n": 1000, "odd": 500} and made.value == 1000


def test_tasks_that_run_again_do_not_count_twice(tmp_path):
    """In a session of its own, whose tasks may fail: the first try of each partition does, after it has counted."""
    import subprocess
    import sys
    import textwrap

    code = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {os.getcwd()!r})
        from pyspark.sql import SparkSession, functions as F
        from editloom.operators import checks
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
        def fragile(batches):
            from pyspark import TaskContext
            for b in batches:
                yield b
            if TaskContext.get().attemptNumber() == 0:
                raise OSError("lost")
        watched = checks.Watched(spark.range(0, 100, numPartitions=2), {{"n": F.count(F.lit(1))}})
        watched.df.mapInArrow(fragile, "id long").write.parquet("file://{tmp_path}/again")
        print("counted", watched.counts["n"], spark.read.parquet("file://{tmp_path}/again").count())
    """)
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "counted 100 100" in run.stdout, run.stderr[-1500:]


def test_files_follow_the_number_of_rows(spark, tmp_path):
    """One amplicon has nine tenths of the rows; no file has much more than the stated number."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 97)).alias("amplicon"), F.concat(F.lit("q"), "id").alias("qname"))
    rows = rows.union(spark.createDataFrame([(None, "q")], rows.schema))
    sinks.dealt_writer(sinks.by_size(rows, "amplicon", "qname", 1000), "amplicon", 1000).parquet(f"file://{tmp_path}/out")
    found = spark.read.parquet(f"file://{tmp_path}/out")
    sizes = found.groupBy("amplicon", F.input_file_name().alias("f")).count().collect()
    assert found.count() == 20_001 and max(r["count"] for r in sizes) < 1300
    files = {}
    for r in sizes:
        files[r["amplicon"]] = files.get(r["amplicon"], 0) + 1
    assert files.pop("hot") >= 15 and set(files.values()) == {1}
