"""Wide tables of many amplicons as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from editloom.operators import summary
from editloom.sources import sinks, text


def test_wide_tables_of_twenty_thousand_amplicons(spark, tmp_path):
    """40,000 columns, which no pivot could plan."""
    names = [f"A{i:05d}" for i in range(20_000)]
    cells = spark.range(5, numPartitions=2).select(F.concat(F.lit("c"), "id").alias("cell"), F.col("id").alias("c"))
    dense = cells.select("cell", "c", F.explode(F.sequence(F.lit(0), F.lit(19_999))).alias("i")).select(
        "cell", F.format_string("A%05d", "i").alias("amplicon"), (F.col("i") * 7 + F.col("c")).alias("tot"), F.when(F.col("i") % 3 > 0, F.col("i") / 8).alias("mod"), F.lit(1).alias("raw_tot"), F.lit(0.5).alias("raw_mod"))
    sinks.write_matrices(dense, dense.where("false"), names, f"file://{tmp_path}")
    back = text.wide_summary(spark, f"file://{tmp_path}/final_all")
    assert back.count() == 100_000 and back.exceptAll(dense.select("cell", "amplicon", F.col("tot").cast("long"), "mod")).count() == 0
    assert text.wide_summary(spark, f"file://{tmp_path}/raw_scored").count() == 0
    assert all(p.read_text().split("\n")[0] == summary.wide_header(names) for p in (tmp_path / "final_all").glob("part-*"))


def test_missing_entries_are_na(spark):
    rows = [("c1", "B", 3, 0.5), ("c1", "A", None, None), ("c2", "B", 1, 100.0), ("c2", "elsewhere", 1, 1.0)]
    dense = spark.createDataFrame(rows, "cell string, amplicon string, tot long, mod double")
    lines = summary.wide_lines(dense, ["B", "A"])
    assert sorted(r["value"] for r in lines.collect()) == ["c1\t3\t0.5\tNA\tNA", "c2\t1\t100.0\tNA\tNA"]
    back = sorted(map(tuple, summary.unpivot_lines(lines, summary.wide_header(["B", "A"])).collect()))
    assert back == [("c1", "A", None, None), ("c1", "B", 3, 0.5), ("c2", "A", None, None), ("c2", "B", 1, 100.0)]
