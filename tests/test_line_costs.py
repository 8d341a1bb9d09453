"""What a line costs: size of generated methods, amounts computed once, tasks that write files."""

import contextlib
import io
import re

from pyspark.sql import functions as F

from tradepanel.catalog import loads
from tradepanel.operators.exports import clean_exports

COLUMNS = ["US$ FOB", "PESO BRUTO", "CANTIDAD", "PAIS DE DESTINO", "PRODUCTO", "REGION DE ORIGEN", "YEAR", "MES"]
COMPILED_BYTES = 8000  # a longer method is never compiled by the JVM


def raw(spark, path):
    rows = [("US$ 12.5", "1", "2", " peru", "vino ", "Maule", "2023", "3"), ("-1", "", None, None, None, None, "2023", "40")]
    spark.createDataFrame(rows, COLUMNS).write.parquet(path)
    return spark.read.parquet(path)


def test_generated_methods_are_compiled(spark, tmp_path):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        clean_exports(raw(spark, str(tmp_path / "t"))).explain("codegen")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:\s*(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < COMPILED_BYTES


def test_a_computed_amount_is_not_filtered_below_what_it_is_made_from(spark, tmp_path):
    rows = raw(spark, str(tmp_path / "t")).withColumn("US$ FOB", F.upper("US$ FOB"))
    found = clean_exports(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "regexp_replace" in line]
    assert [r.FOB_CLEAN for r in found.collect()] == [12.5]


def test_rows_of_one_file_are_made_by_many_tasks(spark, tmp_path):
    rows = spark.range(0, 100, 1, 5).select(F.concat(F.col("id").cast("string"), F.lit("\nx"), F.spark_partition_id().cast("string")).alias("value"))
    loads.write_lines(rows, str(tmp_path / "t"), "A")
    lines = [line for file in (tmp_path / "t").glob("*.csv") for line in file.read_text().split("\n")]
    assert lines[0] == "A" and {x for x in lines if x.startswith("x")} == {f"x{i}" for i in range(5)}
