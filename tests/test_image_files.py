"""The files of ``image_files`` grow in number with the table, not in size."""

from pyspark.sql import functions as F

from skylane.plans import catalog_lake


def test_files_have_a_bound(spark, tmp_path):
    pages = spark.range(3200).select(F.col("id").alias("page_id"), F.lit("<p>x</p>").alias("html"))
    path = str(tmp_path / "pages")
    catalog_lake.write_in_folders(pages, path, rows_per_file=25)
    sizes = spark.read.text(path).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 32 * 4 and max(r["count"] for r in sizes) <= 25 and sum(r["count"] for r in sizes) == 3200
