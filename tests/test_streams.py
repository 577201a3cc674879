from __future__ import annotations

from pyspark.sql import functions as F

from cloakframe.operators.masking import mask_table, masking_report
from cloakframe.plans.derived import derived
from cloakframe.streaming.masking import mask_stream_counted, read_stream, stream_counts


def test_counts_of_a_stream(spark, data_dir, tmp_path):
    """Several batches, a restart, and a batch that is repeated: rows and counts are those of the table."""
    people = derived(spark, data_dir, "people").cache()
    source, out, counts = (f"{tmp_path}/{n}" for n in ("in", "out", "counts"))
    first = F.col("person_id") % 3 > 0

    def run(checkpoint="check"):
        stream = read_stream(spark, source, people.schema, max_files_per_trigger=1)
        mask_stream_counted(stream, out, counts, f"{tmp_path}/{checkpoint}").awaitTermination()

    def same(rows):
        written = spark.read.parquet(out)
        assert written.select("batch_id").distinct().count() > 1
        masked = mask_table(rows)
        assert written.drop("batch_id").exceptAll(masked).isEmpty() and masked.exceptAll(written.drop("batch_id")).isEmpty()
        assert stream_counts(spark, counts).first() == masking_report(rows).first()

    people.where(first).repartition(3).write.parquet(source)
    run()
    same(people.where(first))
    people.where(~first).repartition(2).write.mode("append").parquet(source)
    run()
    same(people)
    run()
    same(people)
    run("lost")  # without its checkpoint it starts again and replaces every batch
    same(people)
