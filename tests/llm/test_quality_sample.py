"""Labels without a usable document take no places of the sample."""

from pyspark.sql import functions as F

from riskloom.llm import quality
from riskloom.llm.common import fold


def test_labels_of_other_documents_take_no_places(spark):
    labels = spark.range(40_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    texts = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("text "), F.col("doc_id")))
    documents = labels.where("doc_id < 60").select("doc_id", texts.alias("text"))
    wanted = documents.where("text IS NOT NULL").where(fold("doc_id", 3) != 1)
    found = quality.sample(documents, labels)
    assert sorted(r.text for r in found.collect()) == sorted(r.text for r in wanted.collect())
