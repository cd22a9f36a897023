"""A fitted pipeline scores a file stream exactly like the batch input."""


from sparkclassify.functions.text import clean_text
from sparkclassify.operators.models import text_naive_bayes_pipeline
from sparkclassify.streaming import score_stream

from .fixtures import mail


def test_stream_scores_equal_batch(spark, tmp_path):
    train = mail(spark).withColumn("clean", clean_text("text"))
    model = text_naive_bayes_pipeline("clean", "label", num_features=64).fit(train)
    src = tmp_path / "in"
    train.select("clean").write.parquet(str(src))
    stream = spark.readStream.schema("clean string").parquet(str(src))
    q = (score_stream(model, stream, keep=["clean"]).writeStream.format("memory")
         .queryName("scored_lines").outputMode("append").start())
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    streamed = sorted((r.clean, r.prediction) for r in spark.table("scored_lines").collect())
    batch = sorted((r.clean, r.prediction)
                   for r in model.transform(train).select("clean", "prediction").collect())
    assert streamed == batch
