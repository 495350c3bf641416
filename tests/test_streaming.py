from kerbsight.operators import survey
from kerbsight.plans import fixtures
from kerbsight.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_stream_finds_what_the_batch_finds(spark, tmp_path):
    pages = fixtures.json_pages(spark, SF, page=300)
    pages.selectExpr("page_no", "body", "timestamp'2024-01-01 00:00:00' as arrived_at").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("page_no bigint, body string, arrived_at timestamp").parquet(str(tmp_path / "in"))
    found = incremental.candidates(stream, fixtures.TARGET)
    query = found.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("source_id")
    want = survey.survey(pages, fixtures.TARGET, limit=None).select("source_id")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
