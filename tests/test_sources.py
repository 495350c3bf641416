"""Sources and sinks: filters that reach the search, files written by tasks, documents told in pieces,
searches that go on where they stopped, fetches side by side."""

import json
import math
import os
import random
import re
import threading
import time

import pytest
from pyspark.sql import functions as F

from kerbsight.functions import geo
from kerbsight.operators import preview, survey
from kerbsight.plans import fixtures
from kerbsight.sources import documents, files, http, recorded

SF = "/root/testdata/sf0.001"


# --- filters in the plan become the box of the search --------------------------


def picture(ident, lon, lat):
    return {"id": ident, "geometry": {"coordinates": [lon, lat]}, "properties": {"view:azimuth": 0}}


PLACES = [picture("in", 6.0, 45.0), picture("near", 6.0004, 45.0001), picture("twice", 6.0001, 45.0), picture("far", 7.0, 45.0), picture("text", "6.0002", 45.0), picture("none", None, 45.0), picture("twice", 6.0002, 45.0), 5]


def provider(folder, obeys):
    """Notes each request in a file; answers with what is in the box, or with everything."""

    def ask(method, url, body, timeout, most):
        from urllib.parse import parse_qs, urlsplit

        (box,) = parse_qs(urlsplit(url).query)["bbox"]
        with open(f"{folder}/asked", "a") as f:
            f.write(box + "\n")
        west, south, east, north = map(float, box.split(","))
        degrees = lambda p: [http._degrees(x) for x in p["geometry"]["coordinates"]]
        inside = lambda p: None not in degrees(p) and west <= degrees(p)[0] <= east and south <= degrees(p)[1] <= north
        found = [p for p in PLACES if not obeys or (isinstance(p, dict) and inside(p))]
        return 200, {}, json.dumps({"features": found}).encode()

    return type("Recorded", (http.PictureSource,), {"ask": staticmethod(ask)})


@pytest.mark.parametrize("obeys", [True, False])
def test_box_comes_from_the_plan(spark, tmp_path, obeys):
    spark.dataSource.register(provider(str(tmp_path), obeys))
    target = survey.Target(45.0, 6.0, 40.0)
    got = {}
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for pushed in ("true", "false"):
        try:
            found = survey.around(spark.read.format("pictures").option("pushdown", pushed).load(), target)
            plan = found._jdf.queryExecution().executedPlan().toString()
            got[pushed] = [(r.source_id, r.distance_m) for r in found.collect()]
            # The source has taken the comparisons over: Spark has no filter of positions before its own columns
            assert bool(re.search(r"longitude#\d+ <= ", plan)) == (pushed == "false")
        finally:
            spark.conf.unset("spark.sql.python.filterPushdown.enabled")  # without it, the source without pushdown works
    assert got["true"] == got["false"] and [x for x, _ in got["true"]] == ["in", "twice", "text", "near"]
    asked = [tuple(map(float, x.split(","))) for x in (tmp_path / "asked").read_text().split()]
    want = tuple(round(x, 8) for x in geo.bbox_for_radius(45.0, 6.0, 40.0))
    assert set(asked) == {want, http.WORLD} and asked[0] == want


def test_filters_that_are_no_box(spark, tmp_path):
    spark.dataSource.register(provider(str(tmp_path), True))
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        rows = spark.read.format("pictures").load()
        assert rows.where("longitude > 6.5 or latitude < 3").count() == 1  # no single box
        assert rows.where("longitude > 6.5 and longitude < 3").count() == 0  # no place at all
        assert rows.where("longitude = 7.0 and page_no = 0").count() == 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert (tmp_path / "asked").read_text().split() == ["-180.00000000,-90.00000000,180.00000000,90.00000000", "7.00000000,-90.00000000,7.00000000,90.00000000"]


# --- files written by tasks ----------------------------------------------------


def tree(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


def test_files_are_written_by_tasks(spark, tmp_path):
    spark.dataSource.register(files.FileSink)
    rows = spark.range(60, numPartitions=6).select(F.concat(F.lit("deep/"), F.col("id"), F.lit(".bin")).alias("name"), F.when(F.col("id") > 0, F.repeat(F.lit("é"), 1000 * F.col("id").cast("int"))).cast("binary").alias("content"))
    for _ in range(2):  # once more over what is there
        rows.write.format("named_files").mode("append").save(f"{tmp_path}/out")
    assert tree(f"{tmp_path}/out") == sorted(f"deep/{k}.bin" for k in range(60))
    assert all((tmp_path / f"out/deep/{k}.bin").read_bytes() == ("é" * 1000 * k).encode() for k in range(60))
    rows.limit(0).write.format("named_files").mode("append").save(f"{tmp_path}/none")
    assert tree(f"{tmp_path}/none") == []


@pytest.mark.parametrize("name", ["../up", "/root/x", "", None, "_staging/x"])
def test_a_failed_task_leaves_nothing(spark, tmp_path, name):
    """Files of the tasks that were done, and those that the failed one had begun, are gone."""
    spark.dataSource.register(files.FileSink)
    rows = spark.range(40, numPartitions=4).select(F.when(F.col("id") == 39, F.lit(name)).otherwise(F.concat(F.lit("f"), F.col("id"))).alias("name"), F.lit(b"x").alias("content"))
    with pytest.raises(Exception, match="not a file name"):
        rows.write.format("named_files").mode("append").save(f"{tmp_path}/out")
    # Tasks that Spark was still stopping may leave their attempt's folder, but no file has its name
    assert all(x.startswith(files.STAGING) for x in tree(f"{tmp_path}/out")) and not os.path.exists(f"{tmp_path}/up")


def test_an_attempt_that_was_killed_leaves_nothing(tmp_path):
    """Its folder goes with the job's, and a repeated attempt's files count once."""
    import pyarrow as pa

    w = files._Writer(str(tmp_path))
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b/c"]), pa.array([b"1", b"2"])], names=["name", "content"])
    first, second = w.write(iter([batch])), w.write(iter([batch]))
    assert first.attempt != second.attempt and len(tree(tmp_path)) == 4
    w.commit([second, None])
    assert tree(tmp_path) == ["a", "b/c"] and not (tmp_path / files.STAGING).exists()
    w = files._Writer(str(tmp_path))
    w.write(iter([batch]))
    w.abort([None])
    assert tree(tmp_path) == ["a", "b/c"]


# --- documents told in pieces --------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 120])
def test_survey_text_is_the_document(spark, n):
    rows = survey.candidates(fixtures.typed_items(spark, SF), fixtures.TARGET)
    rows = survey.ordered(rows).limit(n).withColumn("captured_at", F.lit('é "candidates": []\n  "sequences": []'))
    named = {"license_id": '"candidates": []', "endpoint": 'https://e/\n  "sequences": []'}
    want = documents.to_text(documents.survey_document(rows, fixtures.TARGET, **named))
    pieces = list(documents.survey_text(rows, documents.survey_head(rows, fixtures.TARGET, **named)))
    assert "".join(pieces) == want and len(json.loads(want)["candidates"]) == n and len(pieces) > n


@pytest.mark.parametrize("chars", [1, 3000, documents.PART_CHARS])
def test_a_survey_in_parts_is_the_survey(spark, tmp_path, monkeypatch, chars):
    """Parts of bounded length, written by tasks: no row comes to the driver, and no task reads all of them."""
    rows = survey.ordered(survey.candidates(fixtures.typed_items(spark, SF), fixtures.TARGET).withColumn("captured_at", F.lit('é "candidates": []\n')))
    want = documents.survey_document(rows, fixtures.TARGET)
    monkeypatch.setattr(documents, "PART_CHARS", chars)
    monkeypatch.setattr("pyspark.sql.DataFrame.toLocalIterator", None)
    head = documents.survey_head(rows, fixtures.TARGET)
    for k, told in enumerate((rows, rows.limit(0))):
        documents.write_survey(told, head, f"file://{tmp_path}/{k}")
        parts = [json.loads(p.read_text()) for p in sorted((tmp_path / str(k)).iterdir())]
        assert all((tmp_path / str(k) / p).stat().st_size < chars + 3000 for p in os.listdir(tmp_path / str(k)))
        lists = {key: [x for p in parts for x in p[key]] for key in ("candidates", "sequences")}
        assert lists == ({key: want[key] for key in lists} if k == 0 else {"candidates": [], "sequences": []})
        assert json.loads((tmp_path / str(k) / "head.json").read_text()) == want | {"candidates": [], "sequences": []}
        back = recorded.survey_document(spark, f"{tmp_path}/{k}")
        assert back.exceptAll(told).isEmpty() and told.exceptAll(back).isEmpty()
    (tmp_path / "0/z.json").write_text("{}")
    with pytest.raises(ValueError):
        recorded.survey_document(spark, f"{tmp_path}/0")


def test_a_document_that_fails_leaves_the_old_one(tmp_path):
    path = tmp_path / "x/s.json"
    documents.write_text(str(path), "old")

    def text():
        yield "new"
        raise ValueError("lost")

    with pytest.raises(ValueError):
        documents.write_text(str(path), text())
    assert path.read_text() == "old" and tree(tmp_path) == ["x/s.json"]
    documents.write_text(f"file://{path}", iter(["é", "\n"]))
    assert path.read_bytes() == "é\n".encode() and tree(tmp_path) == ["x/s.json"]


def test_manifest_of_many_thumbnails(spark, tmp_path):
    """Pictures go from the tasks to their files: the driver gets ranks and names."""
    n = 300
    results = spark.range(1, n + 1, numPartitions=8).select(
        F.col("id").cast("int").alias("rank"), F.concat(F.lit("p"), F.col("id")).alias("source_id"), F.lit(None).cast("string").alias("sequence_id"), F.lit(1.5).alias("distance_m"), F.lit("front").alias("view_class"),
        F.lit(True).alias("target_in_fov"), F.lit(None).cast("double").alias("heading_error_deg"), F.lit(None).cast("string").alias("captured_at"), F.lit("https://h/x").alias("source_url"),
        F.when(F.col("id") % 3 > 0, "downloaded").otherwise("failed").alias("status"), F.when(F.col("id") % 3 == 0, "lost").alias("error"), F.lit("https://t").alias("thumbnail_url"),
        F.when(F.col("id") % 3 > 0, F.format_string("thumbnails/%02d_p.jpg", F.col("id"))).alias("local_file"), F.lit(10000).cast("long").alias("bytes"), F.lit("image/jpeg").alias("content_type"), F.repeat(F.lit("x"), F.lit(10000)).cast("binary").alias("content"),
    )
    m = documents.write_preview(results, str(tmp_path), source="s", max_items=n, per_sequence=4)
    assert (m["selected_count"], m["downloaded_count"], m["failed_count"]) == (300, 200, 100)
    text = (tmp_path / "manifest.json").read_text()
    doc = json.loads(text)
    assert text == documents.to_text(doc) and [x["rank"] for x in doc["items"]] == list(range(1, n + 1))
    assert "content" not in doc["items"][0] and doc["items"][0]["captured_at"] is None and "error" not in doc["items"][0] and "local_file" not in doc["items"][2]
    assert len(tree(tmp_path / "thumbnails")) == 200 and (tmp_path / "thumbnails/01_p.jpg").read_bytes() == b"x" * 10000
    assert (tmp_path / "index.html").read_text().count("<figure>") == n


# --- a search that goes on where it stopped ------------------------------------


def paged(folder, last, loops=False):
    def ask(method, url, body, timeout, most):
        n = int(url.rsplit("/", 1)[1]) if "/p/" in url else 0
        with open(f"{folder}/asked", "a") as f:
            f.write(f"{n}\n")
        if n < 40 and os.path.exists(f"{folder}/down-{n}"):
            raise OSError("down")
        following = 2 if loops and n == last else n + 1
        links = [{"rel": "next", "href": f"/p/{following}"}] if loops or n < last else []
        return 200, {}, json.dumps({"features": [{"id": str(n), "geometry": {"coordinates": [6.0, 45.0]}}], "links": links}).encode()

    return type("Paged", (http.SearchStreamSource,), {"ask": staticmethod(ask)})


def test_search_goes_on_after_the_last_page(spark, tmp_path):
    spark.dataSource.register(paged(str(tmp_path), 5))
    pages = spark.readStream.format("picture_search_stream").options(latitude=45, longitude=6, radius_m=50, endpoint="https://e/api").load()

    def run():
        query = pages.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(processingTime="0 seconds").start()
        end = time.time() + 60
        while query.isActive and time.time() < end and len(query.recentProgress) < 40 and not (query.lastProgress and query.lastProgress["numInputRows"] == 0 and query.lastProgress["batchId"] >= 6):
            time.sleep(0.2)
        failed = query.exception()
        query.stop()
        return failed

    (tmp_path / "down-3").touch()
    assert run() is not None
    (tmp_path / "down-3").unlink()
    assert run() is None
    rows = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(r.page_no for r in rows.collect()) == list(range(6))
    asked = [int(x) for x in (tmp_path / "asked").read_text().split()]
    assert asked.count(0) == 1 and asked[: asked.index(3)] == [0, 1, 2]  # what was done was not asked for again
    found = survey.survey(rows, survey.Target(45.0, 6.0, 50.0))
    assert sorted(r.source_id for r in found.collect()) == list("012345")


def test_search_stream_ends_on_a_cycle(tmp_path):
    reader = paged(str(tmp_path), 6, loops=True)({"latitude": "45", "longitude": "6", "radius_m": "5", "endpoint": "https://e"}).simpleStreamReader(None)
    offset, seen = reader.initialOffset(), []
    for _ in range(60):
        rows, end = reader.read(offset)
        rows = list(rows)
        again = list(reader.readBetweenOffsets(offset, end))
        assert again == rows
        seen += [n for n, _ in rows]
        offset = json.loads(json.dumps(end))
    assert not offset["next"] and 7 <= len(seen) < 25 and seen == list(range(len(seen)))


# --- fetches side by side ------------------------------------------------------


def test_fetch_side_by_side_and_again(spark, tmp_path):
    lock, state = threading.Lock(), {"now": 0, "most": 0}

    def ask(method, url, body, timeout, most):
        with lock:
            state["now"] += 1
            state["most"] = max(state["most"], state["now"])
        time.sleep(0.02)
        with lock:
            state["now"] -= 1
        if url.endswith("/flaky"):
            count = len(list(tmp_path.iterdir()))
            (tmp_path / str(count)).touch()
            if count < 2:
                return 503, {}, b""
        if url.endswith("/gone"):
            return 404, {}, b""
        if url.endswith("/down"):
            raise OSError("no route")
        return 200, {"content-type": "image/png"}, b'{"assets":{"thumb":{"href":"https://t/x"}}}'

    answers = http._Answers(ask, 1.0, 3, 3, 0.001)
    urls = ["https://h/1", None, "https://h/flaky", "https://h/gone", "https://h/down"] + [f"https://h/{k}" for k in range(2, 60)]
    got = list(answers.all(urls))
    assert len(got) == len(urls) and 2 <= state["most"] <= 3
    assert [(x[0], x[3], x[4]) for x in got[:5]] == [(200, None, 1), (None, None, 0), (200, None, 3), (404, None, 1), (None, "no route", 3)]
    top = spark.createDataFrame([(k, u) for k, u in enumerate(["https://h/1", "nope", "https://h/down"], 1)], "rank int, source_url string")

    def plain(method, url, body, timeout, most):
        if url.endswith("down"):
            raise OSError("no route")
        return 200, {"content-type": "image/png"}, b'{"assets":{"thumb":{"href":"https://t/x"}}}'

    rows = {r["rank"]: r for r in http.fetch(top, ask=plain, wait_s=0.001).collect()}
    assert (rows[1].attempts, rows[2].attempts, rows[3].attempts) == (2, 0, 3)
    assert rows[1].content and rows[2].item_status is None and rows[3].item_error == "no route"
    assert preview.ANSWER.split(" ")[0] == "rank"


# --- many targets --------------------------------------------------------------


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * geo.EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


def test_many_targets_find_what_each_finds(spark):
    """All over the sphere, with poles, the antimeridian, and radii from a centimetre to half the earth."""
    r = random.Random(5)
    spots = [(90.0, 0.0), (-90.0, 50.0), (89.9999, 170.0), (-89.99, -170.0), (0.0, 180.0), (0.0, -180.0), (0.0, 0.0), (45.0, 179.9999), (-45.0, -179.9999), (60.0, 10.0)]
    around = lambda p, m: (max(-90.0, min(90.0, p[0] + r.gauss(0, m / 111320))), (p[1] + r.gauss(0, m / 111320 / max(0.01, math.cos(math.radians(p[0])))) + 180) % 360 - 180)
    points = [around(p, m) for p in spots for m in (0.01, 5, 300, 40_000, 2_000_000) for _ in range(4)] + spots
    targets = [(k, *around(p, 50), m) for k, (p, m) in enumerate((p, m) for p in spots for m in (0.01, 12.0, 900.0, 70_000.0, 3_000_000.0, 15_000_000.0))]
    targets += [(900, 0.0, 0.0, 0.0), (901, 0.0, 0.0, -5.0), (902, None, 0.0, 5.0), (903, 0.0, float("nan"), 5.0), (904, 0.0, 0.0, None), (905, 10.0, 10.0, 3e7)]
    rows = spark.createDataFrame([(f"p{k}", *p, 10.0, 60.0, None, None) for k, p in enumerate(points)], "source_id string, latitude double, longitude double, heading_deg double, field_of_view_deg double, panoramic boolean, sequence_id string")
    given = spark.createDataFrame(targets, "target_id int, latitude double, longitude double, radius_m double")
    found = survey.candidates_of_targets(rows, given)
    want = {(t, f"p{k}") for t, lat, lon, m in targets if m and m > 0 and lat is not None and lon == lon for k, p in enumerate(points) if round(metres((lat, lon), p), 3) <= m}
    got = [(x.target_id, x.source_id) for x in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert survey.candidates_of_targets(rows, given.limit(0)).count() == 0 and survey.candidates_of_targets(rows.limit(0), given).count() == 0


def test_one_target_of_many_is_that_target(spark):
    rows, t = fixtures.typed_items(spark, SF), fixtures.TARGET
    one = survey.candidates(rows, t)
    many = survey.candidates_of_targets(rows, spark.createDataFrame([(1, t.latitude, t.longitude, t.radius_m)], "target_id int, latitude double, longitude double, radius_m double")).drop("target_id")
    assert one.count() == many.count() == 230 and one.exceptAll(many).isEmpty()


def test_circles_meet_few_points_outside_them(spark):
    """Cells are fine for the circle, and the join deals its work out even where both sides are small."""
    rows, targets = fixtures.typed_items(spark, SF), fixtures.targets(spark, SF)
    found = survey.candidates_of_targets(rows, targets)
    circles = targets.select(geo.level_of_radius("radius_m").alias("level"), F.explode(geo.cells_of_circle("latitude", "longitude", "radius_m")).alias("cell"))
    met = 0
    for (level,) in circles.select("level").distinct().collect():
        met += rows.select(geo.cell_of_point("latitude", "longitude", level).alias("cell")).join(circles.where(F.col("level") == level), "cell").count()
    assert 0 < found.count() <= met < 3 * found.count()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_the_radius_holds_to_the_millimetre(spark):
    """A pair is told from its chord, but for those about a radius away: there the rounded distance decides."""
    r = random.Random(6)
    spots = [(r.uniform(-89, 89), r.uniform(-180, 180)) for _ in range(60)]
    pairs = [(p, (p[0] + r.gauss(0, d), p[1] + r.gauss(0, d))) for p in spots for d in (1e-7, 1e-4, 0.05, 0.7, 12.0) if abs(p[0]) < 45 or d < 1]
    rows = spark.createDataFrame([(f"p{k}", min(90.0, q[0]), q[1], 10.0, 60.0, None, None) for k, (_, q) in enumerate(pairs)], "source_id string, latitude double, longitude double, heading_deg double, field_of_view_deg double, panoramic boolean, sequence_id string")
    far = {r.source_id: r.m for r in rows.join(spark.createDataFrame([(f"p{k}", *p) for k, (p, _) in enumerate(pairs)], "source_id string, a double, b double"), "source_id").select("source_id", F.round(geo.haversine_m("a", "b", "latitude", "longitude"), 3).alias("m")).collect()}
    given = [(3 * k + j, *p, far[f"p{k}"] + (j - 1) / 1000) for k, (p, _) in enumerate(pairs) for j in range(3)]
    found = survey.candidates_of_targets(rows, spark.createDataFrame(given, "target_id int, latitude double, longitude double, radius_m double")).collect()
    own = {(x.target_id, x.source_id): x.distance_m for x in found if x.source_id == f"p{x.target_id // 3}"}
    assert own == {(t, f"p{t // 3}"): far[f"p{t // 3}"] for t, _, _, m in given if m > 0 and far[f"p{t // 3}"] <= m}


def test_pairs_are_told_in_compiled_code(spark):
    """The JVM compiles no method above 8,000 bytes of code, and a generator above the join would make each pair again."""
    on = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = survey.candidates_of_targets(fixtures.typed_items(spark, SF), fixtures.targets(spark, SF)).select("target_id", "source_id", "distance_m", "target_bearing_deg", "view_class")
        told = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "codegen")
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", on)
    sizes = [int(x.split(";")[0]) for x in told.split("maxMethodCodeSize:")[1:]]
    assert len(sizes) > 4 and 0 < max(sizes) < 8000
    assert "Generate" not in plan[: plan.index("SortMergeJoin")] and "Generate" in plan


def test_items_without_a_position_are_near_nothing(spark):
    rows = [("here", 45.0, 6.0, 1), ("none", None, 6.0, 2), ("half", 45.0, None, 3), ("nan", float("nan"), 6.0, 4), ("nan too", 45.0, float("nan"), 5)]
    items = spark.createDataFrame(rows, "source_id string, latitude double, longitude double, level int").selectExpr("*", "cast(null as double) heading_deg", "90D field_of_view_deg", "cast(null as boolean) panoramic", "'s' sequence_id")
    targets = spark.createDataFrame([(1, 45.0, 6.0, 5.0), (2, 45.0, 6.0, float("nan")), (3, 45.0, 6.0, 3e7), (4, -90.0, -180.0, 5.0)], "target_id int, latitude double, longitude double, radius_m double")
    found = survey.candidates_of_targets(items, targets)
    assert sorted((x.target_id, x.source_id, x.view_class, x.distance_m, x.heading_error_deg) for x in found.collect()) == [(1, "here", "unknown", 0.0, None), (3, "here", "unknown", 0.0, None)]
