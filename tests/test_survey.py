import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from kerbsight import schemas
from kerbsight.functions import stac
from kerbsight.operators import preview, shortlist, summary, survey
from kerbsight.plans import fixtures
from kerbsight.plans import queries as Q
from kerbsight.sources import documents, http, recorded

SF = "/root/testdata/sf0.001"


def normal(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    return None if v != v else round(float(v), 6)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    got, want = Q.QUERIES[name](spark, SF), con.execute(Q.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    key = lambda rows: sorted(repr([normal(v) for v in r]) for r in rows)
    assert key(tuple(r) for r in got.select(*columns).collect()) == key(want.fetchall())


def test_entry_counts(spark):
    rows = entry.entry(spark)
    assert rows.count() == 230
    r = summary.overall(rows.select("*")).first()
    assert (r.front_count, r.lateral_count, r.rear_count, r.panoramic_count, r.unknown_count) == (38, 72, 18, 67, 35)
    assert (r.fov_true, r.fov_false, r.fov_unknown, r.sequence_count, r.unsequenced_count) == (90, 63, 77, 13, 29)


def test_empty_input_is_zero_filled(spark):
    none = spark.createDataFrame([], schemas.CANDIDATE)
    assert set(summary.overall(none).first()) == {0}
    assert {r.view_class: r.candidate_count for r in summary.view_class_counts(none).collect()} == dict.fromkeys(schemas.VIEW_CLASSES, 0)
    assert shortlist.shortlist(none).count() == 0


ROWS = [
    ("near-out", "s1", 10.0, False, "front", False, 5.0),
    ("seen-1", "s1", 150.0, False, "lateral", True, 50.0),
    ("seen-2", "s1", 160.0, False, "front", True, 5.0),
    ("front-open", "s2", 300.0, None, "front", None, 10.0),
    ("pano", "s3", 100.0, True, "panoramic", True, None),
    ("loose-1", None, None, False, "front", True, None),
    ("loose-2", "", 900.0, False, "rear", True, 170.0),
]
DDL = "source_id string, sequence_id string, distance_m double, panoramic boolean, view_class string, target_in_fov boolean, heading_error_deg double"


def test_shortlist(spark):
    rows = spark.createDataFrame(ROWS, DDL)
    got = shortlist.shortlist(rows, max_items=9, per_sequence=1).collect()
    assert [(r.rank, r.tier, r.source_id) for r in got] == [(1, 0, "seen-1"), (2, 0, "loose-2"), (3, 0, "loose-1"), (4, 1, "front-open"), (5, 2, "pano")]
    assert [r.source_id for r in shortlist.shortlist(rows, max_items=2, per_sequence=2).collect()] == ["seen-1", "seen-2"]
    for bad in ({"max_items": 0}, {"per_sequence": -1}):
        with pytest.raises(ValueError):
            shortlist.shortlist(rows, **bad)
    plan = shortlist.shortlist(rows)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "TakeOrderedAndProject" in plan


def test_radius_is_inclusive_and_rounded(spark):
    rows = fixtures.typed_items(spark, SF)
    some = survey.candidates(rows, fixtures.TARGET).orderBy("distance_m").first()
    assert survey.candidates(rows, survey.Target(fixtures.TARGET.latitude, fixtures.TARGET.longitude, some.distance_m)).count() == 1
    with pytest.raises(ValueError):
        survey.Target(0.0, 0.0, 0.0)
    plain, pushed = (survey.candidates(rows, fixtures.TARGET, prefilter=p).count() for p in (False, True))
    assert plain == pushed


def test_page_size_does_not_matter(spark):
    a, b = (survey.survey(fixtures.json_pages(spark, SF, page=p), fixtures.TARGET, limit=None).select("source_id") for p in (7, 1000))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_documents_round_trip(spark, tmp_path):
    rows = survey.ordered(survey.candidates(fixtures.typed_items(spark, SF), fixtures.TARGET)).limit(50)
    text = documents.to_text(documents.survey_document(rows, fixtures.TARGET, license_id="é"))
    assert text == documents.to_text(documents.survey_document(rows, fixtures.TARGET, license_id="é"))
    doc = json.loads(text)
    assert doc["schema_version"] == 2 and doc["candidate_count"] == 50 and doc["candidates"][0]["width"] is None and "é" in text and text.endswith("}\n")
    path = str(tmp_path / "s.json")
    documents.write_text(path, text)
    back = recorded.survey_document(spark, path)
    assert back.count() == 50 and shortlist.shortlist(back).count() == shortlist.shortlist(rows).count()
    documents.write_text(path, "{}")
    with pytest.raises(ValueError):
        recorded.survey_document(spark, path)


def test_preview_outcomes(spark, tmp_path):
    top = spark.createDataFrame([(r, f"id/{r}", None, 1.5, "front", True, 2.0, None, u) for r, u in enumerate(["https://h/1", "ftp://h", None, "https://h/4", "https://h/5", "https://h/6", "https://h/7", "https://h/8", "https://h/9"], 1)], "rank int, " + ", ".join(f"{c} {t}" for c, t in zip(preview.CARRIED, "string string double string boolean double string string".split())))
    good = '{"assets":{"thumb":{"href":"https://t"}}}'
    answers = spark.createDataFrame(
        [(1, 200, good, 200, "image/png; a", b"abc"), (4, 500, "", None, None, None), (5, 200, "[]", None, None, None), (6, 200, "{}", None, None, None), (7, 200, good, 404, None, None), (8, 200, good, 200, "text/html", b""), (9, 200, "{bad", None, None, None)],
        "rank int, item_status int, item_body string, thumb_status int, content_type string, content binary",
    )
    got = {r["rank"]: r for r in preview.judge(top, answers).collect()}
    assert got[1].status == "downloaded" and got[1].local_file == "thumbnails/01_id1.png" and got[1].bytes == 3 and got[1].content_type == "image/png"
    want = {2: "source_url", 3: "source_url", 4: "status 500", 5: "no JSON object", 6: "names no thumbnail", 7: "fetching the thumbnail failed", 8: "no image", 9: "not valid JSON"}
    assert all(w in got[k].error for k, w in want.items())
    m = documents.write_preview(preview.judge(top, answers), str(tmp_path), source="s", max_items=9, per_sequence=4)
    assert (m["selected_count"], m["downloaded_count"], m["failed_count"]) == (9, 1, 8)
    assert (tmp_path / "thumbnails/01_id1.png").read_bytes() == b"abc"
    page = (tmp_path / "index.html").read_text()
    assert page.count("<figure>") == 9 and page.index("<b>1</b>") < page.index("<b>2</b>")


def fake(answers):
    def ask(method, url, body, timeout, most):
        status, text = answers[(method, url.split("?")[0] if "search" in url else url)]
        return status, {"Content-Type": "image/png"}, text if isinstance(text, bytes) else text.encode()

    return ask


def test_search_follows_links_and_stops():
    page = lambda ids, link=None: json.dumps({"features": [{"id": i} for i in ids], "links": [link] if link else []})
    a = {("GET", "https://e/search"): (200, page(["a"], {"rel": "next", "href": "/p2", "method": "post", "body": {"t": 1}})), ("POST", "https://e/p2"): (200, page(["b"], {"rel": "next", "href": "https://e/p2", "method": "POST", "body": {"t": 1}}))}
    assert [n for n, _ in http.search_pages(fake(a), "https://e/", 1.0, 2.0, 10.0, limit=5)] == [0, 1]
    assert [n for n, _ in http.search_pages(fake(a), "https://e", 1.0, 2.0, 10.0, limit=1)] == [0]
    for bad in ('{"features":5}', "[]", "{"):
        with pytest.raises(http.ProviderError):
            list(http.search_pages(fake({("GET", "https://e/search"): (200, bad)}), "https://e", 1.0, 2.0, 10.0, limit=5))
    away = {("GET", "https://e/search"): (200, page([], {"rel": "next", "href": "https://other/x"}))}
    with pytest.raises(http.ProviderError):
        list(http.search_pages(fake(away), "https://e", 1.0, 2.0, 10.0, limit=5))


def test_provider_documents():
    ok = {("GET", "https://e/configuration"): (200, '{"license":"x"}'), ("GET", "https://e"): (500, "")}
    assert http.provider_documents(fake(ok), "https://e/") == ('{"license":"x"}', None)
    with pytest.raises(http.ProviderError):
        http.provider_documents(fake(ok | {("GET", "https://e/configuration"): (200, "{}")}), "https://e")


def test_data_source_and_fetch(spark):
    from kerbsight.sources import http as module

    class Recorded(module.SearchSource):
        ask = staticmethod(lambda method, url, body, timeout, most: (200, {}, b'{"features":[{"id":"a"}]}'))

    spark.dataSource.register(Recorded)
    rows = spark.read.format("picture_search").options(latitude=1, longitude=2, radius_m=5).load()
    assert rows.collect()[0].page_no == 0
    top = spark.createDataFrame([(1, "https://h/1"), (2, "nope")], "rank int, source_url string")

    def ask(method, url, body, timeout, most):
        return 200, {"content-type": "image/png"}, b'{"assets":{"thumb":{"href":"https://t"}}}'

    got = {r["rank"]: r for r in module.fetch(top, ask=ask).collect()}
    assert got[1].thumb_status == 200 and got[1].content_type == "image/png" and got[2].item_status is None


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from kerbsight import cli

    pages = tmp_path / "pages"
    pages.mkdir()
    (pages / "0.json").write_text('{"features":[{"id":"a","geometry":{"coordinates":[6.0,45.0]},"properties":{"view:azimuth":0}}]}')
    site = tmp_path / "site.toml"
    site.write_text("latitude = 45.001\nlongitude = 6.0\n")
    out = tmp_path / "o/s.json"
    assert cli.main(["survey", "--site", str(site), "--pages", str(pages), "--output", str(out)]) == 0
    assert f"{out}: " in capsys.readouterr().out
    assert json.loads(out.read_text())["candidates"][0]["view_class"] == "front"
    assert cli.main(["survey", "--pages", str(pages)]) == 2
    assert cli.main(["survey", "--lat", "1", "--lon", "1", "--radius-m", "0", "--pages", str(pages)]) == 2
    assert cli.main(["preview", "--survey", str(tmp_path / "no.json"), "--output-dir", str(tmp_path)]) == 2
    assert "failed" in capsys.readouterr().err


def test_registered_names():
    assert set(Q.ORACLES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert F is not None


def test_search_past_the_page_cap_is_an_error(monkeypatch):
    monkeypatch.setattr(http, "MAX_PAGES", 3)

    def ask(last):
        def get(method, url, body, timeout, most):
            n = int(url.rsplit("/", 1)[1]) if "/p/" in url else 0
            links = [{"rel": "next", "href": f"/p/{n + 1}"}] if n < last else []
            return 200, {}, json.dumps({"features": [{"id": str(n)}], "links": links}).encode()

        return get

    assert [n for n, _ in http.search_pages(ask(2), "https://e", 1.0, 2.0, 10.0, limit=50)] == [0, 1, 2]
    assert [n for n, _ in http.search_pages(ask(9), "https://e", 1.0, 2.0, 10.0, limit=3)] == [0, 1, 2]
    with pytest.raises(http.ProviderError):
        list(http.search_pages(ask(9), "https://e", 1.0, 2.0, 10.0, limit=50))


def reads_once(df):
    """Pages are read for their ids and for their features, and neither again: no second shortlist, no sorted survey below it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Scan parquet") == 2 and "rangepartitioning" not in plan


def test_preview_results_read_the_pages_once(spark):
    assert reads_once(Q.preview_results(spark, SF))


def test_manifest_counts_read_the_pages_once(spark):
    assert reads_once(Q.manifest_counts(spark, SF))


def test_gallery_cards_read_the_pages_once(spark):
    assert reads_once(Q.gallery_cards(spark, SF))


def test_first_places_are_never_broadcast(spark):
    found = survey.of_pages(fixtures.json_pages(spark, SF), fixtures.TARGET, limit=None)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_only_features_within_the_radius_are_typed_and_exchanged(spark):
    found = survey.of_pages(fixtures.json_pages(spark, SF), fixtures.TARGET, limit=None)
    _, below = found._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(place", 1)
    assert "distance_m" in below.split("\n", 1)[1].split("Exchange hashpartitioning(page_no", 1)[0]


def test_first_wins_even_outside_the_radius(spark):
    at = lambda i, lat, more="": f'{{"id":{json.dumps(i)},"geometry":{{"coordinates":[6.0,{lat}]}}{more}}}'
    pages = [
        (0, '{"features":[' + ",".join([at("far-first", 50.0), at("near-first", 45.0), at("blank", '" 45.0 "'), at(" ", 45.0), at("lost", '"x"')]) + "]}"),
        (1, '{"features":[' + ",".join([at("far-first", 45.0), at("near-first", 50.0), at("edge", 45.0, ',"links":[{"rel":"self","href":"https://h/e"}]'), at("lost", 45.0)]) + "]}"),
    ]
    found = survey.of_pages(spark.createDataFrame(pages, "page_no long, body string"), survey.Target(45.0, 6.0, 10.0), limit=None)
    assert {(r.source_id, r.latitude, r.source_url.rsplit("/", 1)[1]) for r in found.collect()} == {("near-first", 45.0, "near-first"), ("blank", 45.0, "blank"), ("edge", 45.0, "e")}


def test_pages_are_parsed_once_for_each_use(spark):
    rows = survey.shredded(spark.createDataFrame([(0, '{"features":[{"id":1}]}')], "page_no long, body string"), stac.FEATURE_ID)
    generated = [line for line in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "posexplode" in line]
    assert len(generated) == 1 and generated[0].count("features,ArrayType(StructType(StructField(id") == 1


def test_tiers_do_not_repeat_the_bearing(spark):
    found = survey.candidates(fixtures.typed_items(spark, SF), fixtures.TARGET)
    plans = [rows._jdf.queryExecution().executedPlan().toString().upper().count("ATAN2(") for rows in (found, shortlist.tiered(found))]
    assert plans[0] == plans[1] > 0
