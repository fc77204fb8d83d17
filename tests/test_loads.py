import json
import os

from pyspark.sql import functions as F

from meridian.operators import specs as sp
from meridian.plans import loads
from meridian.plans.derived import xlsx_bytes, zip_archive
from meridian.sinks import landing
from meridian.sources import raw
from meridian.streaming.drop_folder import land_csv_stream


def _put(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb" if isinstance(data, bytes) else "w") as fh:
        fh.write(data)


def _catalog_entry(dataset_id, *years):
    return {"identifier": f"https://x/data-api/v1/dataset/{dataset_id}/data-viewer", "distribution": [
        {"mediaType": "text/csv", "downloadURL": f"https://files/{dataset_id}/y{y}.csv?v=1", "temporal": f"{y}-01-01/{y}-12-31"} for y in years]}


def test_run_all_end_to_end(spark, tmp_root):
    store = tmp_root.replace("file:", "") + "/store"
    spark.createDataFrame([("x", 0, json.dumps([{"id": "1"}, {"id": "2"}])), ("x", 1000, json.dumps([]))],
                          "dataset string, offset bigint, body string").write.parquet(f"{store}/soc/pages")
    meta = {"xubh-q36u": [{"identifier": "live"}, {"identifier": "old"}], "m": [{"downloadURL": "https://f/broken.csv"}],
            "z": [{"format": "pdf", "downloadURL": "https://f/a.pdf"}, {"format": "ZIP", "downloadURL": "https://f/a.zip"}],
            "nourl": [{"format": "csv"}], "gone": [{"downloadURL": "https://f/absent.csv"}]}
    for key, distributions in meta.items():
        _put(f"{store}/_metastore/{key}.json", json.dumps({"distribution": distributions}))
    _put(f"{store}/_catalog/data.json", json.dumps({"dataset": [_catalog_entry("u", 2022, 2023), _catalog_entry("empty")]}))
    spark.createDataFrame([("live", 0, json.dumps({"results": [{"facility_id": "010001"}]})),
                           ("old", 0, json.dumps({"results": [{"facility_id": "999999"}]}))],
                          "dataset string, offset bigint, body string").write.parquet(f"{store}/hosp/pages")
    _put(f"{store}/glossary/glossary.json", json.dumps({"glossary": [{"title": "a", "slug": "a"}, 5]}))
    for key in ("phys", "phys22"):
        _put(f"{store}/{key}/y2022.csv", "npi,n\n0000000022,5\n")
        _put(f"{store}/{key}/y2023.csv", "npi,n\n0123456789,5\n")
    _put(f"{store}/qhp/a.zip", zip_archive({"a.xlsx": xlsx_bytes([(1, ["t"]), (2, ["State Code"]), (3, ["CA"])])}))
    _put(f"{store}/broken/broken.csv", "a\n")
    bulk = {"source": "dkan_data_api_bulk", "description": "p", "group": "g"}
    specs = sp.specs_from_rows(spark, [
        {"key": "soc", "source": "socrata", "description": "s", "group": "g", "dataset_id": "abcd-1234"},
        {"key": "hosp", "source": "dkan_provider_data", "description": "h", "group": "g", "dataset_id": "xubh-q36u"},
        {"key": "glossary", "source": "healthcare_gov", "description": "g", "group": "g", "path": "/api/glossary.json"},
        bulk | {"key": "phys", "dataset_id": "u"}, bulk | {"key": "phys22", "dataset_id": "u", "year": 2022},
        bulk | {"key": "phys99", "dataset_id": "u", "year": 1999}, bulk | {"key": "none", "dataset_id": "empty"},
        bulk | {"key": "lost", "dataset_id": "nowhere"},
        {"key": "qhp", "source": "dkan_healthcare_gov_zip", "description": "q", "group": "g", "dataset_id": "z"},
        {"key": "nozip", "source": "dkan_healthcare_gov_zip", "description": "q", "group": "g", "dataset_id": "m"},
        {"key": "broken", "source": "dkan_medicaid_bulk", "description": "b", "group": "g", "dataset_id": "m"},
        {"key": "nourl", "source": "dkan_open_payments_bulk", "description": "b", "group": "g", "dataset_id": "nourl"},
        {"key": "absent", "source": "dkan_open_payments_bulk", "description": "b", "group": "g", "dataset_id": "gone"},
        {"key": "unfetched", "source": "dkan_open_payments_bulk", "description": "b", "group": "g", "dataset_id": "unfetched"},
        {"key": "bad", "source": "socrata", "description": "b", "group": "g"},
        {"key": "ftp", "source": "ftp", "description": "b", "group": "g", "dataset_id": "x"},
    ])
    rows = {r.key: r for r in loads.run_all(spark, specs, store, tmp_root, "run-1", at_once=3).collect()}
    assert {k: r.status for k, r in rows.items() if r.status != "failed"} == {
        "soc": "landed", "hosp": "landed", "glossary": "landed", "phys": "landed", "phys22": "landed", "qhp": "landed",
        "bad": "invalid", "ftp": "invalid"}
    assert {k: r.message.split(":")[0] for k, r in rows.items() if r.status == "failed"} == {
        "phys99": "year_missing available", "none": "no_csv", "lost": "dataset_not_found", "nozip": "no_zip", "broken": "EmptyExtractError",
        "nourl": "no_url", "absent": "AnalysisException", "unfetched": "metastore_missing"}
    assert rows["phys99"].message == "year_missing available: 2022,2023" and rows["bad"].message == "required dataset_id"
    assert (rows["soc"].row_count, rows["phys"].source_url) == (2, "https://files/u/y2023.csv?v=1")
    assert [r.facility_id for r in raw.read_runs(spark, tmp_root, "cms_hosp").collect()] == ["010001"]
    assert [r.npi for r in raw.read_runs(spark, tmp_root, "cms_phys").collect()] == ["0123456789"]
    assert [r.npi for r in raw.read_runs(spark, tmp_root, "cms_phys22").collect()] == ["0000000022"]
    recorded = {r.asset: r.row_count for r in landing.read_metrics(spark, tmp_root).collect()}
    assert recorded == {rows[k].asset_name: rows[k].row_count for k in rows if rows[k].status == "landed"}
    routed = loads.run_all(spark, specs, store, tmp_root, "run-2", only=("socrata",))
    assert routed.groupBy("status").count().orderBy("status").collect() == [("invalid", 2), ("landed", 1), ("unrouted", 13)]


def test_csv_stream_lands_each_batch_once(spark, tmp_root):
    src = tmp_root.replace("file:", "") + "/drop"
    for i in range(3):
        _put(f"{src}/f{i}.csv", "k,v\n" + "".join(f"{i}{j},{j}\n" for j in range(4)))
    ckpt = tmp_root + "/ckpt"
    land_csv_stream(spark, src, "k string, v bigint", tmp_root, "cms_stream", checkpoint=ckpt, max_files_per_trigger=1)
    land_csv_stream(spark, src, "k string, v bigint", tmp_root, "cms_stream", checkpoint=ckpt)  # nothing new
    runs = raw.read_runs(spark, tmp_root, "cms_stream", with_run_id=True)
    assert runs.count() == 12
    assert runs.select("_run_id").distinct().count() == 3
    assert runs.where(F.col("k") == "01").first().v == 1


def test_static_documents_with_odd_file_names(spark, tmp_path):
    from meridian.sources import static_json

    (tmp_path / "my glossary+1.json").write_text('{"my glossary+1": [{"title": "a"}]}')
    docs = static_json.read_documents(spark, f"{tmp_path}/*.json")
    assert static_json.static_records(docs).count() == 1


def test_static_documents_of_several_lines(spark, tmp_path):
    from meridian.sources import static_json

    (tmp_path / "glossary.json").write_text('{\n  "glossary": [\n    {"title": "a"},\n    {"title": "b"}\n  ]\n}\n')
    assert static_json.static_records(static_json.read_documents(spark, f"{tmp_path}/*.json")).count() == 2
