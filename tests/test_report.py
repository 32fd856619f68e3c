import json

from tempestry.__main__ import main
from tempestry.operators.harm import harm_by_event_type
from tempestry.operators.ranking import top_k
from tempestry.plans.report import reports
from tempestry.plans.rollup import event_rollup
from tempestry.sources import write_csv

from checks.storm_view import storm

SF_DIR = "/root/testdata/sf0.001"


def test_consolidated_job_from_csv(spark, tmp_path):
    events = storm(spark, SF_DIR)
    write_csv(events, str(tmp_path / "in"))
    main([str(tmp_path / "in"), str(tmp_path / "out"), "--trees", "5", "--depth", "3"])

    def report(name):
        return spark.read.csv(str(tmp_path / "out" / name), header=True, inferSchema=True)

    expected = top_k(harm_by_event_type(events), "total_harm", ["EVENT_TYPE"]).collect()
    assert report("reports/top_harm_by_event_type").collect() == expected
    for name in reports(event_rollup(events)):
        assert report(f"reports/{name}").count() > 0
    split_sizes = [
        spark.read.parquet(str(tmp_path / f"out/model/features/split={s}")).count()
        for s in ("train", "validation", "test")
    ]
    classes = report("model/class_distribution").collect()
    assert sum(split_sizes) == sum(r.event_count for r in classes)
    assert report("model/confusion_matrix").groupBy().sum("event_count").head()[0] == split_sizes[2]
    (record,) = (
        json.loads(line)
        for file in (tmp_path / "out/model/results").glob("*.json")
        for line in file.read_text().splitlines()
    )
    assert set(record) == {
        "test_auc", "test_accuracy", "val_auc", "val_accuracy", "storm_importance",
        "location_importance", "event_type_importance", "state_importance",
        "magnitude_importance", "event_count_importance",
    }


def test_consolidated_job_from_parquet(spark, tmp_path):
    storm(spark, SF_DIR).write.parquet(str(tmp_path / "in"))
    main([str(tmp_path / "in"), str(tmp_path / "out"), "--parquet", "--no-model"])
    assert not (tmp_path / "out/model").exists()
    assert spark.read.parquet(str(tmp_path / "out/reports/rollup")).count() > 0
