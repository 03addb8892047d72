"""Report sets are written as tables and read back; their totals agree with each other."""

import pytest

from loadlens.operators import audit
from loadlens.plans import reports
from loadlens.sources import star


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return star.scored(spark, sf_dir).cache()


def test_high_rate_reports_agree(spark, scored, tmp_path):
    folder = str(tmp_path)
    reports.write_reports(reports.high_rate_reports(scored), folder, "parquet")
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    total = scored.count()
    assert sum(r["count"] for r in read("rate_segments").collect()) == total
    assert sum(r["count"] for r in read("quote_signal_analysis").collect()) == total
    high = {
        name: sum(r["high_rate_loads"] for r in read(name).collect())
        for name in (
            "high_rate_equipment", "high_rate_monthly", "high_rate_distance", "high_rate_routes",
            "high_rate_pickups", "high_rate_deliveries",
        )
    }
    assert len(set(high.values())) == 1 and high["high_rate_equipment"] > 0


def test_error_reports_agree(spark, scored, tmp_path):
    folder = str(tmp_path)
    chosen = reports.error_reports(scored)
    names = ("overall", "equipment_error", "distance_error", "monthly_error")
    reports.write_reports({n: chosen[n] for n in names}, folder, "csv")
    frames = {n: spark.read.csv(f"{folder}/{n}", header=True, inferSchema=True).collect() for n in names}
    total, mae = frames["overall"][0]["count"], frames["overall"][0]["MAE"]
    for n in names[1:]:
        assert sum(r["count"] for r in frames[n]) == total
        assert sum(r["count"] * r["MAE"] for r in frames[n]) / total == pytest.approx(mae)


def test_one_scan_equals_the_single_reports(scored):
    got = audit.one_scan(scored)
    single = {
        "shape": audit.profile_shape, "columns": audit.profile_columns, "missing": audit.missing_report,
        "infinite": audit.infinite_report, "signs": audit.sign_report, "dates": audit.date_range,
    }
    for name, report in single.items():
        want = report(scored)
        assert got[name].columns == want.columns and got[name].collect() == want.collect(), name


def test_every_report_runs(scored, spark, sf_dir):
    from loadlens.sources.star import submission

    sets = [
        reports.audit_reports(scored),
        reports.exploration_reports(scored),
        reports.submission_reports(submission(spark, sf_dir)),
    ]
    for name, df in {k: v for s in sets for k, v in s.items()}.items():
        assert df.count() > 0 or name == "infinite", name
