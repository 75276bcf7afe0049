"""The report run: twelve outputs, one scan of the questions, each equal to its query."""

import os

import pytest
from pyspark.sql import functions as F

from inquirylake import queries
from inquirylake.plans import run
from inquirylake.queries import reports

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("reports"))
    written = run.write(reports.facts(spark, FOLDER), folder)
    return folder, written, run.reports(spark.read.parquet(f"{folder}/_states"), spark.read.parquet(f"{folder}/_facts"))


def test_twelve_outputs_and_one_scan(spark, made, capsys):
    folder, written, frames = made
    assert len(written) == 12 and all(os.path.exists(f"{path}/_SUCCESS") for path in written.values())
    reports.facts(spark, FOLDER).explain("formatted")
    assert capsys.readouterr().out.count("orders.parquet") == 1
    for frame in frames.values():
        frame.explain("formatted")
    assert "orders.parquet" not in capsys.readouterr().out


@pytest.mark.parametrize(
    ("report", "query", "names"),
    [
        ("ministerien", "a10_sla_by_ministry_total", {"ministry": "key"}),
        ("parteien", "a11_sla_by_faction", {}),
        ("abgeordnete", "a12_sla_by_member", {"member": "key"}),
        ("sachgebiete", "a14_topics_reaggregated", {}),
        ("sachgebiete_fraktion", "a15_topics_by_faction_top20", {}),
        ("sachgebiete_zeitreihe", "w1_top3_topics_pivot", {}),
        ("topthemen_zeitreihe", "w2_top5_topics_pivot", {}),
        ("topthemen", "w4_topics_with_ties", {}),
        ("beteiligte", "a16_sla_by_involved_count", {"beteiligte": "key"}),
        ("zeitreihe", "a17_sla_by_month", {}),
        ("uebersicht", "a18_overview_long", {}),
        ("extremwerte", "w5_extremes", {}),
    ],
)
def test_each_equals_its_query(spark, made, report, query, names):
    frame = made[2][report]
    theirs = queries.QUERIES[query](spark, FOLDER).withColumnsRenamed(names)
    columns = [c for c in theirs.columns if c in frame.columns]
    assert len(columns) >= 2 and set(frame.columns) <= {*columns, "rank"}
    shown = lambda df: sorted(repr(tuple(r)) for r in df.select(*(F.col(c).cast("string") for c in columns)).collect())
    assert shown(frame) == shown(theirs)


def test_the_verb_writes_all_reports(spark, tmp_path):
    from inquirylake import cli

    assert cli.main(["report", FOLDER, "--out", str(tmp_path / "o")]) == 0
    assert sum(not n.startswith("_") for n in os.listdir(tmp_path / "o")) == 12
