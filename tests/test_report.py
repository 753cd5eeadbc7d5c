"""Recalibration reports: golden lines, the round trip through files, and forbidden rows."""

import pytest

from lociframe.sources import report

SCHEMA = "rg string, qual int, covariate string, value string, observations long, errors long"
ROWS = [("rg1", 30, "Quality", "", 1000, 3), ("rg1", 9, "Quality", "", 50, 5), ("rg1", 30, "Cycle", "-2", 400, 1), ("rg1", 30, "Cycle", "10", 600, 2), ("rg1", 30, "Context", "AC", 900, 3), ("7", 20, "Quality", "", 10, 0)]


def test_report_round_trip(spark, tmp_path):
    tables = spark.createDataFrame(ROWS, SCHEMA)
    quantized = spark.createDataFrame([(q, q * 10, min(q, 40)) for q in range(94)], "quality int, observations long, quantized int")
    lines = report.report_lines(tables, {"no_standard_covs": "false", "quantizing_levels": 16}, quantized)
    lines.select("value").write.text(str(tmp_path / "r"))
    rows = report.report_rows(spark, str(tmp_path / "r"))
    assert sorted(map(tuple, report.report_tables(rows).collect())) == sorted(ROWS)
    assert report.report_arguments(rows) == {"no_standard_covs": "false", "quantizing_levels": "16"}
    assert report.report_quantized(rows) == [min(q, 40) for q in range(94)]


def test_report_lines(spark):
    text = [r["value"] for r in report.report_lines(spark.createDataFrame(ROWS, SCHEMA)).collect()]
    assert text[:3] == ["#:GATKReport.v1.1:5", "#:GATKTable:6:2:%s:%s:%.4f:%.4f:%d:%.2f:;", "#:GATKTable:RecalTable0:"]
    at = text.index("#:GATKTable:RecalTable2:")
    assert text[at - 1] == "#:GATKTable:8:3:%s:%d:%s:%s:%s:%.4f:%d:%.2f:;"
    assert text[at + 1] == "ReadGroup  QualityScore  CovariateValue  CovariateName  EventType  EmpiricalQuality  Observations  Errors"
    # values go by their text
    assert [x.split()[:4] for x in text[at + 2 : at + 5]] == [["rg1", "30", "-2", "Cycle"], ["rg1", "30", "10", "Cycle"], ["rg1", "30", "AC", "Context"]]
    assert text[at + 2].endswith("           400    1.00") and text[at + 2].startswith("rg1                  30              -2  Cycle          M        ")
    assert text[at + 5] == ""
    first = text.index("#:GATKTable:RecalTable0:")
    assert text[first + 2].startswith("        7  M  ")


def test_report_of_no_rows(spark):
    text = [r["value"] for r in report.report_lines(spark.createDataFrame([], SCHEMA)).collect()]
    assert len(text) == 13 and text[1] == "#:GATKTable:6:0:%s:%s:%.4f:%.4f:%d:%.2f:;"


def test_report_errors(spark, tmp_path):
    bad = "#:GATKTable:8:1:%s:;\n#:GATKTable:RecalTable2:\nReadGroup  QualityScore\nrg1  30  AC  {}  {}  30.0  5  1.00\n"
    for name, event in (("Context", "I"), ("Homopolymer", "M")):
        path = tmp_path / name
        path.write_text(bad.format(name, event).replace("ReadGroup  QualityScore\n", ""))
        with pytest.raises(Exception, match="bad report row"):
            report.report_tables(report.report_rows(spark, str(path))).collect()
    path = tmp_path / "args"
    path.write_text("#:GATKTable:Arguments:x\nArgument  Value\nno_standard_covs  true\n\n#:GATKTable:Other:\nA  B\n1  2\n")
    rows = report.report_rows(spark, str(path))
    assert rows.count() == 1
    with pytest.raises(ValueError, match="standard covariates"):
        report.report_arguments(rows)
    with pytest.raises(ValueError, match="quality 0"):
        report.report_quantized(rows)
