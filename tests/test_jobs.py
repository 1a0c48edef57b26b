from __future__ import annotations

import uuid
from pathlib import Path

import pytest

import lumberline as ll
from lumberline.__main__ import main, show


def test_the_whole_way_on_the_command_line(spark, folder, capsys):
    table = f"logs_{uuid.uuid4().hex}.parsed_logs"
    main(["synth", folder("raw"), "--files", "2", "--lines-per-file", "500"])
    main(["parse", folder("raw"), folder("json"), "--recursive"])
    main(["clean", folder("raw"), folder("clean"), "--recursive", "--without-level", "INFO"])
    main(["register", table, folder("json")])
    main(["stream", folder("raw"), folder("streamed"), "--recursive", "--once",
          "--checkpoint", folder("state")])
    logs = spark.table(table)
    assert logs.count() == 1000 == ll.read_parsed_logs(spark, folder("streamed")).count()
    assert ll.read_clean_logs(spark, folder("clean")).count() == logs.filter("level <> 'INFO'").count()

    capsys.readouterr()
    main(["tables", table.split(".")[0]])
    assert "parsed_logs" in capsys.readouterr().out
    main(["counts", table])
    assert "E2001" in capsys.readouterr().out
    main(["preview", table])
    assert capsys.readouterr().out.count("2024-01-01") == 10
    main(["query", f"SELECT count(*) AS n FROM {table}"])
    assert "1000" in capsys.readouterr().out
    main(["query", f"SELECT count(*) AS n FROM {table};", "--store", folder("results")])
    stored = capsys.readouterr().out.strip()
    assert ll.read_result(spark, stored, "n bigint").first().n == 1000
    with pytest.raises(ll.QueryRefused):
        main(["query", f"DROP TABLE {table}"])


def test_days_streams_and_kept_results_on_the_command_line(spark, folder, capsys):
    table = f"logs_{uuid.uuid4().hex}.clean_logs"
    raw, clean = folder("raw"), folder("clean")
    Path(raw).mkdir()
    lines = [f"2024-01-0{d} 00:00:00, ERROR: x, (E{d})" for d in (1, 2, 3)]
    Path(raw, "1.log").write_text("\n".join([*lines, "9999-99-99 00:00:00, INFO: x"]))
    for _ in range(2):
        main(["clean", raw, clean, "--mode", "replace"])
    main(["register", table, clean, "--format", "parquet", "--partition-by", "day"])
    assert spark.table(table).count() == 4
    Path(raw, "1.log").write_text("2024-01-04 00:00:00, ERROR: x, (E4)\n2024-01-05 00:00:00, ERROR: x, (E5)")
    main(["clean", raw, clean, "--mode", "replace"])
    main(["add-days", table, "2024-01-04", "none"])
    assert spark.table(table).count() == 5

    capsys.readouterr()
    main(["query", f"SELECT count(*) AS n FROM {table}", "--keep", folder("kept")])
    id = capsys.readouterr().out.strip()
    main(["result", folder("kept"), id])
    assert capsys.readouterr().out.split() == ["n", "5"]
    main(["results", folder("kept")])
    assert id in capsys.readouterr().out

    main(["stream-counts", raw, folder("counts"), "--checkpoint", folder("state"), "--once", "--bucket", "1 day"])
    main(["stream-result", folder("counts"), "--checkpoint", folder("state")])
    assert capsys.readouterr().out.count("ERROR\t1") == 2
    main(["stream-result", folder("counts"), "--checkpoint", folder("state"), "--kind", "late"])
    assert len(capsys.readouterr().out.splitlines()) == 1

    main(["parse", raw, folder("json")])
    with open(next(Path(folder("json")).glob("*.json")), "a") as file:
        file.write('{"timestamp": "torn')
    next(Path(folder("json")).glob(".*.json.crc")).unlink()
    main(["mend", folder("json"), folder("mended")])
    assert ll.read_parsed_logs(spark, f"{folder('mended')}/kind=whole").count() == 2


def test_results_are_printed_whole(spark, capsys):
    show(spark.range(1500).selectExpr("concat('E', id) AS id", "id AS count"))
    assert capsys.readouterr().out.splitlines() == ["id\tcount", *(f"E{k}\t{k}" for k in range(1500))]
    show(spark.range(1500), 3)
    assert len(capsys.readouterr().out.splitlines()) == 4
