"""The command line, end to end on a hand-made run."""

from __future__ import annotations

import pytest

from jobtide.__main__ import main


def test_commands(spark, three_sources, tmp_path, capsys):
    folders = {name: str(tmp_path / name) for name in ("responses", "raw", "marts")}
    three_sources.write.parquet(folders["responses"])
    raw, marts = ["--raw", folders["raw"]], ["--marts", folders["marts"]]

    assert main(["check", *raw, *marts], spark) == 1
    assert "passed=0, failed=0, error=9" in capsys.readouterr().out
    assert main(["land", *raw, "--responses", folders["responses"], "--source", "remotive"], spark) == 0
    assert capsys.readouterr().out == "remotive\t1\tsucceeded\t1 of 2 requests, 2 postings in 1 payload(s)\n"
    assert main(["run", *raw, *marts, "--responses", folders["responses"]], spark) == 0
    printed = capsys.readouterr().out
    assert "adzuna\t1\tsucceeded\t" in printed and "remotive" not in printed
    assert main(["build", *raw, *marts, "--select", "mart_companies"], spark) == 0
    assert capsys.readouterr().out == "mart_companies\n"
    assert main(["check", *raw, *marts], spark) == 0
    assert "passed=9, failed=0, error=0" in capsys.readouterr().out
    assert main(["check", "--models", *raw, *marts], spark) == 0
    assert "passed=10, failed=0, error=0" in capsys.readouterr().out


def test_unknown_source_is_refused(spark):
    with pytest.raises(SystemExit):
        main(["land", "--raw", "r", "--responses", "s", "--source", "nosuch"], spark)
