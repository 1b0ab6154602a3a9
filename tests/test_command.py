import pytest

from foliomill.__main__ import main
from foliomill.plans.all import QUERIES


def test_list(capsys):
    assert main(["list"]) == 0
    assert capsys.readouterr().out.split() == sorted(QUERIES)


def test_run_writes_the_rows_of_a_query(spark, sf, tmp_path):
    out = str(tmp_path / "out")
    assert main(["run", "type_counts", sf, out, "--format", "json"]) == 0
    assert spark.read.json(out).count() == QUERIES["type_counts"](spark, sf).count()


def test_unknown_names_are_refused(sf, tmp_path):
    with pytest.raises(SystemExit):
        main(["run", "no_such_query", sf, str(tmp_path / "out")])
