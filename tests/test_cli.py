from quarry import cli


def test_cli_list(capsys):
    cli.main(["list"])
    out = capsys.readouterr().out
    assert "items_without_detail_ranked" in out and "cheapest_path" in out


def test_cli_show(spark, capsys, sf001):
    cli.main(["show", "distinct_rows", "--sf", sf001, "-n", "3"])
    assert "l_returnflag" in capsys.readouterr().out
