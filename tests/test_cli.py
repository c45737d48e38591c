"""The command line runs a query on an existing session's warehouse."""

import os

import pytest

from conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver tables not available")


def test_cli_query_and_checks(spark, capsys):
    from layerstar.__main__ import main
    main(["query", "A7", "--sf", SF_SMALL, "--display", "--rows", "3"])
    out = capsys.readouterr().out
    assert "sales_percentage" in out and "%" in out and "$" in out
    main(["checks", "--sf", SF_SMALL, "--layer", "gold"])
    out = capsys.readouterr().out
    assert "Q25 fact keys" in out
