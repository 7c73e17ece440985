from __future__ import annotations

import os

import pytest

from feedkit.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(os.environ.get("TEST_CPUS", "8"), "feedkit-tests")


@pytest.fixture()
def folder(tmp_path):
    """A fresh folder as a Spark path."""

    def make(name: str) -> str:
        return str(tmp_path / name)

    return make


def rows(df, *order):
    """Rows as plain tuples, sorted."""
    got = [tuple(r) for r in (df.select(*order) if order else df).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))
