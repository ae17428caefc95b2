from __future__ import annotations

import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from clearplate.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL


@pytest.fixture(scope="session")
def marts(spark, sf_dir):
    from clearplate.registry.base import marts_of

    return marts_of(spark, sf_dir)


@pytest.fixture(scope="session")
def layer(marts):
    from clearplate.plans.model import semantic_layer

    return semantic_layer(marts, "2001-08-01")
