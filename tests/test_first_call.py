"""Order operators as the first call of a fresh session, on frames that were never stored."""

import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SETUP = """
import sys, tempfile
sys.path.insert(0, {here!r})
from roadpulse.session import local_session
spark = local_session(2, memory="1g", spark__checkpoint__dir=tempfile.mkdtemp())
ids = spark.createDataFrame([("TEU2_Det0",), ("TEU1_Det1",), ("TEU1_Det0",), ("TEU1_Det2",)], "det_id string")
values = spark.createDataFrame([(float(i % 7),) for i in range(40)], "vkfz double")
"""
CALLS = {
    "node_index": "from roadpulse.operators.axes import node_index; assert node_index(ids).count() == 4",
    "siblings": "from roadpulse.operators.eda import sibling_detectors; assert sibling_detectors(ids).count() == 3",
    "quantiles": "from roadpulse.operators.ordering import exact_quantiles as q; assert q(values, ['vkfz'], [0.5]).first()['value'] == 3.0",
    "drift": "from roadpulse.operators.evaluate import feature_drift as f; assert f(values, values, ['vkfz']).first()['ks'] == 0.0",
}


@pytest.mark.parametrize("name", list(CALLS))
def test_first_call_of_a_session(name):
    done = subprocess.run([sys.executable, "-c", SETUP.format(here=HERE) + CALLS[name]], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]
