"""Parameter validation and the zero cap."""

import pytest

from bitlake.plans.store import BitStore
from bitlake.spec import IdConfig, LogSpec, ScanConfig
from bitlake.streaming.load import run_load

from golden import LINES, write


def test_validation():
    with pytest.raises(ValueError):
        ScanConfig(nodes_total=0)
    with pytest.raises(ValueError):
        ScanConfig(node_id=2, nodes_total=2)
    with pytest.raises(ValueError):
        ScanConfig(max_files=-1)
    with pytest.raises(ValueError):
        IdConfig(owner=1, n_owners=1)
    with pytest.raises(ValueError):
        IdConfig(shard_width=0)
    with pytest.raises(ValueError):
        LogSpec().check_field("nofield")
    with pytest.raises(TypeError):
        LogSpec().check_field(3)
    assert LogSpec().min_positions == 5


def test_zero_cap_loads_nothing(spark, tmp_path):
    root = write(str(tmp_path / "pixel"), LINES)
    store = BitStore(spark, str(tmp_path / "store"))
    assert run_load(spark, store, root=root, scan=ScanConfig(max_files=0), until_done=True) == []
    assert store.marks().count() == 0 and store.facts().count() == 0
