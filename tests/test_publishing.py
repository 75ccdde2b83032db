"""The file that publishes a run, on a local file system."""

import os

import pytest

from scrapeloom.sources.tables import PUBLISHED, PublicationConflict, Warehouse


def test_a_number_is_given_in_one_step(spark, tmp_path):
    """No checksum file that another writer could overwrite, and nothing left aside."""
    first, late = (Warehouse(spark, str(tmp_path)) for _ in range(2))
    for writer in (first, late):
        writer.begin("r")
    assert first.publish("r") == 1
    with pytest.raises(PublicationConflict):
        late.publish("r")
    assert os.listdir(tmp_path / PUBLISHED) == ["0000000001.json"]
    assert Warehouse(spark, str(tmp_path)).current_run() == "r"
